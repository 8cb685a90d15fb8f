"""A Parquet table that can be changed: copy on write, by versions.

Update and delete find the files that hold a hit (``_metadata.file_path`` of
the rows they match, by the key columns alone), rewrite those and no others,
and publish the swap as one version (``versions.FileTable``): readers see the
table before or after, never between, and of two changes to one file the
second is made again on the first's result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.tables import batch_update, one_update_a_key
from ..plans.sizing import sized
from .versions import Conflict, FileTable

FILES = "path string, n_rows bigint"
TRIES = 10


class ParquetTable:
    """``path`` holds the data files, the log and the schema."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = FileTable(spark, f"{self.path}/_log", FILES)

    @classmethod
    def create(cls, df: DataFrame, path: str) -> "ParquetTable":
        """A new table of the rows; an error if there is one."""
        table = cls(df.sparkSession, path)
        table.log._fs.mkdirs(table.log._path(f"{table.path}/_meta"))
        if not table.log._put(f"{table.path}/_meta/schema.json", df.schema.jsonValue()):
            raise ValueError(f"there is a table at {path}")
        table.log.publish(table._written(df), note="create")
        return table

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self.log._read(f"{self.path}/_meta/schema.json"))

    # ---------------------------------------------------------------- reading

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (by default the newest)."""
        return self._rows([r["path"] for r in self.log.files(version).select("path").collect()])

    def _rows(self, paths: list[str]) -> DataFrame:
        # Names of files are all that comes to the driver, as for every reader of Spark's.
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _written(self, rows: DataFrame) -> DataFrame:
        """Rows as new data files; path and rows of each that has any."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        found = self.spark.read.schema(rows.schema).parquet(folder)
        return found.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n_rows"))

    # --------------------------------------------------------------- changing

    def insert(self, rows: DataFrame) -> int:
        """Append rows; returns their number."""
        new = sized(self._written(rows.select(*self.schema.names)), "inserted")
        self.log.publish(new, note="insert")
        return new.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]

    def update(self, updates: DataFrame, key: str, order: str | None = None, set_null: str | None = None) -> int:
        """Change the rows that ``updates`` hit (``tables.batch_update``);
        returns their number."""
        once = sized(one_update_a_key(updates, key, order), "updates")
        return self._rewrite(lambda rows: rows.join(once.select(key), key, "left_semi"),
                             lambda rows: batch_update(rows, once, key, set_null=set_null), "update")

    def delete(self, where: Column) -> int:
        """Drop the rows for which the condition is true; returns their number."""
        return self._rewrite(lambda rows: rows.filter(where), lambda rows: rows.filter(~F.coalesce(where, F.lit(False))), "delete")

    def delete_by_key(self, key: str, value) -> int:
        """Drop the rows of one key; rows with a null key stay."""
        return self.delete(F.col(key) == F.lit(value))

    def _rewrite(self, hits: Callable[[DataFrame], DataFrame], change: Callable[[DataFrame], DataFrame], note: str) -> int:
        for _ in range(TRIES):
            base = self.log.latest()
            rows = self.read(base).select("*", F.col("_metadata.file_path").alias("_file"))
            touched = hits(rows).groupBy("_file").agg(F.count(F.lit(1)).alias("n")).collect()     # a row a file to be rewritten
            if not touched:
                return 0
            paths = [r["_file"] for r in touched]
            gone = self.spark.createDataFrame([(p,) for p in paths], "path string")
            try:
                self.log.publish(self._written(change(self._rows(paths)).select(*self.schema.names)), gone, note)
                return sum(r["n"] for r in touched)
            except Conflict:
                continue       # another change has rewritten one of these files: again, on its result
        raise Conflict(f"{note} failed {TRIES} times")
