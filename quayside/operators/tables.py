"""Table helpers: page, first row, one cell, count, insert, update, delete,
parameter binding, create-from-schema, exists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sequence import chunked_row_number, sized_chunk

UPDATE_TIME = "updateTime"


def _order(order) -> list:
    return [order] if isinstance(order, (str, Column)) else list(order)


def page(df: DataFrame, order, page_no: int, size: int) -> DataFrame:
    """Rows ``(page_no-1)*size`` .. ``+size`` in ``order`` (1-based pages);
    all rows when either number is not positive.  Spark plans a top-k."""
    d = df.orderBy(*_order(order))
    if page_no > 0 and size > 0:
        return d.offset((page_no - 1) * size).limit(size)
    return d


def find_first(df: DataFrame, order) -> DataFrame:
    return df.orderBy(*_order(order)).limit(1)


def find_by(df: DataFrame, column: str, order, where: Column | None = None) -> DataFrame:
    d = df if where is None else df.filter(where)
    return d.orderBy(*_order(order)).select(column).limit(1)


def count_rows(df: DataFrame, where: Column | None = None, name: str = "n_rows") -> DataFrame:
    d = df if where is None else df.filter(where)
    return d.agg(F.count(F.lit(1)).cast("bigint").alias(name))


def insert_rows(target: DataFrame, rows: DataFrame, key: str, order: str,
                chunk_rows: int = 1 << 20) -> DataFrame:
    """Append ``rows`` with generated keys max(key) + 1, + 2, ... in ``order``
    (an integer column; exact, gap-free numbering without a single-task
    window: chunks are as wide as ``chunk_rows`` rows need on average)."""
    top = target.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    numbered = chunked_row_number(rows, [], [order], sized_chunk(rows, order, chunk_rows), "_rn")
    new = numbered.withColumn(key, (top + F.col("_rn")).cast(target.schema[key].dataType)).drop("_rn")
    return target.unionByName(new.select(*target.columns))


def one_update_a_key(updates: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """``updates`` with one row for each key: the last by ``order``; without
    an order a repeated key is an error (raised when the rows are read)."""
    row = F.struct(*updates.columns)
    if order is not None:
        return updates.groupBy(key).agg(F.max_by(row, order).alias("u")).select("u.*")
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.concat(F.lit("two updates of key "), F.col(key).cast("string"))).cast(T.StructType(updates.schema.fields)))
    return updates.groupBy(key).agg(one.otherwise(F.first(row)).alias("u")).select("u.*")


def batch_update(target: DataFrame, updates: DataFrame, key: str, order: str | None = None,
                 set_null: str | None = None) -> DataFrame:
    """Rewrite ``target`` with the values of ``updates`` (by key).  A null
    leaves a value alone, unless the column's name stands in the update's
    ``set_null`` column (array of names).  Two updates of a key: the last by
    ``order``, else an error."""
    changed = [c for c in updates.columns if c in target.columns and c != key]
    u = one_update_a_key(updates, key, order)
    names = F.col(set_null) if set_null else F.lit(None).cast("array<string>")
    u = u.select(key, F.lit(True).alias("_hit"), F.coalesce(names, F.array().cast("array<string>")).alias("_null"),
                 *[F.col(c).alias(f"_u_{c}") for c in changed])
    j = target.join(u, key, "left")
    new = {c: F.when(F.coalesce(F.array_contains("_null", c), F.lit(False)), F.lit(None)).otherwise(F.coalesce(F.col(f"_u_{c}"), F.col(c))) for c in changed}
    return j.select(*[new[c].cast(target.schema[c].dataType).alias(c) if c in new else F.col(c) for c in target.columns])


def updated_count(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """One row, ``n_affected``: the rows of ``target`` that an update hits."""
    return target.join(updates.select(key).distinct(), key, "left_semi").agg(F.count(F.lit(1)).alias("n_affected"))


def delete_by_key(df: DataFrame, key: str, value) -> DataFrame:
    """Drop rows whose key equals ``value``; rows with a null key stay."""
    return df.filter(~F.col(key).eqNullSafe(F.lit(value)))


def deleted_count(df: DataFrame, key: str, value) -> DataFrame:
    """One row: ``n_affected`` rows go, ``exactly_one`` tells a clean delete."""
    hit = df.filter(F.col(key) == F.lit(value)).agg(F.count(F.lit(1)).alias("n_affected"))
    return hit.select("n_affected", (F.col("n_affected") == 1).alias("exactly_one"))


def param_query(spark: SparkSession, sql: str, args: list | dict, **frames) -> DataFrame:
    """Positional (``?``) or named (``:x``) parameters, bound by Spark;
    ``{name}`` in the text refers to a DataFrame passed as a keyword."""
    return spark.sql(sql, args=args, **frames)


def struct_from_bean_types(fields: dict[str, str]) -> T.StructType:
    """Bean field types (string, int, long, float, double, boolean, date,
    enum) -> a Spark schema; unknown types become strings."""
    from ..schemas import TYPE_MAP

    return T.StructType([T.StructField(n, TYPE_MAP.get(t.lower(), T.StringType())) for n, t in fields.items()])


def create_table_ddl(name: str, schema: T.StructType, key: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` from a schema plus an ``updateTime``
    column; a surrogate ``id`` when no key is given."""
    cols = []
    if key is None:
        cols.append("id BIGINT")
    for f in schema.fields:
        cols.append(f"`{f.name}` {f.dataType.simpleString().upper()}")
    cols.append(f"{UPDATE_TIME} TIMESTAMP")
    return f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(cols)}) USING parquet"


def append_generated(spark: SparkSession, name: str, rows: DataFrame, order: str) -> None:
    """Append ``rows`` to a created table, its ``id`` generated from the
    largest one on and ``updateTime`` filled."""
    table = spark.table(name)
    top = table.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    numbered = chunked_row_number(rows, [], [order], sized_chunk(rows, order), "_rn")
    new = with_update_time(numbered.withColumn("id", (F.lit(top) + F.col("_rn")).cast("bigint")))
    new.select(*table.columns).write.mode("append").insertInto(name)


def create_table(spark: SparkSession, name: str, schema: T.StructType, key: str | None = None) -> None:
    spark.sql(create_table_ddl(name, schema, key))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def with_update_time(df: DataFrame) -> DataFrame:
    return df.withColumn(UPDATE_TIME, F.current_timestamp())


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, batch_size: int = 1000) -> None:
    """Batch insert through Spark's JDBC writer."""
    df.write.option("batchsize", str(batch_size)).jdbc(url, table, mode="append", properties=properties)
