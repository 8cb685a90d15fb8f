"""Text sinks: plain and compressed, partitioned by bucket.

Spark's file sink writes every file under a temporary name and publishes a
job's files at commit (``_SUCCESS`` for batch, ``_spark_metadata`` for
streams), which replaces the old write-``.tmp``-then-rename dance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codecs import resolve_codec_py
from ..plans.sizing import clustered, sized

PARTITION_COLUMNS = ["d", "h"]


ORDER = ("partition", "offset")


def write_text(df: DataFrame, path: str, text_col: str = "text", codec: str | None = None,
               partition_by: list[str] = PARTITION_COLUMNS, mode: str = "append",
               max_records_per_file: int | None = None, order: tuple[str, ...] = ORDER,
               dynamic_overwrite: bool = False, cluster: str = "rebalance") -> None:
    """Land one text column, one line per record (``\\n`` separated), in the
    order of the ``order`` columns that ``df`` has.

    ``cluster`` says how rows meet their bucket's writer:

    * ``"rebalance"`` (batch, replays of history): a bucket's rows come
      together; a hot bucket is cut over several tasks, whose files follow
      each other in order.
    * ``"none"`` (live micro-batches): no shuffle.  A micro-batch of one
      Kafka partition spans one or two hours, so each task already writes
      about one file per bucket; compaction merges completed hours later.

    Inside a task rows are sorted by bucket and order, so one writer is open
    at a time and lines keep their order in each file.
    """
    spark_codec = resolve_codec_py(codec) if codec else None
    d = prepare_for_write(df, text_col, partition_by, order, cluster)
    w = d.write.mode(mode).partitionBy(*partition_by)
    if spark_codec:
        w = w.option("compression", spark_codec)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.text(path)


def prepare_for_write(df: DataFrame, text_col: str = "text", partition_by: list[str] = PARTITION_COLUMNS,
                      order: tuple[str, ...] = ORDER, cluster: str = "rebalance") -> DataFrame:
    """The rows exactly as the text writer receives them (see ``write_text``)."""
    by = [c for c in order if c in df.columns and c not in partition_by]
    d = df.select(F.col(text_col).alias("value"), *partition_by, *by)
    if cluster != "none" and partition_by:
        d = clustered(d, *partition_by, order=tuple(by))
    return d.sortWithinPartitions(*partition_by, *by).select("value", *partition_by)


def read_landed(spark, path: str, partition_types: str = "d string, h string") -> DataFrame:
    """Read landed text back; partition columns keep their text form."""
    return spark.read.schema(f"value string, {partition_types}").text(path)


def read_landed_lines(spark, path: str, partition_types: str = "d string, h string") -> DataFrame:
    """Landed lines with their place in their bucket (``line_no`` from 0).  A
    bucket's files follow each other by their tasks' numbers: of one write.

    Lines are numbered inside the blocks that Spark reads files in, and
    blocks after those before them; no file is ever one value."""
    keys = [c.split()[0] for c in partition_types.split(", ")]
    lines = (spark.read.schema(f"value string, {partition_types}").option("lineSep", "\n").text(path)
             .select(*keys, "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_id")))
    task = F.regexp_extract("_file", r"part-(\d+)-[^/]*$", 1).cast("bigint")
    in_turn = Window.partitionBy(*keys).orderBy(task, "_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy(*keys, "_file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    ahead = sized(blocks.select("_file", "_block", F.coalesce(F.sum("_n").over(in_turn), F.lit(0)).alias("_ahead")), "lines-ahead")
    in_block = Window.partitionBy("_file", "_block").orderBy("_id")
    return (lines.withColumn("_place", F.row_number().over(in_block) - 1).join(ahead, ["_file", "_block"])
            .select(*keys, (F.col("_ahead") + F.col("_place")).alias("line_no"), "value"))
