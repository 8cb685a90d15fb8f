"""What a stream has seen of its topics: one version a micro-batch.

A version has a row for each (topic, partition) ever seen: its latest clock
and offset, and when it last brought a record.  Batch N makes version N from
version N-1, so a batch that is delivered again finds what it found before,
and what follows from a version never depends on which partitions a batch
happens to hold:

* ``partition_totals`` - partitions of each topic; they only grow, so a
  consumer group's members keep their partitions.
* ``mark`` - the watermark.  By partition it is the smallest latest clock, so
  a slow partition holds an hour open; a partition that has been silent for
  ``idle_seconds`` holds nothing open until it speaks again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rolling import low_marks
from ..session import remove_folder

SCHEMA = "topic string, partition int, clock timestamp, last_offset bigint, seen_at timestamp"
KEEP = 100        # versions kept, as many as Spark keeps batches of a checkpoint


def _folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def version(spark: SparkSession, path: str, batch_id: int, schema: str = SCHEMA) -> DataFrame:
    """Version ``batch_id`` (empty before the first batch).  A stream that has
    no version yet begins with an empty one; a version that is gone is an error."""
    if batch_id < 0 or not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_folder(path, batch_id))


def put(new: DataFrame, path: str, batch_id: int) -> None:
    """Write version ``batch_id``; versions that no restart needs any more go."""
    new.write.mode("overwrite").parquet(_folder(path, batch_id))
    _expire(new.sparkSession, path, batch_id - KEEP)


def advance(batch: DataFrame, path: str, batch_id: int, known: DataFrame | None = None, now: dt.datetime | None = None) -> DataFrame:
    """Write version ``batch_id`` from the one before and the batch, read once
    by its narrow columns.  ``known`` (topic, n_parts): partitions that the
    source reports, also those that have brought nothing yet."""
    spark = batch.sparkSession
    arrived = F.lit(now or dt.datetime.now(dt.timezone.utc)).cast("timestamp")
    seen = (batch.groupBy("topic", "partition")
            .agg(F.max(F.col("timestamp").cast("timestamp")).alias("clock"), F.max("offset").alias("last_offset")).withColumn("seen_at", arrived))
    every = version(spark, path, batch_id - 1).unionByName(seen)
    if known is not None:
        parts = known.select("topic", F.explode(F.sequence(F.lit(0), F.col("n_parts").cast("int") - 1)).alias("partition"))
        every = every.unionByName(parts, allowMissingColumns=True)
    new = every.groupBy("topic", "partition").agg(*[F.max(c).alias(c) for c in ("clock", "last_offset", "seen_at")])
    put(new.coalesce(1), path, batch_id)     # a row a partition of the topics
    return version(spark, path, batch_id)


def _expire(spark: SparkSession, path: str, batch_id: int) -> None:
    if batch_id >= 0:
        remove_folder(spark, _folder(path, batch_id))


def partition_totals(progress: DataFrame) -> DataFrame:
    """(topic, n_parts) of all partitions seen or reported so far."""
    return progress.groupBy("topic").agg((F.max("partition") + 1).alias("n_parts"))


def mark(progress: DataFrame, idle_seconds: float | None = None, by_partition: bool = True, now=None) -> dt.datetime | None:
    """The clock up to which all is there: by partition (``low_marks`` over all
    topics, silence by arrival), else the latest clock of all.  None without records."""
    if not by_partition:
        return progress.agg(F.max("clock")).first()[0]
    return low_marks(progress.filter("clock IS NOT NULL"), idle_seconds, now=now, silent="seen_at").first()[0]
