"""Stream operators that lose no late record.

Spark's watermark drops what arrives behind it.  A landing may not: late
records count for their own hour, and replays deliver history newest first.
So a micro-batch leaves *partial results* that add up - hour counts, session
slices, new offsets - in its own ``batch_id=N`` folder, overwritten when the
batch is delivered again.  Reading adds the partials up and publishes what the
watermark (latest clock of all batches less the delay) has passed; a late
record changes the published row.  The state is a table: it outlives the
query, and grows with hours and slices, not with records.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import ranges
from ..operators.offsets import KEY
from ..operators.rolling import session_slices, sessions_of_slices
from ..operators.routing import group_split
from ..session import scratch_scope
from . import progress

Partial = Callable[[DataFrame], DataFrame]


def accumulate(records: DataFrame, partial: Partial, path: str, checkpoint: str, trigger: dict | None = None,
               by_partition: bool = False, idle_seconds: float | None = None) -> StreamingQuery:
    """Start a stream that writes ``partial(micro-batch)`` to ``path``, with
    ``passed``: the mark of the batches before (``progress.mark``), whose
    versions lie in ``path/_progress``."""
    root = path.rstrip("/")

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        passed = progress.mark(progress.version(spark, f"{root}/_progress", batch_id - 1), idle_seconds, by_partition)
        progress.advance(batch, f"{root}/_progress", batch_id)
        with scratch_scope(spark):
            partial(batch).withColumn("passed", F.lit(passed).cast("timestamp")).write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return (records.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "20 seconds"})).start())


def finished(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` stream; raise what stopped it."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()


# ------------------------------------------------------------ complete hours

def hour_partials(clock: str = "timestamp") -> Partial:
    c = F.col(clock).cast("timestamp")
    return lambda batch: (batch.groupBy("topic", F.date_trunc("hour", c).alias("hour_start"))
                          .agg(F.count(F.lit(1)).alias("n_records"), F.max(c).alias("max_clock")))


def latest_progress(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the stream's progress."""
    versions = spark.read.schema(f"{progress.SCHEMA}, batch_id int").parquet(f"{path.rstrip('/')}/_progress")
    return versions.filter(F.col("batch_id") == versions.agg(F.max("batch_id")).scalar())


def hours_published(spark: SparkSession, path: str, delay_seconds: int, by_partition: bool = False,
                    idle_seconds: float | None = None, now=None) -> DataFrame:
    """topic, hour_start, hour_end, n_records of the hours that the watermark
    has passed, late records included, and ``n_late``: those that came in
    batches after the hour was passed.  ``by_partition`` and ``idle_seconds``
    as the stream was started with; ``now`` (the time of asking) lets
    partitions become idle though no batch comes any more."""
    p = spark.read.parquet(path)
    delay = F.make_interval(secs=F.lit(delay_seconds))
    end = F.col("hour_start") + F.expr("INTERVAL 1 HOUR")
    late = F.when(end <= F.col("passed") - delay, F.col("n_records")).otherwise(0)
    hours = p.groupBy("topic", "hour_start").agg(F.sum("n_records").cast("bigint").alias("n_records"), F.sum(late).cast("bigint").alias("n_late"))
    low = progress.mark(latest_progress(spark, path), idle_seconds, by_partition, now)
    return (hours.filter(end <= F.lit(low).cast("timestamp") - delay)
            .select("topic", F.col("hour_start").cast("timestamp_ntz").alias("hour_start"), end.cast("timestamp_ntz").alias("hour_end"), "n_records", "n_late"))


# ------------------------------------------------------------- idle sessions

def slice_partials(gap_seconds: int, clock: str = "timestamp") -> Partial:
    return lambda batch: session_slices(batch, gap_seconds, clock=clock)


def sessions_published(spark: SparkSession, path: str, gap_seconds: int, delay_seconds: int) -> DataFrame:
    """Sessions whose idle close the watermark has passed.  A late record can
    lengthen a published session, or join two."""
    slices = (spark.read.parquet(path).groupBy("topic", "_slice")
              .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("_n")))
    watermark = slices.agg(F.timestamp_micros(F.max("_last")) - F.make_interval(secs=F.lit(delay_seconds))).scalar()
    return sessions_of_slices(slices, gap_seconds).filter(F.col("session_end").cast("timestamp") <= watermark)


# ----------------------------------------------------------------- new offsets

def start_dedup(records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Land each (topic, partition, offset) once, however late its copies
    come: a batch lands what no earlier batch has landed.  What has landed is
    kept as ranges (``path/_landed``, version N after batch N), which grow
    with the gaps, not with the records; no earlier batch is read again."""
    root = path.rstrip("/")

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        landed = progress.version(spark, f"{root}/_landed", batch_id - 1, ranges.SCHEMA)
        folder = f"{root}/batch_id={batch_id}"
        with scratch_scope(spark):
            ranges.without(batch.dropDuplicates(KEY), landed).write.mode("overwrite").parquet(folder)
            new = ranges.ranges_of(spark.read.schema(batch.schema).parquet(folder))
            progress.put(ranges.merged(landed.unionByName(new)), f"{root}/_landed", batch_id)

    return (records.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "20 seconds"})).start())


def landed_ranges(spark: SparkSession, path: str) -> DataFrame:
    """The ranges that a ``start_dedup`` stream has landed so far."""
    versions = spark.read.schema(f"{ranges.SCHEMA}, batch_id int").parquet(f"{path.rstrip('/')}/_landed")
    return versions.filter(F.col("batch_id") == versions.agg(F.max("batch_id")).scalar()).drop("batch_id")


# ------------------------------------------------------------- consumer groups

def start_group_split(records: DataFrame, feeds: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                      known: DataFrame | None = None) -> StreamingQuery:
    """Deliver each record once for each consumer group, to the member that
    owns its partition.  Owners follow from all partitions seen so far (and
    those ``known``: topic, n_parts), so they stay when a batch lacks some."""
    root = path.rstrip("/")

    def land(batch: DataFrame, batch_id: int) -> None:
        seen = progress.advance(batch, f"{root}/_progress", batch_id, known)
        with scratch_scope(batch.sparkSession):
            group_split(batch, feeds, progress.partition_totals(seen)).write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return (records.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "20 seconds"})).start())
