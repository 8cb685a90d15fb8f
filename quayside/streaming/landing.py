"""Structured Streaming landing of a record stream by topic and hour.

records stream -> decode -> bucket columns -> text files partitioned by
bucket, each micro-batch in a ``batch_id=N`` folder of its own.  The
checkpoint (in the shared checkpoint folder) holds the source offsets; a
batch that is delivered again rewrites exactly its own files.  Rejected
records always land in a folder beside the lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.routing import decoded
from ..session import configure, scratch_path
from ..sources.records import events_as_records, replay_stream
from .partials import finished

PARTITIONS = ["topic", "d", "h"]


def bucketed_lines(records: DataFrame, clock: str = "timestamp", with_offset: bool = False) -> DataFrame:
    """Good records as (value, topic, d, h[, partition, offset]); the text sink adds
    the line break."""
    r = decoded(records, 0)
    extra = ["partition", "offset"] if with_offset else []
    return (r.filter(F.col("status") == "ok")
            .select(F.col("line").alias("value"), "topic",
                    F.date_format(clock, "yyyy-MM-dd").alias("d"), F.date_format(clock, "HH").alias("h"), *extra))


def land_micro_batch(batch: DataFrame, batch_id: int, out_path: str, codec: str | None = None,
                     partition_by=PARTITIONS, dead_letter_path: str | None = None,
                     cluster: str = "none") -> None:
    """Land one micro-batch into its own ``batch_id=N`` folder, overwriting
    that folder: a replayed batch rewrites exactly its own files.  Rejected
    records go to ``dead_letter_path`` (``<out_path>-rejected`` by default)."""
    from ..functions.text import record_status
    from ..sinks.text import write_text

    b = batch.withColumn("_status", record_status("value")).persist()
    try:
        good = bucketed_lines(b.filter(F.col("_status") == "ok").drop("_status"), with_offset=True)
        write_text(good, f"{out_path.rstrip('/')}/batch_id={batch_id}", "value", codec,
                   partition_by=list(partition_by), mode="overwrite", cluster=cluster)
        dead = (dead_letter_path or f"{out_path.rstrip('/')}-rejected").rstrip("/")
        (b.filter(F.col("_status") != "ok").withColumnRenamed("_status", "reason")
         .write.mode("overwrite").parquet(f"{dead}/batch_id={batch_id}"))
    finally:
        b.unpersist()


def start_landing_batches(records: DataFrame, out_path: str, checkpoint: str, codec: str | None = None,
                          trigger: dict | None = None, partition_by=PARTITIONS,
                          dead_letter_path: str | None = None, cluster: str = "none") -> StreamingQuery:
    """Land each micro-batch with the batch writer (``land_micro_batch``):
    idempotent on replay, readers see ``batch_id`` as one more partition
    column, and the batch writer can bring a bucket's rows together."""
    def land(batch: DataFrame, batch_id: int) -> None:
        land_micro_batch(batch, batch_id, out_path, codec, partition_by, dead_letter_path, cluster)

    return (records.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "20 seconds"})).start())


def land_stream_available_now(spark: SparkSession, folder: str, glob: str = "events*.parquet",
                              out_path: str | None = None, codec: str | None = None,
                              max_files_per_trigger: int | None = None) -> str:
    """Replay recorded ``events`` files of ``folder`` through the landing
    stream until caught up; returns the output folder."""
    configure(spark)
    out = out_path or scratch_path(spark, "stream-out")
    ckpt = scratch_path(spark, "stream-ckpt")
    schema = (spark.read.option("pathGlobFilter", glob).parquet(folder)).schema
    src = replay_stream(spark, folder, schema, max_files_per_trigger=max_files_per_trigger, glob=glob)
    # a replay of history is a backfill: micro-batches are not time-clustered,
    # so cluster rows by bucket before writing
    finished(start_landing_batches(events_as_records(src), out, ckpt, codec, {"availableNow": True}, cluster="rebalance"))
    return out
