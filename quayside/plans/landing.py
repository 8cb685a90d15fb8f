"""Batch landing: records + feeds -> files where the feeds say + manifest.

One plan for all feeds and codecs: each record is decoded once, joined to the
feeds that receive it, framed, and written by one sink (``sinks.files``) that
also writes the rejected records and returns the manifest of its files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codecs import resolve_codec
from ..functions.text import decode_value, frame_line, record_status, utf16_length
from ..operators.feeds import file_extension, reject_reason
from ..operators.routing import bucket_columns, group_assignment, partition_counts
from ..plans.sizing import sized
from ..sinks.files import clear, write_files

# Routing key of rejected records: no topic has such a name.
DEAD_TOPIC = "\x00rejected"


def valid_feeds(feeds: DataFrame) -> DataFrame:
    v = feeds.withColumn("_codec", resolve_codec("codeC"))
    return (v.filter((F.col("isEnabled") == 1) & reject_reason().isNull())
            .withColumn("extension", file_extension()).withColumn("codec", F.col("_codec")).drop("_codec"))


def feed_members(feeds: DataFrame, partitions: DataFrame) -> DataFrame:
    """(topic, partition) -> the feed of each consumer group that receives
    it, with the feed's settings: feeds of a group split the partitions."""
    ok = valid_feeds(feeds)
    settings = ok.select(F.col("id").alias("feed_id"), "topics", "filePath", "filePathFormat", "filePathMode",
                         "isWriteLineBreaks", "codec", "extension")
    return group_assignment(ok, partitions).join(settings, "feed_id")


def bucketed(rows: DataFrame, clock: str) -> DataFrame:
    """Bucket columns from each row's feed settings."""
    cols = bucket_columns(clock, F.col("filePath"), F.col("filePathFormat"), F.col("filePathMode"), topics="topics")
    return rows.withColumns(cols)


def route(records: DataFrame, feeds: DataFrame, clock: str = "timestamp", partitions: DataFrame | None = None) -> DataFrame:
    """Good records at the feeds that receive them: once for each consumer
    group of their topic.  ``partitions`` (topic, n_parts) tells how many
    partitions the topics have; by default it is read from the records."""
    ft = sized(feed_members(feeds, partitions or partition_counts(records)), "members")
    r = records.withColumns({"status": record_status("value"), "text": decode_value("value")}).filter("status = 'ok'")
    return bucketed(r.join(ft, ["topic", "partition"]), clock)


def land_batch(records: DataFrame, feeds: DataFrame, out_root: str, dead_letter_path: str | None = None,
               clock: str = "timestamp", transform: Callable[[DataFrame], DataFrame] | None = None, mode: str = "append",
               cluster: str = "rebalance", manifest_path: str | None = None, delay_seconds: int = 3600,
               watermark=None, partitions: DataFrame | None = None) -> DataFrame:
    """Land a batch; returns the manifest of the files written, with
    ``complete``: the bucket's hour ended at or before the watermark.

    Files land under ``out_root`` at the feed's own path.  Rejected records
    go to ``dead_letter_path`` (``<out_root>-rejected`` by default), never
    nowhere.  ``mode="overwrite"`` replaces both folders first, so a
    micro-batch that is delivered again leaves its files once, also when no
    feed is left to land.  ``transform`` is the per-record hook: it gets the
    routed good rows and what it makes of column ``text`` lands and is
    measured.  ``watermark`` (a timestamp) defaults to the latest clock of
    the batch less ``delay_seconds``.

    The records are scanned once (twice with a ``transform``: it must not see
    rejected rows), plus two narrow columns when ``partitions`` isn't given.
    """
    root = out_root.rstrip("/")
    dead = (dead_letter_path or f"{root}-rejected").rstrip("/")
    tag = "b" if mode == "overwrite" else uuid.uuid4().hex[:8]
    if mode == "overwrite":
        clear(root)
        clear(dead)
    parts = partitions or partition_counts(records)
    late = F.col("late").cast("int") if "late" in records.columns else F.lit(0)
    r = records.withColumns({"status": record_status("value"), "text": decode_value("value"), "_late": F.coalesce(late, F.lit(0))})
    members = feed_members(feeds, parts)
    if transform is None:
        rejected = records.sparkSession.range(1).select(F.lit(DEAD_TOPIC).alias("topic"), F.lit(0).alias("partition"))
        members = sized(members.unionByName(rejected, allowMissingColumns=True), "members").withColumnsRenamed({"topic": "_topic", "partition": "_partition"})
        bad = F.col("status") != "ok"
        key = (F.when(bad, DEAD_TOPIC).otherwise(F.col("topic")) == F.col("_topic")) & (F.when(bad, 0).otherwise(F.col("partition")) == F.col("_partition"))
        rows = _file_rows(bucketed(r.join(members, key), clock), clock)
    else:
        good = bucketed(r.filter("status = 'ok'").join(sized(members, "members"), ["topic", "partition"]), clock)
        none = {c: F.lit(None).cast(t) for c, t in good.dtypes if c not in r.columns}
        rows = _file_rows(transform(good), clock).unionByName(_file_rows(r.filter("status <> 'ok'").withColumns(none), clock))
    manifest = write_files(rows, root, dead, (manifest_path or f"{root}/_manifest/{uuid.uuid4().hex[:8]}").rstrip("/"), tag, cluster)
    if watermark is None:
        watermark = manifest.agg(F.max("max_clock") - F.make_interval(secs=F.lit(delay_seconds))).scalar()
    else:
        watermark = F.lit(watermark)
    return manifest.withColumn("complete", F.coalesce(F.col("bucket_start") + F.expr("INTERVAL 1 HOUR") <= watermark, F.lit(False)))


def _file_rows(rows: DataFrame, clock: str) -> DataFrame:
    """Routed rows as the sink takes them: framed bytes of what lands, the
    raw bytes of what is rejected."""
    good = F.col("status") == "ok"
    framed = frame_line(F.col("text"), F.col("isWriteLineBreaks"))
    # A date pattern may hold slashes; a file's name may not.
    name = F.replace(F.concat_ws("_", "d", "h", "topics"), F.lit("/"), F.lit("-"))
    return rows.select(
        F.when(good, F.col("bucket_dir")).alias("dir"), F.when(good, name).alias("name"), F.when(good, F.col("feed_id")).alias("feed_id"),
        "codec", "extension", "topic", "partition", "offset", F.col(clock).cast("timestamp").alias("clock"),
        F.date_trunc("hour", F.col(clock)).cast("timestamp").alias("bucket_start"), F.col("_late").cast("bigint").alias("late"),
        F.when(good, utf16_length(framed)).alias("chars"),
        F.when(good, F.coalesce(framed, F.lit("")).cast("binary")).otherwise(F.col("value")).alias("data"),
        F.when(~good, F.col("status")).alias("reason"), "key", F.col("timestampType").alias("timestamp_type"))


def landed_manifest(spark, manifest_path: str, delay_seconds: int = 3600) -> DataFrame:
    """The manifest of all batches of a stream landing, ``complete`` as of
    the latest of them."""
    m = spark.read.parquet(manifest_path)
    watermark = m.agg(F.max("max_clock") - F.make_interval(secs=F.lit(delay_seconds))).scalar()
    return m.withColumn("complete", F.coalesce(F.col("bucket_start") + F.expr("INTERVAL 1 HOUR") <= watermark, F.lit(False)))


def watermark_of(records: DataFrame, delay_seconds: int = 3600, clock: str = "timestamp"):
    """max(clock) - delay as a scalar subquery (reads only the clock column)."""
    return records.agg(F.max(F.col(clock).cast("timestamp"))
                       - F.make_interval(secs=F.lit(delay_seconds))).scalar()


def feed_manifest(records: DataFrame, feeds: DataFrame, clock: str = "timestamp", watermark=None,
                  partitions: DataFrame | None = None) -> DataFrame:
    """What would land: per feed and bucket the records, chars (UTF-16 units,
    the line break included), bytes and offsets, without writing.

    The measures add up, so records are first aggregated by (topic,
    partition, hour - or second, if a feed's path has a finer unit) and only
    that small table meets the feeds."""
    ok = valid_feeds(feeds)
    finer = not ok.filter(F.regexp_replace("filePathFormat", "'[^']*'", "").rlike("[msSE]")).isEmpty()
    unit = F.date_trunc("second" if finer else "hour", F.col(clock)).alias(clock)
    r = records.withColumns({"status": record_status("value"), "text": decode_value("value")}).filter("status = 'ok'")
    small = r.groupBy("topic", "partition", unit).agg(
        F.count(F.lit(1)).alias("n"), F.sum(utf16_length("text")).alias("chars"), F.sum(F.octet_length("text")).alias("bytes"),
        F.min("offset").alias("lo"), F.max("offset").alias("hi"))
    small = sized(small, "measures")
    parts = partitions or small.groupBy("topic").agg((F.max("partition") + 1).alias("n_parts"))
    j = bucketed(small.join(feed_members(feeds, parts), ["topic", "partition"]), clock)
    brk = F.when(F.col("isWriteLineBreaks") == 1, F.col("n")).otherwise(0)
    m = (j.groupBy("feed_id", "topic", "bucket_dir", F.date_trunc("hour", F.col(clock)).alias("bucket_start"))
         .agg(F.sum("n").cast("bigint").alias("n_records"), F.sum(F.col("chars") + brk).cast("bigint").alias("n_chars"),
              F.sum(F.col("bytes") + brk).cast("bigint").alias("n_bytes"), F.min("lo").alias("first_offset"), F.max("hi").alias("last_offset")))
    if watermark is not None:
        m = m.withColumn("complete", (F.col("bucket_start") + F.expr("INTERVAL 1 HOUR")) <= watermark)
    return m
