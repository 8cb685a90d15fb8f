"""What landed and how fast: manifests, per-second flow, running totals.

All aggregates are plain ``groupBy`` with partial (map-side) aggregation, so
a hot topic is pre-aggregated per task before any shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import utf16_length
from ..functions.timefmt import DEFAULT_PATH_FORMAT
from ..plans.sizing import sized
from .routing import HOUR_MODE, route_bucket

MIB = 1024 * 1024


def bucket_manifest(decoded: DataFrame, base_path: str, fmt: str = DEFAULT_PATH_FORMAT, mode: str | None = HOUR_MODE,
                    clock: str = "timestamp") -> DataFrame:
    """One row per (topic, bucket folder, hour): records, chars (UTF-16 units,
    as the old counters), bytes and the offset range of the framed lines.
    The measures add up, so records are aggregated by hour (by second, if the
    date pattern is finer) and only that small table gets its folders."""
    unit = "second" if re.search("[msSE]", re.sub("'[^']*'", "", fmt)) else "hour"
    small = decoded.groupBy("topic", F.date_trunc(unit, F.col(clock)).alias(clock)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(utf16_length("line")).alias("chars"), F.sum(F.octet_length("line")).alias("bytes"),
        F.min("offset").alias("lo"), F.max("offset").alias("hi"))
    routed = route_bucket(small.withColumn("partition", F.lit(0)), base_path, fmt, mode, clock)
    return (routed.groupBy("topic", "bucket_dir", F.date_trunc("hour", F.col(clock)).alias("bucket_start"))
            .agg(F.sum("n").cast("bigint").alias("n_records"), F.sum("chars").cast("bigint").alias("n_chars"),
                 F.sum("bytes").cast("bigint").alias("n_bytes"), F.min("lo").alias("first_offset"), F.max("hi").alias("last_offset")))


def flow_size(chars_col) -> F.Column:
    """Old flow text: MiB with two decimals and an ``M``."""
    return F.format_string("%.2fM", F.col(chars_col) / F.lit(float(MIB)))


def flow_per_second(decoded: DataFrame, clock: str = "timestamp") -> DataFrame:
    """Per topic and second: message count (qps), chars and the flow text."""
    return (decoded.groupBy("topic", F.date_trunc("second", F.col(clock)).alias("second"))
            .agg(F.count(F.lit(1)).alias("qps"),
                 F.sum(utf16_length("line")).cast("bigint").alias("n_chars"))
            .withColumn("flow_size", flow_size("n_chars")))


def running_totals(per_second: DataFrame, materialize: bool = True) -> DataFrame:
    """Cumulative messages and chars per topic, in second order.

    A single window over a topic would put the whole topic in one task.
    Instead: day totals -> prefix over days (a few rows per topic) -> running
    sum inside (topic, day) (at most 86,400 rows) + the prefix.  The join and
    the inner window share one exchange on (topic, day).  The per-second
    table (bounded by seconds x topics, not by volume) feeds both sides, so
    it is written once instead of scanning the records twice.
    """
    if materialize:
        per_second = sized(per_second, "per-second")
    s = per_second.withColumn("_day", F.date_trunc("day", F.col("second")))
    days = s.groupBy("topic", "_day").agg(F.sum("qps").alias("_dn"), F.sum("n_chars").alias("_dc"))
    before = Window.partitionBy("topic").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    base = days.select("topic", "_day",
                       F.coalesce(F.sum("_dn").over(before), F.lit(0)).alias("_bn"),
                       F.coalesce(F.sum("_dc").over(before), F.lit(0)).alias("_bc"))
    inner = Window.partitionBy("topic", "_day").orderBy("second").rowsBetween(Window.unboundedPreceding, 0)
    return (s.join(base, ["topic", "_day"])
            .select("topic", "second", "qps", "n_chars",
                    (F.col("_bn") + F.sum("qps").over(inner)).cast("bigint").alias("total_messages"),
                    (F.col("_bc") + F.sum("n_chars").over(inner)).cast("bigint").alias("total_chars")))


def line_bytes(records: DataFrame) -> DataFrame:
    """Bytes a feed lands per topic with and without line breaks."""
    return (records.groupBy("topic")
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.sum(F.octet_length("value")).cast("bigint").alias("bytes_no_breaks"),
                 (F.sum(F.octet_length("value")) + F.count(F.lit(1))).cast("bigint").alias("bytes_with_breaks")))


def landing_size(framed: DataFrame, keys: tuple[str, ...] = ("topic",)) -> DataFrame:
    """What whole framed lines add up to once landed: records, text lines
    (embedded line breaks are not escaped, so one record may be many lines),
    UTF-16 chars and bytes."""
    newlines = F.length("line") - F.length(F.replace(F.col("line"), F.lit("\n"), F.lit("")))
    return (framed.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_records"),
                 F.sum(newlines).cast("bigint").alias("n_lines"),
                 F.sum(utf16_length("line")).cast("bigint").alias("n_chars"),
                 F.sum(F.octet_length("line")).cast("bigint").alias("n_bytes")))


def status_counts(records_with_status: DataFrame) -> DataFrame:
    return records_with_status.groupBy("topic", "status").agg(F.count(F.lit(1)).alias("n_records"))
