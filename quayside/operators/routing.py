"""Routing: decode, bucket columns, fan-out to feeds, consumer-group split.

Bucketing takes a *clock column*, so arrival time (``current_timestamp()``,
one value per micro-batch), Kafka event time and replayed times share one
code path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import decode_value, frame_line, record_status
from ..functions.timefmt import DEFAULT_PATH_FORMAT, hour_of, path_date
from ..plans.sizing import sized

HOUR_MODE = "hour"


def _lit_or_col(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(v)


def writer_tag(partition: str = "partition") -> Column:
    """Stands in for the host part of a file name: each Kafka partition is
    written by its own task, so the partition names the writer."""
    return F.concat(F.lit("p"), F.col(partition).cast("string"))


def bucket_columns(clock="timestamp", base_path=None, fmt=DEFAULT_PATH_FORMAT,
                   mode=HOUR_MODE, topics="topic", writer: Column | None = None) -> dict[str, Column]:
    """Columns ``d``, ``h``, ``bucket_dir`` and ``bucket_name``.

    ``bucket_dir`` = base/date[/HH] (HH only in hour mode; null mode = day),
    ``bucket_name`` = date_HH_topics_writer - HH always, so files roll
    hourly even in day mode.  Every argument may be a literal or a column
    (per-feed values after a join with the feed table).
    """
    clock_c = F.col(clock) if isinstance(clock, str) else clock
    fmt_c = fmt if isinstance(fmt, Column) else F.lit(fmt)
    # a per-feed pattern column goes through the SQL function (formatters are
    # cached per pattern by Spark)
    d = path_date(clock_c, fmt) if isinstance(fmt, str) else F.call_function("date_format", clock_c, fmt_c)
    h = hour_of(clock_c)
    base = _lit_or_col(base_path)
    hour_mode = _lit_or_col(mode).eqNullSafe(HOUR_MODE)
    bdir = F.when(hour_mode, F.concat_ws("/", base, d, h)).otherwise(F.concat_ws("/", base, d))
    topics_c = F.col(topics) if isinstance(topics, str) else topics
    name = F.concat_ws("_", d, h, topics_c, writer if writer is not None else writer_tag())
    return {"d": d, "h": h, "bucket_dir": bdir, "bucket_name": name}


def route_bucket(records: DataFrame, base_path: str, fmt: str = DEFAULT_PATH_FORMAT,
                 mode: str | None = HOUR_MODE, clock: str = "timestamp") -> DataFrame:
    """Add bucket columns for one feed's settings (a narrow transform)."""
    cols = bucket_columns(clock, F.concat_ws("/", F.lit(base_path.rstrip("/")), F.col("topic")),
                          fmt, mode)
    return records.withColumns(cols)


def decoded(records: DataFrame, line_breaks=1) -> DataFrame:
    """Add ``status`` and ``line`` (decoded text, framed by the feed flag)."""
    return records.withColumns({
        "status": record_status("value"),
        "line": frame_line(decode_value("value"), line_breaks),
    })


def split_dead_letter(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, dead): dead rows keep their raw bytes and a ``reason``."""
    s = records.withColumn("reason", record_status("value"))
    return s.filter(F.col("reason") == "ok").drop("reason"), s.filter(F.col("reason") != "ok")


def explode_feed_topics(feeds: DataFrame) -> DataFrame:
    """One row per (feed, subscribed topic); ``topics`` is a comma list."""
    return (feeds.withColumn("topic", F.explode(F.split(F.col("topics"), ",")))
            .withColumn("topic", F.trim(F.col("topic")))
            .filter(F.col("topic") != ""))


def fan_out(records: DataFrame, feeds: DataFrame) -> DataFrame:
    """Every enabled feed receives the records of each topic it subscribes.

    The feed side is a config table of known size: while it is small it is
    broadcast and the record side is not shuffled.
    """
    ft = explode_feed_topics(feeds.filter(F.col("isEnabled") == 1))
    ft = sized(ft.select(F.col("id").alias("feed_id"), F.col("groupID").alias("group_id"), "topic"), "feeds")
    return records.join(ft, "topic")


def partition_counts(records: DataFrame) -> DataFrame:
    """(topic, n_parts) from the records: the largest partition + 1."""
    return records.groupBy("topic").agg((F.max("partition") + 1).alias("n_parts"))


def group_assignment(feeds: DataFrame, partitions_per_topic: DataFrame) -> DataFrame:
    """(group_id, topic, partition) -> feed_id under range assignment.

    Feeds sharing a consumer group split a topic's partitions: members are
    sorted by id; with n partitions and c members the first n % c members
    take n // c + 1 partitions, the rest n // c.  Each member makes its own
    range of partitions, so the grid has a row for each partition of a group.
    Both inputs are metadata sized."""
    ft = explode_feed_topics(feeds.filter(F.col("isEnabled") == 1)).select(
        F.col("id").alias("feed_id"), F.col("groupID").alias("group_id"), "topic").distinct()
    w = Window.partitionBy("group_id", "topic")
    members = ft.withColumns({
        "member": F.row_number().over(w.orderBy("feed_id")) - 1,
        "n_members": F.count(F.lit(1)).over(w),
    }).join(partitions_per_topic, "topic")
    q, r, m = F.floor(F.col("n_parts") / F.col("n_members")), F.col("n_parts") % F.col("n_members"), F.col("member")
    first = m * q + F.least(m, r)
    last = first + q + F.when(m < r, 1).otherwise(0) - 1
    own = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    return members.select("group_id", "topic", F.explode(own).alias("partition"), "feed_id").withColumn("partition", F.col("partition").cast("int"))


def group_split(records: DataFrame, feeds: DataFrame, partitions: DataFrame | None = None) -> DataFrame:
    """Deliver each record once per consumer group, to the member that owns
    its partition.  The partition count per topic is taken from the data
    (max partition + 1) unless it is given."""
    assign = sized(group_assignment(feeds, partitions or partition_counts(records)), "assignment")
    return records.join(assign, ["topic", "partition"])
