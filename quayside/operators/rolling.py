"""File rolling and completion as pure functions of the rows.

* ``roll_by_count`` - files of n records per bucket (exact row numbers with
  bounded windows, see ``sequence``).
* ``roll_by_size`` / ``roll_by_interval`` - greedy rolls: a file closes once
  it holds at least ``limit`` bytes (the record that crosses stays in it), or
  once a record arrives ``limit`` seconds after the file's first record.
  A bucket of any size runs on all tasks (see ``greedy``).
* ``idle_sessions`` - a file idles out ``gap`` after its last write
  (time slices, linked chunk by chunk: no window over a whole key).
* ``hours_complete`` - hours the watermark has passed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sizing import sized
from .greedy import greedy_roll
from .sequence import chunked_row_number, offset_chunk, DEFAULT_CHUNK


def roll_by_count(df: DataFrame, n: int, keys: list[str],
                  order: tuple[str, ...] = ("offset", "partition"),
                  chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """``roll_seq`` = floor((row_number - 1) / n) inside each bucket."""
    ranked = chunked_row_number(df, keys, list(order), offset_chunk(order[0], chunk), "_rn")
    return ranked.withColumn("roll_seq", F.floor((F.col("_rn") - 1) / n).cast("bigint")).drop("_rn")


def roll_by_size(df: DataFrame, limit_bytes: int, keys: list[str],
                 order: tuple[str, ...] = ("offset", "partition"), size_col: str = "n_bytes", parts: int | None = None) -> DataFrame:
    """Rows of unknown size (rejected records) land nowhere, so they roll
    nothing and are left out."""
    return greedy_roll(df.filter(F.col(size_col).isNotNull()), keys, list(order), size_col, "size", limit_bytes, parts)


def roll_by_interval(df: DataFrame, seconds: int, keys: list[str], clock: str = "timestamp",
                     order: tuple[str, ...] = ("offset", "partition"), parts: int | None = None) -> DataFrame:
    d = df.filter(F.col(clock).isNotNull()).withColumn("_us", F.unix_micros(F.col(clock).cast("timestamp")))
    return greedy_roll(d, keys, ["_us", *order], "_us", "interval", seconds * 1_000_000, parts).drop("_us")


DAY_US = 86_400 * 1_000_000


def idle_sessions(records: DataFrame, gap_seconds: int, keys: list[str] = ("topic",),
                  clock: str = "timestamp", slices_per_chunk: int | None = None,
                  materialize: bool = True) -> DataFrame:
    """Sessions closed by ``gap`` of silence (a gap equal to ``gap`` starts a
    new one); ``session_end`` = last record + gap, when the idle close fires.

    1. Two records less than ``gap`` apart share a session, so every
       (key, floor(t / gap)) slice lies in one session: a partial aggregate.
    2. Slices are linked in chunks of ``slices_per_chunk`` (a day's worth by
       default): inside a chunk by ``lag``; the first slice of a chunk takes
       the previous chunk's last time from a per-chunk table (days per key).
    3. Session ids are a two-level prefix sum of "new session" flags.

    No window ever holds more than one chunk of one key.  The slice table
    (bounded by span / gap per key, not by volume) is used three times, so it
    is written once and the records are scanned once.
    """
    slices = session_slices(records, gap_seconds, keys, clock)
    return sessions_of_slices(sized(slices, "slices") if materialize else slices, gap_seconds, keys, slices_per_chunk)


def session_slices(records: DataFrame, gap_seconds: int, keys: list[str] = ("topic",), clock: str = "timestamp") -> DataFrame:
    """(keys, slice): first and last time and records of each slice of
    ``gap`` width.  Slices add up, so they may be made batch by batch."""
    us = F.unix_micros(F.col(clock).cast("timestamp"))
    return (records.groupBy(*keys, F.floor(us / F.lit(gap_seconds * 1_000_000)).alias("_slice"))
            .agg(F.min(us).alias("_first"), F.max(us).alias("_last"), F.count(F.lit(1)).alias("_n")))


def sessions_of_slices(slices: DataFrame, gap_seconds: int, keys: list[str] = ("topic",),
                       slices_per_chunk: int | None = None) -> DataFrame:
    """Sessions of slices (one row for each key and slice); see ``idle_sessions``."""
    keys = list(keys)
    g = gap_seconds * 1_000_000
    per = slices_per_chunk or max(1, DAY_US // g)
    slices = slices.withColumn("_chunk", F.floor(F.col("_slice") / F.lit(per)))
    # previous chunk's last time, per chunk (a small table: chunks per key)
    chunks = slices.groupBy(*keys, "_chunk").agg(F.max("_last").alias("_chunk_last"))
    by_chunk = Window.partitionBy(*keys).orderBy("_chunk")
    chunks = chunks.select(*keys, "_chunk", F.lag("_chunk_last").over(by_chunk).alias("_before"))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_slice")
    linked = (slices.join(chunks, [*keys, "_chunk"])
              .withColumn("_prev", F.coalesce(F.lag("_last").over(w), F.col("_before"))))
    flagged = linked.withColumn(
        "_new", F.when(F.col("_prev").isNull() | (F.col("_first") - F.col("_prev") >= g), 1).otherwise(0))
    # session id = flags before this chunk + running flags inside it
    counts = flagged.groupBy(*keys, "_chunk").agg(F.sum("_new").alias("_cn"))
    counts = counts.select(*keys, "_chunk", F.coalesce(
        F.sum("_cn").over(by_chunk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    sid = (flagged.join(counts, [*keys, "_chunk"])
           .withColumn("_sid", F.col("_base") + F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return (sid.groupBy(*keys, "_sid")
            .agg(F.min("_first").alias("_s"), F.max("_last").alias("_e"), F.sum("_n").alias("n_records"))
            .select(*keys,
                    F.timestamp_micros("_s").cast("timestamp_ntz").alias("session_start"),
                    F.timestamp_micros("_e").cast("timestamp_ntz").alias("last_record"),
                    F.timestamp_micros(F.col("_e") + g).cast("timestamp_ntz").alias("session_end"),
                    F.col("n_records").cast("bigint").alias("n_records")))


def hours_complete(records: DataFrame, delay_seconds: int = 3600, keys: list[str] = ("topic",),
                   clock: str = "timestamp") -> DataFrame:
    """Hourly counts for hours whose end the watermark (max time - delay)
    has reached: what an append-mode stream has published."""
    keys = list(keys)
    c = F.col(clock).cast("timestamp")
    hourly = records.groupBy(*keys, F.window(c, "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n_records"))
    watermark = records.agg(F.max(c) - F.make_interval(secs=F.lit(delay_seconds))).scalar()
    return (hourly.filter(F.col("w.end") <= watermark)
            .select(*keys, F.col("w.start").cast("timestamp_ntz").alias("hour_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("hour_end"), "n_records"))


def low_marks(clocks: DataFrame, idle_seconds: float | None, by: tuple[str, ...] = (), now=None, silent: str = "clock") -> DataFrame:
    """(by, low): the smallest ``clock`` of the partitions that are not idle.

    A partition is idle when its ``silent`` column lies more than
    ``idle_seconds`` behind ``now`` (by default the latest of its group).
    When all are, the latest clock counts: nothing is on its way.  An empty
    table without ``by`` gives one row, null."""
    by = list(by)
    if now is not None:
        edge, rows = F.lit(now).cast("timestamp"), clocks
    elif by:
        edge, rows = F.col("_edge"), clocks.join(clocks.groupBy(*by).agg(F.max(silent).alias("_edge")), by)
    else:
        edge, rows = clocks.agg(F.max(silent)).scalar(), clocks
    active = F.lit(True) if idle_seconds is None else F.col(silent) >= edge - F.make_interval(secs=F.lit(idle_seconds))
    return rows.groupBy(*by).agg(F.coalesce(F.min(F.when(active, F.col("clock"))), F.max("clock")).alias("low"))


def hours_complete_low(records: DataFrame, delay_seconds: int = 3600, idle_seconds: float | None = None, clock: str = "timestamp") -> DataFrame:
    """Hourly counts by topic for the hours that every partition of the topic
    has passed: its low watermark is the smallest latest clock of the
    partitions that are not idle (``idle_seconds`` behind the topic's latest),
    less the delay.  A slow partition holds an hour open, a silent one doesn't."""
    c = F.col(clock).cast("timestamp")
    # A row for each partition and hour: counts and clocks come from one scan.
    hourly = sized(records.groupBy("topic", "partition", F.date_trunc("hour", c).alias("hour"))
                   .agg(F.count(F.lit(1)).alias("n"), F.max(c).alias("clock")), "hours")
    low = low_marks(hourly.groupBy("topic", "partition").agg(F.max("clock").alias("clock")), idle_seconds, ("topic",))
    end = F.col("hour") + F.expr("INTERVAL 1 HOUR")
    return (hourly.groupBy("topic", "hour").agg(F.sum("n").alias("n_records")).join(low, "topic")
            .filter(end <= F.col("low") - F.make_interval(secs=F.lit(delay_seconds)))
            .select("topic", F.col("hour").cast("timestamp_ntz").alias("hour_start"), end.cast("timestamp_ntz").alias("hour_end"), "n_records"))
