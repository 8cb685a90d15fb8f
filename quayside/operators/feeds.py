"""Feed table operators: enabled feeds, validation, change detection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codecs import codec_extension, resolve_codec
from ..functions.timefmt import pattern_ok
from ..schemas import FEED_COLUMNS

PLAIN = "datastream"
COMPRESSED = "compressedstream"


def enabled_feeds(feeds: DataFrame) -> DataFrame:
    return feeds.filter(F.col("isEnabled") == 1).select(*FEED_COLUMNS).orderBy("id")


def codec_resolution(feeds: DataFrame) -> DataFrame:
    codec = resolve_codec("codeC")
    return feeds.select("id", "codeC",
                        F.when(codec == "?", F.lit(None).cast("string")).otherwise(codec).alias("spark_codec"),
                        F.when(F.col("codeC").isNull() | (F.lower("codeC") == "none"), "none")
                        .when(codec == "?", "unknown").otherwise("ok").alias("codec_status"))


def reject_reason(codec_col: str = "_codec") -> F.Column:
    """First broken rule of a feed row, or null when it can be landed."""
    ft = F.lower(F.col("fileType"))
    codec = F.col(codec_col)
    return (F.when(F.col("filePath").isNull(), "path_required")
            .when(~ft.isin(PLAIN, COMPRESSED), "unknown_file_type")
            .when(codec == "?", "unknown_codec")
            .when((ft == PLAIN) & codec.isNotNull(), "codec_on_plain")
            .when((ft == COMPRESSED) & codec.isNull(), "codec_required")
            .when(~pattern_ok("filePathFormat"), "bad_path_format"))


def file_extension(codec_col: str = "_codec") -> F.Column:
    return (F.when(F.coalesce(F.col("fileSuffix"), F.lit("")) != "", F.col("fileSuffix"))
            .otherwise(F.coalesce(codec_extension(codec_col), F.lit(""))))


def feed_validation(feeds: DataFrame) -> DataFrame:
    """Every feed with its resolved codec, file extension and reject reason."""
    v = feeds.withColumn("_codec", resolve_codec("codeC"))
    return v.select("id", "fileType", "codeC",
                    F.when(F.col("_codec") == "?", F.lit(None).cast("string")).otherwise(F.col("_codec"))
                    .alias("spark_codec"),
                    file_extension().alias("extension"),
                    reject_reason().alias("reject_reason"))


def _same_row(old: DataFrame, new: DataFrame, cols: list[str]) -> F.Column:
    return reduce(lambda a, b: a & b, [old[c].eqNullSafe(new[c]) for c in cols])


def config_diff(old: DataFrame, new: DataFrame, key: str = "id", keep: bool = False) -> DataFrame:
    """start / stop / restart (/ keep) per key: a full outer join on the key
    and a null-safe compare of every column."""
    cols = [c for c in old.columns if c != key]
    o, n = old.alias("o"), new.alias("n")
    same = reduce(lambda a, b: a & b, [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in cols])
    j = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    action = (F.when(F.col(f"n.{key}").isNull(), "stop")
              .when(F.col(f"o.{key}").isNull(), "start")
              .when(same, "keep").otherwise("restart"))
    out = j.select(F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(key), action.alias("action"))
    return out if keep else out.filter(F.col("action") != "keep")


def config_removed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``old`` absent from ``new`` (removed or changed): a left anti
    join on a null-safe equality of every column (a hash join)."""
    return old.join(new, _same_row(old, new, old.columns), "left_anti")


def topic_threads(feeds: DataFrame) -> DataFrame:
    """(topic, threads): the topics that enabled feeds subscribe to, with the
    sum of those feeds' threads (one at least)."""
    topic = F.explode(F.split("topics", ",")).alias("topic")
    one = feeds.filter(F.col("isEnabled") == 1).select("id", F.greatest(F.coalesce("numThreads", F.lit(1)), F.lit(1)).alias("n"), topic)
    one = one.withColumn("topic", F.trim("topic")).filter("topic <> ''").distinct()
    return one.groupBy("topic").agg(F.sum("n").cast("int").alias("threads"))


def subscription_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """topic, old_threads, new_threads, action: what a running subscription
    does when the feed table changes - start or stop a topic, or resize it."""
    o, n = topic_threads(old).withColumnRenamed("threads", "old_threads"), topic_threads(new).withColumnRenamed("threads", "new_threads")
    action = F.when(F.col("new_threads").isNull(), "stop").when(F.col("old_threads").isNull(), "start").when(F.col("old_threads") != F.col("new_threads"), "resize")
    return o.join(n, "topic", "full_outer").withColumn("action", action).filter("action IS NOT NULL")
