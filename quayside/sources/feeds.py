"""Feed configuration sources.

* ``read_feeds_jdbc`` - the live config table (filter pushed to the database).
* ``read_feed_list_xml`` - the legacy XML feed list.
* ``feeds_from_nation`` / ``feeds_from_region`` / ``feeds_from_supplier`` - feed tables Spark derives
  from the driver's tables, used by the registered queries and tests so
  that every rule (shared groups, two-topic feeds, codecs, rejects) is hit.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FEED_COLUMNS, FEED_DEFAULTS, FEED_SCHEMA

CONFIG_TABLE = "feed_config"

# The topics of the replayed record stream (event types).
TOPICS = ["click", "error", "purchase", "signup", "view"]


def read_feeds_jdbc(spark: SparkSession, url: str, table: str = CONFIG_TABLE,
                    user_env: str = "QUAYSIDE_DB_USER", password_env: str = "QUAYSIDE_DB_PASSWORD",
                    properties: dict | None = None) -> DataFrame:
    """Enabled feeds from the config database; secrets come from the
    environment only.  ``isEnabled = 1`` is pushed down to the database."""
    props = dict(properties or {})
    if os.environ.get(user_env):
        props["user"] = os.environ[user_env]
    if os.environ.get(password_env):
        props["password"] = os.environ[password_env]
    df = spark.read.jdbc(url, table, properties=props)
    return normalize_feeds(df.filter(F.col("isEnabled") == 1))


def read_feed_list_xml(spark: SparkSession, path: str) -> DataFrame:
    """``<topic name=... consumerThreadCountForTopic=... isContainLineBreaks=...>``
    (attributes, which the XML source prefixes with ``_``, or child elements)."""
    df = spark.read.format("xml").option("rowTag", "topic").load(path)

    def field(name: str) -> F.Column:
        return F.col(f"_{name}") if f"_{name}" in df.columns else F.col(name)

    return df.select(field("name").alias("topics"),
                     field("consumerThreadCountForTopic").cast("int").alias("numThreads"),
                     field("isContainLineBreaks").cast("boolean").cast("int").alias("isWriteLineBreaks"))


def normalize_feeds(df: DataFrame) -> DataFrame:
    """Cast to the feed schema and fill the documented defaults."""
    cols = []
    for f in FEED_SCHEMA.fields:
        c = F.col(f.name).cast(f.dataType)
        if f.name in FEED_DEFAULTS:
            c = F.coalesce(c, F.lit(FEED_DEFAULTS[f.name]))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _topic(idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(t) for t in TOPICS]), (idx % len(TOPICS)) + 1)


def feeds_from_nation(nation: DataFrame) -> DataFrame:
    """A small feed table (one feed per nation): topic by key, a second topic
    for keys >= 20, consumer group by key / 10, gzip for odd keys, hour mode
    below 13, the last nation disabled."""
    k = F.col("n_nationkey")
    return normalize_feeds(nation.select(
        k.cast("bigint").alias("id"),
        F.when(k >= 20, F.concat(_topic(k), F.lit(","), _topic(k + 2))).otherwise(_topic(k)).alias("topics"),
        F.concat(F.lit("grp-"), F.floor(k / 10).cast("string")).alias("groupID"),
        (k % 3 + 1).alias("numThreads"),
        F.when(k % 2 == 1, "CompressedStream").otherwise("DataStream").alias("fileType"),
        F.when(k % 2 == 1, "gzip").alias("codeC"),
        F.concat(F.lit("/logs/"), F.lower("n_name")).alias("filePath"),
        F.lit("yyyy-MM-dd").alias("filePathFormat"),
        F.when(k < 13, "hour").otherwise("day").alias("filePathMode"),
        F.lit("").alias("fileSuffix"),
        F.lit(1).alias("isWriteLineBreaks"),
        F.when(k == 24, 0).otherwise(1).alias("isEnabled"),
    ))


# Framing and codec of the feeds on regions: (file type, codec, line breaks, suffix, date pattern, mode).
REGION_FEEDS = [
    ("DataStream", None, 1, "", "yyyy-MM-dd", "hour"),
    ("CompressedStream", "gzip", 1, "", "yyyy-MM-dd", "hour"),
    ("DataStream", None, 0, "", "yyyy-MM-dd", "hour"),
    ("CompressedStream", "GzipCodec", 0, ".log", "yyyy-MM-dd", "day"),
    ("CompressedStream", "bzip2", 1, "", "yyyy/MM/dd", "day"),
]


def feeds_from_region(region: DataFrame) -> DataFrame:
    """One feed a region, each on a topic of its own: plain and gzip with and
    without line breaks, a suffix in place of the codec's, a date pattern
    with slashes, hour and day mode."""
    k = F.col("r_regionkey") % len(REGION_FEEDS)
    pick = lambda i: F.element_at(F.array(*[F.lit(f[i]) for f in REGION_FEEDS]), k + 1)
    return normalize_feeds(region.select(
        F.col("r_regionkey").cast("bigint").alias("id"), _topic(k).alias("topics"),
        F.concat(F.lit("grp-"), F.col("r_regionkey").cast("string")).alias("groupID"), F.lit(2).alias("numThreads"),
        pick(0).alias("fileType"), pick(1).alias("codeC"),
        F.concat(F.lit("/logs/"), F.replace(F.lower("r_name"), F.lit(" "), F.lit("_"))).alias("filePath"),
        pick(4).alias("filePathFormat"), pick(5).alias("filePathMode"), pick(3).alias("fileSuffix"),
        pick(2).alias("isWriteLineBreaks"), F.lit(1).alias("isEnabled")))


def subscription(feeds: DataFrame) -> tuple[list[str], int]:
    """(topics, partitions to ask for) of the enabled feeds: what a source
    must subscribe to, and the sum of their threads."""
    enabled = feeds.filter(F.col("isEnabled") == 1)
    topics = enabled.select(F.explode(F.split("topics", ",")).alias("t")).select(F.trim("t").alias("t")).filter("t <> ''").distinct()
    threads = enabled.agg(F.sum("numThreads")).first()[0]
    return sorted(r["t"] for r in topics.collect()), int(threads or 0)


def feeds_from_supplier(supplier: DataFrame) -> DataFrame:
    """A feed table that grows with the data (one feed per supplier) and hits
    every validation rule: file types in mixed case, codecs by class name,
    simple name and short name, 'None', unknown codecs, missing paths,
    unsupported date patterns, null modes and disabled feeds."""
    nk, bal = F.col("s_nationkey"), F.col("s_acctbal")
    types = F.array(*[F.lit(x) for x in
                      ["DataStream", "CompressedStream", "compressedstream", "DATASTREAM",
                       "CompressedStream", "SequenceFile"]])
    codecs = F.array(*[F.lit(x) for x in
                       [None, "gzip", "org.apache.hadoop.io.compress.BZip2Codec", "SnappyCodec",
                        "None", "lzo", "Lz4", "DEFLATE"]])
    return normalize_feeds(supplier.select(
        F.col("s_suppkey").alias("id"),
        F.when(nk >= 20, F.concat(_topic(nk), F.lit(","), _topic(nk + 1))).otherwise(_topic(nk)).alias("topics"),
        F.concat(F.lit("grp-"), nk.cast("string")).alias("groupID"),
        (nk % 4 + 1).alias("numThreads"),
        F.element_at(types, nk % 6 + 1).alias("fileType"),
        F.element_at(codecs, nk % 8 + 1).alias("codeC"),
        F.when(bal >= 0, F.concat(F.lit("/logs/"), F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit("_")))))
        .alias("filePath"),
        F.when(nk == 7, "YYYY-MM-dd").when(nk == 8, "yyyyMMdd").otherwise("yyyy-MM-dd").alias("filePathFormat"),
        F.when(nk % 3 == 0, "hour").when(nk % 3 == 1, "day").alias("filePathMode"),
        F.when(nk % 4 == 0, ".log").otherwise("").alias("fileSuffix"),
        F.when(nk % 5 == 4, 0).otherwise(1).alias("isWriteLineBreaks"),
        F.when(bal > 9000, 0).otherwise(1).alias("isEnabled"),
    ))


FEEDS_FROM_SUPPLIER_SQL = """
SELECT s_suppkey AS id,
       CASE WHEN s_nationkey >= 20
            THEN ['click','error','purchase','signup','view'][s_nationkey % 5 + 1] || ',' ||
                 ['click','error','purchase','signup','view'][(s_nationkey + 1) % 5 + 1]
            ELSE ['click','error','purchase','signup','view'][s_nationkey % 5 + 1] END AS topics,
       'grp-' || CAST(s_nationkey AS VARCHAR) AS groupID,
       CAST(s_nationkey % 4 + 1 AS INTEGER) AS numThreads,
       ['DataStream','CompressedStream','compressedstream','DATASTREAM','CompressedStream',
        'SequenceFile'][s_nationkey % 6 + 1] AS fileType,
       [NULL,'gzip','org.apache.hadoop.io.compress.BZip2Codec','SnappyCodec','None','lzo','Lz4',
        'DEFLATE'][s_nationkey % 8 + 1] AS codeC,
       CASE WHEN s_acctbal >= 0 THEN '/logs/' || lower(replace(s_name, '#', '_')) END AS filePath,
       CASE WHEN s_nationkey = 7 THEN 'YYYY-MM-dd' WHEN s_nationkey = 8 THEN 'yyyyMMdd'
            ELSE 'yyyy-MM-dd' END AS filePathFormat,
       CASE WHEN s_nationkey % 3 = 0 THEN 'hour' WHEN s_nationkey % 3 = 1 THEN 'day' END AS filePathMode,
       CASE WHEN s_nationkey % 4 = 0 THEN '.log' ELSE '' END AS fileSuffix,
       CAST(CASE WHEN s_nationkey % 5 = 4 THEN 0 ELSE 1 END AS INTEGER) AS isWriteLineBreaks,
       CAST(CASE WHEN s_acctbal > 9000 THEN 0 ELSE 1 END AS INTEGER) AS isEnabled
FROM supplier
"""

FEEDS_FROM_NATION_SQL = """
SELECT CAST(n_nationkey AS BIGINT) AS id,
       CASE WHEN n_nationkey >= 20
            THEN ['click','error','purchase','signup','view'][n_nationkey % 5 + 1] || ',' ||
                 ['click','error','purchase','signup','view'][(n_nationkey + 2) % 5 + 1]
            ELSE ['click','error','purchase','signup','view'][n_nationkey % 5 + 1] END AS topics,
       'grp-' || CAST(n_nationkey // 10 AS VARCHAR) AS groupID,
       '/logs/' || lower(n_name) AS filePath,
       CASE WHEN n_nationkey < 13 THEN 'hour' ELSE 'day' END AS filePathMode,
       CASE WHEN n_nationkey = 24 THEN 0 ELSE 1 END AS isEnabled
FROM nation
"""

__all__ = ["FEED_COLUMNS", "TOPICS", "read_feeds_jdbc", "read_feed_list_xml", "normalize_feeds",
           "feeds_from_nation", "feeds_from_region", "feeds_from_supplier", "subscription"]
