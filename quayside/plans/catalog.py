"""The registered queries: each is a Spark plan over the driver's tables
plus the equivalent DuckDB SQL used as the correctness oracle.

Stand-ins for the record stream (``events`` replayed as Kafka rows):
topic = event_type, partition = user_id % 3, offset = event_id,
clock = ts, value = props.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.codecs import CODEC_CLASSES, codec_spellings
from ..functions.naming import to_camel, to_snake
from ..functions.coerce import allowed_value, first_failure, null_defaults, try_int
from ..functions.text import fill_template as fill_template_col
from ..functions.timefmt import BAD_LETTER_CLASS, iso_utc
from ..operators import feeds as feed_ops
from ..operators import metrics, offsets, ranges, rolling, routing, tables
from ..session import configure, scratch_path
from ..sinks import files, raw, recovery, text
from ..sources.feeds import (FEEDS_FROM_NATION_SQL, FEEDS_FROM_SUPPLIER_SQL, feeds_from_nation,
                             feeds_from_region, feeds_from_supplier)
from ..sources.records import events_as_records
from ..sources.tables import read_table
from .sizing import sized

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Query parameters (fixed for the catalogue).
BASE = "/logs"
ROLL_COUNT = 10
ROLL_BYTES = 60
ROLL_MINUTES = 10
IDLE_MINUTES = 30
HOUR_DELAY_S = 3600
TAIL_N = 50
PAGE_NO, PAGE_SIZE = 3, 10
DELETE_KEY = 7
TEMPLATE = "{0} in nation {1} holds {2}"

REC = """rec AS (SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS "partition",
                event_id AS "offset", ts, props AS value FROM events)"""
D = "strftime(ts, '%Y-%m-%d')"
H = "strftime(ts, '%H')"


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def records(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    return events_as_records(read_table(spark, sf, "events"))


def _ntz(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


def _day(df: DataFrame) -> DataFrame:
    return df.withColumn("d", F.date_format("timestamp", "yyyy-MM-dd"))


def _hour(df: DataFrame) -> DataFrame:
    return _day(df).withColumn("h", F.date_format("timestamp", "HH"))


# ---------------------------------------------------------------- routing

@query("route_bucket", f"""WITH {REC}
SELECT topic, "partition", "offset", {D} AS d, {H} AS h,
       '{BASE}/' || topic || '/' || {D} || '/' || {H} AS bucket_dir,
       {D} || '_' || {H} || '_' || topic || '_p' || CAST("partition" AS VARCHAR) AS bucket_name
FROM rec""")
def q_route_bucket(spark, sf):
    r = routing.route_bucket(records(spark, sf), BASE, "yyyy-MM-dd", "hour")
    return r.select("topic", "partition", "offset", "d", "h", "bucket_dir", "bucket_name")


@query("route_bucket_day", f"""WITH {REC}
SELECT topic, "partition", "offset", {D} AS d, {H} AS h,
       '{BASE}/' || topic || '/' || {D} AS bucket_dir,
       {D} || '_' || {H} || '_' || topic || '_p' || CAST("partition" AS VARCHAR) AS bucket_name
FROM rec""")
def q_route_bucket_day(spark, sf):
    r = routing.route_bucket(records(spark, sf), BASE, "yyyy-MM-dd", "day")
    return r.select("topic", "partition", "offset", "d", "h", "bucket_dir", "bucket_name")


@query("bucket_manifest", f"""WITH {REC}
SELECT topic, '{BASE}/' || topic || '/' || {D} || '/' || {H} AS bucket_dir,
       date_trunc('hour', ts) AS bucket_start, count(*) AS n_records,
       CAST(sum(length(value) + 1) AS BIGINT) AS n_chars,
       CAST(sum(strlen(value) + 1) AS BIGINT) AS n_bytes,
       min("offset") AS first_offset, max("offset") AS last_offset
FROM rec GROUP BY 1, 2, 3""")
def q_bucket_manifest(spark, sf):
    m = metrics.bucket_manifest(routing.decoded(records(spark, sf), 1), BASE)
    return m.select("topic", "bucket_dir", _ntz("bucket_start"), "n_records", "n_chars", "n_bytes",
                    "first_offset", "last_offset")


FEEDS_N = f"""f AS ({FEEDS_FROM_NATION_SQL}),
ft0 AS (SELECT id AS feed_id, groupID AS group_id, unnest(string_split(topics, ',')) AS topic
        FROM f WHERE isEnabled = 1),
ft AS (SELECT feed_id, group_id, trim(topic) AS topic FROM ft0)"""


@query("fan_out", f"""WITH {REC}, {FEEDS_N}
SELECT ft.feed_id, ft.group_id, r.topic, r."partition", r."offset"
FROM rec r JOIN ft ON r.topic = ft.topic""")
def q_fan_out(spark, sf):
    feeds = feeds_from_nation(read_table(spark, sf, "nation"))
    return routing.fan_out(records(spark, sf), feeds).select("feed_id", "group_id", "topic", "partition",
                                                             "offset")


# The member of a consumer group that owns a partition (range assignment): {feeds} -> a.
def assigned(feeds: str) -> str:
    return f"""f AS ({feeds}),
ft0 AS (SELECT id AS feed_id, groupID AS group_id, unnest(string_split(topics, ',')) AS topic FROM f WHERE isEnabled = 1),
ft AS (SELECT feed_id, group_id, trim(topic) AS topic FROM ft0),
m AS (SELECT *, row_number() OVER (PARTITION BY group_id, topic ORDER BY feed_id) - 1 AS member,
             count(*) OVER (PARTITION BY group_id, topic) AS n_members FROM ft),
p AS (SELECT topic, max("partition") + 1 AS n_parts FROM rec GROUP BY topic),
g0 AS (SELECT m.*, p.n_parts, unnest(range(0, p.n_parts)) AS part FROM m JOIN p USING (topic)),
g AS (SELECT *, n_parts // n_members AS q, n_parts % n_members AS rr FROM g0),
a AS (SELECT group_id, topic, part, feed_id FROM g
      WHERE member = CASE WHEN part < rr * (q + 1) THEN part // (q + 1)
                          ELSE rr + (part - rr * (q + 1)) // NULLIF(q, 0) END)"""


@query("feed_manifest", f"""WITH {REC}, {assigned(FEEDS_FROM_NATION_SQL)}
SELECT a.feed_id, r.topic,
       f.filePath || '/' || {D} || CASE WHEN f.filePathMode = 'hour' THEN '/' || {H} ELSE '' END AS bucket_dir,
       date_trunc('hour', ts) AS bucket_start, count(*) AS n_records,
       CAST(sum(length(value) + 1) AS BIGINT) AS n_chars, CAST(sum(strlen(value) + 1) AS BIGINT) AS n_bytes,
       min("offset") AS first_offset, max("offset") AS last_offset,
       date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM rec) - INTERVAL {HOUR_DELAY_S} SECOND
         AS complete
FROM rec r JOIN a ON r.topic = a.topic AND r."partition" = a.part JOIN f ON f.id = a.feed_id
GROUP BY 1, 2, 3, 4""")
def q_feed_manifest(spark, sf):
    """Each record once for each consumer group of its topic."""
    from .landing import feed_manifest, watermark_of

    feeds = feeds_from_nation(read_table(spark, sf, "nation"))
    recs = records(spark, sf)
    m = feed_manifest(recs, feeds, watermark=watermark_of(recs, HOUR_DELAY_S))
    return m.select("feed_id", "topic", "bucket_dir", _ntz("bucket_start"), "n_records", "n_chars", "n_bytes",
                    "first_offset", "last_offset", "complete")


@query("group_split", f"""WITH {REC}, {assigned(FEEDS_FROM_NATION_SQL)}
SELECT a.group_id, r.topic, r."partition", r."offset", a.feed_id
FROM rec r JOIN a ON r.topic = a.topic AND r."partition" = a.part""")
def q_group_split(spark, sf):
    feeds = feeds_from_nation(read_table(spark, sf, "nation"))
    return routing.group_split(records(spark, sf), feeds).select("group_id", "topic", "partition", "offset",
                                                                 "feed_id")


@query("dead_letter", f"""WITH {REC}
SELECT topic, CASE WHEN value IS NULL THEN 'null_value' ELSE 'ok' END AS status, count(*) AS n_records
FROM rec GROUP BY 1, 2""")
def q_dead_letter(spark, sf):
    return metrics.status_counts(routing.decoded(records(spark, sf), 1))


# Records of which some were damaged on the way: every 13th has no value, every 17th a byte that UTF-8 has not.
LOST, BROKEN = 13, 17
DAMAGED = f"""bad AS (SELECT *, CASE WHEN "offset" % {LOST} = 0 THEN 'null_value' WHEN "offset" % {BROKEN} = 0 THEN 'bad_utf8' ELSE 'ok' END AS reason FROM rec)"""


def damaged_records(spark, sf):
    broken = F.concat(F.unhex(F.lit("41FF")), F.col("value"))
    value = F.when(F.col("offset") % LOST == 0, F.lit(None)).when(F.col("offset") % BROKEN == 0, broken).otherwise(F.col("value"))
    return records(spark, sf).withColumn("value", value)


@query("rejects_landed", f"""WITH {REC}, {DAMAGED}
SELECT topic, "partition", "offset", ts AS timestamp, reason FROM bad WHERE reason <> 'ok'""")
def q_rejects_landed(spark, sf):
    """What a landing of damaged records, delivered twice, leaves in its
    dead-letter folder."""
    from .landing import land_batch

    out = scratch_path(spark, "rejects")
    feeds = feeds_from_region(read_table(spark, sf, "region"))
    for _ in range(2):
        land_batch(damaged_records(spark, sf), feeds, out, mode="overwrite")
    dead = spark.read.parquet(f"{out}-rejected")
    return dead.select("topic", "partition", "offset", _ntz("timestamp"), "reason")


REGION_FEEDS_SQL = f"""f AS (
  SELECT CAST(r_regionkey AS BIGINT) AS feed_id, ['click', 'error', 'purchase', 'signup', 'view'][r_regionkey % 5 + 1] AS topic,
         '/logs/' || replace(lower(r_name), ' ', '_') AS path, r_regionkey % 5 AS k FROM region),
l AS (
  SELECT f.feed_id, path || '/' || CASE k WHEN 4 THEN strftime(ts, '%Y/%m/%d') ELSE {D} END || CASE WHEN k < 3 THEN '/' || {H} ELSE '' END AS bucket_dir,
         date_trunc('hour', ts) AS bucket_start, CASE k WHEN 0 THEN '' WHEN 1 THEN '.gz' WHEN 2 THEN '' WHEN 3 THEN '.log' ELSE '.bz2' END AS extension,
         bad.topic, "partition", "offset", ts, value, CASE WHEN k IN (2, 3) THEN 0 ELSE 1 END AS brk
  FROM bad JOIN f USING (topic) WHERE reason = 'ok')"""


@query("landed_manifest", f"""WITH {REC}, {DAMAGED}, {REGION_FEEDS_SQL}
SELECT feed_id, bucket_dir, bucket_start, extension, count(*) AS n_records, CAST(sum(length(value) + brk) AS BIGINT) AS n_chars,
       CAST(sum(strlen(value) + brk) AS BIGINT) AS n_bytes, min("offset") AS first_offset, max("offset") AS last_offset,
       bucket_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM l) - INTERVAL {HOUR_DELAY_S} SECOND AS complete,
       CAST(sum(strlen(value) + brk) AS BIGINT) AS bytes_on_disk, true AS in_order
FROM l GROUP BY 1, 2, 3, 4""")
def q_landed_manifest(spark, sf):
    """The manifest of a landing (plain, gzip, no line breaks, gzip without
    them, bzip2), next to the bytes read back from the files that it names:
    their number, and whether they stand in the order of the offsets."""
    from .landing import land_batch

    recs = damaged_records(spark, sf)
    feeds = feeds_from_region(read_table(spark, sf, "region"))
    m = land_batch(recs, feeds, scratch_path(spark, "landed-feeds"), delay_seconds=HOUR_DELAY_S)
    hour = ["feed_id", "bucket_start"]
    bytes_ = F.concat(F.col("value").cast("string"), F.when(F.col("isWriteLineBreaks") == 1, "\n").otherwise(""))
    sent = sized(recs.filter(routing.record_status("value") == "ok").join(feeds.select(F.col("id").alias("feed_id"), F.col("topics").alias("topic"), "isWriteLineBreaks"), "topic")
                 .groupBy("feed_id", F.date_trunc("hour", "timestamp").alias("bucket_start"), "partition", F.floor(F.col("offset") / CHECK_OFFSETS).alias("chunk"))
                 .agg(F.sort_array(F.collect_list(F.struct("offset", bytes_.alias("t")))).alias("rows"))
                 .select(*hour, "partition", "chunk", F.array_join(F.transform("rows", lambda x: x["t"]), "").cast("binary").alias("body"))
                 .withColumn("n", F.octet_length("body").cast("bigint")), "sent")
    chunk = ["partition", "chunk"]
    want = _cells(sent.join(_places(sent, hour, chunk, "n"), [*hour, *chunk]), hour, "want")
    got = _cells(files.read_back(m).join(_places(m, hour, ["path"], "n_bytes"), "path").withColumn("start", F.col("start") + F.col("at")), hour, "got")
    checked = (got.join(want, [*hour, "cell"], "full").groupBy(*hour)
               .agg(F.sum(F.octet_length("got")).cast("bigint").alias("bytes_on_disk"), F.bool_and(F.col("got").eqNullSafe(F.col("want"))).alias("in_order")))
    landed = (m.groupBy("feed_id", "bucket_dir", "bucket_start", F.regexp_extract("path", r"\.0(\.[a-z0-9]+)?$", 1).alias("extension"))
              .agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n_records", "n_chars", "n_bytes")], F.min("first_offset").alias("first_offset"),
                   F.max("last_offset").alias("last_offset"), F.max("complete").alias("complete")))
    return (landed.join(checked, hour, "left")
            .select("feed_id", "bucket_dir", _ntz("bucket_start"), "extension", "n_records", "n_chars", "n_bytes", "first_offset", "last_offset", "complete",
                    F.coalesce("bytes_on_disk", F.lit(0).cast("bigint")).alias("bytes_on_disk"), F.coalesce("in_order", F.lit(True)).alias("in_order")))


@query("versioned_compaction", f"""WITH {REC}, {DAMAGED}, {REGION_FEEDS_SQL}
SELECT version, feed_id, count(DISTINCT bucket_dir || strftime(bucket_start, '|%Y-%m-%d %H')) AS n_buckets, count(*) AS n_records,
       CAST(sum(strlen(value) + brk) AS BIGINT) AS n_bytes, CAST(sum(strlen(value) + brk) AS BIGINT) AS bytes_on_disk
FROM l, (VALUES (2), (3)) v(version) GROUP BY 1, 2""")
def q_versioned_compaction(spark, sf):
    """Two landings (even and odd offsets) published as versions 1 and 2, then
    merged bucket by bucket into version 3: a reader of 2, during and after
    the compaction, and one of 3 read the same bytes, each once."""
    from ..sinks.versions import FileTable, compact_table
    from .landing import land_batch

    recs, feeds = damaged_records(spark, sf), feeds_from_region(read_table(spark, sf, "region"))
    table = FileTable(spark, scratch_path(spark, "versions"))
    for odd in (0, 1):
        table.publish(land_batch(recs.filter(F.col("offset") % 2 == odd), feeds, scratch_path(spark, f"landed-{odd}")))
    table.pin("reader")
    compact_table(table, scratch_path(spark, "merged"))
    table.expire(keep=1)        # version 1 goes, the pinned one stays

    def seen(version: int) -> DataFrame:
        files_ = table.files(version)
        body = files.read_back(files_).groupBy("path").agg(F.sum(F.octet_length("body")).alias("on_disk"))
        return (files_.join(body, "path").groupBy("feed_id").agg(
            F.count_distinct("bucket_dir", "bucket_start").alias("n_buckets"), *[F.sum(c).cast("bigint").alias(c) for c in ("n_records", "n_bytes")],
            F.sum("on_disk").cast("bigint").alias("bytes_on_disk")).select(F.lit(version).alias("version"), "*"))

    return seen(2).unionByName(seen(3))


@query("recovery_sweep", f"""WITH {REC}, {DAMAGED}, {REGION_FEEDS_SQL}
SELECT feed_id, CASE WHEN feed_id = 0 AND hour(ts) = 0 THEN 'missing' ELSE 'landed' END AS status, count(*) AS n_records FROM l WHERE feed_id <> 4 GROUP BY 1, 2
UNION ALL SELECT NULL, 'orphan', NULL FROM (SELECT 1 FROM l WHERE feed_id = 4 LIMIT 1)""")
def q_recovery_sweep(spark, sf):
    """A landing whose writer was killed before the manifest of one feed, and
    of which the first hour of another was lost: what the sweep finds.  What
    it removed is gone: a second one finds the rest alone."""
    from ..sinks import recovery
    from .landing import land_batch

    out = scratch_path(spark, "swept")
    landed = land_batch(damaged_records(spark, sf), feeds_from_region(read_table(spark, sf, "region")), out).drop("complete")
    recovery.delete_files(landed.filter((F.col("feed_id") == 0) & (F.hour("bucket_start") == 0)))
    known = landed.filter("feed_id <> 4")
    first = recovery.sweep(known, out, 0)
    again = recovery.reconcile(known, out)
    found = first.filter("status = 'orphan' AND removed").unionByName(again.withColumn("removed", F.lit(False)))
    return found.groupBy("feed_id", "status").agg(F.sum("n_records").cast("bigint").alias("n_records"))


# What is sent and what landed are compared in cells of so many bytes; the sent records are joined over so many offsets.
CELL_BYTES = 64 << 10
CHECK_OFFSETS = 1000


def _places(rows: DataFrame, hour: list[str], order: list[str], size: str) -> DataFrame:
    """``start``: the bytes of a feed's hour before each of its parts."""
    in_turn = Window.partitionBy(*hour).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(*hour, *order, F.coalesce(F.sum(size).over(in_turn), F.lit(0)).alias("start"))


def _cells(rows: DataFrame, hour: list[str], name: str) -> DataFrame:
    """The bytes (``name``) of each cell of a feed's hour, from parts of any
    size: ``body`` at byte ``start``."""
    start, end = F.col("start"), F.col("start") + F.octet_length("body")
    lo, hi = (lambda c: F.greatest(c * CELL_BYTES, start)), (lambda c: F.least((c + 1) * CELL_BYTES, end))
    piece = lambda c: F.substring("body", (lo(c) - start + 1).cast("int"), (hi(c) - lo(c)).cast("int")).cast("string")
    cells = F.sequence(F.floor(start / CELL_BYTES), F.floor((end - 1) / CELL_BYTES))
    pieces = rows.filter(F.octet_length("body") > 0).select(*hour, F.inline(F.transform(cells, lambda c: F.struct(c.alias("cell"), lo(c).alias("at"), piece(c).alias("piece")))))
    return (pieces.groupBy(*hour, "cell").agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("p"))
            .select(*hour, "cell", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias(name)))


# ---------------------------------------------------------------- metrics

PER_SECOND = f"""ps AS (SELECT topic, date_trunc('second', ts) AS second, count(*) AS qps,
               CAST(sum(length(value) + 1) AS BIGINT) AS n_chars FROM rec GROUP BY 1, 2)"""


@query("flow_per_second", f"""WITH {REC}, {PER_SECOND}
SELECT topic, second, qps, n_chars, printf('%.2fM', CAST(n_chars AS DOUBLE) / 1048576.0) AS flow_size
FROM ps""")
def q_flow_per_second(spark, sf):
    f = metrics.flow_per_second(routing.decoded(records(spark, sf), 1))
    return f.select("topic", _ntz("second"), "qps", "n_chars", "flow_size")


@query("running_totals", f"""WITH {REC}, {PER_SECOND}
SELECT topic, second, qps, n_chars,
       CAST(sum(qps) OVER (PARTITION BY topic ORDER BY second ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS total_messages,
       CAST(sum(n_chars) OVER (PARTITION BY topic ORDER BY second ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS total_chars
FROM ps""")
def q_running_totals(spark, sf):
    f = metrics.flow_per_second(routing.decoded(records(spark, sf), 1))
    r = metrics.running_totals(f.drop("flow_size"))
    return r.select("topic", _ntz("second"), "qps", "n_chars", "total_messages", "total_chars")


@query("line_bytes", f"""WITH {REC}
SELECT topic, count(*) AS n_lines, CAST(sum(strlen(value)) AS BIGINT) AS bytes_no_breaks,
       CAST(sum(strlen(value)) + count(*) AS BIGINT) AS bytes_with_breaks
FROM rec GROUP BY 1""")
def q_line_bytes(spark, sf):
    return metrics.line_bytes(records(spark, sf))


@query("text_landing_size", """WITH t AS (SELECT source, text || chr(10) AS line FROM documents)
SELECT source AS topic, count(*) AS n_records,
       CAST(sum(length(line) - length(replace(line, chr(10), ''))) AS BIGINT) AS n_lines,
       CAST(sum(length(line) + length(regexp_replace(line, '[^\\x{10000}-\\x{10FFFF}]', '', 'g'))) AS BIGINT)
         AS n_chars,
       CAST(sum(strlen(line)) AS BIGINT) AS n_bytes
FROM t GROUP BY 1""")
def q_text_landing_size(spark, sf):
    """Whole documents as one feed per source (value = text, line breaks on)."""
    docs = read_table(spark, sf, "documents").select(
        F.col("source").alias("topic"), F.col("text").cast("binary").alias("value"))
    return metrics.landing_size(routing.decoded(docs, 1))


# ---------------------------------------------------------------- offsets

@query("commit_offsets", f"""WITH {REC}
SELECT topic, "partition", max("offset") AS last_offset, max("offset") + 1 AS commit_offset,
       count(*) AS n_records FROM rec GROUP BY 1, 2""")
def q_commit_offsets(spark, sf):
    return offsets.commit_offsets(records(spark, sf))


@query("tail_offsets", f"""WITH {REC},
m AS (SELECT topic, "partition", max("offset") AS last FROM rec GROUP BY 1, 2)
SELECT r.topic, r."partition", r."offset" FROM rec r JOIN m USING (topic, "partition")
WHERE r."offset" >= m.last + 1 - {TAIL_N}""")
def q_tail_offsets(spark, sf):
    return offsets.tail_offsets(records(spark, sf), TAIL_N).select("topic", "partition", "offset")


# Where a replay starts: 50 records from the end, but one topic 200 and one of its partitions at an offset.
REPLAY_STARTS = [(None, None, -TAIL_N), ("click", None, -4 * TAIL_N), ("click", 1, 500)]


@query("replay_from", f"""WITH {REC},
m AS (SELECT topic, "partition", min("offset") AS first, max("offset") + 1 AS end_ FROM rec GROUP BY 1, 2),
s AS (SELECT topic, "partition", greatest(first, least(end_, CASE WHEN topic = 'click' AND "partition" = 1 THEN 500
                                                                  WHEN topic = 'click' THEN end_ - {4 * TAIL_N} ELSE end_ - {TAIL_N} END)) AS start_ FROM m)
SELECT r.topic, r."partition", r."offset", r.value FROM rec r JOIN s USING (topic, "partition") WHERE r."offset" >= s.start_""")
def q_replay_from(spark, sf):
    """All records archived, then replayed from named offsets and from
    offsets counted from the end."""
    from ..sources import archive

    recs, path = records(spark, sf), scratch_path(spark, "archive")
    archive.write_archive(recs, path, "all")
    got = archive.replay_from(spark, path, spark.createDataFrame(REPLAY_STARTS, archive.STARTS))
    return got.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


@query("dedup_offsets", f"""WITH {REC}
SELECT DISTINCT topic, "partition", "offset", value FROM rec""")
def q_dedup_offsets(spark, sf):
    r = records(spark, sf)
    replayed = r.unionByName(r)
    return (offsets.dedup_offsets(replayed)
            .select("topic", "partition", "offset", F.col("value").cast("string").alias("value")))


# Offsets with long runs: the good ones of damaged records, numbered through, a partition for every thousand.
RUNS = f"""{REC}, {DAMAGED}, good AS (SELECT 'all' AS topic, CAST("offset" // 1000 % 3 AS INTEGER) AS "partition", "offset" FROM bad WHERE reason = 'ok')"""
ISLANDS = """SELECT topic, "partition", min("offset") AS lo, max("offset") AS hi
FROM (SELECT *, "offset" - row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS run FROM good)
GROUP BY topic, "partition", run"""


def _runs(r: DataFrame) -> DataFrame:
    good = r.filter((F.col("offset") % LOST != 0) & (F.col("offset") % BROKEN != 0))
    return good.withColumns({"topic": F.lit("all"), "partition": (F.floor(F.col("offset") / 1000) % 3).cast("int")})


@query("landed_ranges", f"WITH {RUNS} {ISLANDS}")
def q_landed_ranges(spark, sf):
    return ranges.ranges_of(_runs(records(spark, sf)))


@query("landed_ranges_stream", f"WITH {RUNS} {ISLANDS}")
def q_landed_ranges_stream(spark, sf):
    """The state of a stream that lands every offset once: all records
    delivered twice, history newest first."""
    from ..streaming import partials

    out, chk = scratch_path(spark, "ranges-stream"), scratch_path(spark, "ckpt")
    replay_newest_first(spark, sf, lambda r: partials.start_dedup(_runs(r), out, chk, {"availableNow": True}), copies=2)
    return partials.landed_ranges(spark, out)


# ---------------------------------------------------------------- rolling

ROLL_ROWS = f"""r AS (SELECT topic, {D} AS d, "partition", "offset", ts,
             row_number() OVER (PARTITION BY topic, {D} ORDER BY "offset", "partition") AS rn FROM rec)"""
# A landed file's bucket: topic, hour and Kafka partition (its writer).
FILE_KEYS = ["topic", "d", "h", "partition"]


@query("roll_by_count", f"""WITH {REC}, {ROLL_ROWS}
SELECT topic, d, "partition", "offset", CAST((rn - 1) // {ROLL_COUNT} AS BIGINT) AS roll_seq FROM r""")
def q_roll_by_count(spark, sf):
    r = _day(records(spark, sf))
    return rolling.roll_by_count(r, ROLL_COUNT, ["topic", "d"]).select("topic", "d", "partition", "offset",
                                                                       "roll_seq")


@query("roll_by_size", f"""WITH RECURSIVE {REC}, {DAMAGED},
r AS (SELECT topic, {D} AS d, {H} AS h, "partition", "offset", strlen(value) + 1 AS sz,
             row_number() OVER (PARTITION BY topic, {D}, {H}, "partition" ORDER BY "offset") AS rn FROM bad WHERE reason = 'ok'),
g(topic, d, h, "partition", rn, fill, seq) AS (
  SELECT topic, d, h, "partition", rn, sz, 0 FROM r WHERE rn = 1
  UNION ALL
  SELECT r.topic, r.d, r.h, r."partition", r.rn,
         CASE WHEN g.fill >= {ROLL_BYTES} THEN r.sz ELSE g.fill + r.sz END,
         CASE WHEN g.fill >= {ROLL_BYTES} THEN g.seq + 1 ELSE g.seq END
  FROM g JOIN r ON r.topic = g.topic AND r.d = g.d AND r.h = g.h AND r."partition" = g."partition" AND r.rn = g.rn + 1)
SELECT r.topic, r.d, r.h, r."partition", r."offset", CAST(g.seq AS BIGINT) AS roll_seq
FROM r JOIN g USING (topic, d, h, "partition", rn)""")
def q_roll_by_size(spark, sf):
    """Rejected records land nowhere and fill no file."""
    size = F.when(routing.record_status("value") == "ok", F.octet_length("value") + 1)
    r = _hour(damaged_records(spark, sf)).withColumn("n_bytes", size).select(*FILE_KEYS, "offset", "n_bytes")
    return rolling.roll_by_size(r, ROLL_BYTES, FILE_KEYS).select(*FILE_KEYS, "offset", "roll_seq")


@query("roll_by_interval", f"""WITH RECURSIVE {REC},
r AS (SELECT topic, {D} AS d, {H} AS h, "partition", "offset", ts,
             row_number() OVER (PARTITION BY topic, {D}, {H}, "partition" ORDER BY ts, "offset") AS rn FROM rec),
g(topic, d, h, "partition", rn, anchor, seq) AS (
  SELECT topic, d, h, "partition", rn, ts, 0 FROM r WHERE rn = 1
  UNION ALL
  SELECT r.topic, r.d, r.h, r."partition", r.rn,
         CASE WHEN r.ts >= g.anchor + INTERVAL {ROLL_MINUTES} MINUTE THEN r.ts ELSE g.anchor END,
         CASE WHEN r.ts >= g.anchor + INTERVAL {ROLL_MINUTES} MINUTE THEN g.seq + 1 ELSE g.seq END
  FROM g JOIN r ON r.topic = g.topic AND r.d = g.d AND r.h = g.h AND r."partition" = g."partition" AND r.rn = g.rn + 1)
SELECT r.topic, r.d, r.h, r."partition", r."offset", CAST(g.seq AS BIGINT) AS roll_seq
FROM r JOIN g USING (topic, d, h, "partition", rn)""")
def q_roll_by_interval(spark, sf):
    r = _hour(records(spark, sf)).select(*FILE_KEYS, "offset", "timestamp")
    return rolling.roll_by_interval(r, ROLL_MINUTES * 60, FILE_KEYS).select(*FILE_KEYS, "offset", "roll_seq")


@query("idle_sessions", f"""WITH {REC},
a AS (SELECT topic, ts, lag(ts) OVER (PARTITION BY topic ORDER BY ts) AS prev FROM rec),
b AS (SELECT *, CASE WHEN prev IS NULL OR ts - prev >= INTERVAL {IDLE_MINUTES} MINUTE THEN 1 ELSE 0 END AS new
      FROM a),
c AS (SELECT *, sum(new) OVER (PARTITION BY topic ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             AS sid FROM b)
SELECT topic, min(ts) AS session_start, max(ts) AS last_record,
       max(ts) + INTERVAL {IDLE_MINUTES} MINUTE AS session_end, count(*) AS n_records
FROM c GROUP BY topic, sid""")
def q_idle_sessions(spark, sf):
    return rolling.idle_sessions(records(spark, sf), IDLE_MINUTES * 60)


@query("hours_complete", f"""WITH {REC},
h AS (SELECT topic, date_trunc('hour', ts) AS hour_start, count(*) AS n_records FROM rec GROUP BY 1, 2)
SELECT topic, hour_start, hour_start + INTERVAL 1 HOUR AS hour_end, n_records FROM h
WHERE hour_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM rec) - INTERVAL {HOUR_DELAY_S} SECOND""")
def q_hours_complete(spark, sf):
    return rolling.hours_complete(records(spark, sf), HOUR_DELAY_S)


REPLAY_RUNS = 3


def replay_newest_first(spark, sf, start, copies: int = 1, keep=None) -> None:
    """The events as a stream that delivers history newest first: a third of
    their time is recorded (in as many files as Spark makes) and then taken by
    one run of the same query, as one micro-batch; ``copies`` times over, so
    that copies come in different batches.  ``start`` makes the
    ``availableNow`` query of a record stream; ``keep`` (run -> condition)
    leaves rows out of a run, they come in one more run at the end."""
    from ..sources.records import replay_stream
    from ..streaming.partials import finished

    configure(spark)
    events = read_table(spark, sf, "events")
    folder = scratch_path(spark, "replay")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = events.agg(F.min(us), F.max(us)).first()
    third = F.floor((us - F.lit(lo)) * REPLAY_RUNS / F.lit(hi - lo + 1))
    held = F.lit(False)
    runs = []
    for part in reversed(range(REPLAY_RUNS)):
        wanted = keep(part) if keep else F.lit(True)
        runs.append((third == part) & wanted)
        held = held | ((third == part) & ~wanted)
    for condition in (runs + [held] if keep else runs) * copies:
        events.filter(condition).write.mode("append").parquet(folder)
        finished(start(events_as_records(replay_stream(spark, folder, events.schema))))


@query("hours_complete_stream", f"""WITH {REC},
h AS (SELECT topic, date_trunc('hour', ts) AS hour_start, count(*) AS n_records FROM rec GROUP BY 1, 2)
SELECT topic, hour_start, hour_start + INTERVAL 1 HOUR AS hour_end, n_records FROM h
WHERE hour_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM rec) - INTERVAL {HOUR_DELAY_S} SECOND""")
def q_hours_complete_stream(spark, sf):
    """Structured Streaming, newest third first: every record of the later
    batches is behind the watermark and still counts for its hour."""
    from ..streaming import partials

    out, chk = scratch_path(spark, "hours-stream"), scratch_path(spark, "ckpt")
    replay_newest_first(spark, sf, lambda r: partials.accumulate(r, partials.hour_partials(), out, chk, {"availableNow": True}))
    return partials.hours_published(spark, out, HOUR_DELAY_S).drop("n_late")


# Partitions that lag: partition 2 of every topic by days, partition 1 of one topic fell silent.
SLOW_DAYS, SILENT_DAYS, IDLE_DAYS = 3, 15, 7
LAGGING = f"""lag AS (SELECT * FROM rec
  WHERE NOT ("partition" = 2 AND ts > (SELECT max(ts) FROM rec) - INTERVAL {SLOW_DAYS} DAY)
    AND NOT ("partition" = 1 AND topic = 'error' AND ts > (SELECT max(ts) FROM rec) - INTERVAL {SILENT_DAYS} DAY)),
c AS (SELECT topic, "partition", max(ts) AS clock FROM lag GROUP BY 1, 2),
h AS (SELECT topic, date_trunc('hour', ts) AS hour_start, count(*) AS n_records FROM lag GROUP BY 1, 2)"""


def _lagging(r: DataFrame, top) -> DataFrame:
    after = lambda days: F.col("timestamp") > F.lit(top) - F.make_interval(days=F.lit(days))
    slow = (F.col("partition") == 2) & after(SLOW_DAYS)
    silent = (F.col("partition") == 1) & (F.col("topic") == "error") & after(SILENT_DAYS)
    return r.filter(~slow & ~silent)


@query("hours_complete_low", f"""WITH {REC}, {LAGGING},
e AS (SELECT topic, max(clock) AS edge FROM c GROUP BY 1),
low AS (SELECT topic, min(clock) AS low FROM c JOIN e USING (topic) WHERE clock >= edge - INTERVAL {IDLE_DAYS} DAY GROUP BY 1)
SELECT topic, hour_start, hour_start + INTERVAL 1 HOUR AS hour_end, n_records FROM h JOIN low USING (topic)
WHERE hour_start + INTERVAL 1 HOUR <= low - INTERVAL {HOUR_DELAY_S} SECOND""")
def q_hours_complete_low(spark, sf):
    """No hour is complete that a slow partition has not passed; a partition
    silent for a week holds none open."""
    r = records(spark, sf)
    return rolling.hours_complete_low(_lagging(r, r.agg(F.max("timestamp")).first()[0]), HOUR_DELAY_S, IDLE_DAYS * 86400)


@query("hours_complete_low_stream", f"""WITH {REC}, {LAGGING}
SELECT topic, hour_start, hour_start + INTERVAL 1 HOUR AS hour_end, n_records FROM h
WHERE hour_start + INTERVAL 1 HOUR <= (SELECT min(clock) FROM c) - INTERVAL {HOUR_DELAY_S} SECOND""")
def q_hours_complete_low_stream(spark, sf):
    """The same in a stream, newest third first: the smallest clock over all
    partitions, kept in the progress table from batch to batch."""
    from ..streaming import partials

    out, chk = scratch_path(spark, "low-stream"), scratch_path(spark, "ckpt")
    top = records(spark, sf).agg(F.max("timestamp")).first()[0]
    replay_newest_first(spark, sf, lambda r: partials.accumulate(_lagging(r, top), partials.hour_partials(), out, chk, {"availableNow": True}, by_partition=True))
    return partials.hours_published(spark, out, HOUR_DELAY_S, by_partition=True).drop("n_late")


@query("group_split_stream", f"""WITH {REC}, {assigned(FEEDS_FROM_NATION_SQL)}
SELECT a.group_id, r.topic, r."partition", r."offset", a.feed_id
FROM rec r JOIN a ON r.topic = a.topic AND r."partition" = a.part""")
def q_group_split_stream(spark, sf):
    """Consumer groups over four micro-batches, of which two lack partitions:
    every record goes to the member that owns its partition in the full table."""
    from ..streaming import partials

    feeds = feeds_from_nation(read_table(spark, sf, "nation"))
    out, chk = scratch_path(spark, "groups-stream"), scratch_path(spark, "ckpt")
    partition = F.col("user_id") % 3
    replay_newest_first(spark, sf, lambda r: partials.start_group_split(r, feeds, out, chk, {"availableNow": True}),
                        keep=lambda run: partition <= {2: 2, 1: 0, 0: 1}[run])
    return spark.read.parquet(out).select("group_id", "topic", "partition", "offset", "feed_id")


@query("idle_sessions_stream", f"""WITH {REC},
a AS (SELECT topic, ts, lag(ts) OVER (PARTITION BY topic ORDER BY ts) AS prev FROM rec),
b AS (SELECT *, CASE WHEN prev IS NULL OR ts - prev >= INTERVAL {IDLE_MINUTES} MINUTE THEN 1 ELSE 0 END AS new
      FROM a),
c AS (SELECT *, sum(new) OVER (PARTITION BY topic ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             AS sid FROM b),
s AS (SELECT topic, min(ts) AS session_start, max(ts) AS last_record,
             max(ts) + INTERVAL {IDLE_MINUTES} MINUTE AS session_end, count(*) AS n_records
      FROM c GROUP BY topic, sid)
SELECT * FROM s WHERE session_end <= (SELECT max(ts) FROM rec) - INTERVAL {HOUR_DELAY_S} SECOND""")
def q_idle_sessions_stream(spark, sf):
    """Structured Streaming, newest third first (a session is published once
    the watermark passes its idle close; late records lengthen it)."""
    from ..streaming import partials

    out, chk = scratch_path(spark, "sessions-stream"), scratch_path(spark, "ckpt")
    gap = IDLE_MINUTES * 60
    replay_newest_first(spark, sf, lambda r: partials.accumulate(r, partials.slice_partials(gap), out, chk, {"availableNow": True}))
    return partials.sessions_published(spark, out, gap, HOUR_DELAY_S)


@query("dedup_offsets_stream", f"""WITH {REC}
SELECT DISTINCT topic, "partition", "offset", value FROM rec""")
def q_dedup_offsets_stream(spark, sf):
    """Every record delivered twice, the copies in different micro-batches,
    history newest first."""
    from ..streaming import partials

    out, chk = scratch_path(spark, "dedup-stream"), scratch_path(spark, "ckpt")
    replay_newest_first(spark, sf, lambda r: partials.start_dedup(r, out, chk, {"availableNow": True}), copies=2)
    return spark.read.parquet(out).select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


@query("file_names", f"""WITH {REC},
r AS (SELECT topic, {D} AS d, {H} AS h, "offset",
             row_number() OVER (PARTITION BY topic, {D}, {H} ORDER BY "offset", "partition") AS rn FROM rec)
SELECT topic, d, h, CAST((rn - 1) // 2 AS BIGINT) AS roll_seq,
       d || '_' || h || '_' || topic || '.' || CAST((rn - 1) // 2 AS VARCHAR) || '.log' AS file_name,
       count(*) AS n_records, min("offset") AS first_offset
FROM r GROUP BY ALL""")
def q_file_names(spark, sf):
    r = records(spark, sf).withColumns({"d": F.date_format("timestamp", "yyyy-MM-dd"),
                                        "h": F.date_format("timestamp", "HH")})
    rolled = rolling.roll_by_count(r, 2, ["topic", "d", "h"])
    name = F.concat_ws(".", F.concat_ws("_", "d", "h", "topic"), F.col("roll_seq").cast("string"), F.lit("log"))
    return (rolled.groupBy("topic", "d", "h", "roll_seq", name.alias("file_name"))
            .agg(F.count(F.lit(1)).alias("n_records"), F.min("offset").alias("first_offset")))


# ---------------------------------------------------------------- feeds

FEEDS_S = f"feeds AS ({FEEDS_FROM_SUPPLIER_SQL})"


def _supplier_feeds(spark, sf):
    configure(spark)
    return feeds_from_supplier(read_table(spark, sf, "supplier"))


@query("enabled_feeds", f"""WITH {FEEDS_S}
SELECT * FROM feeds WHERE isEnabled = 1 ORDER BY id""")
def q_enabled_feeds(spark, sf):
    return feed_ops.enabled_feeds(_supplier_feeds(spark, sf))


def _codec_case(col: str) -> str:
    exact = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in sorted(CODEC_CLASSES.items()))
    ci = " ".join(f"WHEN lower({col}) = '{k}' THEN '{v}'" for k, v in sorted(codec_spellings().items()))
    return f"CASE WHEN {col} IS NULL OR lower({col}) = 'none' THEN NULL {exact} {ci} ELSE '?' END"


@query("codec_resolve", f"""WITH {FEEDS_S}, c AS (SELECT id, codeC, {_codec_case('codeC')} AS k FROM feeds)
SELECT id, codeC, CASE WHEN k = '?' THEN NULL ELSE k END AS spark_codec,
       CASE WHEN codeC IS NULL OR lower(codeC) = 'none' THEN 'none' WHEN k = '?' THEN 'unknown' ELSE 'ok' END
         AS codec_status
FROM c""")
def q_codec_resolve(spark, sf):
    return feed_ops.codec_resolution(_supplier_feeds(spark, sf))


@query("feed_validation", f"""WITH {FEEDS_S}, c AS (SELECT *, {_codec_case('codeC')} AS k FROM feeds)
SELECT id, fileType, codeC, CASE WHEN k = '?' THEN NULL ELSE k END AS spark_codec,
       CASE WHEN coalesce(fileSuffix, '') <> '' THEN fileSuffix
            ELSE coalesce(CASE k WHEN 'gzip' THEN '.gz' WHEN 'bzip2' THEN '.bz2' WHEN 'deflate' THEN '.deflate'
                                 WHEN 'snappy' THEN '.snappy' WHEN 'lz4' THEN '.lz4' END, '') END AS extension,
       CASE WHEN filePath IS NULL THEN 'path_required'
            WHEN lower(fileType) NOT IN ('datastream', 'compressedstream') THEN 'unknown_file_type'
            WHEN k = '?' THEN 'unknown_codec'
            WHEN lower(fileType) = 'datastream' AND k IS NOT NULL THEN 'codec_on_plain'
            WHEN lower(fileType) = 'compressedstream' AND k IS NULL THEN 'codec_required'
            WHEN filePathFormat IS NULL OR filePathFormat = ''
                 OR regexp_matches(regexp_replace(filePathFormat, '''[^'']*''', '', 'g'),
                                   '{BAD_LETTER_CLASS}') THEN 'bad_path_format'
       END AS reject_reason
FROM c""")
def q_feed_validation(spark, sf):
    return feed_ops.feed_validation(_supplier_feeds(spark, sf))


SNAPSHOTS = """o AS (SELECT * FROM supplier WHERE s_acctbal < 9000),
n AS (SELECT s_suppkey, CASE WHEN s_nationkey = 11 THEN NULL ELSE s_name END AS s_name, s_nationkey,
             CASE WHEN s_nationkey = 7 THEN CAST(floor(s_acctbal) AS DOUBLE) ELSE s_acctbal END AS s_acctbal
      FROM supplier WHERE s_acctbal > -500)"""
SAME = " AND ".join(f"o.{c} IS NOT DISTINCT FROM n.{c}" for c in
                    ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])


def _snapshots(spark, sf):
    configure(spark)
    s = read_table(spark, sf, "supplier")
    old = s.filter(F.col("s_acctbal") < 9000)
    new = (s.filter(F.col("s_acctbal") > -500)
           .withColumn("s_name", F.when(F.col("s_nationkey") == 11, F.lit(None)).otherwise(F.col("s_name")))
           .withColumn("s_acctbal", F.when(F.col("s_nationkey") == 7, F.floor("s_acctbal").cast("double"))
                       .otherwise(F.col("s_acctbal"))))
    return old, new


@query("config_diff", f"""WITH {SNAPSHOTS}
SELECT coalesce(o.s_suppkey, n.s_suppkey) AS s_suppkey,
       CASE WHEN n.s_suppkey IS NULL THEN 'stop' WHEN o.s_suppkey IS NULL THEN 'start' ELSE 'restart' END
         AS action
FROM o FULL OUTER JOIN n ON o.s_suppkey = n.s_suppkey
WHERE n.s_suppkey IS NULL OR o.s_suppkey IS NULL OR NOT ({SAME})""")
def q_config_diff(spark, sf):
    old, new = _snapshots(spark, sf)
    return feed_ops.config_diff(old, new, key="s_suppkey")


TOPIC_THREADS = """SELECT topic, CAST(sum(n) AS INTEGER) AS threads FROM (
  SELECT s_nationkey % 4 + 1 AS n, unnest(['all', 'n' || s_nationkey, 's' || s_suppkey]) AS topic FROM {0} WHERE s_acctbal <= 9000) GROUP BY topic"""


@query("subscription_diff", f"""WITH {SNAPSHOTS}, ot AS ({TOPIC_THREADS.format("o")}), nt AS ({TOPIC_THREADS.format("n")})
SELECT topic, ot.threads AS old_threads, nt.threads AS new_threads,
       CASE WHEN nt.threads IS NULL THEN 'stop' WHEN ot.threads IS NULL THEN 'start' ELSE 'resize' END AS action
FROM ot FULL OUTER JOIN nt USING (topic) WHERE ot.threads IS DISTINCT FROM nt.threads""")
def q_subscription_diff(spark, sf):
    """What a subscription does when the feeds change: every feed has a topic
    of its own, one that its nation shares, and one that all share."""
    topics = F.concat(F.lit("all, n"), F.col("s_nationkey"), F.lit(",s"), F.col("s_suppkey"))
    old, new = (feeds_from_supplier(d).join(d.select(F.col("s_suppkey").alias("id"), topics.alias("own")), "id").withColumn("topics", F.col("own")) for d in _snapshots(spark, sf))
    return feed_ops.subscription_diff(old, new)


@query("config_removed", f"""WITH {SNAPSHOTS}
SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE {SAME})""")
def q_config_removed(spark, sf):
    old, new = _snapshots(spark, sf)
    return feed_ops.config_removed(old, new)


# ---------------------------------------------------------------- sinks

def _landed_query(spark, sf, codec):
    r = routing.decoded(_hour(records(spark, sf)), 0).filter("status = 'ok'")
    path = scratch_path(spark, "landed")
    text.write_text(r, path, "line", codec, partition_by=["topic", "d", "h"])
    lines = text.read_landed_lines(spark, path, "topic string, d string, h string")
    return lines.select("value", "topic", "d", "h", F.col("line_no").cast("bigint").alias("line_no"))


# Lines of a bucket in the order of partition and offset, over all its files.
LANDED_SQL = f"""WITH {REC} SELECT value, topic, {D} AS d, {H} AS h,
       row_number() OVER (PARTITION BY topic, {D}, {H} ORDER BY "partition", "offset") - 1 AS line_no FROM rec WHERE value IS NOT NULL"""


@query("landed_roundtrip", LANDED_SQL)
def q_landed_roundtrip(spark, sf):
    return _landed_query(spark, sf, None)


@query("landed_roundtrip_gz", LANDED_SQL)
def q_landed_roundtrip_gz(spark, sf):
    return _landed_query(spark, sf, "gzip")


@query("concat_bytes", f"""WITH {REC}
SELECT topic, {D} AS d, {H} AS h, CAST(sum(strlen(value)) AS BIGINT) AS n_bytes, true AS same_bytes FROM rec GROUP BY 1, 2, 3""")
def q_concat_bytes(spark, sf):
    """Values one after another, without a separator: how many bytes a bucket's
    files hold, and whether they are the values in the order of the offsets."""
    r = _hour(records(spark, sf)).withColumn("bucket", F.concat(F.lit("topic="), "topic", F.lit("/d="), "d", F.lit("/h="), "h"))
    path = scratch_path(spark, "raw")
    raw.write_raw(r.select("bucket", F.col("value").alias("data"), "partition", "offset"), path)
    bucket = ["bucket"]
    sent = sized(r.filter("value IS NOT NULL").groupBy("bucket", "partition", F.floor(F.col("offset") / CHECK_OFFSETS).alias("chunk"))
                 .agg(F.sort_array(F.collect_list(F.struct("offset", F.col("value").cast("string").alias("t")))).alias("rows"))
                 .select("bucket", "partition", "chunk", F.array_join(F.transform("rows", lambda x: x["t"]), "").cast("binary").alias("body"))
                 .withColumn("n", F.octet_length("body").cast("bigint")), "sent")
    want = _cells(sent.join(_places(sent, bucket, ["partition", "chunk"], "n"), ["bucket", "partition", "chunk"]), bucket, "want")
    landed = recovery.listing(spark, path).filter(~F.col("path").rlike("/[_.][^/]*$"))
    landed = sized(landed.select("path", "size", F.lit(None).cast("string").alias("codec"), F.regexp_extract("path", "(topic=[^/]+/d=[^/]+/h=[^/]+)/", 1).alias("bucket")), "raw-files")
    placed = files.read_back(landed).join(_places(landed, bucket, ["path"], "size"), "path").withColumn("start", F.col("start") + F.col("at"))
    checked = (_cells(placed, bucket, "got").join(want, ["bucket", "cell"], "full").groupBy("bucket")
               .agg(F.sum(F.octet_length("got")).cast("bigint").alias("n_bytes"), F.bool_and(F.col("got").eqNullSafe(F.col("want"))).alias("same_bytes")))
    part = lambda k: F.regexp_extract("bucket", f"(?:^|/){k}=([^/]+)", 1).alias(k)
    return checked.select(part("topic"), part("d"), part("h"), "n_bytes", "same_bytes")


@query("stream_landing", f"""WITH {REC} SELECT value, topic, {D} AS d, {H} AS h FROM rec WHERE value IS NOT NULL""")
def q_stream_landing(spark, sf):
    from ..streaming.landing import start_landing_batches

    out, chk = scratch_path(spark, "stream-out"), scratch_path(spark, "ckpt")
    replay_newest_first(spark, sf, lambda r: start_landing_batches(r, out, chk, trigger={"availableNow": True}, cluster="rebalance"))
    return (text.read_landed(spark, out, "batch_id string, topic string, d string, h string")
            .select("value", "topic", "d", "h"))


# ---------------------------------------------------------------- functions

@query("iso_time", """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso_time FROM events""")
def q_iso_time(spark, sf):
    configure(spark)
    return read_table(spark, sf, "events").select("event_id", iso_utc("ts").alias("iso_time"))


def _tpl_arg(c: str) -> str:
    t = f"coalesce(trim(CAST({c} AS VARCHAR)), '')"
    return f"CASE WHEN lower({t}) = 'null' THEN '' ELSE {t} END"


@query("fill_template", f"""SELECT s_suppkey,
  replace(replace(replace('{TEMPLATE}', '{{0}}', {_tpl_arg('s_name')}), '{{1}}', {_tpl_arg('s_nationkey')}),
          '{{2}}', {_tpl_arg('s_acctbal')}) AS filled
FROM supplier""")
def q_fill_template(spark, sf):
    s = read_table(spark, sf, "supplier")
    return s.select("s_suppkey", fill_template_col(TEMPLATE, "s_name", "s_nationkey", "s_acctbal").alias("filled"))


CAMEL_SQL = """CASE WHEN x IS NULL OR trim(x) = '' THEN x
     ELSE string_split(x, '_')[1] ||
          array_to_string(list_transform(string_split(x, '_')[2:], lambda p: upper(p[1:1]) || p[2:]), '') END"""


@query("to_camel", f"""WITH p AS (SELECT p_partkey, replace(p_name, ' ', '_') AS x FROM part)
SELECT p_partkey, x AS db_name, {CAMEL_SQL} AS java_name FROM p""")
def q_to_camel(spark, sf):
    p = read_table(spark, sf, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("_")).alias("db_name"))
    return p.withColumn("java_name", to_camel("db_name"))


@query("to_snake", f"""WITH p AS (SELECT p_partkey, replace(p_name, ' ', '_') AS x FROM part),
j AS (SELECT p_partkey, {CAMEL_SQL} AS java_name FROM p)
SELECT p_partkey, java_name,
       CASE WHEN java_name IS NULL OR trim(java_name) = '' THEN java_name
            ELSE lower(regexp_replace(java_name, '([a-z])([A-Z])', '\\1_\\2', 'g')) END AS db_name
FROM j""")
def q_to_snake(spark, sf):
    p = read_table(spark, sf, "part")
    j = p.select("p_partkey", to_camel(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("java_name"))
    return j.withColumn("db_name", to_snake("java_name"))


@query("null_defaults", """SELECT d.doc_id, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_null_defaults(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id")
    labels = read_table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    return null_defaults(docs.join(labels, "doc_id", "left"), ["quality", "toxic"])


# The order enums (status letters, priority names).
ORDER_STATUS = ["F", "O", "P"]
PRIORITY_NAMES = ["URGENT", "HIGH", "MEDIUM", "NOT SPECIFIED", "LOW"]


def _sql_list(xs):
    return ", ".join(f"'{x}'" for x in xs)


@query("coerce_types", f"""WITH c AS (
  SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS order_date,
         TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority_rank,
         split_part(o_orderpriority, '-', 2) AS priority_name,
         coalesce(o_totalprice, 0.0) AS total_price, o_orderstatus
  FROM orders)
SELECT o_orderkey, order_date, priority_rank, priority_name, total_price,
       CASE WHEN priority_rank IS NULL THEN 'priority_not_a_number'
            WHEN coalesce(priority_name IN ({_sql_list(PRIORITY_NAMES)}), false) = false THEN 'unknown_priority'
            WHEN coalesce(o_orderstatus IN ({_sql_list(ORDER_STATUS)}), false) = false THEN 'unknown_status'
       END AS reject_reason
FROM c""")
def q_coerce_types(spark, sf):
    """Bean-style coercion: date kind narrowed, enum names matched exactly,
    numbers parsed without errors, nulls to primitive zero; the first broken
    rule is reported instead of failing the row."""
    o = read_table(spark, sf, "orders")
    pr = F.col("o_orderpriority")
    c = o.select("o_orderkey", F.col("o_orderdate").cast("date").cast("timestamp_ntz").alias("order_date"),
                 try_int(F.split_part(pr, F.lit("-"), F.lit(1))).alias("priority_rank"),
                 F.split_part(pr, F.lit("-"), F.lit(2)).alias("priority_name"),
                 F.coalesce(F.col("o_totalprice"), F.lit(0.0)).alias("total_price"), "o_orderstatus")
    reason = first_failure([(F.col("priority_rank").isNotNull(), "priority_not_a_number"),
                            (allowed_value("priority_name", PRIORITY_NAMES), "unknown_priority"),
                            (allowed_value("o_orderstatus", ORDER_STATUS), "unknown_status")])
    return c.select("o_orderkey", "order_date", "priority_rank", "priority_name", "total_price",
                    reason.alias("reject_reason"))


# ---------------------------------------------------------------- table helpers

@query("page", f"""SELECT * FROM orders ORDER BY o_orderkey LIMIT {PAGE_SIZE} OFFSET {(PAGE_NO - 1) * PAGE_SIZE}""")
def q_page(spark, sf):
    return tables.page(read_table(spark, sf, "orders"), "o_orderkey", PAGE_NO, PAGE_SIZE)


@query("find_first", """SELECT * FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber LIMIT 1""")
def q_find_first(spark, sf):
    return tables.find_first(read_table(spark, sf, "lineitem"), ["l_shipdate", "l_orderkey", "l_linenumber"])


@query("find_by", """SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING'
ORDER BY c_acctbal DESC, c_custkey LIMIT 1""")
def q_find_by(spark, sf):
    c = read_table(spark, sf, "customer")
    return tables.find_by(c, "c_name", [F.col("c_acctbal").desc(), "c_custkey"],
                          F.col("c_mktsegment") == "BUILDING")


@query("count_rows", """SELECT count(*) AS n_rows FROM lineitem WHERE l_quantity > 25""")
def q_count_rows(spark, sf):
    return tables.count_rows(read_table(spark, sf, "lineitem"), F.col("l_quantity") > 25)


@query("delete_by_key", f"""SELECT * FROM supplier WHERE s_suppkey IS DISTINCT FROM {DELETE_KEY}""")
def q_delete_by_key(spark, sf):
    return tables.delete_by_key(read_table(spark, sf, "supplier"), "s_suppkey", DELETE_KEY)


UPDATES_SQL = """WITH u AS (SELECT s_suppkey, s_acctbal + 100 AS s_acctbal, s_nationkey % 2 = 1 AS no_name FROM supplier WHERE s_nationkey < 10)"""


def _updates(s: DataFrame) -> DataFrame:
    """A rise for some suppliers (in two steps, the second counts), which
    take the name of every other one away; a null name elsewhere is no change."""
    first = s.filter(F.col("s_nationkey") < 10).select(
        "s_suppkey", F.lit(None).cast("string").alias("s_name"), (F.col("s_acctbal") + 50).alias("s_acctbal"),
        F.when(F.col("s_nationkey") % 2 == 1, F.array(F.lit("s_name"))).alias("set_null"), F.lit(1).alias("step"))
    return first.unionByName(first.withColumns({"s_acctbal": F.col("s_acctbal") + 50, "step": F.lit(2)}))


@query("batch_update", f"""{UPDATES_SQL}
SELECT s.s_suppkey, CASE WHEN u.no_name THEN NULL ELSE s.s_name END AS s_name, s.s_nationkey,
       coalesce(u.s_acctbal, s.s_acctbal) AS s_acctbal
FROM supplier s LEFT JOIN u ON s.s_suppkey = u.s_suppkey""")
def q_batch_update(spark, sf):
    s = read_table(spark, sf, "supplier")
    return tables.batch_update(s, _updates(s), "s_suppkey", order="step", set_null="set_null")


@query("update_affected", f"{UPDATES_SQL} SELECT count(*) AS n_affected FROM supplier WHERE s_suppkey IN (SELECT s_suppkey FROM u)")
def q_update_affected(spark, sf):
    s = read_table(spark, sf, "supplier")
    return tables.updated_count(s, _updates(s), "s_suppkey")


@query("delete_affected", f"SELECT count(*) AS n_affected, count(*) = 1 AS exactly_one FROM supplier WHERE s_suppkey = {DELETE_KEY}")
def q_delete_affected(spark, sf):
    return tables.deleted_count(read_table(spark, sf, "supplier"), "s_suppkey", DELETE_KEY)


@query("table_changes", f"""{UPDATES_SQL}
SELECT 'now' AS seen, s.s_suppkey, CASE WHEN u.no_name THEN NULL ELSE s.s_name END AS s_name, s.s_nationkey, coalesce(u.s_acctbal, s.s_acctbal) AS s_acctbal
FROM supplier s LEFT JOIN u ON s.s_suppkey = u.s_suppkey WHERE s.s_suppkey <> {DELETE_KEY}
UNION ALL SELECT 'before', s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def q_table_changes(spark, sf):
    """A table that is updated and loses a key, each change one version that
    rewrites the files it touches; its first version is still there."""
    from ..sinks.tables import ParquetTable

    s = read_table(spark, sf, "supplier")
    table = ParquetTable.create(s.repartitionByRange("s_suppkey"), scratch_path(spark, "table"))
    table.update(_updates(s), "s_suppkey", order="step", set_null="set_null")
    table.delete_by_key("s_suppkey", DELETE_KEY)
    names = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
    return (table.read().select(F.lit("now").alias("seen"), *names)
            .unionByName(table.read(1).select(F.lit("before").alias("seen"), *names)))


@query("insert_rows", """WITH top AS (SELECT coalesce(max(s_suppkey), 0) AS m FROM supplier),
ins AS (SELECT (SELECT m FROM top) + row_number() OVER (ORDER BY c_custkey) AS s_suppkey,
               c_name AS s_name, c_nationkey AS s_nationkey, c_acctbal AS s_acctbal
        FROM customer)
SELECT * FROM supplier UNION ALL SELECT * FROM ins""")
def q_insert_rows(spark, sf):
    s = read_table(spark, sf, "supplier")
    c = read_table(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("s_name"), F.col("c_nationkey").alias("s_nationkey"),
        F.col("c_acctbal").alias("s_acctbal"))
    return tables.insert_rows(s, c, "s_suppkey", "c_custkey")


@query("param_filter", """SELECT event_id, event_type, value FROM events WHERE event_type <> 'error' AND value > 50.0""")
def q_param_filter(spark, sf):
    ev = read_table(spark, sf, "events")
    return tables.param_query(spark, "SELECT event_id, event_type, value FROM {ev} WHERE event_type <> ? AND value > ?",
                              ["error", 50.0], ev=ev)
