from datetime import datetime

from pyspark.sql import functions as F

from quayside.operators import feeds as feed_ops
from quayside.operators import offsets, routing
from quayside.schemas import FEED_SCHEMA
from quayside.sources.feeds import normalize_feeds

REC = "topic string, partition int, offset long, value binary, timestamp timestamp"


def _recs(spark, rows):
    return spark.createDataFrame([(t, p, o, v, datetime(2024, 1, 1)) for t, p, o, v in rows], REC)


def test_commit_and_tail(spark):
    r = _recs(spark, [("a", 0, o, b"x") for o in range(10)] + [("a", 1, 5, b"y"), ("b", 0, 7, b"z")])
    c = {(x.topic, x.partition): (x.last_offset, x.commit_offset) for x in offsets.commit_offsets(r).collect()}
    assert c == {("a", 0): (9, 10), ("a", 1): (5, 6), ("b", 0): (7, 8)}
    tail = sorted((x.topic, x.partition, x.offset) for x in offsets.tail_offsets(r, 3).collect())
    assert tail == [("a", 0, 7), ("a", 0, 8), ("a", 0, 9), ("a", 1, 5), ("b", 0, 7)]


def test_dedup_repeated_offsets(spark):
    r = _recs(spark, [("a", 0, 1, b"x"), ("a", 0, 1, b"x"), ("a", 1, 1, b"x"), ("b", 0, 1, b"x")])
    assert offsets.dedup_offsets(r).count() == 3


def _feed(i, topics, group="g", ftype="DataStream", codec=None, path="/p", fmt="yyyy-MM-dd", mode="hour",
          suffix="", breaks=1, enabled=1, threads=1):
    return (i, topics, group, threads, ftype, codec, path, fmt, mode, suffix, breaks, enabled)


FIXTURE_FEEDS = [
    _feed(1, "a"),                                              # plain hour feed
    _feed(2, "a", mode="day", group="g2"),                      # plain day feed
    _feed(3, "b", ftype="CompressedStream", codec="gzip"),      # gzip by short name
    _feed(4, "b", ftype="compressedstream", codec="org.apache.hadoop.io.compress.GzipCodec", group="g4"),
    _feed(5, "b", ftype="CompressedStream", codec="None"),      # None codec -> required
    _feed(6, "b", ftype="CompressedStream", codec="lzo"),       # unknown codec
    _feed(7, "a", codec="gzip"),                                # codec on plain
    _feed(8, "a", ftype="CompressedStream", codec=None),        # no codec on compressed
    _feed(9, "a", ftype="SequenceFile"),                        # rejected type
    _feed(10, "a", path=None),                                  # null path
    _feed(11, "a", fmt="YYYY-MM-dd"),                           # bad pattern
    _feed(12, "a,b", group="g12"),                              # two-topic feed
    _feed(13, "a", enabled=0),                                  # disabled
    _feed(14, "a", mode=None, suffix=None, breaks=0, group="g"),  # null mode / suffix, no breaks
]


def _feeds(spark, rows=FIXTURE_FEEDS):
    return normalize_feeds(spark.createDataFrame(rows, FEED_SCHEMA))


def test_feed_validation_fixtures(spark):
    got = {r.id: r.reject_reason for r in feed_ops.feed_validation(_feeds(spark)).collect()}
    assert got == {1: None, 2: None, 3: None, 4: None, 5: "codec_required", 6: "unknown_codec",
                   7: "codec_on_plain", 8: "codec_required", 9: "unknown_file_type", 10: "path_required",
                   11: "bad_path_format", 12: None, 13: None, 14: None}
    ext = {r.id: r.extension for r in feed_ops.feed_validation(_feeds(spark)).collect()}
    assert ext[3] == ".gz" and ext[1] == ""


def test_enabled_feeds_sorted(spark):
    ids = [r.id for r in feed_ops.enabled_feeds(_feeds(spark)).collect()]
    assert ids == [i for i in range(1, 15) if i != 13]


def test_config_diff_actions(spark):
    old = _feeds(spark, FIXTURE_FEEDS[:5])
    new_rows = [FIXTURE_FEEDS[3], FIXTURE_FEEDS[0], FIXTURE_FEEDS[2],          # moved order: keep
                _feed(2, "a", mode="day", group="g2", codec="gzip"),          # codeC null -> value
                _feed(99, "z")]                                               # added; 5 removed
    got = {r.id: r.action for r in feed_ops.config_diff(old, _feeds(spark, new_rows), keep=True).collect()}
    assert got == {1: "keep", 2: "restart", 3: "keep", 4: "keep", 5: "stop", 99: "start"}
    removed = sorted(r.id for r in feed_ops.config_removed(old, _feeds(spark, new_rows)).collect())
    assert removed == [2, 5]


def test_group_split_range_assignment(spark):
    # 5 partitions, group g has 2 members on topic a -> {0,1,2} and {3,4}
    feeds = _feeds(spark, [_feed(1, "a"), _feed(2, "a"), _feed(3, "a", group="solo")])
    recs = _recs(spark, [("a", p, 100 + p, b"x") for p in range(5)])
    got = sorted((r.group_id, r.partition, r.feed_id) for r in routing.group_split(recs, feeds).collect())
    assert got == [("g", 0, 1), ("g", 1, 1), ("g", 2, 1), ("g", 3, 2), ("g", 4, 2),
                   ("solo", 0, 3), ("solo", 1, 3), ("solo", 2, 3), ("solo", 3, 3), ("solo", 4, 3)]


def test_group_split_more_members_than_partitions(spark):
    feeds = _feeds(spark, [_feed(i, "a") for i in range(1, 6)])
    recs = _recs(spark, [("a", p, p, b"x") for p in range(3)])
    got = sorted((r.partition, r.feed_id) for r in routing.group_split(recs, feeds).collect())
    assert got == [(0, 1), (1, 2), (2, 3)]


def test_fan_out_counts(spark):
    feeds = _feeds(spark)
    recs = _recs(spark, [("a", 0, 1, b"x"), ("b", 0, 2, b"y"), ("zz", 0, 3, b"q")])
    got = sorted((r.feed_id, r.topic) for r in routing.fan_out(recs, feeds).collect())
    a_feeds = [f[0] for f in FIXTURE_FEEDS if "a" in f[1].split(",") and f[11] == 1]
    b_feeds = [f[0] for f in FIXTURE_FEEDS if "b" in f[1].split(",") and f[11] == 1]
    assert got == sorted([(i, "a") for i in a_feeds] + [(i, "b") for i in b_feeds])


def test_bucket_columns_modes(spark):
    ts = datetime(2024, 1, 1, 23, 59, 59, 999999)
    df = spark.createDataFrame([("a", 2, 1, b"x", ts)], REC)
    hour = routing.route_bucket(df, "/base", mode="hour").first()
    day = routing.route_bucket(df, "/base", mode=None).first()
    assert hour.bucket_dir == "/base/a/2024-01-01/23" and day.bucket_dir == "/base/a/2024-01-01"
    assert hour.bucket_name == day.bucket_name == "2024-01-01_23_a_p2"
    nxt = routing.route_bucket(spark.createDataFrame([("a", 2, 1, b"x", datetime(2024, 1, 2))], REC), "/base")
    assert nxt.first().bucket_dir == "/base/a/2024-01-02/00"


def _range_assign(n_parts, members):
    """Kafka's range assignor for one topic: sorted members, contiguous ranges,
    the first n % c members take one extra partition."""
    q, r = divmod(n_parts, len(members))
    out, p = {}, 0
    for i, m in enumerate(sorted(members)):
        take = q + (1 if i < r else 0)
        for _ in range(take):
            out[p] = m
            p += 1
    return out


def test_group_split_matches_range_assignor(spark):
    feeds, recs, want = [], [], set()
    fid = 1
    for members in range(1, 6):
        group = f"g{members}"
        ids = list(range(fid, fid + members))
        fid += members
        for i in ids:
            feeds.append(_feed(i, ",".join(f"t{n}" for n in range(1, 8)), group=group))
    for n in range(1, 8):
        for p in range(n):
            recs.append((f"t{n}", p, 1000 * n + p, b"x"))
    for members in range(1, 6):
        group = f"g{members}"
        ids = [f[0] for f in feeds if f[2] == group]
        for n in range(1, 8):
            for p, m in _range_assign(n, ids).items():
                want.add((group, f"t{n}", p, m))
    got = {(r.group_id, r.topic, r.partition, r.feed_id)
           for r in routing.group_split(_recs(spark, recs), _feeds(spark, feeds)).collect()}
    assert got == want


def test_insert_rows_keys_with_tiny_chunks(spark):
    """Generated keys are max(key) + 1, + 2, ... in order, also when the
    numbering crosses many chunks (no partition key: the global path)."""
    from conftest import SF001
    from quayside.operators.tables import insert_rows
    from quayside.sources.tables import read_table

    s = read_table(spark, SF001, "supplier")
    c = read_table(spark, SF001, "customer").select(
        "c_custkey", F.col("c_name").alias("s_name"), F.col("c_nationkey").alias("s_nationkey"),
        F.col("c_acctbal").alias("s_acctbal"))
    top = s.agg(F.max("s_suppkey")).first()[0]
    out = insert_rows(s, c, "s_suppkey", "c_custkey", chunk_rows=2)
    new = out.filter(F.col("s_suppkey") > top).select("s_suppkey", "s_name").collect()
    names = [r.c_name for r in read_table(spark, SF001, "customer").orderBy("c_custkey").collect()]
    assert sorted((r.s_suppkey, r.s_name) for r in new) == [(top + i + 1, n) for i, n in enumerate(names)]
    assert out.count() == s.count() + len(names)


def test_reloader_reports_rejected_feeds(spark):
    from quayside.streaming.reload import FeedReloader

    seen = []
    FeedReloader(lambda sp: _feeds(sp), [seen.append]).refresh(spark)
    rejects = sorted((i, a) for i, a in seen[0] if a.startswith("reject:"))
    assert rejects == [(5, "reject:codec_required"), (6, "reject:unknown_codec"), (7, "reject:codec_on_plain"),
                       (8, "reject:codec_required"), (9, "reject:unknown_file_type"),
                       (10, "reject:path_required"), (11, "reject:bad_path_format")]
