"""Stream = batch: the same operators through Structured Streaming."""

import os

from conftest import SF001
from quayside.operators import rolling
from quayside.sinks import text
from quayside.sources.records import events_as_records, replay_stream
from quayside.sources.tables import read_table
from quayside.streaming.landing import land_stream_available_now


def _stream(spark):
    schema = read_table(spark, SF001, "events").schema
    return events_as_records(replay_stream(spark, SF001, schema, glob="events.parquet"))


def test_late_records_change_published_hours(spark, scratch):
    """Newest first: what comes behind the watermark is counted, as late."""
    from quayside.plans.catalog import replay_newest_first
    from quayside.streaming import partials

    out = os.path.join(scratch, "hours")
    replay_newest_first(spark, SF001, lambda r: partials.accumulate(r, partials.hour_partials(), out, os.path.join(scratch, "c"), {"availableNow": True}))
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 3
    got = partials.hours_published(spark, out, 3600)
    want = rolling.hours_complete(events_as_records(read_table(spark, SF001, "events")), 3600)
    assert got.drop("n_late").exceptAll(want).count() == 0 and got.count() == want.count()
    n, late = got.agg({"n_records": "sum", "n_late": "sum"}).select("sum(n_records)", "sum(n_late)").first()
    assert n == want.agg({"n_records": "sum"}).first()[0] and n / 2 < late < n


def test_replayed_batches_change_nothing(spark, scratch):
    """The same files once more under a new checkpoint: batch folders are
    written again, nothing is counted twice."""
    from quayside.streaming import partials

    out = os.path.join(scratch, "hours")
    for c in ("c1", "c2"):
        partials.finished(partials.accumulate(_stream(spark), partials.hour_partials(), out, os.path.join(scratch, c), {"availableNow": True}))
    assert partials.hours_published(spark, out, 0).agg({"n_records": "sum"}).first()[0] <= read_table(spark, SF001, "events").count()


def test_stream_landing_roundtrip(spark, scratch):
    out = land_stream_available_now(spark, SF001, "events.parquet", out_path=os.path.join(scratch, "out"))
    back = text.read_landed(spark, out, "batch_id string, topic string, d string, h string")
    src = read_table(spark, SF001, "events")
    assert back.count() == src.count()
    assert back.select("value").exceptAll(src.selectExpr("props AS value")).count() == 0


def test_feed_reload_per_batch(spark, scratch):
    """Three micro-batches; the config changes before the second and the
    read fails before the third (the running feeds stay)."""
    from pyspark.sql import functions as F

    from quayside.sources.feeds import feeds_from_nation
    from quayside.streaming.reload import FeedReloader, start_feed_landing

    src_dir = os.path.join(scratch, "src")
    ev = read_table(spark, SF001, "events")
    (ev.withColumn("part", F.floor(F.col("event_id") * 3 / ev.count()))
     .repartition(1).write.partitionBy("part").parquet(src_dir))
    files = []
    for p in range(3):
        files += [os.path.join(src_dir, f"part={p}", f) for f in os.listdir(os.path.join(src_dir, f"part={p}"))
                  if f.endswith(".parquet")]
    flat = os.path.join(scratch, "flat")
    os.makedirs(flat)
    for i, f in enumerate(files):
        os.link(f, os.path.join(flat, f"events-{i}.parquet"))

    nation = read_table(spark, SF001, "nation")
    calls = {"n": 0}

    def read(sp):
        calls["n"] += 1
        feeds = feeds_from_nation(nation)
        if calls["n"] == 2:
            return feeds.withColumn("filePathMode", F.lit("day"))  # every feed changes -> restart
        if calls["n"] >= 3:
            raise RuntimeError("config database unreachable")
        return feeds

    seen = []
    reloader = FeedReloader(read, [seen.append])
    stream = events_as_records(replay_stream(spark, flat, ev.schema, max_files_per_trigger=1, glob="*.parquet"))
    out, man = os.path.join(scratch, "out"), os.path.join(scratch, "manifest")
    # replaying weeks of history per micro-batch is a backfill: cluster by bucket
    q = start_feed_landing(stream, reloader, out, os.path.join(scratch, "ckpt"), manifest_path=man,
                           trigger={"availableNow": True}, cluster="rebalance")
    q.awaitTermination()
    assert q.exception() is None
    assert calls["n"] == 3
    assert {a for _, a in seen[0]} == {"start"} and {a for _, a in seen[1]} == {"restart"}
    assert len(seen) == 2  # the failed read changed nothing
    m = spark.read.parquet(man)
    assert m.select("batch_id").distinct().count() == 3
    # each record lands once for each consumer group of its topic
    from quayside.operators.routing import group_split

    landed = spark.read.parquet(man).agg(F.sum("n_records")).first()[0]
    assert landed == group_split(events_as_records(ev), feeds_from_nation(nation)).count()


def test_late_rows_land_and_are_counted(spark, scratch):
    import time as _time

    from pyspark.sql import functions as F

    from quayside.sources.feeds import feeds_from_nation
    from quayside.streaming.reload import FeedReloader, start_feed_landing

    ev = read_table(spark, SF001, "events")
    from datetime import datetime

    mid = F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz")  # events span 2024-01-01 .. 01-30
    src = os.path.join(scratch, "src")
    ev.filter(F.col("ts") >= mid).coalesce(1).write.parquet(os.path.join(src, "a"))
    _time.sleep(1.1)  # the file source orders files by modification time
    ev.filter(F.col("ts") < mid).coalesce(1).write.parquet(os.path.join(src, "b"))
    stream = events_as_records(spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true")
                               .option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.parquet")
                               .parquet(src))
    nation = read_table(spark, SF001, "nation")
    reloader = FeedReloader(lambda sp: feeds_from_nation(nation))
    man = os.path.join(scratch, "manifest")
    q = start_feed_landing(stream, reloader, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"),
                           manifest_path=man, trigger={"availableNow": True}, late_delay_seconds=3600,
                           cluster="rebalance")
    q.awaitTermination()
    m = spark.read.parquet(man)
    by_batch = {r.batch_id: (r.n, r.late) for r in
                m.groupBy("batch_id").agg(F.sum("n_records").alias("n"), F.sum("n_late").alias("late")).collect()}
    assert by_batch[0][1] == 0
    # every row of the older file is behind max(newer file) - 1 hour: all late, all landed
    assert by_batch[1][1] == by_batch[1][0] > 0


def test_a_batch_that_comes_again_finds_its_watermark(spark, scratch):
    """Batch 1 lands twice (a restart from an older checkpoint): the same
    late rows, files, manifest and rejected records."""
    from datetime import datetime

    from quayside.sources.feeds import feeds_from_nation
    from quayside.streaming import reload

    landed = {}
    nation = read_table(spark, SF001, "nation")
    hours = {0: [5, 6], 1: [2, 4, 5, 9], 2: [7, 8, 10]}
    rows = lambda n: spark.createDataFrame(
        [(None, b"x" if h != 4 else None, "click", 0, 100 * n + h, datetime(2024, 1, 1, h), 0) for h in hours[n]],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int")
    out = os.path.join(scratch, "out")
    land = _foreach_batch(reload, rows(0), reload.FeedReloader(lambda sp: feeds_from_nation(nation)), out, scratch)
    for n in (0, 1, 1, 2):
        land(rows(n), n)
        m = spark.read.parquet(f"{out}-manifest/batch_id={n}")
        dead = spark.read.parquet(f"{out}-rejected/batch_id={n}").count() if n == 1 else 0
        per_feed = m.groupBy("feed_id").sum("n_late", "n_records").collect()
        state = ({(r["sum(n_late)"], r["sum(n_records)"]) for r in per_feed}, dead)
        assert landed.setdefault(n, state) == state
    # watermarks: none, 06:00 - 1h, 09:00 - 1h (the rejected row of 04:00 lands nowhere)
    assert landed == {0: ({(0, 2)}, 0), 1: ({(1, 3)}, 1), 2: ({(1, 3)}, 0)}


def _foreach_batch(reload, records, reloader, out, scratch):
    """The micro-batch function that ``start_feed_landing`` hands to Spark."""
    class Writer:
        def foreachBatch(self, f):
            self.f = f
            return self

        def option(self, *a):
            return self

        def trigger(self, **k):
            return self

        def start(self):
            return self.f

    class Records:
        writeStream = Writer()

    original, reload.observed = reload.observed, lambda r: Records()
    try:
        return reload.start_feed_landing(records, reloader, out, os.path.join(scratch, "ckpt"))
    finally:
        reload.observed = original


def test_a_new_topic_is_subscribed(spark, scratch):
    """The feed table gains a feed of another topic after the first batch:
    the source starts again with both topics and nothing is lost."""
    from pyspark.sql import functions as F

    from quayside.sources.feeds import feeds_from_region
    from quayside.streaming.reload import FeedReloader, run_feed_landing

    ev = read_table(spark, SF001, "events")
    src = os.path.join(scratch, "src")
    ev.withColumn("topic", F.col("event_type")).coalesce(1).write.partitionBy("topic").parquet(src)
    region = read_table(spark, SF001, "region")
    calls, asked = {"n": 0}, []

    def read(sp):
        calls["n"] += 1
        return feeds_from_region(region).filter(F.col("id").isin([0] if calls["n"] < 3 else [0, 4]))

    def source(topics, threads):
        asked.append((topics, threads))
        paths = ",".join(f"topic={t}" for t in topics)
        return events_as_records(spark.readStream.schema(ev.schema).parquet(f"{src}/{{{paths}}}"))

    out, man = os.path.join(scratch, "out"), os.path.join(scratch, "man")
    counters = []
    for _ in range(2):   # caught up, then started again
        run_feed_landing(spark, source, FeedReloader(read), out, os.path.join(scratch, "ckpt"), manifest_path=man, cluster="rebalance",
                         trigger={"availableNow": True}, poll_seconds=0.2, on_counters=lambda n, rows: counters.extend(rows))
    assert asked[0] == (["click"], 2) and asked[-1] == (["click", "view"], 4)
    got = {r["feed_id"]: r["n"] for r in spark.read.parquet(man).groupBy("feed_id").agg(F.sum("n_records").alias("n")).collect()}
    want = {r["event_type"]: r["count"] for r in ev.groupBy("event_type").count().collect()}
    assert got == {0: want["click"], 4: want["view"]}
    assert sum(r["messages"] for r in counters) == want["click"] + want["view"]
