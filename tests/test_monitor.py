"""Progress of batches as a table, stops after a commit, subscriptions that change."""

import os
import signal
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from quayside.sources.feeds import feeds_from_region
from quayside.sources.records import events_as_records
from quayside.sources.tables import read_table
from quayside.streaming import monitor, reload
from quayside.streaming.partials import finished

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def commits(checkpoint):
    """(batches begun, batches committed) of a checkpoint."""
    names = lambda d: {int(n) for n in os.listdir(os.path.join(checkpoint, d)) if n.isdigit()}
    return names("offsets"), names("commits")


def recorded(spark, folder, files):
    ev = read_table(spark, SF001, "events")
    ev.repartitionByRange(files, "event_id").write.parquet(folder)
    return ev


def test_progress_is_a_table(spark, scratch):
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    ev = recorded(spark, src, 4)
    stream = events_as_records(spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(src))
    listener, states = monitor.ProgressLog(spark, os.path.join(scratch, "log"), states=lambda *a: states.append(a)), []
    listener.states = lambda *a: states.append(a)
    spark.streams.addListener(listener)
    try:
        finished(reload.observed(stream).writeStream.format("parquet").option("checkpointLocation", os.path.join(scratch, "c")).trigger(availableNow=True).start(out))
        for _ in range(100):
            if any(s == "terminated" for _, s, _ in states):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert [s for _, s, _ in states] == ["started", "terminated"]
    p = monitor.progress_table(spark, os.path.join(scratch, "log"))
    got = sorted((r.batch_id, r.input_rows, r.messages) for r in p.collect())
    assert len(got) == 2 and sum(n for _, n, _ in got) == ev.count() == sum(m for _, _, m in got)
    flow = monitor.batch_flow(p).orderBy("batch_id").collect()
    assert flow[-1].total_messages == ev.count() and flow[-1].total_chars == p.agg(F.sum("chars")).first()[0]
    assert all(r.qps > 0 and r.flow_size.endswith("M") for r in flow)


def slow_stream(spark, scratch, files=6):
    src = os.path.join(scratch, "src")
    ev = recorded(spark, src, files)
    return lambda topics, threads: events_as_records(spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)).filter(F.col("topic").isin(topics))


def test_a_marker_ends_the_landing_after_a_commit(spark, scratch):
    """The marker comes while batch 1 lands: 1 is committed, 2 isn't begun;
    the next run lands the rest, and every record once."""
    region, marker = read_table(spark, SF001, "region"), os.path.join(scratch, "stop")
    out, chk, man = (os.path.join(scratch, n) for n in ("out", "chk", "man"))
    source = slow_stream(spark, scratch)
    run = lambda on: reload.run_feed_landing(
        spark, source, reload.FeedReloader(lambda sp: feeds_from_region(region)), out, chk, poll_seconds=0.2, drain=monitor.Drain(spark, marker), manifest_path=man,
        trigger={"availableNow": True}, on_counters=on)
    run(lambda n, rows: open(marker, "w").close() if n == 1 else None)
    assert commits(chk)[1] == {0, 1} and not os.path.exists(marker)
    assert {r.batch_id for r in spark.read.parquet(man).select("batch_id").distinct().collect()} == {0, 1}
    run(None)
    begun, done = commits(chk)
    assert begun == done == set(range(6))
    landed = spark.read.parquet(man).agg(F.sum("n_records")).first()[0]
    assert landed == read_table(spark, SF001, "events").filter("props IS NOT NULL").count()


def test_sigterm_ends_the_command_after_a_commit(spark, scratch):
    src, feeds = os.path.join(scratch, "src"), os.path.join(scratch, "feeds")
    recorded(spark, src, 2)
    feeds_from_region(read_table(spark, SF001, "region")).write.parquet(feeds)
    out, chk, log = (os.path.join(scratch, n) for n in ("out", "chk", "log"))
    env = {**os.environ, "PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"}
    p = subprocess.Popen([sys.executable, "-m", "quayside", "land", "--replay", src, "--feeds-parquet", feeds, "--out", out, "--checkpoint", chk,
                          "--trigger-seconds", "1", "--progress", log], env=env, cwd=scratch, stdout=subprocess.PIPE, stderr=subprocess.STDOUT)
    try:
        for _ in range(600):
            if os.path.isdir(f"{out}-manifest/_progress/batch_id=0"):
                break       # the first batch is being landed
            assert p.poll() is None, p.stdout.read().decode()[-2000:]
            time.sleep(0.2)
        p.send_signal(signal.SIGTERM)
        text, _ = p.communicate(timeout=240)
    finally:
        p.kill()
    assert p.returncode == 0, text.decode()[-2000:]
    begun, done = commits(chk)
    assert 0 in done and len(begun - done) <= 1       # a batch that was planned and left has written nothing
    for n in begun - done:
        assert not os.path.exists(os.path.join(out, f"batch_id={n}"))


def region_feeds(region, threads):
    """Feeds of the topics named, with so many threads."""
    wanted = F.create_map(*[F.lit(x) for t, n in threads.items() for x in (t, n)])
    return feeds_from_region(region).filter(F.col("topics").isin(list(threads))).withColumn("numThreads", wanted[F.col("topics")])


def test_subscriptions_start_stop_and_resize_with_their_offsets(spark, scratch):
    """click and view; view stops and click gets threads; view comes back.
    Each change starts a generation from the committed offsets; nothing is
    lost or landed twice, a batch number is used once."""
    region, ev = read_table(spark, SF001, "region"), read_table(spark, SF001, "events")
    out, chk, man, src = (os.path.join(scratch, n) for n in ("out", "chk", "man", "src"))
    asked = []

    def source(topics, threads, starts):
        asked.append((topics, threads, {t: len(ps) for t, ps in starts.items()}))
        r = events_as_records(spark.readStream.schema(ev.schema).parquet(src)).filter(F.col("topic").isin(topics))
        known = [(F.col("topic") == t) & (F.col("partition") == p) & (F.col("offset") < o) for t, ps in starts.items() for p, o in ps.items()]
        for c in known:
            r = r.filter(~c)
        return r

    steps = [({"click": 2, "view": 1}, 300), ({"click": 5}, 600), ({"click": 5, "view": 1}, 1000), ({"click": 5, "view": 1}, 1001)]
    for threads, upto in steps:
        ev.filter((F.col("event_id") < upto) & (F.col("event_id") >= dict(zip([s[1] for s in steps], [0] + [s[1] for s in steps]))[upto])).coalesce(1).write.mode("append").parquet(src)
        reload.run_feed_landing(spark, source, reload.FeedReloader(lambda sp, t=threads: region_feeds(region, t)), out, chk, hand_over=True,
                                manifest_path=man, trigger={"availableNow": True}, poll_seconds=0.2)
    assert [a[:2] for a in asked] == [(["click", "view"], 3), (["click"], 5), (["click", "view"], 6), (["click", "view"], 6)]
    assert asked[0][2] == {} and set(asked[1][2]) == {"click", "view"} == set(asked[2][2])
    got = {r.feed_id: r.n for r in spark.read.parquet(man).groupBy("feed_id").agg(F.sum("n_records").alias("n")).collect()}
    want = {t: ev.filter(F.col("event_type") == t).filter("props IS NOT NULL").count() for t in ("click", "view")}
    assert got == {0: want["click"], 4: want["view"]}
    batches = [r.batch_id for r in spark.read.parquet(man).groupBy("batch_id").count().collect()]
    assert sorted(batches) == list(range(len(batches)))


def test_a_batch_begun_before_the_change_is_landed_again(spark, scratch):
    """A generation that was killed in its second batch hands over the
    offsets of the first, and its second batch's number."""
    g = reload.Generations(spark, os.path.join(scratch, "chk"), os.path.join(scratch, "p"))
    folder, first, starts = g.enter({"a": 1})
    assert (first, starts) == (0, {}) and g.enter({"a": 1})[:2] == (folder, 0)
    from quayside.streaming import progress
    from test_progress import batch

    for n, rows in enumerate([[(0, 5, 1)], [(0, 9, 2)]]):
        progress.advance(batch(spark, *rows), os.path.join(scratch, "p"), n)
    os.makedirs(os.path.join(folder, "commits"))
    open(os.path.join(folder, "commits", "0"), "w").close()
    assert g.enter({"a": 2}) == (os.path.join(scratch, "chk", "generation=1"), 1, {"click": {0: 6}})
    assert g.enter({"a": 3}) == (os.path.join(scratch, "chk", "generation=2"), 1, {"click": {0: 6}})    # nothing committed in between


@pytest.mark.parametrize("running,wanted,moves", [
    ({}, {"a": 1}, {"a": "start"}), ({"a": 1, "b": 2}, {"b": 3}, {"a": "stop", "b": "resize"}), ({"a": 1}, {"a": 1}, {})])
def test_topic_changes(running, wanted, moves):
    assert reload.topic_changes(running, wanted) == moves
