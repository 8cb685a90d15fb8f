"""Progress versions: stable owners, low watermarks, batches that come again."""

import datetime as dt
import os

from pyspark.sql import functions as F
from test_streaming import _foreach_batch

from conftest import SF001
from quayside.operators import rolling
from quayside.sources.feeds import feeds_from_region
from quayside.sources.tables import read_table
from quayside.streaming import partials, progress

RECORD = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
DAY = dt.datetime(2024, 1, 1)


def at(hour, minute=0):
    return DAY + dt.timedelta(hours=hour, minutes=minute)


def batch(spark, *rows):
    """(partition, offset, hour) rows of topic click."""
    return spark.createDataFrame([(None, f"p{p}".encode(), "click", p, o, at(h), 0) for p, o, h in rows], RECORD)


def test_versions_grow_and_come_again(spark, scratch):
    one = progress.advance(batch(spark, (0, 5, 1), (3, 9, 2)), scratch, 0)
    assert {(r.partition, r.clock, r.last_offset) for r in one.collect()} == {(0, at(1), 5), (3, at(2), 9)}
    for _ in range(2):      # a batch that is delivered again
        two = progress.advance(batch(spark, (0, 6, 4), (1, 2, 3)), scratch, 1)
        assert {(r.partition, r.clock, r.last_offset) for r in two.collect()} == {(0, at(4), 6), (1, at(3), 2), (3, at(2), 9)}
        assert progress.partition_totals(two).collect()[0].n_parts == 4
    known = spark.createDataFrame([("click", 6), ("new", 2)], "topic string, n_parts int")
    assert {(r.topic, r.n_parts) for r in progress.partition_totals(progress.advance(batch(spark), scratch, 2, known)).collect()} == {("click", 6), ("new", 2)}


def test_old_versions_go(spark, scratch, monkeypatch):
    monkeypatch.setattr(progress, "KEEP", 2)
    for n in range(5):
        progress.advance(batch(spark, (0, n, n)), scratch, n)
    assert sorted(f for f in os.listdir(scratch) if f.startswith("batch")) == ["batch_id=3", "batch_id=4"]


def test_marks(spark, scratch):
    seen = [at(20), at(23)]
    progress.advance(batch(spark, (0, 1, 10), (1, 1, 4)), scratch, 0, now=seen[0])
    p = progress.advance(batch(spark, (0, 2, 12), (2, 1, 9)), scratch, 1, now=seen[1])
    assert progress.mark(p) == at(4) and progress.mark(p, by_partition=False) == at(12)
    assert progress.mark(p, idle_seconds=7200) == at(9)                    # partition 1 has said nothing for 3 hours
    assert progress.mark(p, idle_seconds=7200, now=at(40)) == at(12)       # nobody has: all that came is there
    empty = progress.version(spark, os.path.join(scratch, "none"), -1)
    assert progress.mark(empty) is None and progress.mark(empty, 60) is None


def test_a_slow_partition_holds_an_hour_open(spark):
    r = batch(spark, (0, 1, 1), (0, 2, 9), (1, 1, 1), (1, 2, 3))
    hours = lambda d: {x.hour_start.hour for x in d.collect()}
    assert hours(rolling.hours_complete_low(r, 0)) == {1}
    assert hours(rolling.hours_complete(r, 0)) == {1, 3}
    assert hours(rolling.hours_complete_low(r, 0, idle_seconds=3600)) == {1, 3}
    assert rolling.hours_complete_low(batch(spark), 0).count() == 0


def _feeds(spark):
    """Two members of one group on one topic."""
    one = feeds_from_region(read_table(spark, SF001, "region")).filter("topics = 'click'").withColumn("groupID", F.lit("g"))
    return one.unionByName(one.withColumn("id", F.col("id") + 100).withColumn("filePath", F.lit("/logs/second")))


def test_owners_stay_when_batches_lack_partitions(spark, scratch):
    """Four partitions, two members: 0 and 1 are the first's, 2 and 3 the
    second's, also in batches that hold only some, and when one comes again."""
    from quayside.streaming import reload

    feeds, out = _feeds(spark), os.path.join(scratch, "out")
    land = _foreach_batch(reload, batch(spark), reload.FeedReloader(lambda sp: feeds), out, scratch)
    first, second = sorted(r.id for r in feeds.select("id").collect())
    owners = {0: first, 1: first, 2: second, 3: second}
    batches = [[(0, 0, 1), (1, 0, 1), (2, 0, 1), (3, 0, 1)], [(0, 1, 2), (1, 1, 2)], [(2, 2, 3)], [(1, 3, 4), (3, 3, 4)]]
    for n in (0, 1, 1, 2, 3, 2):
        land(batch(spark, *batches[n]), n)
        got = {r.feed_id: r.n for r in spark.read.parquet(f"{out}-manifest/batch_id={n}").groupBy("feed_id").agg(F.sum("n_records").alias("n")).collect()}
        want = {}
        for p, _, _ in batches[n]:
            want[owners[p]] = want.get(owners[p], 0) + 1
        assert got == want


def test_reported_partitions_decide_from_the_first_batch_on(spark, scratch):
    out = os.path.join(scratch, "out")
    feeds = _feeds(spark)
    known = spark.createDataFrame([("click", 4)], "topic string, n_parts int")
    src = os.path.join(scratch, "src")
    batch(spark, (1, 0, 1)).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    partials.finished(partials.start_group_split(stream, feeds, out, os.path.join(scratch, "c"), {"availableNow": True}, known))
    assert [r.feed_id for r in spark.read.parquet(out).collect()] == [min(r.id for r in feeds.collect())]


def test_a_landing_leaves_no_scratch(spark, scratch):
    """Folders that a micro-batch writes aside go with it; the feeds' snapshot is one."""
    from quayside.session import ensure_checkpoint_dir, local_path
    from quayside.streaming import reload

    feeds, out = _feeds(spark), os.path.join(scratch, "out")
    land = _foreach_batch(reload, batch(spark), reload.FeedReloader(lambda sp: feeds), out, scratch)
    folder = local_path(ensure_checkpoint_dir(spark))
    land(batch(spark, (0, 1, 1)), 0)
    before = set(os.listdir(folder))
    for n in (1, 2):
        land(batch(spark, (0, n + 1, n + 1)), n)
    assert set(os.listdir(folder)) == before
