"""Offset ranges against sets of numbers."""

import os
import random

import pytest

from quayside.operators import ranges
from quayside.streaming import partials

ROW = "topic string, partition int, offset bigint"


def numbers(seed, n=400, top=3000):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        start = rng.randrange(top)
        out += [("a" if rng.random() < .8 else "b", rng.randrange(2), o) for o in range(start, start + rng.choice([1, 1, 5, 60]))]
    return out


def islands(rows):
    out, last = set(), None
    for r in sorted(set(rows)) + [None]:
        if last and r and r[:2] == last[0][:2] and r[2] == last[1][2] + 1:
            last = (last[0], r)
            continue
        if last:
            out.add((*last[0], last[1][2]))
        last = (r, r)
    return out


@pytest.mark.parametrize("block,span", [(4, 16), (64, 100), (1 << 12, 1 << 20)])
def test_ranges_of_offsets(spark, block, span):
    rows = numbers(block)
    got = ranges.ranges_of(spark.createDataFrame(rows + rows[:50], ROW), block, span).collect()
    assert len(got) == len(islands(rows)) and {tuple(r) for r in got} == islands(rows)


def test_merging_ranges_that_overlap(spark):
    rng = random.Random(3)
    some = [("a", 0, lo, lo + rng.choice([0, 3, 500])) for lo in (rng.randrange(5000) for _ in range(80))]
    want = islands([("a", 0, o) for _, _, lo, hi in some for o in range(lo, hi + 1)])
    got = ranges.merged(spark.createDataFrame(some, ranges.SCHEMA), 64)
    assert {tuple(r) for r in got.collect()} == want
    holes = {(r.lo, r.hi) for r in ranges.gaps(got).collect()}
    ends = sorted((lo, hi) for _, _, lo, hi in want)
    assert holes == {(a[1] + 1, b[0] - 1) for a, b in zip(ends, ends[1:])}


@pytest.mark.parametrize("block", [4, 1 << 12])
def test_without(spark, block):
    landed, rows = numbers(1, 60), [(*r, i) for i, r in enumerate(numbers(2, 60))]
    held = ranges.ranges_of(spark.createDataFrame(landed, ROW))
    got = ranges.without(spark.createDataFrame(rows, ROW + ", block int"), held, block)
    assert got.columns == ["topic", "partition", "offset", "block"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(r for r in rows if r[:3] not in set(landed))
    assert ranges.without(spark.createDataFrame([], ROW), held).count() == 0
    assert ranges.without(spark.createDataFrame(rows, ROW + ", b int"), spark.createDataFrame([], ranges.SCHEMA)).count() == len(rows)


def test_state_grows_with_gaps(spark, scratch):
    """A thousand records, then copies and the missing ones: three ranges, then one."""
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    sets = [range(0, 1000, 1), list(range(0, 1000)) + list(range(1100, 1200)) + [1300], list(range(900, 1400))]
    sizes = []
    for offsets in sets:
        rows = [("t", 0, o) for o in offsets]
        spark.createDataFrame(rows + rows[:10], ROW).selectExpr("*", "timestamp_seconds(offset) AS timestamp").write.mode("append").parquet(src)
        stream = spark.readStream.schema(ROW + ", timestamp timestamp").parquet(src)
        partials.finished(partials.start_dedup(stream, out, os.path.join(scratch, "c"), {"availableNow": True}))
        sizes.append(sorted((r.lo, r.hi) for r in partials.landed_ranges(spark, out).collect()))
    assert sizes == [[(0, 999)], [(0, 999), (1100, 1199), (1300, 1300)], [(0, 1399)]]
    back = spark.read.parquet(out)
    assert back.count() == 1400 == back.select("offset").distinct().count()
    assert {r.batch_id: r["count"] for r in back.groupBy("batch_id").count().collect()} == {0: 1000, 1: 101, 2: 299}
