"""Rolls, sessions and exact numbering against brute force.

Small Arrow batches and tiny chunks force the cross-batch and cross-chunk
paths that the oracle queries (one chunk, one batch) do not reach.
"""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.operators import greedy, metrics, rolling
from quayside.operators.sequence import chunked_row_number


def _rows(n, keys=("a", "b", "c"), seed=7, min_size=1):
    rnd = random.Random(seed)
    base = datetime(2024, 1, 1)
    out = []
    for i in range(n):
        k = rnd.choice(keys)
        out.append((k, rnd.randint(0, 2), i * 3 + rnd.randint(0, 2), rnd.randint(min_size, 60),
                    base + timedelta(seconds=rnd.randint(0, 3 * 86400))))
    return out


SCHEMA = "topic string, partition int, offset long, n_bytes long, timestamp timestamp"


def _greedy_size(rows, limit):
    out, state = {}, {}
    for t, p, o, sz, ts in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        seq, fill = state.get(t, (0, 0))
        if fill >= limit:
            seq, fill = seq + 1, 0
        fill += sz
        state[t] = (seq, fill)
        out[(t, p, o)] = seq
    return out


def _greedy_interval(rows, secs):
    out, state = {}, {}
    for t, p, o, sz, ts in sorted(rows, key=lambda r: (r[0], r[4], r[2], r[1])):
        if t not in state:
            state[t] = (0, ts)
        seq, anchor = state[t]
        if ts >= anchor + timedelta(seconds=secs):
            seq, anchor = seq + 1, ts
        state[t] = (seq, anchor)
        out[(t, p, o)] = seq
    return out


@pytest.fixture()
def small_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


@pytest.mark.parametrize("limit", [1, 50, 200, 1000])
def test_roll_by_size_matches_greedy(spark, small_batches, limit):
    rows = _rows(400)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.topic, r.partition, r.offset): r.roll_seq
           for r in rolling.roll_by_size(df, limit, ["topic"]).collect()}
    assert got == _greedy_size(rows, limit)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_roll_by_size_with_empty_records(spark, small_batches, seed):
    """Zero-byte records (empty value, no line break) never open a file on
    their own, and one that follows a full file starts the next one."""
    rows = _rows(300, seed=seed, min_size=0)
    rows = [(t, p, o, 0 if o % 4 == 0 else sz, ts) for t, p, o, sz, ts in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.topic, r.partition, r.offset): r.roll_seq
           for r in rolling.roll_by_size(df, 90, ["topic"]).collect()}
    assert got == _greedy_size(rows, 90)


def test_roll_by_size_exact_boundary(spark):
    # 3 records of 100 bytes, limit 200: the 2nd reaches the limit exactly,
    # so the 3rd opens a new file
    df = spark.createDataFrame([("t", 0, i, 100, datetime(2024, 1, 1)) for i in range(3)], SCHEMA)
    assert [r.roll_seq for r in rolling.roll_by_size(df, 200, ["topic"]).orderBy("offset").collect()] == [0, 0, 1]


@pytest.mark.parametrize("secs", [60, 3600, 45 * 60])
def test_roll_by_interval_matches_greedy(spark, small_batches, secs):
    rows = _rows(400)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.topic, r.partition, r.offset): r.roll_seq
           for r in rolling.roll_by_interval(df, secs, ["topic"]).collect()}
    assert got == _greedy_interval(rows, secs)


@pytest.mark.parametrize("parts,fan", [(5, 64), (30, 3)])
def test_a_bucket_cut_over_parts_rolls_as_one(spark, parts, fan):
    """One bucket holds most rows and lies in many parts, whose tables are
    composed over several levels; some keys are null, some rows empty."""
    rows = _rows(600, keys=("a", "a", "a", "a", "a", "b", None), min_size=0)
    rows = [(t, p, o, 0 if o % 5 == 0 else sz, ts) for t, p, o, sz, ts in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    named = [(r[0] or "", *r[1:]) for r in rows]
    by = {"size": ["offset", "partition"], "interval": ["us", "offset", "partition"]}
    df = df.withColumn("us", F.unix_micros("timestamp"))
    for kind, measure, limit in [("size", "n_bytes", n) for n in (30, 1500)] + [("interval", "us", 7200 * 1_000_000)]:
        rolled = greedy.greedy_roll(df, ["topic"], by[kind], measure, kind, limit, parts, fan)
        want = _greedy_size(named, limit) if kind == "size" else _greedy_interval(named, limit / 1_000_000)
        assert {(r.topic or "", r.partition, r.offset): r.roll_seq for r in rolled.collect()} == want


@pytest.mark.parametrize("seed", range(5))
def test_transfer_tables_compose(seed):
    """Tables of random places, equal ones among them, against a walk over all rows."""
    rnd = np.random.default_rng(seed)
    x = np.sort(rnd.integers(0, 400, 200)) * 3
    for limit in (1, 7, 50, 5000):
        cuts = np.sort(rnd.choice(np.arange(1, 200), 12, replace=False))
        parts = [p for p in np.split(x, cuts) if len(p)]
        tables = [greedy.transfer(p, limit) for p in parts[1:]]
        whole = greedy.composed(tables, int(parts[1][0]), limit)
        for anchor in parts[0][parts[0] + limit > parts[0][-1]]:
            rolls, at = 0, anchor
            for v in np.concatenate(parts[1:]):
                if v >= at + limit:
                    rolls, at = rolls + 1, v
            got = greedy.through(whole, np.zeros(1, np.int64), np.array([anchor]), limit)
            assert (int(got[0][0]), int(got[1][0])) == (rolls, at)


def test_a_large_bucket_uses_all_tasks(spark):
    """A third of all rows in one bucket: no part reads much more than the others."""
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"), "id", (F.col("id") % 97).alias("n"))
    rolled = greedy.greedy_roll(df, ["k"], ["id"], "n", "size", 5000, 12)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rolled.filter("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count() >= 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = [(r.n, r.roll_seq) for r in rolled.filter("k = 'hot'").orderBy("id").collect()]
    seq = fill = 0
    for n, got in hot:
        if fill >= 5000:
            seq, fill = seq + 1, 0
        fill += n
        assert got == seq


@pytest.mark.parametrize("chunk", [1, 5, 64, 1 << 20])
def test_chunked_row_number(spark, chunk):
    rows = _rows(300)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.topic, r.partition, r.offset): r.rn for r in
           chunked_row_number(df, ["topic"], ["offset", "partition"], F.floor(F.col("offset") / chunk)).collect()}
    want = {}
    for t in {r[0] for r in rows}:
        for i, r in enumerate(sorted((r for r in rows if r[0] == t), key=lambda r: (r[2], r[1]))):
            want[(r[0], r[1], r[2])] = i + 1
    assert got == want


def test_roll_by_count_small_chunks(spark):
    rows = _rows(300)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.topic, r.partition, r.offset): r.roll_seq
           for r in rolling.roll_by_count(df, 4, ["topic"], chunk=3).collect()}
    want = {}
    for t in {r[0] for r in rows}:
        for i, r in enumerate(sorted((r for r in rows if r[0] == t), key=lambda r: (r[2], r[1]))):
            want[(r[0], r[1], r[2])] = i // 4
    assert got == want


def _sessions(rows, gap):
    out = []
    for t in sorted({r[0] for r in rows}):
        ts = sorted(r[4] for r in rows if r[0] == t)
        start = prev = ts[0]
        n = 1
        for x in ts[1:]:
            if x - prev >= timedelta(seconds=gap):
                out.append((t, start, prev, n))
                start, n = x, 0
            prev = x
            n += 1
        out.append((t, start, prev, n))
    return sorted(out)


@pytest.mark.parametrize("gap,per", [(60, None), (600, None), (1800, None), (7200, None),
                                     (600, 1), (600, 3), (1800, 2), (60, 7)])
def test_idle_sessions_brute_force(spark, gap, per):
    """``per`` forces tiny chunks so sessions are linked across many chunks."""
    rows = _rows(500)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.topic, r.session_start, r.last_record, r.n_records)
                 for r in rolling.idle_sessions(df, gap, slices_per_chunk=per).collect())
    assert got == _sessions(rows, gap)


def test_session_gap_exactly_equal_starts_new(spark):
    t0 = datetime(2024, 1, 1, 0, 10)
    rows = [("t", 0, 1, 1, t0), ("t", 0, 2, 1, t0 + timedelta(minutes=30)),
            ("t", 0, 3, 1, t0 + timedelta(minutes=59, seconds=59, microseconds=999999))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.session_start, r.n_records) for r in rolling.idle_sessions(df, 1800).collect())
    assert got == [(t0, 1), (t0 + timedelta(minutes=30), 2)]


def test_hours_complete_boundaries(spark):
    base = datetime(2024, 1, 1)
    rows = [("t", 0, 1, 1, base + timedelta(hours=1) - timedelta(microseconds=1)),
            ("t", 0, 2, 1, base + timedelta(hours=1)),
            ("t", 0, 3, 1, base + timedelta(hours=3))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.hour_start, r.n_records) for r in rolling.hours_complete(df, 3600).collect())
    # watermark = 03:00 - 1h = 02:00: hours 00 and 01 are complete, 03 is not
    assert got == [(base, 1), (base + timedelta(hours=1), 1)]


def test_running_totals_brute_force(spark):
    rows = _rows(600)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("line", F.lit("xy"))
    per = metrics.flow_per_second(df)
    got = {(r.topic, r.second): (r.total_messages, r.total_chars)
           for r in metrics.running_totals(per.drop("flow_size")).collect()}
    want, acc = {}, {}
    for t, _, _, _, ts in sorted(rows, key=lambda r: (r[0], r[4])):
        s = ts.replace(microsecond=0)
        n, c = acc.get(t, (0, 0))
        acc[t] = (n + 1, c + 2)
        want[(t, s)] = acc[t]
    assert got == want


def test_unknown_sizes_roll_nothing(spark, small_batches):
    rows = [("a", 0, i, None if i == 3 else 50, datetime(2024, 1, 1)) for i in range(12)]
    got = rolling.roll_by_size(spark.createDataFrame(rows, SCHEMA), 100, ["topic"]).collect()
    assert sorted((r.offset, r.roll_seq) for r in got) == [(i, (i - (i > 3)) // 2) for i in range(12) if i != 3]


def test_sparse_keys_need_few_chunks(spark):
    """Ids spread over 64 bits: the chunk table follows the rows."""
    from quayside.operators.sequence import sized_chunk

    rnd = random.Random(3)
    ids = [rnd.randrange(-2**62, 2**62) for _ in range(1000)]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    assert df.select(sized_chunk(df, "id", 100).alias("c")).distinct().count() <= 11
    got = chunked_row_number(df, [], ["id"], sized_chunk(df, "id", 100), "rn").collect()
    assert [r.id for r in sorted(got, key=lambda r: r.rn)] == sorted(ids)
