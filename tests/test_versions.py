"""Versions of landed files, and the sweep of what a killed writer leaves."""

import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from quayside.plans.landing import land_batch
from quayside.sinks import recovery
from quayside.sinks.files import read_back
from quayside.sinks.versions import Conflict, FileTable, compact_table
from quayside.sources.feeds import feeds_from_region
from quayside.sources.tables import read_table

RECORD = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
ONE = "path string, n bigint"


def land(spark, out, lo, hi):
    """A landing of a few hours of two topics: lines lo to hi."""
    rows = [(None, f"line {i}".encode(), ("click", "view")[i % 2], 0, i, datetime(2024, 1, 1, i // 2 % 3), 0) for i in range(lo, hi)]
    return land_batch(spark.createDataFrame(rows, RECORD), feeds_from_region(read_table(spark, SF001, "region")), out)


def lines(files):
    return sorted(x for r in read_back(files.select("path", "codec")).collect() for x in bytes(r.body).decode().splitlines())


def small(spark, *rows):
    return spark.createDataFrame([(p, n) for p, n in rows], ONE)


def paths(df):
    return sorted(r.path for r in df.collect())


def test_versions_are_whole_and_stay(spark, scratch):
    t = FileTable(spark, os.path.join(scratch, "t"), ONE)
    assert t.latest() == 0 and t.files().count() == 0
    assert t.publish(small(spark, ("a", 1), ("b", 2))) == 1
    assert t.publish(small(spark, ("c", 3)), small(spark, ("a", 0))) == 2
    assert paths(t.files(1)) == ["a", "b"] and paths(t.files()) == ["b", "c"]
    assert t.publish(small(spark, ("a", 9))) == 3          # a name that comes again
    assert {(r.path, r.n) for r in t.files().collect()} == {("a", 9), ("b", 2), ("c", 3)}
    with pytest.raises(ValueError):
        t.files(7)
    assert [h["version"] for h in t.history()] == [1, 2, 3]


def test_two_writers(spark, scratch, monkeypatch):
    """Both publish onto version 1; the second finds 2 taken and makes 3.
    Who wants to replace what the other has replaced gets a conflict."""
    t, other = (FileTable(spark, os.path.join(scratch, "t"), ONE) for _ in range(2))
    t.publish(small(spark, ("a", 1), ("b", 1)))
    original, once = FileTable._put, []

    def late(self, path, what):
        if self is t and not once:
            once.append(other.publish(small(spark, ("x", 1)), small(spark, ("a", 0))))
        return original(self, path, what)

    monkeypatch.setattr(FileTable, "_put", late)
    assert t.publish(small(spark, ("y", 1)), small(spark, ("b", 0))) == 3 and once == [2]
    assert paths(t.files()) == ["x", "y"] and paths(t.files(2)) == ["b", "x"]
    once.clear()
    with pytest.raises(Conflict):
        once.append(1)
        t.publish(small(spark, ("z", 1)), small(spark, ("a", 0)))
    assert t.latest() == 3


def test_snapshots_shorten_the_log(spark, scratch, monkeypatch):
    monkeypatch.setattr("quayside.sinks.versions.SNAPSHOT_EVERY", 3)
    t = FileTable(spark, os.path.join(scratch, "t"), ONE)
    for i in range(7):
        t.publish(small(spark, (f"f{i}", i)), small(spark, (f"f{i - 2}", 0)) if i >= 2 else None)
    assert paths(t.files()) == ["f5", "f6"] and paths(t.files(3)) == ["f1", "f2"] and paths(t.files(5)) == ["f3", "f4"]
    assert t._snapshot(6) and not t._snapshot(5)


def test_compaction_under_readers(spark, scratch):
    """Readers of a version see every line once, before, during and after;
    what no version needs goes by expiry, what is pinned stays."""
    t = FileTable(spark, os.path.join(scratch, "t"))
    want = sorted(f"line {i}" for i in range(24))
    for n, (lo, hi) in enumerate([(0, 12), (12, 24)]):
        t.publish(land(spark, os.path.join(scratch, f"out{n}"), lo, hi))
    before = t.pin("reader")
    assert compact_table(t, os.path.join(scratch, "merged")) == 3
    assert t.files(2).count() == 12 and t.files().count() == 6
    assert lines(t.files(before)) == want == lines(t.files())
    assert t.files().agg(F.sum("n_records")).first()[0] == 24
    assert t.expire(keep=1).count() == 0 and lines(t.files(before)) == want
    t.unpin("reader")
    assert {r.removed for r in t.expire(keep=1).collect()} == {True}
    assert lines(t.files()) == want and t.versions() == [3]
    with pytest.raises(ValueError):
        t.files(2)
    assert not [f for _, _, fs in os.walk(os.path.join(scratch, "out0")) for f in fs if "click" in f and not f.startswith(".")]
    assert compact_table(t, os.path.join(scratch, "merged")) is None
    t.publish(land(spark, os.path.join(scratch, "out3"), 24, 30))
    assert len(lines(t.files())) == 30


def test_a_large_bucket_is_merged_in_parts(spark, scratch):
    """Files of one bucket merge part by part, each in a task of its own; a
    bucket whose feed changed its codec keeps the codecs apart."""
    t = FileTable(spark, os.path.join(scratch, "t"))
    for n in range(6):
        t.publish(land(spark, os.path.join(scratch, f"out{n}"), 6 * n, 6 * n + 6))
    gz = land(spark, os.path.join(scratch, "gz"), 36, 42)
    t.publish(gz)
    want = lines(t.files())
    one = t.files().filter("feed_id = 0").agg(F.max("n_bytes")).first()[0]
    assert compact_table(t, os.path.join(scratch, "merged"), part_bytes=2 * one) is not None
    assert lines(t.files()) == want
    per_bucket = [r["count"] for r in t.files().groupBy("feed_id", "bucket_start").count().collect()]
    assert all(3 <= n <= 5 for n in per_bucket)
    assert compact_table(t, os.path.join(scratch, "merged")) is not None and lines(t.files()) == want
    assert t.files().count() == len(per_bucket)


def test_a_crash_before_publishing_loses_nothing(spark, scratch, monkeypatch):
    t, out = FileTable(spark, os.path.join(scratch, "t")), os.path.join(scratch, "out")
    t.publish(land(spark, out, 0, 6))

    def crash(self, path, what):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(FileTable, "_put", crash)
        new = land(spark, out, 6, 12)
        with pytest.raises(RuntimeError):
            t.publish(new)
    assert t.latest() == 1 and len(lines(t.files())) == 6
    orphans = recovery.sweep(t.files(), out, older_than_seconds=0)
    assert orphans.filter("status = 'orphan' AND removed").count() == new.count() and len(lines(t.files())) == 6
    t.publish(land(spark, out, 6, 12))
    assert len(lines(t.files())) == 12


def test_sweep(spark, scratch):
    out = os.path.join(scratch, "out")
    m = land(spark, out, 0, 24).drop("complete")
    files = sorted(r.path for r in m.collect())
    folder = os.path.dirname(files[0])
    os.remove(files[0])
    with open(files[1], "ab") as f:
        f.write(b"more")
    for name in ("_x_b00000.0.tmp", "whole_b00009.0"):
        with open(os.path.join(folder, name), "w") as f:
            f.write("left by a killed writer")
    old = time.time() - 7200
    os.utime(os.path.join(folder, "_x_b00000.0.tmp"), (old, old))
    status = lambda d: {os.path.basename(r.path): (r.status, r.removed) for r in d.collect() if r.status != "landed"}
    looked = status(recovery.sweep(m, out, delete=False))
    base = os.path.basename
    assert looked == {base(files[0]): ("missing", False), base(files[1]): ("changed", False), "_x_b00000.0.tmp": ("staged", False), "whole_b00009.0": ("orphan", False)}
    assert status(recovery.sweep(m, out))["_x_b00000.0.tmp"] == ("staged", True)
    assert status(recovery.sweep(m, out))["whole_b00009.0"] == ("orphan", False)       # a running writer's, for all we know
    assert status(recovery.sweep(m, out, 0))["whole_b00009.0"] == ("orphan", True)
    assert status(recovery.sweep(m, out, 0)) == {base(files[0]): ("missing", False), base(files[1]): ("changed", False)}
    assert recovery.listing(spark, os.path.join(scratch, "nowhere")).count() == 0
