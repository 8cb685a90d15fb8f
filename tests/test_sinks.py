"""Sinks: text and gzip round trips, raw concatenation bytes, dead letter,
batch landing with feeds, and idempotent replay of a micro-batch."""

import contextlib
import glob
import gzip
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from quayside.plans.landing import land_batch
from quayside.sinks import raw, text
from quayside.sources.feeds import feeds_from_nation
from quayside.sources.records import events_as_records
from quayside.sources.tables import read_table
from quayside.streaming.landing import bucketed_lines


def _events(spark):
    return events_as_records(read_table(spark, SF001, "events"))


def test_text_roundtrip_plain_and_gzip(spark, scratch):
    lines = bucketed_lines(_events(spark), with_offset=True)
    for codec, ext in [(None, ".txt"), ("gzip", ".txt.gz"), ("GzipCodec", ".txt.gz")]:
        out = os.path.join(scratch, f"out-{codec}")
        text.write_text(lines, out, "value", codec, partition_by=["topic", "d", "h"])
        files = glob.glob(f"{out}/topic=*/d=*/h=*/part-*")
        assert files and all(f.endswith(ext) for f in files)
        back = text.read_landed(spark, out, "topic string, d string, h string")
        assert back.count() == lines.count()
        assert back.exceptAll(lines.drop("partition", "offset")).count() == 0
    # gzip files really are gzip
    one = glob.glob(f"{scratch}/out-gzip/topic=*/d=*/h=*/part-*")[0]
    with gzip.open(one, "rt") as fh:
        assert fh.read().endswith("\n")


def test_raw_concat_whole_texts(spark, scratch):
    """Whole documents (931 of 1000 hold newlines at sf0.01) land byte for byte."""
    docs = read_table(spark, SF001, "documents")
    df = docs.select(F.concat(F.lit("lang="), "lang").alias("bucket"), F.col("text").cast("binary").alias("data"),
                     F.col("doc_id").alias("offset"))
    raw.write_raw(df, scratch)
    assert not glob.glob(f"{scratch}/**/*.tmp", recursive=True)
    on_disk = {}
    for f in glob.glob(f"{scratch}/lang=*/part-*"):
        lang = f.split("lang=")[1].split("/")[0]
        on_disk[lang] = on_disk.get(lang, 0) + os.path.getsize(f)
    want = {r.lang: r.n for r in docs.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    assert on_disk == want


def test_dead_letter_and_landing(spark, scratch):
    rows = [(b"ok", "click", 0, 1), (None, "click", 0, 2), (bytes([0x41, 0xFF]), "view", 1, 3),
            ("a😀".encode(), "view", 1, 4), (b"", "click", 2, 5)]
    recs = spark.createDataFrame(
        [(None, v, t, p, o, datetime(2024, 1, 1, 0, 59, 59, 999999), 0) for v, t, p, o in rows],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, "
        "timestampType int")
    feeds = feeds_from_nation(read_table(spark, SF001, "nation"))
    dead = os.path.join(scratch, "dead")
    for _ in range(2):    # the same batch delivered twice
        manifest = land_batch(recs, feeds, os.path.join(scratch, "landed"), dead, mode="overwrite")
        d = spark.read.parquet(dead)
        assert sorted((r.offset, r.reason) for r in d.collect()) == [(2, "null_value"), (3, "bad_utf8")]
    m = manifest.collect()
    # every good record lands once for each consumer group of its topic
    from quayside.operators.routing import group_split

    want = group_split(recs.filter("offset NOT IN (2, 3)"), feeds, recs.groupBy("topic").agg((F.max("partition") + 1).alias("n_parts")))
    assert sum(r.n_records for r in m) == want.count() > 0
    assert all(os.path.getsize(r.path) == r.file_bytes and r.bucket_dir in r.path for r in m)
    assert len(_files(os.path.join(scratch, "landed"))) == len(m)
    # no feed left: the replayed batch leaves nothing of its old files
    land_batch(recs, feeds.filter("id < 0"), os.path.join(scratch, "landed"), dead, mode="overwrite")
    assert _files(os.path.join(scratch, "landed")) == []
    assert spark.read.parquet(dead).count() == 2


def _files(root):
    return sorted(f for f in glob.glob(f"{root}/**/*", recursive=True)
                  if os.path.isfile(f) and not any(p[0] in "_." for p in os.path.relpath(f, root).split("/")))


def _scans(spark, scratch, run):
    """How often ``run`` opens the records it is given: a counter in a map stage."""
    folder = os.path.join(scratch, "scans")
    os.makedirs(folder, exist_ok=True)

    def count(batches):
        import uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        yield from batches

    recs = _events(spark)
    recs = recs.coalesce(1).mapInArrow(count, recs.schema)
    run(recs)
    return len(os.listdir(folder))


def test_landing_scans_the_records_once(spark, scratch):
    feeds = feeds_from_nation(read_table(spark, SF001, "nation"))
    parts = _events(spark).groupBy("topic").agg((F.max("partition") + 1).alias("n_parts"))
    n = _scans(spark, scratch, lambda recs: land_batch(recs, feeds, os.path.join(scratch, "out"), partitions=parts).count())
    assert n == 1


def test_transform_is_what_lands_and_is_measured(spark, scratch):
    from quayside.sources.feeds import feeds_from_region

    feeds = feeds_from_region(read_table(spark, SF001, "region"))
    m = land_batch(_events(spark), feeds, scratch, transform=lambda d: d.withColumn("text", F.lit("x")).filter("offset % 2 = 0"))
    rows = m.collect()
    breaks = {0: 1, 1: 1, 2: 0, 3: 0, 4: 1}
    assert sum(r.n_records for r in rows) == _events(spark).filter("offset % 2 = 0").count()
    assert all(r.n_bytes == r.n_chars == r.n_records * (1 + breaks[r.feed_id]) for r in rows)


def test_feeds_land_where_they_say(spark, scratch):
    """Codec, suffix, day mode and a pattern with slashes; every codec's
    bytes read back, the standard ones by Spark as well."""
    import bz2

    from quayside.sources.feeds import feeds_from_region
    from quayside.sinks.files import compressor, decompressed, read_back

    feeds = feeds_from_region(read_table(spark, SF001, "region"))
    m = land_batch(_events(spark), feeds, scratch)
    got = {r.feed_id: r for r in m.filter("n_records > 0").collect()}
    raw_bytes = {i: open(r.path, "rb").read() for i, r in got.items()}
    assert got[0].path.endswith(".0") and got[1].path.endswith(".gz") and got[3].path.endswith(".log") and got[4].path.endswith(".bz2")
    assert raw_bytes[3][:2] == b"\x1f\x8b" and b"\n" not in gzip.decompress(raw_bytes[3])
    assert bz2.decompress(raw_bytes[4]).count(b"\n") == got[4].n_records
    assert "/2024/01/" in got[4].bucket_dir and got[0].bucket_dir.count("/") == 4
    assert {r.path: len(r.body) for r in read_back(m).collect()} == {r.path: r.n_bytes for r in m.collect()}
    assert spark.read.text([r.path for r in m.filter("feed_id = 1").collect()]).count() == m.filter("feed_id = 1").agg(F.sum("n_records")).first()[0]

    class Out:
        def __init__(self):
            self.data = b""

        def write(self, b):
            self.data += bytes(b)

    text_bytes = b"some text, " * 30_000
    for codec in (None, "gzip", "deflate", "bzip2", "snappy", "lz4"):
        out = Out()
        c = compressor(out, codec)
        for a in range(0, len(text_bytes), 7777):
            c.write(text_bytes[a:a + 7777])
        c.finish()
        assert decompressed(out.data, codec) == text_bytes
        if codec in ("gzip", "deflate", "bzip2", "snappy", "lz4"):
            name = os.path.join(scratch, "x" + {"gzip": ".gz", "deflate": ".deflate", "bzip2": ".bz2", "snappy": ".snappy", "lz4": ".lz4"}[codec])
            open(name, "wb").write(out.data)
            assert spark.read.text(name, wholetext=True).first()[0] == text_bytes.decode()


def test_lines_keep_their_order(spark, scratch):
    rows = [(f"{p}:{o:06d}", p, o, "x") for p in range(3) for o in range(3000)]
    df = spark.createDataFrame(rows, "text string, partition int, offset long, d string").repartition(7)
    for cluster in ("rebalance", "none"):
        out = os.path.join(scratch, cluster)
        text.write_text(df, out, partition_by=["d"], cluster=cluster)
        n = 0
        for f in glob.glob(f"{out}/d=x/part-*"):
            lines = open(f).read().splitlines()
            assert lines == sorted(lines)
            n += len(lines)
        assert n == len(rows)


def test_raw_sink_has_one_open_file(spark, scratch):
    """More buckets in a task than the process may open files."""
    df = spark.createDataFrame([(f"b={i}", f"x{i}".encode(), i) for i in range(400)], "bucket string, data binary, offset long").coalesce(1)

    def limited(batches):
        import resource

        resource.setrlimit(resource.RLIMIT_NOFILE, (100, resource.getrlimit(resource.RLIMIT_NOFILE)[1]))
        yield from batches

    import pyarrow as pa
    from quayside.sinks.raw import _write_task

    got = df.mapInArrow(lambda b: (pa.RecordBatch.from_pydict({"n": [len(_write_task(scratch, limited(b), "t").paths)]}) for _ in [0]), "n long").collect()
    assert got[0].n == 400
    assert open(glob.glob(f"{scratch}/b=7/part-*")[0]).read() == "x7"


def test_raw_overwrite_leaves_only_its_files(spark, scratch):
    df = lambda n: spark.createDataFrame([(f"b={i}", b"x") for i in range(n)], "bucket string, data binary")
    raw.write_raw(df(5), scratch)
    raw.write_raw(df(2), scratch, mode="overwrite")
    assert len(_files(scratch)) == 2


def test_foreach_batch_replay_is_idempotent(spark, scratch):
    from quayside.streaming.landing import land_micro_batch

    recs = _events(spark)
    out, dead = os.path.join(scratch, "out"), os.path.join(scratch, "dead")
    for _ in range(2):  # the same micro-batch delivered twice
        land_micro_batch(recs, 7, out, dead_letter_path=dead)
    land_micro_batch(recs.limit(5), 8, out, dead_letter_path=dead)
    back = text.read_landed(spark, out, "batch_id string, topic string, d string, h string")
    assert back.filter("batch_id = '7'").count() == recs.count()
    assert back.filter("batch_id = '8'").count() == 5


def test_live_micro_batch_lands_without_shuffle(spark, scratch):
    """Live mode (cluster="none"): no exchange before the writer, every good
    record lands once, dead letters go to their own folder."""
    from quayside.streaming.landing import bucketed_lines, land_micro_batch

    recs = _events(spark)
    out, dead = os.path.join(scratch, "out"), os.path.join(scratch, "dead")
    land_micro_batch(recs, 0, out, dead_letter_path=dead, cluster="none")
    back = text.read_landed(spark, out, "batch_id string, topic string, d string, h string")
    assert back.count() == recs.count()
    # the rows the writer receives: no shuffle in live mode, one exchange by bucket for backfills
    from quayside.sinks.text import prepare_for_write

    lines = bucketed_lines(recs, with_offset=True)
    parts = ["topic", "d", "h"]
    live = prepare_for_write(lines, "value", parts, cluster="none")._jdf.queryExecution().executedPlan().toString()
    back_fill = prepare_for_write(lines, "value", parts)._jdf.queryExecution().executedPlan()
    assert "Exchange" not in live
    assert "Exchange hashpartitioning(topic" in back_fill.toString()


@contextlib.contextmanager
def many_tasks(spark):
    """No joining of small tasks: a bucket is cut as a hot one is."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("name", ["landed_roundtrip", "landed_roundtrip_gz", "landed_manifest"])
def test_landing_of_many_files_a_bucket_gives_the_same(spark, monkeypatch, name):
    from quayside.plans import catalog, sizing

    few = sorted(map(str, catalog.QUERIES[name](spark, SF001).collect()))
    monkeypatch.setattr(sizing, "SMALL_TASK_BYTES", 1)
    monkeypatch.setattr(catalog, "CELL_BYTES", 50)
    monkeypatch.setattr(catalog, "CHECK_OFFSETS", 7)
    with many_tasks(spark):
        many = sorted(map(str, catalog.QUERIES[name](spark, SF001).collect()))
    assert few == many and "in_order=False" not in "".join(many)


def test_lines_of_a_hot_bucket_are_numbered_over_its_files(spark, scratch, monkeypatch):
    from quayside.plans import sizing
    from quayside.sinks import text

    monkeypatch.setattr(sizing, "SMALL_TASK_BYTES", 1)
    rows = spark.range(5000).selectExpr("cast(id AS string) AS text", "if(id % 75 = 0, 'c', 'd') AS d", "if(id % 50 = 0, 'x', 'hot') AS h", "cast(id DIV 2000 AS int) AS partition", "id AS offset").repartition(5)
    with many_tasks(spark):
        text.write_text(rows, f"{scratch}/hot")
    assert spark.read.text(f"{scratch}/hot/d=d/h=hot").selectExpr("_metadata.file_path AS f").distinct().count() > 3
    got = sorted((r["line_no"], int(r["value"])) for r in text.read_landed_lines(spark, f"{scratch}/hot").collect() if (r["d"], r["h"]) == ("d", "hot"))
    want = [i for i in range(5000) if i % 50 and i % 75]
    assert got == list(enumerate(want))


@pytest.mark.parametrize("codec", [None, "gzip", "deflate", "bzip2", "snappy", "lz4"])
def test_files_are_read_in_parts_of_bounded_size(codec):
    """Any codec, several members of a stream, parts smaller than a line."""
    import io
    import random

    from quayside.sinks.files import compressor, plain_parts

    rng = random.Random(7)
    plain = b"".join(b"%d " % rng.randrange(10**9) * rng.choice([1, 400]) for _ in range(3000))
    out = io.BytesIO()
    for part in (plain[:70_000], plain[70_000:]):
        w = compressor(out, codec)
        w.write(part)
        w.finish()
    for size in (1000, 1 << 20):
        parts = list(plain_parts(io.BytesIO(out.getvalue()), codec, size))
        assert b"".join(parts) == plain and all(len(p) <= max(size, 64 << 10) for p in parts)
    assert list(plain_parts(io.BytesIO(b""), codec)) == []
