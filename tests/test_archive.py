"""Replay from offsets: which start, which files."""

import json
import os

from pyspark.sql import functions as F

from conftest import SF001
from quayside.sources import archive
from quayside.sources.records import events_as_records
from quayside.sources.tables import read_table
from quayside.streaming.partials import finished

ENDS = "topic string, partition int, first_offset bigint, end_offset bigint"


def starts(spark, *rows):
    return spark.createDataFrame(list(rows), archive.STARTS)


def test_starts_are_resolved(spark):
    ends = spark.createDataFrame([("a", 0, 10, 100), ("a", 1, 0, 30), ("b", 0, 5, 6)], ENDS)
    resolve = lambda *s: {(r.topic, r.partition): r.start_offset for r in archive.resolve_starts(ends, starts(spark, *s)).collect()}
    assert resolve((None, None, -50)) == {("a", 0): 50, ("a", 1): 0, ("b", 0): 5}
    assert resolve(("a", None, 20)) == {("a", 0): 20, ("a", 1): 20}
    assert resolve(("a", 1, -5), ("a", None, 3), (None, None, 0)) == {("a", 0): 10, ("a", 1): 25, ("b", 0): 5}
    assert resolve(("a", 0, 1000), ("b", 0, -1000)) == {("a", 0): 100, ("b", 0): 5}
    assert resolve() == {} and resolve(("x", None, 0)) == {}
    got = archive.resolve_starts(ends, starts(spark, ("a", None, -1)))
    assert json.loads(archive.kafka_starting_offsets(got)) == {"a": {"0": 99, "1": 29}}


def test_a_replay_reads_only_the_files_it_needs(spark, scratch):
    recs = events_as_records(read_table(spark, SF001, "events"))
    half = recs.count() // 2
    for batch, part in (("1", F.col("offset") <= half), ("2", F.col("offset") > half), ("2", F.col("offset") > half)):
        archive.write_archive(recs.filter(part), scratch, batch, files=12)
    manifest = archive.archive_manifest(spark, scratch)
    assert manifest.agg(F.sum("n_records")).first()[0] == recs.count()
    files = manifest.select("path").distinct().count()
    got = archive.replay_from(spark, scratch, starts(spark, (None, None, -50)))
    opened = lambda df: [f for f in df.inputFiles() if "/batch=" in f]
    assert all("/batch=2/" in f for f in opened(got)) and len(opened(got)) <= files / 2
    last = {(r.topic, r.partition): r.last for r in recs.groupBy("topic", "partition").agg(F.max("offset").alias("last")).collect()}
    want = {(r.topic, r.partition, r.offset) for r in recs.collect() if r.offset >= last[r.topic, r.partition] + 1 - 50}
    assert {(r.topic, r.partition, r.offset) for r in got.collect()} == want and got.columns == recs.columns
    one = archive.replay_from(spark, scratch, starts(spark, ("view", 1, -3)))
    assert len(opened(one)) == 1 and {r.partition for r in one.collect()} == {1}
    assert archive.replay_from(spark, scratch, starts(spark, ("none", 0, 0))).count() == 0


def test_data_without_a_manifest_is_not_read(spark, scratch):
    recs = events_as_records(read_table(spark, SF001, "events"))
    archive.write_archive(recs.limit(10), scratch, "1")
    recs.write.parquet(os.path.join(scratch, "batch=2"))       # a writer that was killed
    assert archive.replay_from(spark, scratch, starts(spark, (None, None, 0))).count() == 10


def test_a_stream_starts_at_the_offsets(spark, scratch):
    recs, out = events_as_records(read_table(spark, SF001, "events")), os.path.join(scratch, "out")
    arch, top = os.path.join(scratch, "arch"), 900
    archive.write_archive(recs.filter(F.col("offset") < top), arch, "1")
    s = archive.replay_stream_from(spark, arch, starts(spark, (None, None, 800)))
    archive.write_archive(recs.filter(F.col("offset") >= top), arch, "2")
    finished(s.writeStream.format("parquet").option("checkpointLocation", os.path.join(scratch, "c")).trigger(availableNow=True).start(out))
    got = {r.offset for r in spark.read.parquet(out).collect()}
    resolved = archive.resolve_starts(archive.offset_ends(archive.archive_manifest(spark, arch).filter("batch = '1'")), starts(spark, (None, None, 800)))
    begin = {(r.topic, r.partition): r.start_offset for r in resolved.collect()}
    assert got == {r.offset for r in recs.collect() if r.offset >= begin[r.topic, r.partition]}
