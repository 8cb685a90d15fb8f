"""Properties from the test strategy: every record lands in exactly one
bucket or in dead letter; manifest rows add up to the input; roll sequences
start at 0 and rise by at most 1; delivery modes map to options."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from quayside.operators import metrics, rolling, routing
from quayside.sources.records import events_as_records
from quayside.sources.tables import read_table
from quayside.streaming.delivery import delivery_options


@pytest.fixture(scope="module")
def recs(spark):
    return events_as_records(read_table(spark, SF001, "events"))


def test_manifest_adds_up(spark, recs):
    routed = routing.decoded(routing.route_bucket(recs, "/b"), 1)
    good, dead = routing.split_dead_letter(recs)
    m = metrics.bucket_manifest(routed.filter(F.col("status") == "ok"), "/b").agg(F.sum("n_records")).first()[0]
    assert m + dead.count() == recs.count() == good.count() + dead.count()
    assert routed.groupBy("offset", "partition", "topic").count().filter("count > 1").count() == 0


@pytest.mark.parametrize("kind", ["count", "size", "interval"])
def test_roll_sequences_are_dense(spark, recs, kind):
    r = recs.withColumn("d", F.date_format("timestamp", "yyyy-MM-dd")).withColumn(
        "n_bytes", F.octet_length("value") + 1)
    if kind == "count":
        out = rolling.roll_by_count(r, 3, ["topic", "d"], chunk=5)
    elif kind == "size":
        out = rolling.roll_by_size(r.select("topic", "d", "partition", "offset", "n_bytes"), 37, ["topic", "d"])
    else:
        out = rolling.roll_by_interval(r.select("topic", "d", "partition", "offset", "timestamp"), 1200,
                                       ["topic", "d"])
    seqs = out.groupBy("topic", "d").agg(F.min("roll_seq").alias("lo"), F.max("roll_seq").alias("hi"),
                                         F.countDistinct("roll_seq").alias("n"))
    assert seqs.filter((F.col("lo") != 0) | (F.col("n") != F.col("hi") + 1)).count() == 0
    # sequences never go down in arrival order
    order = ["timestamp", "offset", "partition"] if kind == "interval" else ["offset", "partition"]
    w = Window.partitionBy("topic", "d").orderBy(*order)
    steps = out.withColumn("step", F.col("roll_seq") - F.lag("roll_seq").over(w))
    assert steps.filter((F.col("step") < 0) | (F.col("step") > 1)).count() == 0


def test_delivery_modes():
    assert delivery_options("batch") == ({}, {})
    assert delivery_options("TIME", ack_time_ms=2000) == ({"processingTime": "2000 milliseconds"}, {})
    assert delivery_options("COUNT", ack_count=500) == ({}, {"maxOffsetsPerTrigger": "500"})
    trig, src = delivery_options("COUNT_TIME", 3000, 100)
    assert src == {"minOffsetsPerTrigger": "100", "maxTriggerDelay": "3000ms"}
    with pytest.raises(NotImplementedError):
        delivery_options("RECORD")
    with pytest.raises(ValueError):
        delivery_options("SOMETIMES")
