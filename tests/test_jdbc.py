"""Feed config through JDBC with an in-process, in-memory Derby database
(no server, no port): enabled-filter pushdown and the batch writer."""

import uuid

from pyspark.sql import functions as F

from quayside.operators.tables import write_jdbc
from quayside.sources.feeds import read_feeds_jdbc
from test_offsets_feeds import FIXTURE_FEEDS, _feeds

DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_feed_table_roundtrip_and_pushdown(spark):
    url = f"jdbc:derby:memory:qs{uuid.uuid4().hex[:8]};create=true"
    feeds = _feeds(spark)
    write_jdbc(feeds, url, "feed_config", DRIVER, batch_size=5)
    got = read_feeds_jdbc(spark, url, properties=DRIVER)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(isEnabled), *EqualTo(isEnabled,1)]" in plan or "EqualTo(isEnabled,1)" in plan
    ids = sorted(r.id for r in got.collect())
    assert ids == sorted(f[0] for f in FIXTURE_FEEDS if f[11] == 1)
    # defaults are filled on read
    row = got.filter(F.col("id") == 14).first()
    assert row.fileSuffix == "" and row.filePathMode is None
