import os
import sys
import tempfile
import time

import pytest

os.environ["TZ"] = "UTC"
time.tzset()
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quayside.session import build_session

    s = build_session("local[*]", app="quayside-tests", shuffle_partitions=8,
                      extra={"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="quayside-test-")
