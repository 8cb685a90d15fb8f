"""Every registered query against its DuckDB oracle (small scale factor).

scripts/check_oracle.py runs them at sf0.01, with those of the optional
training-data package (tests/llm).
"""

import pytest

import __spark_entry__ as E
from conftest import SF001
from oracle_util import duck, rows
from quayside.plans import catalog

NAMES = list(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLE) == set(catalog.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF001).toPandas()
    want = con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows(got) == rows(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "n_records" in df.columns
