"""The registered queries: those with SQL against DuckDB, all others for their contract's columns."""

import pytest
from oracle_util import duck, rows

from conftest import SF001
from quayside.llm import queries

COLUMNS = {
    "op1_": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op3_": {"doc_id": "bigint"},
    "op4_": {"doc_id": "bigint", "item_id": "bigint"},
    "op6_": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op7_": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op8_": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op10_": {"doc_id": "bigint"},
    "op11_": {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"},
    "op12_": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op13_": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"},
}


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_matches_sql(spark, name):
    got = queries.QUERIES[name](spark, SF001).toPandas()
    want = duck(SF001).sql(queries.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("prefix", list(COLUMNS))
def test_query_gives_its_columns(spark, prefix):
    name = next(n for n in queries.QUERIES if n.startswith(prefix))
    got = queries.QUERIES[name](spark, SF001)
    types = dict(got.dtypes)
    assert {c: types.get(c) for c in COLUMNS[prefix]} == COLUMNS[prefix]
    n = spark.read.parquet(f"{SF001}/documents.parquet").count()
    if prefix in ("op1_", "op7_", "op8_", "op11_", "op12_"):
        assert got.count() == n


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op7_language"](spark, SF001).join(spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.filter("held_out").selectExpr("avg(double(lang_pred = lang))").first()[0] > 0.95
