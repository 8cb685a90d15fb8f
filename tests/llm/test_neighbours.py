import numpy as np
import pytest
from helpers import with_clashes

from quayside.llm import neighbours as N


def exact(ids, vectors, query_id, query, top):
    score = (vectors * query).sum(axis=1)
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != query_id][:top]
    return [(int(ids[i]), float(score[i])) for i in order]


def rows(n, dim, seed=0):
    r = np.random.default_rng(seed)
    v = r.standard_normal((n, dim)) * r.uniform(0.5, 2, (n, 1))
    v[n // 3:2 * n // 3] = v[0]            # a third of all rows is one vector
    return [(i, x.tolist()) for i, x in enumerate(v)]


@pytest.mark.parametrize("dim", [1, 3, 24])
def test_recall_and_exact_scores(spark, monkeypatch, dim):
    monkeypatch.setattr(N, "VECTOR_BLOCK", 900)
    monkeypatch.setattr(N, "QUERY_BLOCK", 40)
    data = rows(2000, dim)
    df = with_clashes(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    got = N.nearest(df, df.filter("vec_id % 20 = 0"), top=10).toPandas()
    ids, vectors = np.arange(len(data)), np.array([v for _, v in data])
    hits = total = 0
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        want = exact(ids, vectors, q, vectors[q], 10)
        assert list(g["rank"]) == list(range(1, 11)) and q not in set(g["vec_id"])
        assert np.allclose(g["score"], [(vectors[v] * vectors[q]).sum() for v in g["vec_id"]], atol=1e-12)
        hits, total = hits + len({v for v, _ in want} & set(g["vec_id"])), total + 10
    assert got["query_id"].nunique() == 100 and hits / total >= 0.9


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, inf]), (6, [1.0, None]), (7, [2.0, 1.0]), (8, [2.0, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (10, [-1.0, 0.0]), (10, [-1.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in N.nearest(df, df.filter("vec_id % 20 = 0 or vec_id = 9")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 7, 2.0), (0, 2, 8, 2.0), (0, 3, 10, -1.0), (0, 4, 10, -1.0)]


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert N.nearest(df, df).collect() == []
