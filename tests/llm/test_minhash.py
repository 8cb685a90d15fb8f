import random

import pytest
from helpers import components, corpus, edited, prose, with_clashes

from quayside.llm import minhash as M
from quayside.llm.components import connected_components


def check(spark, rows):
    want = components(rows)
    got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    key = lambda d, n, c: (-1 if d is None else d, n, -1 if c is None else c)
    assert sorted(key(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(key(rows[i][0], n, c) for i, (n, c) in want.items())


def test_components_match_brute_force(spark):
    check(spark, corpus())


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_and_loose_groups(spark, monkeypatch, seed):
    """Members of a bucket that are not linked with its centre, and chains of
    links: a text that drifts away edit by edit."""
    monkeypatch.setattr(M, "PROBES", 1)
    monkeypatch.setattr(M, "GROWTH", 2)
    monkeypatch.setattr(M, "TILE", 7)
    rng = random.Random(seed)
    rows, now = [], prose(rng, 120)
    for i in range(40):
        rows.append((1000 - i, now))
        now = edited(rng, now, rng.choice([1, 1, 2, 3]))
    base = prose(rng, 60)
    rows += [(i, edited(rng, base, rng.randrange(0, 5))) for i in range(60)]
    check(spark, rows)


def test_one_of_each_group_stays(spark):
    rows = corpus()
    want = components(rows)
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = M.keep_one(docs)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert {d for d, _ in got if d is not None} == {c for _, c in want.values() if c is not None}
    assert {d for d, t in got if not t} == {400, 401}                            # rows without words stay
    assert len([1 for d, _ in got if d == 406]) == 1 and len([1 for d, _ in got if d == 407]) == 2
    assert len(got) == len(set(got))


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert M.near_duplicates(df).collect() == [] and M.keep_one(df).collect() == []


def test_connected_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)] + [(500, 500), (7, 3)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert got == {x: find(x) for e in edges for x in e if e[0] != e[1]}


def test_rows_without_id_meet_their_own_nodes_only(spark):
    rng = random.Random(6)
    base = prose(rng, 80)
    rows = [(None if i % 2 else 3, edited(rng, base, 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "xxhash64(text) AS text_hash")
    nodes = df.selectExpr("md5(text) AS node", "doc_id", "text_hash")
    got = M.texts_of(df, nodes).collect()
    assert len(got) == 40 and len({r["node"] for r in got}) == 40
    check(spark, rows)
