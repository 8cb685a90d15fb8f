import collections
import itertools
import random

import numpy as np
import pytest
from helpers import edited, prose, shingles, with_clashes, words

from quayside.llm import decontaminate as D


def brute(rows, items):
    out = {}
    for r, (_, text) in enumerate(rows):
        ws = words(text)
        for i, (_, item) in enumerate(items):
            n = len(words(item))
            want = collections.Counter(shingles(words(item)))
            best = (0.0, 0)
            for a in range(max(1, len(ws) - n + 1)) if want and ws else ():
                got = collections.Counter(shingles(ws[a:a + n], min(5, n)))
                best = max(best, (sum((got & want).values()) / sum((got | want).values()), -a))
            if best[0] >= D.SIMILARITY:
                out[r, i] = (-best[1], min(n, len(ws)), best[0])
    return out


def fixture():
    rng = random.Random(5)
    items = [(i, prose(rng, rng.randrange(12, 60), 3000)) for i in range(12)]
    items += [(50, None), (51, ""), (52, "just three words"), (None, prose(rng, 20, 3000)), (54, items[0][1]), (55, "a b a b a b a b a b a b")]
    rows = []
    for i in range(40):
        body = prose(rng, rng.randrange(5, 200), 3000)
        k = i % 12
        if i % 2:
            body += " " + edited(rng, items[k][1], rng.randrange(0, 3)).upper() + "; " + prose(rng, 30, 3000)
        rows.append((i, body))
    rows += [(90, None), (91, ""), (92, "Just... three, words"), (None, items[3][1]), (93, "two words"), (93, items[4][1]), (94, "b a b a b a b a b a b a b a"),
             (95, " ".join(items[5][1].split()[:-3])), (96, prose(rng, 70_000, 3000) + " " + items[6][1])]
    return rows, items


@pytest.mark.parametrize("per_pass", [4000, 5])
def test_matches_are_those_of_brute_force(spark, monkeypatch, per_pass):
    monkeypatch.setattr(D, "ITEMS_A_PASS", per_pass)
    rows, items = fixture()
    want = brute(rows, items)
    keyed = [(n, d, t) for n, (d, t) in enumerate(rows)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.contaminated(spark.createDataFrame(keyed, "n long, doc_id long, text string").repartition(3), bench, ["n"]).collect()
    found = collections.defaultdict(list)
    for r in got:
        found[r["n"], r["item_id"]].append((r["start_word"], r["n_words"], r["similarity"]))
    assert {(r, items[i][0]) for r, i in want} == set(found)
    for (r, i), (at, n, similarity) in want.items():
        assert any(g[0] == at and g[1] == n and abs(g[2] - similarity) < 1e-9 for g in found[r, items[i][0]])
    assert len(got) == len(want)


def test_documents_with_items_go(spark):
    rows, items = fixture()
    bad = {r for r, _ in brute(rows, items)}
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = D.remove_contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in got.collect()) == sorted((d is None, d or 0, t or "") for i, (d, t) in enumerate(rows) if i not in bad)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    assert D.remove_contaminated(docs, none).count() == 1
    assert D.remove_contaminated(docs.limit(0), none).count() == 0


def test_blocks_find_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(2)
    items = [(i, rng.integers(0, 1 << 64, 30, dtype=np.uint64)) for i in range(8)]
    s = D.Sized(34, items)
    prints = np.concatenate([rng.integers(0, 1 << 64, 300, dtype=np.uint64), *(s.prints[k:k + 1] ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, n, replace=False).astype(np.uint64)) for k in range(8) for n in range(1, 30))])
    want = {(w, i) for w in range(len(prints)) for i in range(8) if int(np.bitwise_count(prints[w] ^ s.prints[i])) <= D.RADIUS}
    assert set(zip(*(x.tolist() for x in s.candidates(prints)))) == want


def test_items_longer_than_a_region(monkeypatch):
    monkeypatch.setattr(D, "REGION", 64)
    for longest in (10, 63, 64, 65, 200):
        found = list(itertools.islice(D._regions(np.ones(1000, bool), longest), 1000))
        assert len(found) < 1000
        assert all(any(lo <= a and a + longest <= hi for lo, hi in found) for a in range(1000 - longest + 1))
    rng = random.Random(7)
    item, other = prose(rng, 300, 3000), prose(rng, 20, 3000)
    index = D.Index([(0, item), (1, other)])
    doc = prose(rng, 150, 3000) + " " + item + " " + item + " " + other + " " + prose(rng, 500, 3000)
    w = D.hash_words(texts(doc), D.LETTERS)
    assert sorted(index.search(w.hash)) == [(0, 150, 300, 1.0), (1, 750, 20, 1.0)]


def texts(*every):
    import pyarrow as pa

    return pa.array(every, pa.string())
