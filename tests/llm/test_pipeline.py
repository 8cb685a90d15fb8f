"""The pipeline's stages, each against a brute-force version on its own input."""

import random

from helpers import components, corpus, prose, with_clashes
from test_decontaminate import brute as leaks
from test_langid import SYLLABLES, text
from test_repeats import brute as repeats

import corpus_pipeline as P
from quayside.llm import langid, queries
from quayside.llm.tokens import encoder


def rows():
    rng = random.Random(12)
    out = [(i, text(rng, lang, rng.randrange(20, 80)), lang, "s", 1) for i in range(150) for lang in [rng.choice(list(SYLLABLES))]]
    out += [(1000 + (d or 0) if d is not None else None, t, "aa", None, None) for d, t in corpus(5)]
    return out + [(3000, "12 34 ?!", "bb", "s", 3), (3001, None, None, None, None)]


def items():
    rng = random.Random(13)
    return [(0, prose(rng, 30, 5000)), (1, prose(rng, 40, 5000)), (None, None)]


def folder(spark, scratch):
    rng = random.Random(14)
    docs = rows() + [(4000 + i, prose(rng, 30, 5000) + " " + items()[i % 2][1] + " " + prose(rng, 30, 5000), "cc", "s", 0) for i in range(2)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(items(), "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    return scratch


def key(d, t):
    return (d is None, d or 0, t or "")


def test_stages_match_brute_force(spark, scratch):
    sf = folder(spark, scratch)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    model = queries.language_model(docs)
    for name, stage in P.STAGES[:-1]:
        had = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = f"{scratch}/{name}"
        stage(spark, docs, sf).write.parquet(out)
        docs = spark.read.parquet(out)
        assert docs.columns == columns
        got = sorted((r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None)
        if name == "language":
            want = [(d, t) for d, t in had if (p := model.predict(t))[0] != langid.UND and p[1] > 1 / len(model.langs) + P.ABOVE_GUESS]
            assert {3000, 3001, 1400, 1401, 1402} <= {d for d, _ in had} - {d for d, _ in want}
        elif name == "near_duplicates":
            found = components(had)
            want = [had[i] for i, (n, c) in found.items() if n == 0 or had[i][0] == c]
        elif name == "repeated_passages":
            spans = repeats(had)
            assert any(spans.values())
            want = None
            for d, t in got:
                i = next(i for i, (e, x) in enumerate(had) if e == d and (x == t or spans[i]))
                left, at = "", 0
                for start, stop, _, _ in spans[i]:
                    left, at = left + had[i][1][at:start], stop
                assert (left + had[i][1][at:]).split() == t.split()
        else:
            bad = {r for r, _ in leaks(had, items())}
            assert bad
            want = [x for i, x in enumerate(had) if i not in bad]
        if want is not None:
            assert sorted(set((d, t) for d, t in want if d is not None)) == sorted(set(got))
    _, last = P.STAGES[-1]
    had = [(r["doc_id"], r["text"]) for r in docs.collect()]
    packed = last(spark, docs, sf).collect()
    tokens = {}
    for r in packed:
        tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["n_tokens"]
    want = {}
    for d, t in had:
        want[d] = want.get(d, 0) + 1 + len(encoder(queries.tokenizer_path()).tokenizer.encode(t, add_special_tokens=False).ids)
    assert tokens == want


def test_run_applies_all_stages(spark, scratch):
    got = P.run(spark, folder(spark, scratch))
    assert got.count() > 100 and {"doc_id", "n_tokens", "bucket_tokens", "batch"} <= set(got.columns)


def test_stages_on_empty_and_odd_tables(spark, scratch):
    sf = folder(spark, scratch)
    docs = with_clashes(spark.read.parquet(f"{sf}/documents.parquet"))
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs.limit(0), sf).collect() == []
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        assert out.filter("node <> 'own node' or node is null").count() == 0
    assert P.STAGES[-1][1](spark, docs.limit(0), sf).collect() == []


def test_language_stage_without_labels(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12 !", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r["doc_id"] for r in P.language(spark, docs, "").collect()] == [1]
