import pytest
from helpers import with_clashes, words

from quayside.llm import license_scan as L


def brute(text):
    ws = words(text)
    places = [(i, t.label) for t in L.NAMES for i in range(len(ws)) if tuple(ws[i:i + len(t.words)]) == t.words]
    starts = [i for i, _ in places]
    return len(ws), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


TEXTS = [
    None, "", "!!!", "MIT", "mit der Frau", "Released under the MIT License.", "mit-license MIT\nLICENSE",
    "GNU  General, Public (License) gnu general public license version 3", "gnu general public licence",
    "apache license apache license version 2.0", "Licensed under the Apache License, Version 2.0.", "CC BY-NC 4.0, cc by", "ccc by cc b y",
    "Licensed under CC BY-NC 4.0.", "license", "the mit\u00e9 license", "MIT\u2028License", "x " * 30_000 + "mit license",
    "All rights reserved", "copyright 2020 all rights reserved", "CC CC BY BY", "\u212aCC BY",
]


def test_places_match_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "mit license"), (3, "MIT License")] * 2
    got = L.scan_licenses(with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(r["text"])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) >= (r["n_base"] > 0)
        assert r["node"] == "own node"
    labels = {r["text"]: r["labels"] for r in got}
    assert "gpl-3" in labels[TEXTS[7]] and "apache-2" in labels[TEXTS[10]] and "cc-by-nc" in labels[TEXTS[13]]


def test_no_documents_and_no_python(spark):
    df = L.scan_licenses(spark.createDataFrame([], "doc_id long, text string"))
    assert df.collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_template_key_must_be_in_the_text():
    with pytest.raises(StopIteration):
        L.Template.of("x", "a b c", "c d")
