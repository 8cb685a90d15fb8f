import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from helpers import with_clashes

from quayside.llm import langid

SYLLABLES = {"aa": ["ba", "lo", "mi"], "bb": ["kra", "tz", "ung"], "cc": ["éo", "qui", "eau"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(n))


def test_held_out_texts(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, lang, rng.randrange(20, 60)), lang) for i in range(150) for lang in [rng.choice(list(SYLLABLES))]]
    model = langid.train(spark.createDataFrame([(t, x, i) for i, t, x in rows if i % 5], "text string, lang string, key long"))
    assert model.langs == ["aa", "bb", "cc"]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = langid.identify(docs, model).collect()
    assert all(r["lang_pred"] == r["lang"] and 0.9 < r["score"] <= 1 for r in got if r["doc_id"] % 5 == 0)
    assert got[0]["row"] == "own row"


def test_backing_off_reaches_unseen_words():
    model = trained()
    assert "balolomi" not in model.words
    assert model.predict("balolomi MIMILO")[0] == "aa" and model.predict("tztzkraung")[0] == "bb"
    assert model.predict("жжж ждж")[1] == pytest.approx(model.guess())      # no known letter: no evidence
    assert model.predict("é")[0] == "cc"


def test_texts_without_language():
    model = trained()
    for t in (None, "", "123 !? _", "\n"):
        assert model.predict(t) == (langid.UND, 0.0)
    label, score = model.predict(text(random.Random(2), "cc", 30_000))
    assert label == "cc" and score > 0.999


def test_memory_overflow(monkeypatch):
    monkeypatch.setattr(langid, "KNOWN_WORDS", 3)
    model, again = trained(), trained()
    for i in range(30):
        t = text(random.Random(i), "bb", 20)
        monkeypatch.setattr(langid, "KNOWN_WORDS", 3)
        a = model.predict(t)
        monkeypatch.setattr(langid, "KNOWN_WORDS", 10**6)
        assert a == again.predict(t)


def trained():
    import pandas as pd

    rng = random.Random(7)
    pdf = pd.DataFrame([(lang, text(rng, lang, 60)) for lang in SYLLABLES for _ in range(5)], columns=["lang", "text"])
    counts = next(langid._count([pdf[pdf["lang"] == "aa"]])), next(langid._count([pdf[pdf["lang"] == "bb"]])), next(langid._count([pdf[pdf["lang"] == "cc"]]))
    got = pd.concat(counts)
    got = got[(got["size"] > 0) | (got["piece"].str.len() < 6)]
    return langid._model(pa.Table.from_pandas(got, preserve_index=False))


def test_nothing_to_learn_from(spark):
    model = langid.train(spark.createDataFrame([("x", None, 1), (None, "aa", 2)], "text string, lang string, key long"))
    assert model.predict("some words") == (langid.UND, 0.0)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert langid.identify(docs, model).collect() == []


def brute(rows, text, smoothing=langid.SMOOTHING):
    """Word-first back-off, by its definition: {language: log likelihood}."""
    words = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    grams = lambda w, n: list(w) if n == 1 else [f"<{w}>"[i:i + n] for i in range(len(w) + 3 - n)]
    counts = {}
    for lang, t in rows:
        for w in words(t):
            counts.setdefault((lang, 0), Counter())[w] += 1
            for n in range(1, langid.MAX_GRAM + 1):
                counts.setdefault((lang, n), Counter()).update(grams(w, n))
    langs = sorted({lang for lang, _ in rows})
    known = [set().union(*(counts.get((lang, n), ()) for lang in langs)) for n in range(langid.MAX_GRAM + 1)]

    def log(lang, n, piece):
        c = counts.get((lang, n), Counter())
        return math.log((c[piece] + smoothing) / (sum(c.values()) + smoothing * (len(c) + 1)))

    out = dict.fromkeys(langs, 0.0)
    for w in words(text):
        for lang in langs:
            if w in known[0]:
                out[lang] += log(lang, 0, w)
                continue
            got = next((g for n in range(min(langid.MAX_GRAM, len(w) + 2), 0, -1) if (g := [(n, x) for x in grams(w, n) if x in known[n]])), [])
            out[lang] += sum(log(lang, n, x) for n, x in got) / len(got) if got else 0.0
    return out


def test_predictions_equal_brute_force(spark):
    """Known words, unseen ones of every length of known n-grams, letters of no language."""
    rng = random.Random(11)
    rows = [(lang, text(rng, lang, 40)) for lang in SYLLABLES for _ in range(8)]
    model = langid.train(spark.createDataFrame([(t, lang, i) for i, (lang, t) in enumerate(rows)], "text string, lang string, key long"))
    some = [text(rng, lang, n) for lang in SYLLABLES for n in (1, 3, 50)] + ["éo tz balo", "жж lo", "ж", "Lo LO kraq zzzz", "quixé b a z q"]
    some += ["".join(rng.choice("balomikrtzungéqeu") for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    for t in some:
        want = brute(rows, t)
        best = max(want.values())
        label, score = model.predict(t)
        assert score == pytest.approx(1 / sum(math.exp(v - best) for v in want.values()), rel=1e-3)
        assert want[label] == pytest.approx(best, abs=1e-3)


def test_rows_of_one_id_and_text_teach_once(spark):
    rng = random.Random(3)
    one = [(text(rng, "aa", 30), "aa", 7)] * 500 + [(text(rng, "bb", 30), "bb", 7)] * 3
    model = langid.train(spark.createDataFrame(one, "text string, lang string, key long"))
    again = langid.train(spark.createDataFrame([one[0], one[-1]], "text string, lang string, key long"))
    assert model.words == again.words and (model.word_logs == again.word_logs).all()
