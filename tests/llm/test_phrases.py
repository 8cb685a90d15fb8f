"""Phrase collocations against a brute-force version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import LOWER, with_clashes

from quayside.llm import phrases, wordruns

SCHEMA = "doc_id bigint, text string, lang string"


def runs_of(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        ws = re.findall(r"[^\x20\x09]+", piece)
        for k in range(1, 5):
            for i in range(len(ws) - k + 1):
                yield tuple(ws[i:i + k])


def brute(rows, min_count=30, inside=80, top=2000):
    by_lang = defaultdict(list)
    for _, text, lang in rows:
        by_lang["und" if lang is None else lang].append(text)
    out = []
    for lang, texts in by_lang.items():
        f = Counter(r for t in texts for r in runs_of(t))
        n = sum(c for r, c in f.items() if len(r) == 1)
        cand = {r: a for r, a in f.items() if len(r) > 1 and a >= min_count}
        longer = Counter()
        for r, a in cand.items():
            for m in range(2, len(r)):
                for i in range(len(r) - m + 1):
                    longer[r[i:i + m]] = max(longer[r[i:i + m]], a)
        found = []
        for r, a in cand.items():
            if r in longer and 100 * longer[r] >= inside * a:
                continue
            score, k = min((2000000 * a // (f[r[:k]] + f[r[k:]]), k) for k in range(1, len(r)))
            found.append((-score, -a, " ".join(r).encode(), f[r[:k]], f[r[k:]]))
        out += [(lang, i, p.decode(), -a, le, ri, n, -s) for i, (s, a, p, le, ri) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def made_up(seed, n=300, vocab=12):
    rng = random.Random(seed)
    fixed = [["New", "York", "City", "hall"], ["ein", "Satz"], ["a\x00b", "é", "ß"], ["x"] * 9]
    rows = []
    for i in range(n):
        ws = []
        for _ in range(rng.randrange(0, 40)):
            ws += rng.choice(fixed) if rng.random() < .15 else [f"w{min(rng.randrange(vocab), rng.randrange(vocab))}"]
            if rng.random() < .1:
                ws.append(rng.choice([".", ",", "\n", "; x:", "!?", "\x0b", "\t", "  "]))
        rows.append((i, " ".join(ws), rng.choice(["en", "en", "en", "de", None, "und"])))
    return rows + [(n, None, "en"), (n + 1, "", "de"), (n + 2, "?!", None), (n + 3, "long " * 3000 + "y" * 5000, "en"), (None, None, None)]


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("head", [1 << 17, 8, 0])
def test_equals_brute_force(spark, monkeypatch, head):
    """All runs numbered; most of them known by the filter alone; all of them."""
    monkeypatch.setattr(phrases, "HEAD", head)
    rows = made_up(head)
    docs = with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert result(phrases.collocations(docs)) == brute(rows)


def test_top_and_parameters(spark):
    rows = made_up(9)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert result(phrases.collocations(docs, min_count=5, inside_percent=100, top=3)) == brute(rows, 5, 100, 3)


def test_one_passage_in_a_third_of_all_rows(spark):
    rows = made_up(4, 100) + [(1000 + i, "the very same passage of words. " * 3, "en") for i in range(60)]
    assert result(phrases.collocations(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)


def test_nothing_frequent_and_empty_tables(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, "a b c", "en"), (2, None, None)], SCHEMA)).count() == 0


def test_long_texts_are_cut_without_loss(monkeypatch):
    monkeypatch.setattr(wordruns, "PIECE_BYTES", 40)
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["aa", "b.", "ccc", ", d", "e" * 50, "\n"]) for _ in range(300)), None, "", "q r s t u"]
    for size in (2, 3, 4):
        got = Counter()
        for _, _, r, carried in wordruns.walk(pa.array(texts), phrases.WORDS, phrases.BREAKS, size - 1):
            for w in range(max(carried, size - 1), len(r.broken)):
                if not r.broken[w - size + 2:w + 1].any():
                    got[tuple(bytes(r.data[r.start[w - size + 1]:r.start[w + 1] - 1]).decode().split(" "))] += 1
        assert got == Counter(r for t in texts for r in runs_of(t) if len(r) == size)


def test_tiles_count_exactly_in_little_memory(monkeypatch):
    monkeypatch.setattr(phrases, "DENSE_PAIRS", 50)
    monkeypatch.setattr(phrases, "DENSE_TILES", 2)
    monkeypatch.setattr(phrases, "SPARSE_PAIRS", 300)
    rng, tiles, got, want = np.random.default_rng(1), phrases.Tiles(), Counter(), Counter()

    def take(found):
        for lang, codes, counts in found:
            for c, n in zip(codes.tolist(), counts.tolist()):
                got[lang, c >> phrases.HEAD_BITS, c & (1 << phrases.HEAD_BITS) - 1] += n

    for i in range(40):
        lang = "en" if i % 3 else "de"
        left, right = (np.minimum(rng.zipf(1.2, 200), (1 << phrases.HEAD_BITS) - 1).astype(np.int64) for _ in range(2))
        take(tiles.add(lang, left, right))
        want.update((lang, a, b) for a, b in zip(left.tolist(), right.tolist()))
        assert len(tiles.dense) <= 2 and tiles.n_fresh < 300
    take(tiles.rest())
    assert got == want


def test_the_filter_lets_through_all_that_it_holds():
    rng = np.random.default_rng(2)
    held, others = (rng.integers(0, 1 << 64, 20000, dtype=np.uint64) for _ in range(2))
    f = phrases.Filter()
    assert not f.passes(held).any()
    f.add(held)
    assert f.passes(held).all() and f.passes(others).mean() < 0.01
