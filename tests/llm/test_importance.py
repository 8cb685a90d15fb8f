"""Importance resampling against a brute-force version."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import corpus, prose, with_clashes, words

from quayside.llm import importance, wordruns
from quayside.llm.wordhash import LETTERS

SCHEMA = "doc_id bigint, text string"


def features(text):
    ws = words(text)
    return [" ".join(ws[i:i + n]).encode() for n in (1, 2, 3) for i in range(len(ws) - n + 1)]


def brute(rows, target, percent=5, min_words=20):
    """Sorted (doc_id, n_features, weight, score) and {rank: (score, doc_id)}."""
    s, t = (Counter(zlib.crc32(f) % 10000 for text in texts for f in features(text)) for texts in ([x for _, x in rows], target))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
    out, able = [], []
    for i, text in rows:
        fs = features(text)
        w = sum(gain(zlib.crc32(f) % 10000) for f in fs)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(fs), w, score))
        if len(words(text)) >= min_words:
            able.append((-score, i is not None, i))
    able.sort()
    return out, {r: (-x[0], x[2]) for r, x in enumerate(able[:percent * len(able) // 100], 1)}


def key(row):
    return tuple((v is not None, v) for v in row)


def check(got, rows, target, **how):
    want, ranks = brute(rows, target, **how)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=key) == sorted(want, key=key)
    assert {r.rank: (r.score, r.doc_id) for r in got if r.rank is not None} == ranks
    assert sum(r.rank is not None for r in got) == len(ranks)


@pytest.fixture()
def small_head(monkeypatch):
    """So few frequent words that most features are tail features."""
    monkeypatch.setattr(importance, "HEAD_WORDS", 40)
    monkeypatch.setattr(importance, "PAIR_WORDS", 10)


def test_equals_brute_force(spark, small_head):
    rows = corpus() + [(500 + i, f"Grüße an ALLE {i}, x-y_z\x00 9000 " + prose(random.Random(i), 25)) for i in range(60)]
    target = [rows[3][1], None, "", "one two", rows[5][1]]
    docs = with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(4))
    got = importance.resample(docs, spark.createDataFrame([(x,) for x in target], "text string"), percent=30).collect()
    check(got, rows, target, percent=30)


def test_keeps_columns_that_clash(spark):
    docs = with_clashes(spark.createDataFrame(corpus()[:5], SCHEMA)).withColumn("rank", importance.F.lit("own"))
    got = importance.resample(docs, spark.createDataFrame([("a b",)], "text string"), keep=["row", "n", "a.b"])
    assert got.columns[:3] == ["row", "n", "a.b"] and got.count() == 5


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame(corpus()[:30], SCHEMA)
    assert importance.resample(none, some).count() == 0
    check(importance.resample(some, none, percent=50).collect(), corpus()[:30], [], percent=50)


def test_ties_of_one_id_rank_once_each(spark):
    """A third of all rows null ids with one text: places differ, none is lost."""
    rows = [(None, "word " * 30)] * 50 + [(i, prose(random.Random(i), 40)) for i in range(100)]
    got = importance.resample(spark.createDataFrame(rows, SCHEMA).repartition(5), spark.createDataFrame([("word word word",)], "text string"), percent=60).collect()
    check(got, rows, ["word word word"], percent=60)
    assert sorted(r.rank for r in got if r.rank) == list(range(1, 91))


def test_long_texts_are_cut_without_loss(monkeypatch):
    monkeypatch.setattr(wordruns, "PIECE_BYTES", 64)
    rng = random.Random(3)
    texts = [prose(rng, 200), "", "x" * 300 + " tail " + "é" * 100, None, "a b", "?" * 200 + "a"]
    head = importance.Head([b"w1x ", b"w2x ", b"tail ", b"b "]).prepare()
    total = np.zeros(importance.BUCKETS + 1, np.int64)
    for _, _, r, carried in wordruns.walk(pa.array(texts), LETTERS):
        total += np.bincount(importance.buckets(r, carried, head).ravel(), minlength=importance.BUCKETS + 1)
    want = Counter(zlib.crc32(f) % 10000 for t in texts for f in features(t))
    assert {b: n for b, n in enumerate(total[:-1].tolist()) if n} == dict(want)


def test_states_move_as_crc_does():
    a, b = b"frequent", b"pair"
    crc = np.array([zlib.crc32(a)], np.uint32)
    assert importance.moved(crc, np.array([len(b)]))[0] ^ np.uint32(zlib.crc32(b)) == zlib.crc32(a + b)
