"""Backtracking encoder against the library's merges; decoding against its decode."""

import hashlib
import json
import random

import numpy as np
import pytest
from helpers import corpus, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF001
from quayside.llm import bpe, queries

PATH = queries.tokenizer_path()
ODD = [None, "", " \n\t x y", "a<|endoftext|>b <|startoftext|><|x", "<|endoftext|>" * 3, "İSTANBUL ΑΣ 日本語テキスト 1234 it's we'll 😀😀 é ́x",
       "'S 'Re don't\x00a\x07", "a b c ﻿q", "É" * 3, "a" * 30000, "ab" * 20000, "."*5000, "!?" * 3000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_every_token_and_pairs_of_them(library):
    m, rng = bpe.coder(PATH).merges, random.Random(5)
    vocab = [t.removesuffix("</w>") for t in library.get_vocab() if not t.startswith("<|")]
    for w in [x for x in vocab if x] + [rng.choice(vocab) + rng.choice(vocab) for _ in range(20000)]:
        if w:
            assert m.encode(w) == [t.id for t in library.model.tokenize(w)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdehnort'", min_size=1, max_size=60))
def test_random_words(word):
    library = Tokenizer.from_file(PATH) if not hasattr(test_random_words, "t") else test_random_words.t
    test_random_words.t = library
    assert bpe.coder(PATH).merges.encode(word) == [t.id for t in library.model.tokenize(word)]


def test_vocabularies_with_dead_merges():
    """Merges whose parts never meet, two ways to one token, equal letters."""
    from tokenizers.models import BPE

    vocab = {t: i for i, t in enumerate(["a", "b", "c", "ab", "bc", "abc", "aa", "aaa", "aaaa", "ca"])}
    merges = [("a", "b"), ("b", "c"), ("a", "bc"), ("a", "a"), ("aa", "a"), ("aa", "aa"), ("ab", "c"), ("c", "a")]
    m, library = bpe.Merges(vocab, merges), BPE(vocab, merges)
    rng = random.Random(2)
    for _ in range(3000):
        w = "".join(rng.choice("aabc") for _ in range(rng.randrange(1, 14)))
        assert m.encode(w) == [t.id for t in library.tokenize(w)], w


def test_texts_equal_the_library(spark, library):
    rows = [(i, t) for i, (_, t) in enumerate(corpus())] + [(1000 + i, t) for i, t in enumerate(ODD)]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id int, text string").repartition(3))
    ids = docs.withColumn("ids", bpe.encoded(docs.text, PATH))
    got = ids.withColumn("spelt", bpe.decoded(ids.ids, PATH)).select("doc_id", "text", "ids", "spelt", "row").collect()
    assert len(got) == len(rows)
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.spelt == library.decode(want, skip_special_tokens=False) and r.row == "own row"


def test_decoding_of_any_ids(spark, library):
    df = spark.createDataFrame([([1, 49407, 5, 99999999, -1],), ([],), (None,), (list(range(0, 49408, 7)),)], "ids array<int>")
    got = [r[0] for r in df.select(bpe.decoded(df.ids, PATH)).collect()]
    want = [library.decode(x, skip_special_tokens=False) for x in ([1, 49407, 5], [], list(range(0, 49408, 7)))]
    assert got == [want[0], want[1], None, want[2]]


def test_query_equals_the_library(spark, library):
    got = {r.doc_id: r for r in queries.QUERIES["op12_bpe"](spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False)))


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert none.select(bpe.encoded(none.text, PATH)).count() == 0


def test_other_files_are_refused(tmp_path):
    spec = json.load(open(PATH)) | {"model": {"type": "WordPiece"}}
    (tmp_path / "x.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.Backtracking(str(tmp_path / "x.json"))


def test_memory_is_emptied_in_time(monkeypatch, library):
    monkeypatch.setattr(bpe, "POOL_IDS", 100)
    monkeypatch.setattr(bpe, "KNOWN_PAIRS", 50)
    import pyarrow as pa

    c, texts = bpe.Backtracking(PATH), [t for _, t in corpus()[:20]]
    got = [x for a, b, n, g in c.blocks(pa.array(texts)) for x in np.split(c.ids(g), np.cumsum(n)[:-1])]
    assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
