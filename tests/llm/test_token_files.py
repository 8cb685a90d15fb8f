import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import corpus, prose, with_clashes

from quayside.llm import packing, token_files
from quayside.llm.queries import tokenizer_path
from quayside.llm.storage import committed_file, filesystem, input_file
from quayside.llm.tokens import encoder
from quayside.session import scratch_path


def direct(texts):
    t = encoder(tokenizer_path()).tokenizer
    return [e.ids for e in t.encode_batch(list(texts), add_special_tokens=False)]


def test_pieces_give_the_ids_of_whole_texts():
    rng = random.Random(3)
    alphabet = "abcXYZ éÉß'’.,;!?&%$#*-_|<>\t\n\r\x0b\x0c\x1c\x85\xa0\u2003İſKΣσς中文ा1234 🙂ﬁ½"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["", "it's we're 'S <|endoftext|>a <|startoftext|>", "ΟΔΟΣ", "don't", "É́", None]
    enc = encoder(tokenizer_path())
    got = []
    for a, b, lens, gathered in enc.blocks(pa.array(texts)):
        ids, ends = enc.ids(gathered), np.concatenate([[0], np.cumsum(lens)])
        got += [ids[ends[i]:ends[i + 1]].tolist() for i in range(b - a)]
    assert got == direct(t or "" for t in texts)
    assert enc.lengths(pa.array(texts)).tolist() == [len(x) for x in got]


def test_cache_overflow_keeps_ids_right(monkeypatch):
    from quayside.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_PIECES", 50)
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 300)
    enc = tokens.PieceEncoder(tokenizer_path())
    texts = [prose(random.Random(i), 60, 5000) for i in range(20)]
    got = [enc.ids(g).tolist() for _, _, _, g in enc.blocks(pa.array(texts))]
    assert sum(got, []) == sum(direct(texts), [])


@pytest.mark.parametrize("frame", [7, 1 << 18])
def test_shard_round_trip_and_single_documents(scratch, monkeypatch, frame):
    monkeypatch.setattr(token_files, "FRAME_IDS", frame)
    docs = [np.arange(n, dtype=np.uint32) + 10 * n for n in (3, 0, 20, 1, 7)]
    path = f"file:{scratch}/x.tids"
    with committed_file(path) as f:
        w = token_files.ShardWriter(f)
        w.add(np.array([5, 6, 7, 8, 9]), np.array([len(d) for d in docs]), np.concatenate(docs))
        assert w.close() == (5, 31)
    with input_file(path) as f:
        r = token_files.ShardReader(f)
        assert r.doc_ids.tolist() == [5, 6, 7, 8, 9]
        assert [np.frombuffer(raw, "<u4").tolist() for _, raw in r.documents()] == [d.tolist() for d in docs]
        assert [np.frombuffer(raw, "<u4").tolist() for _, raw in r.documents([2, 4])] == [docs[2].tolist(), docs[4].tolist()]


def test_a_damaged_frame_is_noticed(scratch):
    path = f"{scratch}/x.tids"
    with committed_file(path) as f:
        w = token_files.ShardWriter(f)
        w.add(np.array([1]), np.array([1000]), np.arange(1000, dtype=np.uint32))
        w.close()
    raw = bytearray(open(path, "rb").read())
    raw[40] ^= 1
    open(path, "wb").write(raw)
    with input_file(path) as f, pytest.raises(Exception):
        list(token_files.ShardReader(f).documents())


def test_a_failed_write_leaves_no_file(scratch):
    with pytest.raises(RuntimeError), committed_file(f"{scratch}/y") as f:
        f.write(b"x")
        raise RuntimeError
    fs, path = filesystem(scratch)
    from pyarrow.fs import FileSelector

    assert fs.get_file_info(FileSelector(path)) == []


def test_documents_from_files(spark, monkeypatch):
    rows = corpus()
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string")).repartition(3)
    shards = token_files.write_token_files(df, scratch_path(spark, "t"), tokenizer_path(), partitions=4)
    got = [r.asDict() for r in token_files.read_token_files(shards).collect()]
    assert len(got) == len(rows)
    got.sort(key=lambda r: r["start"])
    ids = [(r["doc_id"] is not None, r["doc_id"]) for r in got]
    assert ids == sorted(ids, key=lambda x: (x[0], x[1] or 0))
    at, want = 0, {}
    for (d, _), x in zip(rows, direct(t or "" for _, t in rows)):
        raw = np.array(x + [1], "<u4").tobytes()
        want.setdefault(d, []).append((len(x) + 1, zlib.crc32(raw)))
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        assert (r["n_tokens"], r["ids_crc32"]) in want[r["doc_id"]]
    some = {r["doc_id"]: r["ids"] for r in token_files.fetch_documents(shards, [3, 401, 999]).collect()}
    assert some == {3: direct([rows[3][1]])[0] + [1], 401: [1]}


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    shards = token_files.write_token_files(df, scratch_path(spark, "t"), tokenizer_path())
    assert token_files.read_token_files(shards).collect() == []


def brute_padding(lengths, counts, k):
    from itertools import combinations

    best = None
    for ends in combinations(range(len(lengths) - 1), min(k, len(lengths)) - 1):
        ends = [*ends, len(lengths) - 1]
        pad = sum(c * (lengths[next(e for e in ends if e >= i)] - n) for i, (n, c) in enumerate(zip(lengths, counts)))
        best = pad if best is None else min(best, pad)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_bucket_ends_are_optimal(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 60), 9))
    counts = [rng.randrange(1, 50) for _ in lengths]
    for k in (1, 2, 3, 4, 12):
        ends = packing.best_ends(lengths, counts, k)
        assert ends[-1] == lengths[-1] and ends == sorted(set(ends)) and len(ends) <= k
        pad = sum(c * (next(e for e in ends if e >= n) - n) for n, c in zip(lengths, counts))
        assert pad == brute_padding(lengths, counts, k)


def test_batches_hold_every_piece_within_the_budget(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_ROWS", 5)
    rows = corpus()
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    pieces = packing.token_pieces(df, tokenizer_path(), max_tokens=200)
    got = packing.pack(pieces, token_budget=1000, buckets=4).toPandas()
    want = []
    for (d, _), x in zip(rows, direct(t or "" for _, t in rows)):
        n = len(x) + 1
        want += [(-1 if d is None else d, i, i * 200, min(200, n - i * 200)) for i in range(-(-n // 200))]
    assert sorted(got[["doc_id", "piece", "start_token", "n_tokens"]].fillna(-1).astype(int).itertuples(index=False, name=None)) == sorted(want)
    assert got["bucket_tokens"].nunique() <= 4
    assert ((got["bucket_tokens"] - got["n_tokens"]) == got["padding"]).all() and (got["padding"] >= 0).all()
    for (length,), bucket in got.groupby(["bucket_tokens"]):
        per = max(1, 1000 // length)
        sizes = bucket.groupby("batch").size().sort_index()
        assert list(sizes.index) == list(range(len(sizes)))
        assert (sizes.iloc[:-1] == per).all() and sizes.iloc[-1] <= per
        assert not bucket.duplicated(["batch", "slot"]).any()


def test_packing_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.token_pieces(df, tokenizer_path())).collect() == []


def test_a_third_of_all_pieces_without_an_id(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_ROWS", 20)
    rows = [(None, 0, 7, "x")] * 150 + [(i, i % 3, 5 + i % 11, "y") for i in range(300)] + [(4, 1, 9, "z")] * 30
    schema = "doc_id long, piece int, n_tokens int, _place string"
    pieces = spark.createDataFrame(rows, schema).selectExpr("*", "'c' AS _n", "1 AS _chunk", "2 AS place", "3 AS row", "4 AS many", "5 AS batch")
    got = packing.pack(pieces, token_budget=100, buckets=3)
    assert got.columns == [c for c in pieces.columns if c != "batch"] + ["bucket_tokens", "batch", "slot", "padding"]
    got = got.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["n_tokens"], r["_place"]) for r in got) == sorted((d is None, d or 0, p, n, x) for d, p, n, x in rows)
    places = {(r["bucket_tokens"], r["batch"], r["slot"]) for r in got}
    assert len(places) == len(rows)
    for end in {r["bucket_tokens"] for r in got}:
        per, inside = 100 // end, sorted((r["batch"], r["slot"]) for r in got if r["bucket_tokens"] == end)
        assert inside == [(i // per, i % per) for i in range(len(inside))]
    # Nothing else than a chunk's share of the rows without an id stands together.
    batches = {r["batch"] for r in got if r["doc_id"] is None}
    assert len(batches) > 150 // 10
