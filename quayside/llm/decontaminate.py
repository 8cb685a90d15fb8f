"""Benchmark decontamination: SimHash of item-sized windows, multi-index
Hamming blocks, exact weighted-shingle similarity.

For an item of n words every window of n words of a document is a suspect (a
shorter document is one window).  Window and item are multisets of 5-word
shingles; they match from a weighted Jaccard similarity (sum of the smaller
counts over sum of the larger) of ``SIMILARITY`` on.

1. Items are indexed by size: their shingle counts, a 64-bit SimHash, and for
   each of ``BLOCKS`` blocks of its bits a table: block value -> items whose
   block differs in at most ``RADIUS // BLOCKS`` bits.  By the pigeonhole
   principle every fingerprint within ``RADIUS`` of an item's is found by one
   of the blocks.  (At similarity 0.75 fingerprints differ in 11 bits on
   average, with a deviation of 3.)
2. Documents stream past the index.  A window without any shingle of any item
   has similarity 0 and is passed over; the bit sums of the others come from
   one running sum over the document's shingles, whatever the window's size.
3. Candidates within the radius are verified on the full multisets; the best
   window of each (document, item) is kept.

The index is broadcast.  Its size grows with the benchmark, not with the
documents; beyond ``ITEMS_A_PASS`` items the benchmark is taken in several
passes of that many, so the bound holds for any benchmark.

Nulls and the like: null, empty or wordless texts and items match nothing; an
item of fewer than 5 words is one shingle and matches where all its words
stand in a row.  Equal items each match.  Null ids are kept as they are.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import packed, unpacked
from .wordhash import LETTERS, Words, blocks, hash_runs, hash_words, mix

SHINGLE = 5
SIMILARITY = 0.75
RADIUS = 23
BLOCKS = (11, 11, 11, 11, 10, 10)     # bits of each block, 64 in all
ITEMS_A_PASS = 4000
REGION = 1 << 16                      # shingles whose bit sums are held at once
FILTER_BITS = 20

FOUND = [T.StructField("item", T.LongType()), T.StructField("start_word", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("similarity", T.DoubleType())]


def _bits(hashes: np.ndarray) -> np.ndarray:
    """64 signs (1, -1) of each hash."""
    raw = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32)
    return 2 * raw - 1


def _prints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def _block(prints: np.ndarray, k: int) -> np.ndarray:
    shift = sum(BLOCKS[:k])
    return ((prints >> np.uint64(shift)) & np.uint64((1 << BLOCKS[k]) - 1)).astype(np.int64)


def _ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


class Sized:
    """Items of one number of words."""

    def __init__(self, size: int, items: list[tuple[int, np.ndarray]]):
        self.size, self.unit = size, min(size, SHINGLE)
        self.span = size - self.unit + 1              # shingles in a window
        self.ids = [i for i, _ in items]
        self.counts = [np.unique(h, return_counts=True) for _, h in items]
        self.prints = np.concatenate([_prints(_bits(h).sum(axis=0, keepdims=True)) for _, h in items])
        self.near = []
        for k, bits in enumerate(BLOCKS):
            values = np.arange(1 << bits, dtype=np.int64)
            self.near.append(_ones(values[:, None] ^ _block(self.prints, k)[None, :]) <= RADIUS // len(BLOCKS))

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all fingerprints within the radius."""
        found = self.near[0][_block(prints, 0)]
        for k in range(1, len(BLOCKS)):
            found = found | self.near[k][_block(prints, k)]
        window, item = np.nonzero(found)
        close = _ones(prints[window] ^ self.prints[item]) <= RADIUS
        return window[close], item[close]

    def similarity(self, item: int, window: np.ndarray) -> float:
        hashes, counts = self.counts[item]
        at = np.minimum(np.searchsorted(hashes, window), len(hashes) - 1)
        common = np.minimum(np.bincount(at[hashes[at] == window], minlength=len(hashes)), counts).sum()
        return float(common / (len(window) + counts.sum() - common))


class Index:
    """Items (number, text) by size."""

    def __init__(self, items: list[tuple[int, str]]):
        import pyarrow as pa

        by_size = defaultdict(list)
        w = hash_words(pa.array([t for _, t in items], pa.string()), LETTERS)
        for i, (number, _) in enumerate(items):
            words = w.hash[w.first[i]:w.first[i + 1]]
            if len(words):
                by_size[len(words)].append((number, _shingles(words, min(len(words), SHINGLE))))
        self.sized = [Sized(n, x) for n, x in sorted(by_size.items())]
        self.known, self.filter = {}, {}
        for unit in {s.unit for s in self.sized}:
            self.known[unit] = np.unique(np.concatenate([h for s in self.sized if s.unit == unit for h, _ in s.counts]))
            self.filter[unit] = np.zeros(1 << FILTER_BITS, bool)
            self.filter[unit][self.known[unit] >> np.uint64(64 - FILTER_BITS)] = True

    def live(self, hashes: np.ndarray, unit: int) -> np.ndarray:
        """Which of the shingles are some item's."""
        out = self.filter[unit][hashes >> np.uint64(64 - FILTER_BITS)]
        maybe = np.flatnonzero(out)
        out[maybe] = np.isin(hashes[maybe], self.known[unit])
        return out

    def search(self, words: np.ndarray):
        """(item, first word, words, similarity) of matching windows of a
        text, given its word hashes: the best window of each item."""
        best: dict[int, tuple[float, int, int]] = {}
        for unit in self.known:
            k = min(unit, len(words))
            sized = [s for s in self.sized if s.unit == unit]
            if k < unit and unit < SHINGLE:
                continue                                # fewer words than such items have
            hashes = _shingles(words, k)
            live = self.live(hashes, unit)
            longest = max(s.span for s in sized)
            for lo, hi in _regions(live, longest):
                bits = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(_bits(hashes[lo:hi]), axis=0, dtype=np.int32)])
                lively = np.concatenate([[0], np.cumsum(live[lo:hi])])
                for s in sized:
                    span = min(s.span, len(hashes))
                    starts = np.flatnonzero(lively[span:] > lively[:-span]) if hi - lo >= span else np.zeros(0, np.int64)
                    if not len(starts):
                        continue
                    window, item = s.candidates(_prints(bits[starts + span] - bits[starts]))
                    for a, i in zip(starts[window].tolist(), item.tolist()):
                        got = s.similarity(i, hashes[lo + a:lo + a + span])
                        if got >= SIMILARITY and (got, -lo - a) > best.get(s.ids[i], (0.0, 0, 0))[:2]:
                            best[s.ids[i]] = got, -lo - a, min(s.size, len(words))
        return [(item, -at, n, got) for item, (got, at, n) in best.items()]


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    starts = np.arange(max(0, len(words) - size + 1))
    return hash_runs(words, starts, starts + size)


def _regions(live: np.ndarray, longest: int):
    """(from, to) stretches of shingles that hold every window with a live
    one; two windows long at least, whatever the size of the items."""
    size = max(REGION, 2 * longest)
    at = np.flatnonzero(live)
    if not len(at):
        return
    cuts = np.flatnonzero(np.diff(at) > 2 * longest)
    for a, b in zip(at[np.append(0, cuts + 1)], at[np.append(cuts, len(at) - 1)]):
        lo, end = max(0, int(a) - longest + 1), min(len(live), int(b) + longest)
        while lo < end:
            yield lo, min(end, lo + size)
            if lo + size >= end:
                break
            lo += size - longest


def _search(batches, index: Index):
    """Rows of the matches: those of the documents, repeated for each item."""
    import pyarrow as pa

    units = list(index.known)
    for batch in batches:
        for a, b in blocks(batch.column("text")):
            rows = batch.slice(a, b - a)
            w = hash_words(rows.column("text"), LETTERS)
            found = [(i, *m) for i in _suspects(w, index, units) for m in index.search(w.hash[w.first[i]:w.first[i + 1]])]
            take = pa.array([f[0] for f in found], pa.int64())
            columns = [pa.array([f[k] for f in found], t) for k, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.int64()), (4, pa.float64()))]
            yield pa.RecordBatch.from_arrays([rows.column("row").take(take), *columns], ["row", "item", "start_word", "n_words", "similarity"])


def _suspects(w: Words, index: Index, units: list[int]) -> list[int]:
    """Texts with a shingle of some item."""
    hit = np.zeros(len(w.first) - 1, bool)
    for unit in units:
        n = len(w.hash) - unit + 1
        if n > 0:
            starts = np.arange(n)
            live = starts[index.live(hash_runs(w.hash, starts, starts + unit), unit)]
            row = np.searchsorted(w.first, live, "right") - 1
            hit[row[live + unit <= w.first[row + 1]]] = True
    return np.flatnonzero(hit).tolist()


def contaminated(docs: DataFrame, benchmark: DataFrame, keep: list[str]) -> DataFrame:
    """The matches of ``docs`` (text) with ``benchmark`` (item_id, text): the
    columns ``keep`` of the document, item_id, start_word and n_words of the
    best window, similarity."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    rows = docs.select(packed(docs.select(*keep)), F.col("text").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], *FOUND])
    out = None
    for part in _passes(items):
        index = spark.sparkContext.broadcast(Index([(i, r["text"]) for i, r in enumerate(part)]))
        ids = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(part)], "item bigint, item_id bigint")
        found = (rows.mapInArrow(lambda batches, index=index: _search(batches, index.value), schema).join(ids, "item"))
        out = found if out is None else out.unionByName(found)
    return unpacked(out, "item_id", "start_word", "n_words", "similarity")


def _passes(items: DataFrame):
    """The items, ``ITEMS_A_PASS`` at a time (once, empty, if there is none)."""
    part: list = []
    none = True
    for r in items.orderBy("item_id", "text").toLocalIterator():
        part.append(r)
        if len(part) == ITEMS_A_PASS:
            yield part
            part, none = [], False
    if part or none:
        yield part


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the documents that hold an item."""
    rows = docs.select(packed(docs), "doc_id", "text", F.xxhash64(F.col("text").cast("string")).alias("hash"))
    bad = contaminated(rows, benchmark, ["doc_id", "hash"]).select(F.col("doc_id").alias("id"), F.col("hash").alias("bad")).distinct()
    return unpacked(rows.join(bad, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("bad")), "left_anti"))
