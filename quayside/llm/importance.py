"""Importance resampling towards a target distribution (hashed n-grams).

Features are all runs of 1 to 3 words, joined by one blank; a feature's bucket
is the CRC-32 of its bytes modulo ``BUCKETS``.  The CRC of a run follows from
those of its words: crc(a + b) = crc(a) moved on by len(b) bytes, xor crc(b).

1. One pass counts words; the most frequent (at most ``HEAD_WORDS``, none
   longer than ``HEAD_BYTES``) are broadcast with their CRC states, and the
   CRCs and buckets of all pairs of the first ``PAIR_WORDS`` of them make a
   table.  A pair is no more frequent than its words, so every pair more
   frequent than the last of these words is in it.
2. One pass over the corpus and one over the target add up the buckets.
   Features of head words alone come from the tables, all others (the tail)
   take a direct CRC of their bytes, so the totals are exact.
3. A bucket's gain is the floored log ratio of its smoothed shares.  One more
   pass adds up the gains of each document's features; Gumbel noise from a
   hash of the id makes the largest scores a sample without replacement.
4. The drawn rows are numbered over range partitions.

Nulls and the like: a null or empty text has no features, weight 0.  A null
id hashes as the empty string, and ranks first among ties.  Rows of equal
score and id take the places in any order; each counts.  Rows with fewer than
``min_words`` words have a score and are never drawn.  Without documents the
result is empty, without a target its shares are the smoothing alone.  Very
long texts are taken in pieces.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import quoted
from .ranking import numbered
from .storage import written
from .wordhash import LETTERS
from .wordruns import Runs, frequent, walk

BUCKETS = 10_000
HEAD_WORDS = 1 << 16
HEAD_BYTES = 64
PAIR_WORDS = 1024
POLYNOMIAL = 0xEDB88320    # fixed value of CRC-32
DRAW_PERCENT = 5
MIN_WORDS = 20
SEED = 42


def _shift_tables() -> np.ndarray:
    """[bytes moved on, byte of the state, its value]: the state after so many zero bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(POLYNOMIAL), step >> 1)
    out = np.empty((HEAD_BYTES + 1, 4, 256), np.uint32)
    for byte in range(4):
        out[0, byte] = np.arange(256, dtype=np.uint32) << np.uint32(8 * byte)
    for n in range(1, HEAD_BYTES + 1):
        out[n] = step[out[n - 1] & 0xFF] ^ (out[n - 1] >> np.uint32(8))
    return out.reshape(-1)


SHIFT = _shift_tables()
BLANK_CRC = np.uint32(zlib.crc32(b" "))


def moved(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRCs moved on by ``n`` bytes (at most ``HEAD_BYTES``)."""
    at = n.astype(np.int64) << 10
    out = SHIFT[at + (crc & 0xFF)]
    for byte in (1, 2, 3):
        out ^= SHIFT[at + (byte << 8) + ((crc >> np.uint32(8 * byte)) & np.uint32(0xFF))]
    return out


@dataclass
class Head:
    """Frequent words (each with a blank behind), the most frequent first."""

    words: list[bytes]
    ready: bool = field(default=False, compare=False)

    def __getstate__(self):
        return {"words": self.words, "ready": False}

    def prepare(self) -> "Head":
        if not self.ready:
            self.place = {w: i for i, w in enumerate(self.words)}
            self.crc = np.fromiter((zlib.crc32(w[:-1]) for w in self.words), np.uint32, len(self.words))
            top, size = self.crc[:PAIR_WORDS], np.fromiter((len(w) - 1 for w in self.words[:PAIR_WORDS]), np.int64)
            self.pairs = moved(np.repeat(_with_blank(top), len(top)), np.tile(size, len(top))) ^ np.tile(top, len(top))
            self.pair_bucket = (self.pairs % BUCKETS).astype(np.int16)
            self.n_top, self.ready = len(top), True
        return self


def _with_blank(crc: np.ndarray) -> np.ndarray:
    return moved(crc, np.ones(len(crc), np.int64)) ^ BLANK_CRC


def _direct(r: Runs, last: np.ndarray, size: int) -> np.ndarray:
    """Buckets of the runs of ``size`` words that end in the words ``last``."""
    view, crc = memoryview(r.data), zlib.crc32
    starts, ends = r.start[last - (size - 1)].tolist(), (r.start[last + 1] - 1).tolist()
    return np.fromiter((crc(view[a:b]) % BUCKETS for a, b in zip(starts, ends)), np.int64, len(starts))


def buckets(r: Runs, carried: int, head: Head) -> np.ndarray:
    """[3, words]: the bucket of the run of 1, 2 and 3 words that ends in each
    word; ``BUCKETS`` where there is none (or the piece before had it)."""
    codes, words = r.distinct()
    n = len(codes)
    out = np.full((3, n), BUCKETS, np.int64)
    if not n:
        return out
    place = np.fromiter((head.place.get(w, -1) for w in words), np.int64, len(words))
    crc = np.fromiter((zlib.crc32(w[:-1]) if p < 0 else 0 for w, p in zip(words, place.tolist())), np.uint32, len(words))
    known = place >= 0
    crc[known] = head.crc[place[known]]
    out[0] = (crc % BUCKETS)[codes]
    place, crc, size = place[codes], crc[codes], np.diff(r.start) - 1
    same = ~r.broken[1:]
    two = np.flatnonzero(same) + 1
    both = (place[two - 1] >= 0) & (place[two] >= 0)
    table = both & (place[two - 1] < head.n_top) & (place[two] < head.n_top)
    state = np.zeros(n, np.uint32)          # of the pair of head words that ends here
    t = two[table]
    at = place[t - 1] * head.n_top + place[t]
    state[t], out[1, t] = head.pairs[at], head.pair_bucket[at]
    t = two[both & ~table]
    state[t] = moved(_with_blank(crc[t - 1]), size[t]) ^ crc[t]
    out[1, t] = state[t] % BUCKETS
    t = two[~both]
    out[1, t] = _direct(r, t, 2)
    three = np.flatnonzero(same[1:] & same[:-1]) + 2
    all3 = (place[three - 2] >= 0) & (place[three - 1] >= 0) & (place[three] >= 0)
    t = three[all3]
    out[2, t] = (moved(_with_blank(state[t - 1]), size[t]) ^ crc[t]) % BUCKETS
    t = three[~all3]
    out[2, t] = _direct(r, t, 3)
    out[:, :carried] = BUCKETS
    return out


def head_words(docs: DataFrame, text: str = "text") -> Head:
    """The frequent words of all texts: a list of bounded size."""
    def count(batches):
        for batch in batches:
            for _, _, r, carried in walk(batch.column(0), LETTERS):
                codes, words = r.distinct()
                n = np.bincount(codes[carried:], minlength=len(words))
                short = np.fromiter((len(w) <= HEAD_BYTES for w in words), bool, len(words))    # with its blank
                yield pa.RecordBatch.from_pydict({"word": pa.array([w for w, s in zip(words, short) if s], pa.binary()), "n": n[short]})

    counts = docs.select(quoted(text).cast("string")).mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    top = frequent(written(counts.filter("n > 1"), "words"), HEAD_WORDS).collect()
    return Head([bytes(r["word"]) for r in sorted(top, key=lambda r: (-r["n"], r["word"]))])


def bucket_totals(docs: DataFrame, head, text: str = "text") -> np.ndarray:
    """Features of all texts in each bucket (``head``: broadcast)."""
    def count(batches):
        total, table = np.zeros(BUCKETS + 1, np.int64), head.value.prepare()
        for batch in batches:
            for _, _, r, carried in walk(batch.column(0), LETTERS):
                total += np.bincount(buckets(r, carried, table).ravel(), minlength=BUCKETS + 1)
        found = np.flatnonzero(total[:BUCKETS])
        yield pa.RecordBatch.from_pydict({"bucket": found, "n": total[found]})

    sums = docs.select(quoted(text).cast("string")).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for r in sums.collect():        # a row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(of_docs: np.ndarray, of_target: np.ndarray) -> np.ndarray:
    """Floored log ratios of the smoothed shares, one each bucket, and 0 for no bucket."""
    S, T = float(of_docs.sum()) + BUCKETS, float(of_target.sum()) + BUCKETS
    ratio = [math.floor(1000 * math.log((float(t) + 1) * S / ((float(s) + 1) * T))) for s, t in zip(of_docs, of_target)]
    return np.array([*ratio, 0], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, head, text: str = "text"):
    """Column struct<n_words, n_features, weight> of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    @F.arrow_udf("n_words bigint, n_features bigint, weight bigint")
    def weigh(texts: pa.Array) -> pa.Array:
        table, worth = head.value.prepare(), shared.value
        words, weight = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for a, b, r, carried in walk(texts, LETTERS):
            sums = np.concatenate([[0], np.cumsum(worth[buckets(r, carried, table)].sum(axis=0))])
            weight[a:b] += sums[r.first[1:]] - sums[r.first[:-1]]
            words[a:b] += np.diff(r.first) - carried
        features = words + np.maximum(words - 1, 0) + np.maximum(words - 2, 0)
        return pa.StructArray.from_arrays([pa.array(words), pa.array(features), pa.array(weight)], ["n_words", "n_features", "weight"])

    return weigh(quoted(text).cast("string"))


def resample(docs: DataFrame, target: DataFrame, keep: list[str] = ("doc_id",), id: str = "doc_id", text: str = "text",
             percent: int = DRAW_PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """The columns ``keep`` of every document with n_words, n_features,
    weight, score and rank (1, 2, … of the drawn, else null): ``percent`` of
    the documents of ``min_words`` words or more are drawn."""
    spark = docs.sparkSession
    head = spark.sparkContext.broadcast(head_words(docs, text))
    gain = gains(bucket_totals(docs, head, text), bucket_totals(target, head))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(quoted(id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    found = docs.select(F.struct(*map(quoted, keep)).alias("row"), quoted(id).alias("id"), noise.alias("noise"), weighed(docs, gain, head, text).alias("w"))
    scored = written(found.select("row", "id", "w.*", (F.col("w.weight") + F.col("noise")).alias("score")), "scored")
    able = F.col("n_words") >= min_words
    drawn = scored.agg(F.count_if(able)).first()[0] * percent // 100
    places = numbered(scored.withColumn("able", able), F.desc("able"), F.desc("score"), F.asc("id"))
    rank = F.when(F.col("able") & (F.col("rank") <= drawn), F.col("rank"))
    return places.select(*(F.col("row").getField(c).alias(c) for c in keep), "n_words", "n_features", "weight", "score", rank.alias("rank"))
