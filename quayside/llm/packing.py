"""Packing into length buckets with the least padding.

1. Every text is measured in tokens (end id included) and cut into pieces of at
   most ``max_tokens``.
2. The global histogram of piece lengths (at most ``max_tokens`` rows, whatever
   the corpus) goes to the driver, where dynamic programming chooses the
   ``buckets`` upper ends that minimise the padding of all pieces: with
   ``best(k, j)`` the least padding of the j shortest lengths in k buckets,
   ``best(k, j) = min over i of best(k - 1, i) + padding of lengths i..j``.
3. In a bucket of length B a batch takes ``token_budget // B`` pieces, so its
   padded size stays in the budget and all batches but a bucket's last are
   full.  Pieces are numbered in the order of a hash, a chunk of the hash range
   at a time, so that no bucket, however common its lengths, is one task.
   Pieces that agree in all that is hashed (rows without an id, of one length)
   and fill more than a chunk are hashed with their place in the table, too;
   they are one for each ``CHUNK_ROWS`` pieces at most.

Nulls and the like: a null or empty text is one piece that holds the end id; a
long text is as many pieces as it needs.  Null and repeated doc_ids are kept as
they are; each row is packed.  No pieces give no batches.  Columns of ``pieces``
stay, whatever their names, but for those that the result replaces.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import chunked_row_number
from .columns import packed, unpacked
from .storage import written
from .tokens import encoder

MAX_TOKENS = 4096
TOKEN_BUDGET = 65_536
BUCKETS = 16
CHUNK_ROWS = 50_000        # pieces numbered in one window, about
HASH_BITS = 40

PIECES = "doc_id bigint, piece int, start_token bigint, n_tokens int"


def token_pieces(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, piece, start_token, n_tokens of each piece of each text."""
    def measure(batches):
        import pyarrow as pa

        enc = encoder(tokenizer)
        for batch in batches:
            n = enc.lengths(batch.column("text")) + 1
            count = -(-n // max_tokens)
            row = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").take(pa.array(row)), "piece": piece.astype(np.int32), "start_token": piece * max_tokens,
                "n_tokens": np.minimum(n[row] - piece * max_tokens, max_tokens).astype(np.int32)})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(measure, PIECES)


def best_ends(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets over the histogram (distinct
    lengths, ascending) that minimise the padding."""
    if not lengths:
        return []
    size = np.array(lengths, np.int64)
    n = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    tokens = np.concatenate([[0], np.cumsum(size * np.array(counts, np.int64))])
    m, k = len(size), min(buckets, len(size))
    best = np.full(m + 1, np.iinfo(np.int64).max // 2)
    best[0] = 0
    cut = np.zeros((k + 1, m + 1), np.int64)
    for b in range(1, k + 1):
        now = np.full(m + 1, np.iinfo(np.int64).max // 2)
        for j in range(b, m + 1):
            padding = best[:j] + size[j - 1] * (n[j] - n[:j]) - (tokens[j] - tokens[:j])
            cut[b, j] = int(np.argmin(padding))
            now[j] = padding[cut[b, j]]
        best = now
    ends, j = [], m
    for b in range(k, 0, -1):
        ends.append(int(size[j - 1]))
        j = int(cut[b, j])
    return ends[::-1]


def pack(pieces: DataFrame, token_budget: int = TOKEN_BUDGET, buckets: int = BUCKETS) -> DataFrame:
    """``pieces`` with bucket_tokens (the padded length), batch (a number in
    its bucket), slot (place in the batch) and padding."""
    pieces = written(pieces, "packing-pieces")
    histogram = pieces.groupBy("n_tokens").count().orderBy("n_tokens").collect()
    ends = best_ends([r[0] for r in histogram], [r[1] for r in histogram], buckets)
    chunks = max(1, -(-sum(r[1] for r in histogram) // CHUNK_ROWS))
    hashed = ["doc_id", "piece", "n_tokens"]
    alike = written(pieces.groupBy(*hashed).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CHUNK_ROWS)
                    .select(F.struct(*hashed).alias("alike"), F.lit(True).alias("many")), "packing-alike")
    rows = pieces.select(packed(pieces, ["bucket_tokens", "batch", "slot", "padding"]), *hashed, F.monotonically_increasing_id().alias("at"))
    rows = rows.join(alike, F.struct(*hashed).eqNullSafe(F.col("alike")), "left")
    place = F.pmod(F.xxhash64(*hashed, F.when(F.col("many"), F.col("at"))), F.lit(1 << HASH_BITS))
    end = F.element_at(F.filter(F.array(*map(F.lit, ends or [0])), lambda e: e >= F.col("n_tokens")), 1)
    placed = rows.select("row", *hashed, end.alias("bucket_tokens"), place.alias("place"))
    numbered = chunked_row_number(placed, ["bucket_tokens"], ["place", "doc_id", "piece"],
                                  F.floor(F.col("place") * chunks / F.lit(1 << HASH_BITS)), "n")
    per = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.col("bucket_tokens")))
    return unpacked(numbered, "bucket_tokens", F.floor((F.col("n") - 1) / per).cast("bigint").alias("batch"),
                    F.pmod(F.col("n") - 1, per).cast("int").alias("slot"),
                    (F.col("bucket_tokens") - F.col("n_tokens")).cast("int").alias("padding"))
