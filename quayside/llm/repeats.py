"""Repeated passages: line and sentence hashing over the whole corpus.

A text is cut into units that tile it: a line ends a unit, and so does a
sentence inside a line (a passage may stand in the midst of a line).  A unit
is normalised to its words (letters and digits, A-Z folded), and digested.

1. One pass gives a row (digest, document) for each distinct unit of at least
   ``UNIT_WORDS`` words of a document.  Shorter units (lists, verse, menus) are
   digested together with their neighbours: from each unit on, and up to each,
   as many as make ``RUN_WORDS`` words, if two or more of them are short.
2. Digests are grouped globally; the smallest doc_id (then hash of the text)
   is the earliest ranked occurrence.  It is a minimum taken before the shuffle, and only digests of
   two documents or more are joined back with the rows; a digest that a third
   of all documents hold is split by adaptive execution.
3. The digests that a document repeats (at most its own units) meet its text
   again.  Neighbouring repeated units (with shorter units between them) make
   a run; a run of at least ``CUT_WORDS`` words is cut out, so that a sentence
   or line that happens to stand elsewhere too leaves a document as it is.
   A passage's first and last sentence may be cut short by what is around it
   and then are no part of the run: of ``PASSAGE_WORDS`` words, half must be
   found in whole units.  What occurs
   before in its own text (without an overlap) is repeated too.  Spans keep
   their offsets in the original text.

Scripts without blanks: a sentence mark of theirs ends a unit, and a long word
counts as several (one for each ``WORD_BYTES`` bytes beyond the first).

Nulls and the like: null and empty texts have no units and stay as they are.
Null doc_ids rank last.  Rows of one doc_id (null too) rank by a hash of their
texts; of rows with equal doc_id and text any one is the first, and what the
others hold is repeated.  Only repeated passages go, never rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .columns import packed, unpacked
from .storage import written
from .wordhash import LETTERS, Words, blocks, hash_runs, hash_words, mix

UNIT_WORDS = 4             # shorter units are no evidence alone, but may stand inside a run
RUN_WORDS = 10             # words of short units that are digested together
PASSAGE_WORDS = 50         # a passage has more
CUT_WORDS = PASSAGE_WORDS // 2
NO_ID = (1 << 63) - 1      # stands for a null doc_id: the last in rank
WORD_BYTES = 12            # a word of three times as many counts as two, of four times as three …
ENDS = np.isin(np.arange(256), [ord(c) for c in ".!?"])
MARKS = tuple(c.encode() for c in "。！？｡．।॥؟۔።။។")     # sentence marks beyond ASCII

SPAN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "stop", "n_words", "kept_doc_id")])


@dataclass
class Units:
    """Units of consecutive texts: ``first[i]:first[i + 1]`` are text i's.
    Words ``word[u]:word[u + 1]`` and bytes ``start[u]:start[u + 1]`` are unit
    u's (starts run to the next unit's, so the units tile each text).
    ``size`` counts its words, long ones as several."""

    first: np.ndarray
    word: np.ndarray
    start: np.ndarray
    size: np.ndarray
    words: Words


def cut(texts) -> Units:
    """Units of an Arrow string array."""
    w = hash_words(texts, LETTERS, MARKS)
    n = len(w.hash)
    opens = np.zeros(n, bool)
    opens[w.first[:-1][w.first[:-1] < w.first[1:]]] = True
    if n:
        lines = np.flatnonzero(w.data == 10)
        before = np.searchsorted(lines, w.start)
        opens[1:] |= before[1:] > before[:-1]
        after = w.data[w.end[:-1]]         # beyond ASCII only a mark ends a word
        opens[1:] |= (ENDS[after] | (after > 127)) & (w.start[1:] > w.end[:-1])
    word = np.append(np.flatnonzero(opens), n)
    first = np.searchsorted(word[:-1], w.first)
    start = np.append(w.start[word[:-1]], len(w.data))
    start[first[:-1][first[:-1] < first[1:]]] = w.offsets[:-1][first[:-1] < first[1:]]   # a text's first unit begins with it
    upto = np.concatenate([[0], np.cumsum(np.maximum((w.end - w.start) // WORD_BYTES - 1, 1))])
    return Units(first, word, start, np.diff(upto[word]), w)


def _digested(u: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(from unit, to unit, text, digest, second digest) of what is evidence,
    in order: long units, and short ones with their neighbours."""
    short = u.size < UNIT_WORDS
    long = np.flatnonzero(~short)
    upto, shorts = (np.concatenate([[0], np.cumsum(x)]) for x in (u.size, short))
    at = np.arange(len(u.size))
    text = np.searchsorted(u.first, at, "right")     # the next text's number
    lo = np.concatenate([at, np.searchsorted(upto, upto[1:] - RUN_WORDS, "right") - 1])
    hi = np.concatenate([np.searchsorted(upto, upto[:-1] + RUN_WORDS), at + 1])
    whole = (lo >= np.tile(u.first[text - 1], 2)) & (hi <= np.tile(u.first[text], 2)) if len(at) else np.zeros(0, bool)
    lo, hi = lo[whole], hi[whole]
    several = shorts[hi] - shorts[lo] > 1
    lo, hi = np.concatenate([long, lo[several]]), np.concatenate([long + 1, hi[several]])
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], hi[order]
    row = np.searchsorted(u.first, lo, "right") - 1
    d1, d2 = (hash_runs(u.words.hash, u.word[lo], u.word[hi], k) for k in (0, 1))
    return lo, hi, row, d1, d2


def _of_text(row: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """A key for a digest in one text of a batch."""
    return digest ^ mix(row.astype(np.uint64) + np.uint64(1))


def _digests(batches):
    """A row for each distinct digest of each text."""
    import pyarrow as pa

    for batch in batches:
        for a, b in blocks(batch.column("text")):
            rows = batch.slice(a, b - a)
            _, _, row, d1, d2 = _digested(cut(rows.column("text")))
            _, once = np.unique(_of_text(row, d1), return_index=True)
            yield pa.RecordBatch.from_pydict({
                "d1": d1[once].view(np.int64), "d2": d2[once].view(np.int64), **{c: rows.column(c).take(pa.array(row[once])) for c in ("doc", "hash")}})


def _runs(flagged: np.ndarray, size: np.ndarray, firsts: np.ndarray):
    """(from unit, to unit) of the runs to cut out, over texts that begin at
    the units ``firsts``.  Short units join a run between repeated ones."""
    n = len(flagged)
    solid = flagged | (size < UNIT_WORDS)
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    begins[firsts] |= solid[firsts]
    starts = np.flatnonzero(begins)
    group = np.cumsum(begins)[flagged] - 1      # the run that each repeated unit is in
    at = np.flatnonzero(flagged)
    lo, hi = np.full(len(starts), n), np.full(len(starts), -1)
    np.minimum.at(lo, group, at)
    np.maximum.at(hi, group, at)
    real = hi >= 0
    lo, hi = lo[real], hi[real] + 1
    upto = np.concatenate([[0], np.cumsum(size)])
    enough = upto[hi] - upto[lo] >= CUT_WORDS
    return lo[enough], hi[enough]


def _excise(batches):
    """Cuts the runs out of each text: what is left, and the spans."""
    import pyarrow as pa

    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("n_words", pa.int64()), ("kept_doc_id", pa.int64())]))
    for batch in batches:
        for a, b in blocks(batch.column("text")):
            rows = batch.slice(a, b - a)
            u = cut(rows.column("text"))
            marks = rows.column("marks").combine_chunks() if isinstance(rows.column("marks"), pa.ChunkedArray) else rows.column("marks")
            marked = np.repeat(np.arange(b - a), marks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            flat = marks.flatten()
            marks_of = _of_text(marked, flat.field("d1").to_numpy(zero_copy_only=False).view(np.uint64))
            keepers = flat.field("kept").to_numpy(zero_copy_only=False)
            order = np.argsort(marks_of)

            since, upto, row, digest, _ = _digested(u)
            own = rows.column("doc").to_numpy(zero_copy_only=False)
            key = _of_text(row, digest)
            _, first_at, which = np.unique(key, return_index=True, return_inverse=True)
            again = (since >= upto[first_at[which]]) | rows.column("copy").to_numpy(zero_copy_only=False)[row]
            place = np.minimum(np.searchsorted(marks_of, key, sorter=order), max(len(order) - 1, 0))
            known = marks_of[order[place]] == key if len(order) else np.zeros(len(key), bool)
            kept_in = own[row]
            kept_in[known] = keepers[order[place[known]]] if len(order) else 0
            flagged, keeper = np.zeros(len(u.size), bool), np.zeros(len(u.size), np.int64)
            hit = np.flatnonzero(again | known)
            single = upto[hit] - since[hit] == 1
            for some in (hit[~single][::-1], hit[single]):      # of several, the first that holds a unit names its keeper; a unit's own digest comes before them
                n = upto[some] - since[some]
                at = np.repeat(since[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
                flagged[at] = True
                keeper[at] = np.repeat(kept_in[some], n)

            lo, hi = _runs(flagged, u.size, u.first[:-1][u.first[:-1] < u.first[1:]])
            n_words = u.word[hi] - u.word[lo]
            spans, cleaned = _cut_out(u, lo, hi, n_words, keeper[lo], rows.column("text"))
            yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(cleaned, pa.string()), pa.array(spans, span)], ["row", "cleaned", "spans"])


def _cut_out(u: Units, lo, hi, n_words, keeper, texts) -> tuple[list[list], list]:
    """(spans, text left) of each text of a block."""
    row = np.searchsorted(u.first, lo, "right") - 1
    ends = np.where(hi >= u.first[row + 1], u.words.offsets[row + 1], u.start[np.minimum(hi, len(u.start) - 1)])
    raw = u.words.data.tobytes()
    cleaned = texts.to_pylist()
    spans: list[list] = [[] for _ in cleaned]
    parts: dict[int, list[bytes]] = {}
    done: dict[int, tuple[int, int]] = {}       # bytes and characters behind a text's last span
    for i, s, e, k, n in zip(row.tolist(), u.start[lo].tolist(), ends.tolist(), keeper.tolist(), n_words.tolist()):
        begin, end = int(u.words.offsets[i]), int(u.words.offsets[i + 1])
        at, chars = done.get(i, (begin, 0))
        gone = raw[s:e].decode("utf-8")
        chars += len(raw[at:s].decode("utf-8"))
        spans[i].append({"start": chars, "stop": chars + len(gone), "n_words": n, "kept_doc_id": None if k == NO_ID else k})
        # Lines stay lines: a cut from within a line to the next leaves a break.
        broken = "\n" in gone and begin < s and raw[s - 1:s] != b"\n" and e < end
        parts.setdefault(i, []).append(raw[at:s] + b"\n" * broken)
        done[i] = e, chars + len(gone)
    for i, p in parts.items():
        cleaned[i] = (b"".join(p) + raw[done[i][0]:int(u.words.offsets[i + 1])]).decode("utf-8")
    return spans, cleaned


def _keys(docs: DataFrame) -> list:
    """text, doc (``NO_ID`` for a null doc_id) and hash of the rows."""
    text = F.col("text").cast("string")
    return [text.alias("text"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("hash")]


def repeated_digests(docs: DataFrame) -> DataFrame:
    """doc, hash, marks (digest, doc in which it stays) of each document that
    holds units of earlier ones."""
    spark = docs.sparkSession
    path, schema = scratch_path(spark, "repeats-units"), "d1 bigint, d2 bigint, doc bigint, hash bigint"
    docs.select(*_keys(docs)).mapInArrow(_digests, schema).write.parquet(path)
    units = spark.read.schema(schema).parquet(path)
    rank = F.struct("doc", "hash")
    earliest = units.groupBy("d1", "d2").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return (units.join(earliest, ["d1", "d2"]).filter(rank > F.col("first"))
            .groupBy("doc", "hash").agg(F.collect_set(F.struct("d1", F.col("first.doc").alias("kept"))).alias("marks")))


def _told_apart(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copy``: whether another row of the same doc and text
    comes before."""
    repeated = written(rows.filter("text <> ''").groupBy("doc", "hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "repeated-rows")
    none = F.lit(False).alias("copy")
    if repeated.isEmpty():
        return rows.select("*", none)
    # Written, so that a row has one place for all who ask.
    several = written(rows.join(repeated, ["doc", "hash"], "left_semi").withColumn("place", F.monotonically_increasing_id()), "repeated-texts")
    first = several.groupBy("doc", "hash").agg(F.min("place").alias("first"))
    several = several.join(first, ["doc", "hash"]).withColumn("copy", F.col("place") > F.col("first"))
    return rows.join(repeated, ["doc", "hash"], "left_anti").select(*rows.columns, none).unionByName(several.select(*rows.columns, "copy"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with ``text`` freed of repeated passages, and
    ``removed``: their spans in the original text (characters, words) with the
    doc_id in which the passage stays.  A column named so is replaced."""
    rows = (_told_apart(docs.select(packed(docs, ["removed"]), *_keys(docs)))
            .join(repeated_digests(docs), ["doc", "hash"], "left").select("row", "text", "doc", "copy", "marks"))
    schema = T.StructType([rows.schema["row"], T.StructField("cleaned", T.StringType()), T.StructField("spans", T.ArrayType(SPAN))])
    out = rows.mapInArrow(_excise, schema)
    return unpacked(out.withColumn("row", F.col("row").withField("text", F.col("cleaned"))), F.col("spans").alias("removed"))
