"""Runs of words of many texts at once, with their bytes.

``walk`` folds A-Z, cuts texts into words and lays the words of a block of
texts one after another, each followed by one blank: any run of words is then
one slice of bytes.  A very long text comes in pieces, each with the last
words of the piece before in front, so memory is bounded by the block and no
run is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordhash import FOLD, blocks, text_bytes

PIECE_BYTES = 4 << 20      # longer texts are cut
BLANK = 32


@dataclass
class Runs:
    """Word w is ``data[start[w]:start[w + 1] - 1]``, a blank follows it; text
    i's words are ``first[i]:first[i + 1]``.  ``broken[w]``: a break or the
    text's beginning stands before word w."""

    data: np.ndarray
    start: np.ndarray
    first: np.ndarray
    broken: np.ndarray

    def distinct(self) -> tuple[np.ndarray, list[bytes]]:
        """(number of each word, the distinct words, each with its blank)."""
        import pyarrow as pa

        n = len(self.start) - 1
        if not n:
            return np.zeros(0, np.int64), []
        words = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(self.start), pa.py_buffer(self.data)])
        coded = words.dictionary_encode()
        return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def runs(data: np.ndarray, offsets: np.ndarray, words: np.ndarray, breaks: np.ndarray | None = None) -> Runs:
    """``data``: UTF-8 bytes of texts, text i at ``offsets[i]:offsets[i + 1]``."""
    folded = np.insert(FOLD[data], offsets[1:], BLANK)       # a blank ends every text
    offsets = offsets + np.arange(len(offsets))
    word = words[folded]
    edge = np.diff(word.astype(np.int8), prepend=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    keep = word
    keep[end] = True
    out = folded[keep]
    start = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(end - begin + 1, out=start[1:])
    out[start[1:] - 1] = BLANK
    first = np.searchsorted(begin, offsets)
    broken = np.zeros(len(begin), bool)
    if breaks is not None and len(begin):
        upto = np.cumsum(breaks[folded])[begin]
        broken[1:] = upto[1:] > upto[:-1]
    broken[first[:-1][first[:-1] < first[1:]]] = True
    return Runs(out, start, first, broken)


def _pieces(data: np.ndarray, words: np.ndarray) -> Iterator[np.ndarray]:
    """A long text's bytes, cut before separators."""
    at = 0
    while at < len(data):
        to = at + PIECE_BYTES
        while to < len(data) and words[data[to]]:
            stop = np.flatnonzero(~words[data[to:to + PIECE_BYTES]])
            to = to + int(stop[0]) if len(stop) else to + PIECE_BYTES
        yield data[at:to]
        at = to


def walk(texts, words: np.ndarray, breaks: np.ndarray | None = None, carry: int = 2) -> Iterator[tuple[int, int, Runs, int]]:
    """(row from, row to, runs, words carried) of an Arrow string array;
    nulls are empty.  Runs that end in one of the carried words were in the
    piece before."""
    for a, b in blocks(texts, PIECE_BYTES):
        data, offsets = text_bytes(texts.slice(a, b - a))
        if b - a > 1 or len(data) <= PIECE_BYTES:
            yield a, b, runs(data, offsets, words, breaks), 0
            continue
        before, flags = np.zeros(0, np.uint8), np.zeros(0, bool)
        for piece in _pieces(data, words):
            piece = np.concatenate([before, piece])
            r = runs(piece, np.array([0, len(piece)]), words, breaks)
            r.broken[:len(flags)] = flags
            yield a, b, r, len(flags)
            from_word = max(0, len(r.broken) - carry)
            before, flags = r.data[r.start[from_word]:], r.broken[from_word:].copy()


def frequent(counts: DataFrame, most: int, n: str = "n") -> DataFrame:
    """The rows of largest ``n``, at most ``most``: all above a count that a
    histogram of (logarithmic) bins gives, so nothing is sorted in one task."""
    width = F.floor(F.log2(F.col(n)) * 16)
    bins = sorted(((r["b"], r["rows"]) for r in counts.groupBy(width.alias("b")).agg(F.count(F.lit(1)).alias("rows")).collect()), reverse=True)
    least, total = None, 0
    for b, rows in bins:       # a few hundred, whatever the counts
        total += rows
        if total > most:
            break
        least = b
    return counts.filter(F.lit(False) if least is None else width >= least)
