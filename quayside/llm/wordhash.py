"""Hashes of the words of many texts at once, with numpy.

Texts stay the UTF-8 bytes of their Arrow array.  Byte tables say which bytes
belong to words and what they fold to (all separators are ASCII, so bytes
decide alone, but for the marks that a caller names).  A running sum of ``code[byte] * B**position`` (mod 2**64)
gives every word's hash as a difference, taken back to position 0 by the
inverse power, and mixed.  The same trick hashes runs of words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SEGMENT = 1 << 18          # bytes hashed at once
BLOCK_BYTES = 1 << 20      # text bytes of a block of documents
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse mod 2**64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Powers:
    """Powers of an odd base and of its inverse, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> "Powers":
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)
        return self


BYTE_POWERS = Powers(BASE)
CODE = np.random.default_rng(20240601).integers(0, 1 << 64, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The public 64-bit finaliser of MurmurHash3: a bijection."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def fold_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def word_table(separators) -> np.ndarray:
    t = np.ones(256, bool)
    t[list(separators)] = False
    return t


FOLD = fold_table()
#: Words between white space, and words of letters and digits (any byte beyond ASCII is a letter).
BLANKS = word_table([32, *range(9, 14)])
LETTERS = word_table([*range(0, 48), *range(58, 65), *range(91, 97), *range(123, 128)])


@dataclass
class Words:
    """Words of consecutive texts.  ``first[i]:first[i + 1]`` are text i's;
    starts and ends are byte places in ``data``, where text i is
    ``offsets[i]:offsets[i + 1]``."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def text_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array; nulls are empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _marked(b: np.ndarray, marks) -> np.ndarray:
    """Places of the bytes of the characters ``marks`` (UTF-8 tells where a character begins)."""
    out = np.zeros(len(b), bool)
    for m in marks:
        at = np.flatnonzero(b[:max(0, len(b) - len(m) + 1)] == m[0])
        for k in range(1, len(m)):
            at = at[b[at + k] == m[k]]
        for k in range(len(m)):
            out[at + k] = True
    return out


def hash_words(texts, table: np.ndarray, marks: tuple[bytes, ...] = ()) -> Words:
    """Words of an Arrow string array, A-Z folded.  ``marks`` are characters
    beyond ASCII that end words too."""
    data, offsets = text_bytes(texts)
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(data):
        to = min(at + SEGMENT, len(data))
        while to < len(data):    # on to the next byte that ends a word
            stop = np.flatnonzero(~table[data[to:to + SEGMENT]])
            if len(stop):
                to += int(stop[0])
                break
            to = min(to + SEGMENT, len(data))
        b = data[at:to]
        word = table[b]
        if marks and b.max() > 127:
            word &= ~_marked(b, marks)
        cut = inner[np.searchsorted(inner, at, "right"):np.searchsorted(inner, to)] - at
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        begins[cut] |= word[cut]
        ends[cut - 1] |= word[cut - 1]
        s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        p = BYTE_POWERS.need(len(b) + 1)
        upto = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(CODE[FOLD[b]] * p.up[:len(b)], out=upto[1:])
        parts.append((mix((upto[e] - upto[s]) * p.down[s] + (e - s).astype(np.uint64)), s + at, e + at))
        at = to
    h, s, e = (np.concatenate(x) if parts else np.zeros(0, t) for x, t in zip(zip(*parts) if parts else [()] * 3, (np.uint64, np.int64, np.int64)))
    return Words(h, s, e, np.searchsorted(s, offsets), data, offsets)


RUN_POWERS = (Powers(0xD6E8FEB86659FD93), Powers(0xA0761D6478BD642F))


def hash_runs(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of each run ``start:end`` of word hashes; ``which`` of two
    independent functions."""
    p = RUN_POWERS[which].need(len(hashes) + 1)
    upto = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * p.up[:len(hashes)], out=upto[1:])
    return mix((upto[end] - upto[start]) * p.down[start] + (end - start).astype(np.uint64))


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first) of each text's word shingles in order, with repeats; a
    text of fewer words has its whole sequence as one, one without words none."""
    n = np.diff(words.first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    start = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], count)
    end = start + np.repeat(np.minimum(n, size), count)
    return hash_runs(words.hash, start, end), first


def blocks(texts, most: int = BLOCK_BYTES):
    """(from, to) of consecutive rows with about ``most`` bytes of text."""
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
        yield at, to
        at = to
