"""Token ids of whole texts, at the price of the distinct words.

The tokenizer (a file of the ``tokenizers`` library, its path a parameter)
drops white space before its merges, so the ids of a text are the ids of its
blank-separated pieces one after another.  Each Arrow batch is split and
dictionary-encoded, only pieces not seen before are encoded, and the ids are
gathered with numpy.  Only space and line feed are cut at; any other white
space stays inside a piece for the tokenizer to treat.

A new piece of Latin letters with signs behind (most are) goes to the
tokenizer's merge model in these two parts, as its own pre-tokenizer would
cut it; all others go through the whole tokenizer.
"""

from __future__ import annotations

import gc
import os
import re
from array import array

import numpy as np

# Distinct pieces (and as many parts) that one worker keeps before it starts anew, some
# 200 bytes each: reused workers hold them while other jobs run.
CACHE_PIECES = 350_000
# Text bytes that are split and gathered at once.
BLOCK_BYTES = 4 << 20

# Letters that lower-case one to one and are the same in any normal form, then
# signs (no apostrophe, which takes letters along, and no bracketed special token).
PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?&%$#*]*)")

_ENCODERS: dict[str, "PieceEncoder"] = {}


def encoder(path: str) -> "PieceEncoder":
    """The worker's encoder of a tokenizer file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """start, start+1, … of each (start, length), one after another."""
    total = int(lens.sum())
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable bytes are themselves, the rest follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PieceEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.parts: dict[str, bytes] = {"": b""}
        self._reset()
        # The short way is for tokenizers that lower-case and cut as assumed above.
        probe = ["Aé", "Zürich,", "THE!?", "x*", "ñandú...", "Stop.;"]
        whole = [e.ids for e in self.tokenizer.encode_batch(probe, add_special_tokens=False)]
        self.plain = [list(array("I", self._parts(*PLAIN.fullmatch(p).groups()))) for p in probe] == whole

    def _reset(self) -> None:
        self.slot: dict[str, int] = {"": 0}
        self.start = np.zeros(1, np.int64)
        self.length = np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _part(self, part: str) -> bytes:
        if (ids := self.parts.get(part)) is None:
            spelt = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
            ids = self.parts[part] = array("I", [t.id for t in self.tokenizer.model.tokenize(spelt)]).tobytes()
        return ids

    def _parts(self, letters: str, signs: str) -> bytes:
        ids = self._part(letters.lower())
        return ids + self._part(signs) if signs else ids

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece as native unsigned 32-bit integers."""
        whole = lambda some: [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        if not self.plain:
            return whole(pieces)
        if len(self.parts) > CACHE_PIECES:
            self.parts = {"": b""}
        match, parts = PLAIN.fullmatch, self._parts
        found = [parts(*m.groups()) if (m := match(p)) else None for p in pieces]
        others = [i for i, x in enumerate(found) if x is None]
        for i, ids in zip(others, whole([pieces[i] for i in others])):
            found[i] = ids
        return found

    def _slots(self, pieces: list[str]) -> np.ndarray:
        slots = [self.slot.get(p) for p in pieces]
        new = [p for p, s in zip(pieces, slots) if s is None]
        if len(self.slot) + len(new) > CACHE_PIECES:
            self._reset()
            new = [p for p in pieces if p]
        if new:
            gc.disable()     # many small objects and no cycles
            ids = self._encode(new)
            gc.enable()
            lens = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            first = len(self.start)
            self.slot.update(zip(new, range(first, first + len(new))))
            self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(lens) - lens])
            self.length = np.concatenate([self.length, lens])
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), np.uint32)])
            slots = [self.slot[p] for p in pieces]
        return np.array(slots, np.int64)

    def _pieces(self, texts):
        """(slot of each piece, first piece of each text) of an Arrow string array."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_string()), "\n", " ")
        parts = pc.split_pattern(texts, " ")
        first = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        coded = parts.flatten().dictionary_encode()
        slots = self._slots(coded.dictionary.to_pylist())
        return slots[coded.indices.to_numpy(zero_copy_only=False)], first

    def blocks(self, texts):
        """(row from, row to, lengths, ids) of an Arrow string array, a few
        megabytes of text at a time."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            before = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, before + BLOCK_BYTES, "right")))
            slots, first = self._pieces(texts.slice(at, to - at))
            piece_len = self.length[slots]
            upto = np.concatenate([[0], np.cumsum(piece_len)])
            yield at, to, upto[first[1:]] - upto[first[:-1]], (slots, piece_len)
            at = to

    def ids(self, gathered) -> np.ndarray:
        slots, piece_len = gathered
        return self.pool[ranges(self.start[slots], piece_len)]

    def lengths(self, texts) -> np.ndarray:
        """Number of ids of each text (null: 0)."""
        return np.concatenate([n for _, _, n, _ in self.blocks(texts)] or [np.zeros(0, np.int64)])
