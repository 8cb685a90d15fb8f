"""Byte-pair encoding by backtracking, decoding by an offset table.

The tokenizer is a BPE file of the ``tokenizers`` library (its path a
parameter).  Its normaliser and pre-tokenizer cut texts into words; merges are
not run.  Instead each word is covered from the left with its longest tokens,
which one Aho-Corasick pass (over the word read backwards) finds for all
places.  A token may follow another only if merging would leave the two
apart, which a table of merges and of each token's last merge decides; where
none fits, the last token is taken back and a shorter one tried.  A place that
was given up is never tried again, so the work is linear in the word.

That a cover of pairwise compatible tokens is the merges' result holds as each
text has one result, and a token's inside does not depend on what stands
around it.  Merges whose parts never meet are left out when the tables are
made.

Decoding joins the tokens' spellings by one blank, as the library does for a
file without a decoder: bytes of all spellings lie one after another, and an
offset table says where each begins.

Nulls and the like: a null or empty text has no ids and decodes to the empty
string.  Special tokens that stand in a text are found first.  Ids unknown to
the file spell nothing.  Long texts are encoded in blocks.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .tokens import PLAIN, PieceEncoder, ranges

END = "\x00"               # stands for the mark of a word's end: one letter no spelling has
KNOWN_PAIRS = 1 << 20      # compatibility answers that a worker remembers
POOL_IDS = 16 << 20        # ids of remembered pieces after which they are forgotten
DECODE_IDS = 1 << 18       # ids decoded at once
NEVER = 1 << 62

_CODERS: dict[str, "Backtracking"] = {}


def coder(path: str) -> "Backtracking":
    """The worker's coder of a tokenizer file, kept between tasks."""
    if path not in _CODERS:
        _CODERS[path] = Backtracking(path)
    return _CODERS[path]


class Merges:
    """The tables of a vocabulary and its merges, and the encoder of a word.

    Tokens are numbered as in the vocabulary.  ``made[t]``: rank of the merge
    that makes token t (-1: a letter), ``parts[t]`` its two parts."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        import ahocorasick

        def spelt(token: str) -> str:
            return token.removesuffix(suffix) + END if suffix and token.endswith(suffix) else token

        size = max(vocab.values(), default=-1) + 1
        self.size, self.made, self.parts = [0] * size, [-1] * size, [(-1, -1)] * size
        ids = {spelt(t): i for t, i in vocab.items()}
        for t, i in ids.items():
            self.size[i] = len(t)
        self.pairs: dict[tuple[int, int], int] = {}
        self.known: dict[tuple[int, int], bool] = {}
        usable = {t for t in ids if len(t.removesuffix(END)) == 1}
        for rank, (a, b) in enumerate(merges):
            a, b = spelt(a), spelt(b)
            if a in usable and b in usable and self.compatible(ids[a], ids[b]):
                c = ids[a + b]
                self.made[c], self.parts[c], self.pairs[ids[a], ids[b]] = rank, (ids[a], ids[b]), rank
                usable.add(a + b)
        self.prefix = [-1] * size          # the longest usable token that begins a token
        self.found = ahocorasick.Automaton()
        for t in usable:
            i = ids[t]
            self.found.add_word(t[::-1], i)
            self.prefix[i] = next((ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in usable), -1)
        if usable:
            self.found.make_automaton()
        self.end = END if suffix else ""

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves the two tokens side by side.  Backwards from
        their last merges: the parts that met at the border must not have had
        a merge of a rank that came before."""
        made, parts, pairs, before = self.made, self.parts, self.pairs, NEVER
        while True:
            if pairs.get((left, right), NEVER) < before:
                return False
            if made[left] > made[right]:
                before, left = made[left], parts[left][1]
            elif made[right] < 0:
                return True
            else:
                before, right = made[right] + 1, parts[right][0]    # of equal ranks the left place merges first

    def fits(self, left: int, right: int) -> bool:
        if (known := self.known.get((left, right))) is None:
            if len(self.known) >= KNOWN_PAIRS:
                self.known.clear()
            known = self.known[left, right] = self.compatible(left, right)
        return known

    def encode(self, word: str) -> list[int]:
        """Ids of a word (letters of the vocabulary)."""
        if not word:
            return []
        word += self.end
        n, size, prefix, fits = len(word), self.size, self.prefix, self.fits
        longest = [-1] * n
        for at, token in self.found.iter(word[::-1]):
            start = n - 1 - at
            if longest[start] < 0 or size[token] > size[longest[start]]:
                longest[start] = token
        is_open = bytearray(b"\x01") * (n + 1)
        if self.end:
            is_open[n - 1] = 0             # the end mark belongs to its letter
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            while token >= 0 and not (is_open[at + size[token]] and (not out or fits(out[-1], token))):
                token = prefix[token]
            if token >= 0:
                out.append(token)
                at += size[token]
                if at == n:
                    return out
                token = longest[at]
            elif out:
                is_open[at] = 0
                token = out.pop()
                at -= size[token]
            else:
                raise ValueError("the vocabulary lacks a letter")


class Backtracking(PieceEncoder):
    """Texts to ids and back: pieces are cut, remembered and gathered as in
    ``PieceEncoder``; their words are encoded by ``Merges``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        unsupported = [k for k in ("dropout", "continuing_subword_prefix", "ignore_merges", "byte_fallback") if model.get(k)]
        if model["type"] != "BPE" or unsupported:
            raise ValueError(f"not a plain BPE file: {model['type']} {unsupported}")
        super().__init__(path)
        self.merges = Merges(model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]],
                             model.get("end_of_word_suffix") or "")
        self.parts = {"": b""}             # forget the probe's
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        spelling = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        n = max(spelling, default=-1) + 1
        self.spelt = Spellings([spelling.get(i) for i in range(n)])

    def _part(self, part: str) -> bytes:
        if (ids := self.parts.get(part)) is None:
            spelt = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
            # No merges yet: the probe of the short way, made before them, asks the library.
            ids = super()._part(part) if not hasattr(self, "merges") else array("I", self.merges.encode(spelt)).tobytes()
            self.parts[part] = ids
        return ids

    def _slots(self, pieces: list[str]) -> np.ndarray:
        if len(self.pool) > POOL_IDS:
            self._reset()
        return super()._slots(pieces)

    def _encode(self, pieces: list[str]) -> list[bytes]:
        if len(self.parts) > 2 * KNOWN_PAIRS:
            self.parts = {"": b""}
        match = PLAIN.fullmatch
        return [self._parts(*m.groups()) if self.plain and (m := match(p)) else self._any(p) for p in pieces]

    def _any(self, piece: str) -> bytes:
        """A piece of any letters: special tokens, then words as the file cuts them."""
        out = array("I")
        for section in self.cut.split(piece) if self.cut else [piece]:
            if section in self.special:
                out.append(self.special[section])
                continue
            section = self.tokenizer.normalizer.normalize_str(section) if self.tokenizer.normalizer else section
            words = self.tokenizer.pre_tokenizer.pre_tokenize_str(section) if self.tokenizer.pre_tokenizer else [(section, None)]
            for word, _ in words:
                out.extend(self.merges.encode(word))
        return out.tobytes()


class Spellings:
    """Bytes of all tokens, each with a blank behind, and where they begin."""

    def __init__(self, tokens: list[str | None]):
        spelt = [b"" if t is None else t.encode() + b" " for t in tokens]
        self.data = np.frombuffer(b"".join(spelt), np.uint8)
        self.length = np.fromiter(map(len, spelt), np.int64, len(spelt))
        self.start = np.cumsum(self.length) - self.length

    def decode(self, ids: np.ndarray) -> bytes:
        ids = ids[(ids >= 0) & (ids < len(self.start))]
        return b"".join(self.data[ranges(self.start[some], self.length[some])].tobytes()
                        for some in np.split(ids, range(DECODE_IDS, len(ids), DECODE_IDS)))[:-1]


def encoded(text: Column, path: str) -> Column:
    """array<int>: the ids of each text (null: none)."""
    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        enc = coder(path)
        lengths, ids = [np.zeros(1, np.int64)], [np.zeros(0, np.uint32)]
        for _, _, n, got in enc.blocks(texts):
            lengths.append(n)
            ids.append(enc.ids(got))
        return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(lengths)), pa.int32()), pa.array(np.concatenate(ids).view(np.int32)))

    return encode(text.cast("string"))


def decoded(ids: Column, path: str) -> Column:
    """The string that each list of ids spells (null: null)."""
    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        spell = coder(path).spelt.decode
        upto, values = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(zero_copy_only=False)
        texts = [spell(values[a:b]) for a, b in zip(upto, upto[1:])]
        return pa.array(texts, pa.binary(), mask=lists.is_null().to_numpy(zero_copy_only=False)).cast(pa.string())

    return decode(ids)
