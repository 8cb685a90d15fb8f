"""Language identification, words first, then shorter and shorter n-grams.

A model holds, for each language, log frequencies of words and of character
n-grams.  A text's letters are cut into words.  A known word scores by its
log frequency in each language; an unseen word by the mean log frequency of
its longest n-grams that are known: lengths ``MAX_GRAM`` down to 1, the first
length of which it has any.  The language with the largest mean over the
words wins, ties go to the first by name.

Training reads a bounded sample: a hash of the row's key and text draws
``sample_per_lang`` rows of each language in expectation, and rows of one key
and text count once.  Words and n-grams are counted in Spark, and all that the
sample holds are kept, so the sample bounds the model, which is broadcast.
Prediction reads every whole text; the score is the winner's posterior from
all of its words.  Letters that no language has are evidence for none.

Nulls and the like: a text that is null or has no letter is ``und`` with
score 0; so is every text when nothing was learned.  Rows with a null
language or text teach nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import packed, quoted, unpacked

UND = "und"
MAX_GRAM = 4
SAMPLE_PER_LANG = 1000
SMOOTHING = 0.5
KNOWN_WORDS = 80_000       # words whose score a worker remembers

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    """N-grams of the word with its ends marked (single letters without)."""
    if n == 1:
        return list(word)
    w = f"<{word}>"
    return [w[i:i + n] for i in range(len(w) - n + 1)]


@dataclass
class Model:
    langs: list[str]
    words: dict[str, int]
    word_logs: np.ndarray              # word × language
    grams: list[dict[str, int]]        # by length, from 0
    gram_logs: np.ndarray
    seen: dict[str, int] = field(default_factory=dict)
    seen_logs: np.ndarray | None = None

    def __getstate__(self):
        return {**self.__dict__, "seen": {}, "seen_logs": None}

    def _learn_unseen(self, unseen: list[str]) -> None:
        """Scores of words that the model doesn't hold, by backing off."""
        rows, sizes = [], []
        for w in unseen:
            got: list[int] = []
            for n in range(min(MAX_GRAM, len(w) + 2), 0, -1):
                known = self.grams[n]
                if got := [known[g] for g in grams_of(w, n) if g in known]:
                    break
            rows += got or [0]
            sizes.append(len(got) or 1)
        lens = np.array(sizes)
        means = np.add.reduceat(self.gram_logs[rows], np.cumsum(lens) - lens, axis=0) / lens[:, None]
        if self.seen_logs is None or len(self.seen) + len(unseen) > KNOWN_WORDS:
            self.seen, self.seen_logs = {}, np.zeros((0, len(self.langs)), np.float32)
        first = len(self.seen_logs)
        self.seen.update(zip(unseen, range(first, first + len(unseen))))
        self.seen_logs = np.concatenate([self.seen_logs, means.astype(np.float32)])

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score from 0 to 1: the posterior of the winner)."""
        counts = Counter(words_of(text)) if text and self.langs else None
        if not counts:
            return UND, 0.0
        unseen = [w for w in counts if w not in self.words]
        if new := [w for w in unseen if w not in self.seen]:
            self._learn_unseen(new)
            unseen = unseen if all(map(self.seen.__contains__, unseen)) else self._again(unseen)
        total = np.zeros(len(self.langs))
        if unseen:
            total += np.array([counts[w] for w in unseen]) @ self.seen_logs[[self.seen[w] for w in unseen]]
        if known := [w for w in counts if w in self.words]:
            total += np.array([counts[w] for w in known]) @ self.word_logs[[self.words[w] for w in known]]
        best = int(np.argmax(total))
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())

    def guess(self) -> float:
        """The score of a text that holds no evidence: all languages are alike."""
        return 1 / len(self.langs) if self.langs else 0.0

    def _again(self, unseen: list[str]) -> list[str]:
        """After the memory was emptied halfway: learn this text's words anew."""
        self.seen, self.seen_logs = {}, None
        self._learn_unseen(unseen)
        return unseen


def _count(batches):
    """Occurrences of words and n-grams, added up over each batch."""
    for pdf in batches:
        for lang, texts in pdf.groupby("lang")["text"]:
            words = Counter(w for t in texts for w in words_of(t))
            found = Counter({(0, w): n for w, n in words.items()})
            for w, n in words.items():
                for size in range(1, MAX_GRAM + 1):
                    for g in grams_of(w, size):
                        found[size, g] += n
            yield pd.DataFrame([(lang, size, g, n) for (size, g), n in found.items()], columns=["lang", "size", "piece", "n"])


def train(rows: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG) -> Model:
    """A model of ``rows`` (text, lang, key): ``key`` is any column that tells
    rows apart."""
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").count().collect()     # a row for each language of the model
    if not sizes:
        return Model([], {}, np.zeros((0, 0)), [{}] * (MAX_GRAM + 1), np.zeros((0, 0)))
    share = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], sample_per_lang / r["count"])))
    draw = F.pmod(F.xxhash64("key", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.filter(draw < share[F.col("lang")]).dropDuplicates(["lang", "key", "text"]).select("lang", "text")
    counts = sample.mapInPandas(_count, "lang string, size int, piece string, n bigint").groupBy("lang", "size", "piece").agg(F.sum("n").alias("n")).checkpoint()
    return _model(counts.select("lang", "size", "piece", "n").toArrow())       # the sample's words and n-grams


def _model(got: pa.Table) -> Model:
    """The model of counts (lang, size, piece, n; size 0: words)."""
    got = got.combine_chunks()
    lang, size, piece, n = (got.column(c).combine_chunks() if got.num_rows else got.column(c) for c in ("lang", "size", "piece", "n"))
    langs = sorted(pc.unique(lang).to_pylist())
    pieces = [pc.unique(piece.filter(pc.equal(size, s))) for s in range(MAX_GRAM + 1)]
    pieces = [p.take(pc.sort_indices(p)) for p in pieces]
    # n-grams of all lengths share one table; its row 0 is for words of unknown letters.
    first = np.cumsum([0, 1, *map(len, pieces[1:MAX_GRAM])])
    tables = [np.zeros((len(pieces[0]), len(langs)), np.float32), np.zeros((1 + sum(map(len, pieces[1:])), len(langs)), np.float32)]
    spans = [(tables[0], 0), *((tables[1], int(first[s])) for s in range(1, MAX_GRAM + 1))]
    for s, (table, at) in enumerate(spans):
        for i, name in enumerate(langs):
            mine = pc.and_(pc.equal(size, s), pc.equal(lang, name))
            counted = n.filter(mine).to_numpy(zero_copy_only=False).astype(np.float64)
            seen = np.zeros(len(pieces[s]))
            seen[pc.index_in(piece.filter(mine), value_set=pieces[s]).to_numpy(zero_copy_only=False)] = counted
            table[at:at + len(seen), i] = np.log((seen + SMOOTHING) / (counted.sum() + SMOOTHING * (len(counted) + 1)))
    tables[1][0] = tables[1][0].mean()
    number = lambda s, at: {p: at + i for i, p in enumerate(pieces[s].to_pylist())}
    return Model(langs, number(0, 0), tables[0], [{}] + [number(s, int(first[s])) for s in range(1, MAX_GRAM + 1)], tables[1])


def language(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """struct<lang_pred, score> of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        return pd.DataFrame([m.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(quoted(text).cast("string"))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` put beside its columns
    (columns of these names are replaced)."""
    found = docs.select(packed(docs, ("lang_pred", "score")), language(docs, model, text).alias("found"))
    return unpacked(found, "found.lang_pred", "found.score")
