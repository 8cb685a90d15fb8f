"""Phrase collocations: frequent runs of 2 to 4 words and how tightly they hold.

Everything is per language.  Texts are cut at punctuation and line ends into
pieces, those at blanks into words; a phrase is a run of words in one piece.

1. Words are counted.  The most frequent of those that can stand in a phrase
   (at least ``min_count``; at most ``HEAD`` of them, each of bounded length)
   get numbers by frequency in their language and are broadcast.  The others,
   whose number has no bound, are known to the tasks by a Bloom filter of fixed
   size: it lets all of them through, and few words besides.
2. Pairs of numbered words are counted by direct address: a pair's number is
   (left, right), cut into tiles of 1024 x 1024.  Frequent words have small
   numbers, so few tiles hold most pairs; a tile that fills up is counted by a
   dense ``bincount``, all others as sorted (pair, count) lists.  Pairs with an
   unnumbered word are counted by their words.  Counts are added up by Spark,
   so every frequent pair is exact.
3. Frequent pairs are ranked anew, and a run of three is a (pair, word), a run
   of four a (triple, word), counted in the same way.  A run counts only if
   both its shorter runs are frequent (or pass the filter): no other can be.
4. Scores, the cut that decides and the phrases inside longer ones are joins
   and aggregates of the frequent phrases; numbers are decimals, so products
   are exact.

Nulls and the like: a null language is ``und``, null and empty texts have no
words.  Repeated rows count each.  A language without a frequent phrase has no
rows, nor has an empty table.  Very long texts are taken in pieces, very long
words are words.  Ties rank by the bytes of the phrase, of which no two are
equal.  Only the two named columns are read, so others cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import quoted
from .ranking import numbered
from .storage import written
from .wordhash import mix, word_table
from .wordruns import Runs, frequent, walk

MIN_COUNT = 30
MAX_WORDS = 4
INSIDE_PERCENT = 80
TOP = 2000

ENDS = [10, 11, 12, 13, *b".,;:!?"]
WORDS = word_table([9, 32, *ENDS])
BREAKS = ~word_table(ENDS)

HEAD_BITS = 17
HEAD = 1 << HEAD_BITS      # numbered runs of a size, all languages together
HEAD_BYTES = 64            # a numbered run's bytes for each of its words
TILE_BITS = 10
TILES = 1 << (HEAD_BITS - TILE_BITS)
DENSE_PAIRS = 1 << 16      # pairs of a block in a tile from which on it is counted densely
DENSE_TILES = 8            # dense tiles that a task holds, 8 MB each
SPARSE_PAIRS = 1 << 21     # pairs that a task holds before it sorts them, and sorted ones before it lets them go
FILTER_BITS = 20           # 2**20 words of 64 bits: 8 MB a size, whatever the input
FACTOR = np.uint64(0x9E3779B97F4A7C15)


# ----------------------------------------------------------- what tasks know

def seed_of(lang: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(lang.encode())


def hash_word(word: bytes, seed: int) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word, seed)


def joined_hash(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a run from that of its first words and that of its last."""
    return mix(left * FACTOR + word)


def filter_place(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word of the filter, its four bits) of each hash."""
    bits = np.zeros(len(h), np.uint64)
    for shift in (20, 26, 32, 38):
        bits |= np.uint64(1) << ((h >> np.uint64(shift)) & np.uint64(63))
    return (h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64), bits


class Filter:
    """Bloom filter of fixed size."""

    def __init__(self, rows: pa.Table | None = None):
        self.words = None
        if rows is not None and rows.num_rows:
            self.words = np.zeros(1 << FILTER_BITS, np.uint64)
            self.words[rows["place"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)

    def add(self, h: np.ndarray) -> None:
        if len(h):
            if self.words is None:
                self.words = np.zeros(1 << FILTER_BITS, np.uint64)
            np.bitwise_or.at(self.words, *filter_place(h))

    def passes(self, h: np.ndarray) -> np.ndarray:
        if self.words is None:
            return np.zeros(len(h), bool)
        place, bits = filter_place(h)
        return (self.words[place] & bits) == bits


@dataclass
class Ranked:
    """Numbered runs of one size in one language, the most frequent first."""

    runs: list[bytes]
    place: dict[bytes, int] | None = None          # of words
    hashes: np.ndarray | None = None
    codes: np.ndarray | None = None                # of longer runs, ascending, with their numbers
    numbers: np.ndarray | None = None


class Known:
    """Numbered runs of each size (from 1) and language, and the filters of the others."""

    def __init__(self):
        self.ranked: list[dict[str, Ranked]] = []
        self.filters: list[Filter] = []

    def add(self, head: pa.Table, others: Filter) -> None:
        rows = sorted(zip(head["lang"].to_pylist(), (-n for n in head["n"].to_pylist()), head["phrase"].to_pylist()))
        by_lang: dict[str, Ranked] = {}
        for lang, _, phrase in rows:
            by_lang.setdefault(lang, Ranked([])).runs.append(phrase)
        for lang, r in by_lang.items():
            if not self.ranked:
                seed = seed_of(lang)
                r.place = {w: i for i, w in enumerate(r.runs)}
                r.hashes = np.fromiter((hash_word(w, seed) for w in r.runs), np.uint64, len(r.runs))
            else:
                shorter = {p: i for i, p in enumerate(self.of(lang, len(self.ranked)).runs)}
                words = self.of(lang, 1).place or {}
                codes = np.full(len(r.runs), -1, np.int64)
                for i, p in enumerate(r.runs):
                    left, _, last = p.rpartition(b" ")
                    if left in shorter and last in words:
                        codes[i] = shorter[left] << HEAD_BITS | words[last]
                order = np.argsort(codes, kind="stable")
                r.numbers = order[codes[order] >= 0]
                r.codes = codes[r.numbers]
                # A run whose parts have no numbers is let through by the filter, as those without a number are.
                others.add(run_hashes([r.runs[i].split(b" ") for i in order[codes[order] < 0]], seed_of(lang)))
        self.ranked.append(by_lang)
        self.filters.append(others)

    def of(self, lang: str, size: int) -> Ranked:
        return self.ranked[size - 1].get(lang) or Ranked([], {}, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def phrase(self, lang: str, size: int, code: int) -> bytes:
        return self.of(lang, size - 1).runs[code >> HEAD_BITS] + b" " + self.of(lang, 1).runs[code & (1 << HEAD_BITS) - 1]


def run_hashes(known_words: list[list[bytes]], seed: int) -> np.ndarray:
    """Hashes of runs of equal size, given as their words."""
    out = None
    for column in zip(*known_words):
        h = np.fromiter((hash_word(w, seed) for w in column), np.uint64, len(column))
        out = h if out is None else joined_hash(out, h)
    return out if out is not None else np.zeros(0, np.uint64)


def possible(known: Known, lang: str, r: Runs, size: int, carried: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(last word of each run of ``size`` words that may be frequent, number
    of its first size - 1 words, number of its last word; -1: no number)."""
    codes, words = r.distinct()
    n = len(codes)
    first, seed = known.of(lang, 1), seed_of(lang)
    place = np.fromiter((first.place.get(w[:-1], -1) for w in words), np.int64, len(words))
    h = np.fromiter((0 if p >= 0 else hash_word(w[:-1], seed) for w, p in zip(words, place.tolist())), np.uint64, len(words))
    numbered = place >= 0
    h[numbered] = first.hashes[place[numbered]]
    alive = (numbered | known.filters[0].passes(h))[codes]
    word, word_hash = place[codes], h[codes]
    left, left_hash = word, word_hash
    for s in range(2, size + 1):
        ok = alive[1:] & alive[:-1] & ~r.broken[1:]
        at = np.flatnonzero(ok) + 1
        if s == size:
            at = at[at >= carried]
            return at, left[at - 1], word[at]
        runs, a, b = known.of(lang, s), left[at - 1], word[at]
        number = np.full(len(at), -1, np.int64)
        if len(runs.codes):
            code = a << HEAD_BITS | b
            slot = np.minimum(np.searchsorted(runs.codes, code), len(runs.codes) - 1)
            hit = (a >= 0) & (b >= 0) & (runs.codes[slot] == code)
            number[hit] = runs.numbers[slot[hit]]
        hashed = joined_hash(left_hash[at - 1], word_hash[at])
        live = (number >= 0) | known.filters[s - 1].passes(hashed)
        left, left_hash, alive = np.full(n, -1, np.int64), np.zeros(n, np.uint64), np.zeros(n, bool)
        left[at], left_hash[at], alive[at] = number, hashed, live
    raise ValueError("size is 2 at least")


# ---------------------------------------------------------------- counting

class Tiles:
    """Counts of numbered pairs in bounded memory: dense tiles and sorted lists."""

    def __init__(self):
        self.dense: dict[tuple[str, int], np.ndarray] = {}
        self.fresh: dict[str, list[np.ndarray]] = {}
        self.sorted: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.n_fresh = 0

    def add(self, lang: str, left: np.ndarray, right: np.ndarray):
        """Counts pairs; yields (language, codes, counts) of what it lets go."""
        tile = (left >> TILE_BITS) * TILES + (right >> TILE_BITS)
        filled = np.bincount(tile, minlength=TILES * TILES)
        for t in np.flatnonzero(filled >= DENSE_PAIRS):
            if (lang, t) not in self.dense:
                if len(self.dense) >= DENSE_TILES:
                    yield from self._dense()
                self.dense[lang, t] = np.zeros(1 << 2 * TILE_BITS, np.int64)
        is_dense = np.zeros(TILES * TILES, bool)
        for at, t in list(self.dense):
            if at == lang and filled[t]:
                is_dense[t] = True
                inside = tile == t
                cell = (left[inside] & (1 << TILE_BITS) - 1) << TILE_BITS | (right[inside] & (1 << TILE_BITS) - 1)
                self.dense[lang, t] += np.bincount(cell, minlength=1 << 2 * TILE_BITS)
        rest = ~is_dense[tile]
        self.fresh.setdefault(lang, []).append(left[rest] << HEAD_BITS | right[rest])
        self.n_fresh += int(rest.sum())
        if self.n_fresh >= SPARSE_PAIRS:
            yield from self._merge()

    def _merge(self):
        for lang, fresh in self.fresh.items():
            codes, counts = np.unique(np.concatenate(fresh), return_counts=True)
            if lang in self.sorted:
                old, n = self.sorted[lang]
                every, ns = np.concatenate([old, codes]), np.concatenate([n, counts])
                order = np.argsort(every, kind="stable")       # two ascending lists
                every, ns = every[order], ns[order]
                begin = np.flatnonzero(np.diff(every, prepend=-1))
                codes, counts = every[begin], np.add.reduceat(ns, begin) if len(begin) else ns
            self.sorted[lang] = codes, counts
        self.fresh, self.n_fresh = {}, 0
        if sum(len(c) for c, _ in self.sorted.values()) >= SPARSE_PAIRS:
            yield from self._let_go()

    def _let_go(self):
        for lang, (codes, counts) in self.sorted.items():
            yield lang, codes, counts
        self.sorted = {}

    def _dense(self):
        for (lang, t), n in self.dense.items():
            cell = np.flatnonzero(n)
            left, right = (t // TILES << TILE_BITS) + (cell >> TILE_BITS), (t % TILES << TILE_BITS) + (cell & (1 << TILE_BITS) - 1)
            yield lang, left << HEAD_BITS | right, n[cell]
        self.dense = {}

    def rest(self):
        yield from self._merge()
        yield from self._let_go()
        yield from self._dense()


COUNTS = "lang string, code bigint, phrase binary, n bigint"
EMIT_ROWS = 1 << 16


def _batches(lang: str, codes, phrases, counts):
    n = len(counts)
    for a in range(0, n, EMIT_ROWS):
        m = min(EMIT_ROWS, n - a)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.DictionaryArray.from_arrays(pa.array(np.zeros(m, np.int8)), [lang]).cast(pa.string()),
            "code": pa.nulls(m, pa.int64()) if codes is None else pa.array(codes[a:a + m]),
            "phrase": pa.nulls(m, pa.binary()) if phrases is None else pa.array(phrases[a:a + m], pa.binary()),
            "n": pa.array(counts[a:a + m], pa.int64())})


def _by_lang(batch):
    """(language, its texts) of an Arrow batch."""
    import pyarrow.compute as pc

    langs = batch.column("lang")
    for lang in pc.unique(langs).to_pylist():
        yield lang, batch.column("text").filter(pc.equal(langs, lang))


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, phrase (null: all words of the language together), n."""
    def count(batches):
        for batch in batches:
            for lang, some in _by_lang(batch):
                for _, _, r, carried in walk(some, WORDS, BREAKS, 0):
                    codes, words = r.distinct()
                    n = np.bincount(codes[carried:], minlength=len(words))
                    used = np.flatnonzero(n)
                    yield from _batches(lang, None, [words[i][:-1] for i in used] + [None], np.append(n[used], n.sum()))

    return texts.mapInArrow(count, COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def run_counts(texts: DataFrame, known, size: int, min_count: int) -> DataFrame:
    """lang, phrase, n of the frequent runs of ``size`` words (``known``: broadcast)."""
    def count(batches):
        tiles = Tiles()
        for batch in batches:
            for lang, some in _by_lang(batch):
                for _, _, r, carried in walk(some, WORDS, BREAKS, size - 1):
                    at, left, right = possible(known.value, lang, r, size, carried)
                    numbered = (left >= 0) & (right >= 0)
                    for let_go in tiles.add(lang, left[numbered], right[numbered]):
                        yield from _batches(let_go[0], let_go[1], None, let_go[2])
                    others = at[~numbered]
                    if len(others):
                        view = memoryview(r.data)
                        runs = [bytes(view[a:b]) for a, b in zip(r.start[others - size + 1].tolist(), (r.start[others + 1] - 1).tolist())]
                        found = pa.array(runs, pa.large_binary()).value_counts()
                        yield from _batches(lang, None, found.field("values").to_pylist(), found.field("counts").to_numpy())
        for let_go in tiles.rest():
            yield from _batches(let_go[0], let_go[1], None, let_go[2])

    def spell(batches):
        for b in batches:
            phrases = [p if c is None else known.value.phrase(lang, size, c) for lang, c, p in zip(*(b.column(x).to_pylist() for x in ("lang", "code", "phrase")))]
            yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array(phrases, pa.binary()), b.column("n")], ["lang", "phrase", "n"])

    sums = texts.mapInArrow(count, COUNTS).groupBy("lang", "code", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    return sums.mapInArrow(spell, "lang string, phrase binary, n bigint")


def filter_of(runs: DataFrame) -> Filter:
    """The filter of runs (lang, phrase) of one size: at most 2**20 rows reach the driver."""
    def place(batches):
        import pyarrow.compute as pc

        for b in batches:
            for lang in pc.unique(b.column("lang")).to_pylist():
                some = b.column("phrase").filter(pc.equal(b.column("lang"), lang)).to_pylist()
                places, bits = filter_place(run_hashes([p.split(b" ") for p in some], seed_of(lang)))
                yield pa.RecordBatch.from_pydict({"place": places, "bits": bits.view(np.int64)})

    return Filter(runs.select("lang", "phrase").mapInArrow(place, "place bigint, bits bigint").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow())


# ------------------------------------------------------------------ phrases

def frequent_runs(docs: DataFrame, text: str, lang: str, min_count: int, max_words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, phrase, size, n of all frequent runs; those of them that are
    numbered: a table of bounded size; lang, n: words of each language)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(quoted(lang).cast("string"), F.lit("und")).alias("lang"), quoted(text).cast("string").alias("text"))
    words = written(word_counts(texts).filter((F.col("n") >= min_count) | F.col("phrase").isNull()), "words")
    totals = words.filter("phrase IS NULL").select("lang", "n")
    level = words.filter((F.col("n") >= min_count) & F.col("phrase").isNotNull()).select("lang", "phrase", "n")
    known, found, numbered = Known(), [], []
    for size in range(1, max_words + 1):
        short = F.octet_length("phrase") <= HEAD_BYTES * size
        top = frequent(level.filter(short), HEAD)
        least = top.agg(F.min("n")).first()[0]
        is_top = short & (F.col("n") >= least) if least is not None else F.lit(False)
        found.append(level.withColumn("size", F.lit(size)))
        numbered.append(level.filter(is_top))
        if size < max_words:
            known.add(level.filter(is_top).toArrow(), filter_of(level.filter(~is_top)))
            level = written(run_counts(texts, spark.sparkContext.broadcast(known), size + 1, min_count), f"runs-{size + 1}")
    return reduce(DataFrame.unionByName, found), reduce(DataFrame.unionByName, numbered[:-1]), totals


def exact(name: str, factor: int = 1):
    return F.col(name).cast("decimal(19,0)") * F.lit(factor).cast("decimal(7,0)")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                 inside_percent: int = INSIDE_PERCENT, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l,
    r, n, score (see the module)."""
    runs, head, totals = frequent_runs(docs, text, lang, min_count, max_words)
    runs = runs.withColumn("phrase", F.col("phrase").cast("string"))
    head = head.select("lang", F.col("phrase").cast("string").alias("part"), F.col("n").alias("f"))
    phrases = runs.filter("size > 1").withColumn("words", F.split("phrase", " "))
    part = lambda a, n: F.array_join(F.slice("words", a, n), " ")
    cuts = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(k.alias("k"), part(F.lit(1), k).alias("left"), part(k + 1, F.col("size") - k).alias("right")))
    cut = phrases.select("lang", "phrase", F.col("n").alias("a"), F.explode(cuts).alias("cut"))
    sides = cut.select("lang", "phrase", "a", "cut.k", F.explode(F.array(F.struct(F.lit(True).alias("is_left"), F.col("cut.left").alias("part")), F.struct(F.lit(False).alias("is_left"), F.col("cut.right").alias("part")))).alias("s")).select("lang", "phrase", "a", "k", "s.*")
    # Parts that many phrases share are numbered runs, of which there are so many at most; the others are joined by key.
    met = sides.join(F.broadcast(head), ["lang", "part"], "left")
    others = runs.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f")).join(F.broadcast(head.select("lang", "part")), ["lang", "part"], "left_anti")
    valued = met.filter("f IS NOT NULL").unionByName(met.filter("f IS NULL").drop("f").join(others, ["lang", "part"]))
    both = valued.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("is_left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("is_left"), F.col("f"))).alias("r"))
    score = F.expr("CAST(2000000 * CAST(a AS DECIMAL(19, 0)) div (CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0))) AS BIGINT)")
    scored = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")).select("lang", "phrase", "a", "best.*")
    # The largest count of a longer phrase around each phrase.
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("size") - m + 1), lambda a: part(a, m))))
    around = (phrases.filter("size > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("longer")))
    kept = (scored.join(around, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (exact("longer", 100) < exact("a", inside_percent))).drop("longer"))
    # Numbered through over all languages, whatever a language's share; its own places begin at its first.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    places = numbered(written(kept, "kept"), F.asc("lang"), *order, out="place")
    begin = places.groupBy("lang").agg(F.min("place").alias("begin"))
    ranked = places.join(begin, "lang").withColumn("rank", F.col("place") - F.col("begin") + 1).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
