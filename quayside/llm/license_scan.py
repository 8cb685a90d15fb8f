"""Licence scan by a positional index of rare words; DataFrame functions only.

A template is the word list of a licence notice with one mandatory key phrase
inside it.  Each template is indexed under the rarest word (highest IDF over
the documents) of its key phrase, together with that word's place.  A
document looks up the rare words that it holds: an occurrence at word ``i``
proposes that the template begins at ``i - place``.  A proposal stands only
if every word of the key phrase is found at its relative position; then the
IDF-weighted share of the template's words that stand at theirs is its
coverage.  As the rare word is a part of the mandatory phrase, no place of a
phrase can be missed.

Names (``gnu general public license``) are templates that are all key phrase;
their places are counted.  Notices are longer, tolerate other words outside
their key phrase, and give a label from ``MIN_COVERAGE`` on.

All steps work inside a document's row, so there is no shuffle but the word
counts, whose size is that of the templates' vocabulary.

Nulls and the like: a null or wordless text has no words, no labels and score
0; repeated rows are each judged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import packed, quoted, unpacked

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"   # on text with A-Z lowered
SAME_WORD = r"[a-z0-9\x80-\x{10FFFF}]+"         # the same set, which Java's matcher tells faster
# Other letters whose lower case has an ASCII letter: Kelvin sign, I with dot.
ODD_LETTERS = ("\u212a", "\u0130")
MIN_COVERAGE = 0.6
NAME_SCORE = 0.5           # score of a licence's bare name


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: int               # place of the key phrase's first word
    key_words: tuple[str, ...]
    base: bool

    @staticmethod
    def of(label: str, text: str, key: str | None = None) -> "Template":
        words, key_words = tuple(text.split()), tuple((key or text).split())
        at = next(i for i in range(len(words)) if words[i:i + len(key_words)] == key_words)
        return Template(label, words, at, key_words, key is None)


NAMES = [
    Template.of("gpl", "gnu general public license"),
    Template.of("apache", "apache license"),
    Template.of("cc-by", "cc by"),
    Template.of("mit", "mit license"),
]
NOTICES = [
    Template.of("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template.of("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template.of("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    Template.of("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    Template.of("apache-2", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template.of("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template.of("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template.of("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Template.of("mit-notice", "released under the mit license", "mit license"),
    Template.of("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template.of("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    Template.of("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    Template.of("reserved", "copyright all rights reserved", "all rights reserved"),
]


def vocabulary(templates: list[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.words})


def lowered(text: Column) -> Column:
    """The text with A-Z lowered, and perhaps letters beyond ASCII too: no
    word is cut otherwise, and none becomes a template's."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    odd = F.contains(text, F.lit(ODD_LETTERS[0])) | F.contains(text, F.lit(ODD_LETTERS[1]))
    return F.when(odd, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(SAME_WORD), F.lit(0))


def inverse_frequency(docs: DataFrame, templates: list[Template], text: str = "text") -> dict[str, float]:
    """IDF over all documents of the templates' words (a fixed vocabulary, so
    what reaches the driver doesn't grow with the documents)."""
    vocab = vocabulary(templates)
    words = F.array_intersect(words_of(lowered(quoted(text))), F.array(*map(F.lit, vocab)))
    counts = (docs.select(F.explode(F.concat(words, F.array(F.lit("")))).alias("word"))   # "" counts the documents
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect())
    n = {r["word"]: r["n"] for r in counts}
    return {w: math.log((1 + n.get("", 0)) / (1 + n.get(w, 0))) + 1 for w in vocab}


def scan_licenses(docs: DataFrame, names: list[Template] = NAMES, notices: list[Template] = NOTICES,
                  text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_base (places of names), first_word, last_word
    (their smallest and largest start), base_labels, labels (of names and
    notices) and score put beside its columns; columns of these names are
    replaced."""
    idf = inverse_frequency(docs, names + notices, text)
    rare = {t: max(range(len(t.key_words)), key=lambda i: (idf[t.key_words[i]], -i)) for t in names + notices}
    index_words = sorted({t.key_words[i] for t, i in rare.items()})

    added = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rows = docs.select(packed(docs, added), lowered(quoted(text)).alias("body"))
    held = F.lit(False)
    for w in index_words:
        held |= F.contains("body", F.lit(w))
    rows = rows.select("row", held.alias("held"), words_of(F.col("body")).alias("words"))
    # The rare words of the row: (word, place).
    placed = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(index_words))
    rows = rows.select("row", F.size("words").cast("bigint").alias("n_words"), "words", F.when(F.col("held"), placed).otherwise(F.array().cast("array<struct<w:string,i:int>>")).alias("rare"))

    def starts(t: Template) -> Column:
        """Where the template begins, by its verified proposals."""
        proposed = F.transform(F.filter("rare", lambda x: x["w"] == t.key_words[rare[t]]), lambda x: x["i"] - (t.key + rare[t]))

        def verified(s: Column) -> Column:
            ok = F.lit(True)
            for j, w in enumerate(t.key_words):
                ok &= F.coalesce(F.get("words", s + (t.key + j)) == w, F.lit(False))
            return ok

        return F.filter(proposed, verified)

    def coverage(t: Template, s: Column) -> Column:
        total = sum(idf[w] for w in t.words)
        at = lambda j, w: F.when(F.get("words", s + j) == w, idf[w]).otherwise(0.0)
        found = at(0, t.words[0])
        for j, w in enumerate(t.words[1:], 1):
            found = found + at(j, w)
        return F.round(found / total, 6)

    def best_coverage(t: Template) -> Column:
        return F.coalesce(F.array_max(F.transform(starts(t), lambda s: coverage(t, s))), F.lit(0.0))

    rows = rows.select(
        "row", "n_words",
        F.array(*(F.struct(F.lit(t.label).alias("label"), starts(t).alias("starts")) for t in names)).alias("names"),
        F.array(*(F.struct(F.lit(t.label).alias("label"), best_coverage(t).alias("best")) for t in notices)).alias("notices"))
    places = F.flatten(F.transform("names", lambda x: x["starts"]))
    base = F.transform(F.filter("names", lambda x: F.size(x["starts"]) > 0), lambda x: x["label"])
    own = F.transform(F.filter("notices", lambda x: x["best"] >= MIN_COVERAGE), lambda x: x["label"])
    best = F.array_max(F.transform("notices", lambda x: x["best"]))
    rows = rows.select("row", "n_words", places.alias("places"), base.alias("base"), own.alias("own"), best.alias("best"))
    return unpacked(
        rows, "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").cast("bigint").alias("first_word"), F.array_max("places").cast("bigint").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", "own"))), ",").alias("labels"),
        F.greatest("best", F.when(F.size("base") > 0, NAME_SCORE).otherwise(0.0)).alias("score"))


def duckdb_sql(names: list[Template] = NAMES, notices: list[Template] = NOTICES) -> str:
    """The same result by brute force over every word of every document."""
    row = lambda t: f"('{t.label}', {list(t.words)}, {t.key}, {list(t.key_words)}, {t.base})"
    vocab = vocabulary(names + notices)
    return f"""
WITH t(label, words, k, key_words, base) AS (VALUES {', '.join(map(row, names + notices))}),
d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
v AS (SELECT unnest({vocab}) AS word),
df AS (SELECT word, (SELECT count(*) FROM d WHERE list_contains(w, word)) AS n FROM v),
idf AS (SELECT word, ln((1 + (SELECT count(*) FROM d)) / (1 + n)) + 1 AS x FROM df),
p AS (SELECT r, unnest(range(len(w))) AS i, unnest(w) AS word FROM d),
s AS (SELECT p.r, label, base, words, i - k AS s FROM p JOIN t ON p.word = key_words[1] JOIN d ON d.r = p.r
      WHERE list_slice(w, i + 1, i + len(key_words)) = key_words),
j AS (SELECT label, unnest(words) AS word, unnest(range(len(words))) AS j FROM t),
total AS (SELECT label, sum(x) AS total FROM j JOIN idf USING (word) GROUP BY label),
c AS (SELECT s.r, s.label, s.base, s.s, round(sum(CASE WHEN p.word IS NOT NULL THEN x ELSE 0 END) / any_value(total), 6) AS cover
      FROM s JOIN j USING (label) JOIN idf ON idf.word = j.word JOIN total USING (label)
      LEFT JOIN p ON p.r = s.r AND p.i = s.s + j.j AND p.word = j.word GROUP BY ALL),
g AS (SELECT r, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
             list_sort(list(DISTINCT label) FILTER (base)) AS b, list_sort(list(DISTINCT label) FILTER (base OR cover >= {MIN_COVERAGE})) AS l,
             greatest(coalesce(max(cover) FILTER (NOT base), 0), CASE WHEN bool_or(base) THEN {NAME_SCORE} ELSE 0 END) AS score FROM c GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(b, ','), '') AS base_labels, coalesce(array_to_string(l, ','), '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN g USING (r)"""
