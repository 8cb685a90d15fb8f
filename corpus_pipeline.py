"""The corpus pipeline: documents to packed training batches.

Language identification drops texts without a language, near-duplicate
removal keeps one document of each group, repeated passages are cut out,
documents that hold benchmark items go, and what is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import decontaminate, langid, minhash, packing, queries, repeats
from quayside.llm.columns import packed, quoted, unpacked
from quayside.session import scratch_path
from quayside.sources.tables import read_table

# A language is a guess when its score hardly exceeds that of a text without evidence, however many languages there are.
ABOVE_GUESS = 1e-6


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are null, have no letter, or hold no evidence for one
    language rather than another.  Without labelled rows to learn from, no language can be rejected:
    only texts without a letter go."""
    queries.prepared(spark)
    model = queries.language_model(docs)
    if not model.langs:
        return docs.filter(F.col("text").cast("string").rlike(r"\p{L}"))
    found = docs.select(packed(docs), langid.language(docs, model).alias("found"))
    known = (F.col("found.lang_pred") != langid.UND) & (F.col("found.score") > model.guess() + ABOVE_GUESS)
    return unpacked(found.filter(known))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    queries.prepared(spark)
    return minhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages out that an earlier document (or the same, earlier on)
    holds; documents of which nothing but blanks is left go."""
    queries.prepared(spark)
    found = repeats.remove_repeats(docs)
    left = found.filter(F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast("bigint"))
    return left.select(*map(quoted, docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    queries.prepared(spark)
    return decontaminate.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of pieces in length buckets."""
    queries.prepared(spark)
    return packing.pack(packing.token_pieces(docs, queries.tokenizer_path()))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", pack_batches),
]
ORACLE_SQL = None     # learned languages, MinHash and a tokenizer; tested against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each stage's rows are written as
    Parquet in the shared folder and reread as the next one's input."""
    queries.prepared(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
