"""Offsets: commit positions, tail replay and duplicate removal (streams:
``streaming.partials``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.sizing import sized

KEY = ["topic", "partition", "offset"]

def commit_offsets(records: DataFrame) -> DataFrame:
    """Last offset seen per partition and the position to commit (last + 1)."""
    return (records.groupBy("topic", "partition")
            .agg(F.max("offset").alias("last_offset"),
                 (F.max("offset") + 1).alias("commit_offset"),
                 F.count(F.lit(1)).alias("n_records")))


def tail_offsets(records: DataFrame, n: int) -> DataFrame:
    """Keep the last ``n`` offsets of each partition (a negative start
    offset of -n).  The per-partition maximum is Kafka metadata: it is
    computed once, and while it is small the records stay where they are."""
    last = sized(records.groupBy("topic", "partition").agg(F.max("offset").alias("_last")), "tail")
    return (records.join(last, ["topic", "partition"])
            .filter(F.col("offset") >= F.col("_last") + 1 - n)
            .drop("_last"))


def dedup_offsets(records: DataFrame) -> DataFrame:
    """Drop replayed copies: one row per (topic, partition, offset)."""
    return records.dropDuplicates(KEY)
