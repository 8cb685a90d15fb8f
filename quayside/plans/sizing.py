"""Small sides whose size the optimizer knows.

A config table, per-partition maxima or an assignment grid is computed once
and written to the shared scratch folder.  Read back, it has a file size, so
Catalyst itself decides by bytes (``spark.sql.autoBroadcastJoinThreshold``)
whether to broadcast it; beyond that the join shuffles.  The written table
also ends the lineage: the records behind it are scanned once, and a lost
executor doesn't recompute them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path

# Estimated bytes for each core below which a write counts as small.
SMALL_TASK_BYTES = 64 << 20


def sized(df: DataFrame, name: str = "side") -> DataFrame:
    """``df`` as a written table of known size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clustered(df: DataFrame, *columns: str, order: tuple[str, ...] = ()) -> DataFrame:
    """Rows with equal ``columns`` together, for a write by those columns.

    A large input is rebalanced: tasks are sized by bytes and a hot value is
    cut over several.  With ``order`` it is cut by ranges of those columns, so
    that a value's tasks follow each other in that order.  Rebalancing would put a small one into a single task,
    though its many files cost more than its bytes; it is dealt to all cores.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < cores * SMALL_TASK_BYTES:
        return df.repartition(cores, *columns)
    if order:
        return df.repartitionByRange(*columns, *order)    # neighbours are joined by bytes, if small
    return df.hint("rebalance", *columns)
