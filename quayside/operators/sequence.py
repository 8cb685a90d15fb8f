"""Exact ``row_number()`` without putting a whole key into one task.

A window ``partitionBy(key).orderBy(o)`` sends every row of a key to one
task; with one hot key that task gets a third of the data.  Here the order
column is cut into chunks of at most ``chunk`` units:

1. count rows per (key, chunk)                      - partial aggregate
2. prefix-sum the counts over chunks per key        - small table
3. row_number inside (key, chunk) + the prefix      - bounded windows

The big side is shuffled once, on (key, chunk), which both the join with
the prefix table and the inner window reuse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK = 1 << 20


def chunked_row_number(df: DataFrame, keys: list[str], order: list[str],
                       chunk_of: Column, out: str = "rn") -> DataFrame:
    """Add ``out`` = row_number() over (partition by keys order by order),
    1-based. ``chunk_of`` must be monotone in the first order column."""
    d = df.withColumn("_chunk", chunk_of)
    counts = d.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*keys, "_chunk",
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    return (d.join(base, [*keys, "_chunk"])
            .withColumn(out, (F.col("_base") + F.row_number().over(inner)).cast("bigint"))
            .drop("_chunk", "_base"))


def offset_chunk(col: str = "offset", chunk: int = DEFAULT_CHUNK) -> Column:
    return F.floor(F.col(col) / F.lit(chunk))


def sized_chunk(df: DataFrame, order: str, rows: int = DEFAULT_CHUNK) -> Column:
    """Chunks of an integer column that hold ``rows`` rows on average: their
    number follows the row count, however sparse the values are."""
    lo, hi, n = df.agg(F.min(order), F.max(order), F.count(order)).first()
    width = max(1, -(-(int(hi) - int(lo) + 1) * rows // n)) if n else 1
    return F.floor((F.col(order).cast("decimal(20,0)") - F.lit(int(lo or 0))) / F.lit(width)).cast("bigint")
