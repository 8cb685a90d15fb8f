"""Sets of offsets as ranges: (topic, partition, lo, hi), ends included.

What landed of a partition is a few long ranges, however many records they
hold: their number grows with the gaps.  Records are only numbered inside
bounded blocks, ranges inside slices; windows over a whole partition see its
slices (or, for ``gaps``, its ranges) alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sizing import sized

SCHEMA = "topic string, partition int, lo bigint, hi bigint"
KEYS = ["topic", "partition"]
BLOCK = 1 << 12       # offsets that are matched with the ranges among them at once
SPAN = 1 << 20        # offsets of a slice


def ranges_of(offsets: DataFrame, block: int = BLOCK, span: int = SPAN) -> DataFrame:
    """The ranges that the rows' offsets fill; repeated offsets count once."""
    at = F.floor(F.col("offset") / block).alias("_block")
    one = offsets.select(*KEYS, F.col("offset").cast("bigint").alias("offset")).distinct()
    in_block = Window.partitionBy(*KEYS, "_block").orderBy("offset")
    runs = one.select("*", at).withColumn("_run", F.col("offset") - F.row_number().over(in_block))
    return merged(runs.groupBy(*KEYS, "_block", "_run").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).select(*KEYS, "lo", "hi"), span)


def merged(ranges: DataFrame, span: int = SPAN) -> DataFrame:
    """Ranges that touch or overlap as one: disjoint, in no order.

    A range begins an island if it lies beyond all ranges before it: the
    largest end of earlier slices (a table of slices) and of its own.  Islands
    are numbered by counts of slices and a running count inside."""
    ranges = sized(ranges.select(*KEYS, "lo", "hi").withColumn("_slice", F.floor(F.col("lo") / span)), "ranges")
    by_slice = Window.partitionBy(*KEYS).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    tops = ranges.groupBy(*KEYS, "_slice").agg(F.max("hi").alias("_top"))
    tops = tops.select(*KEYS, "_slice", F.max("_top").over(by_slice).alias("_before"))
    inside = Window.partitionBy(*KEYS, "_slice").orderBy("lo", "hi")
    reach = F.greatest("_before", F.max("hi").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    flagged = ranges.join(tops, [*KEYS, "_slice"]).withColumn("_reach", reach)
    flagged = flagged.withColumn("_new", F.when(F.col("_reach").isNull() | (F.col("lo") > F.col("_reach") + 1), 1).otherwise(0))
    counts = flagged.groupBy(*KEYS, "_slice").agg(F.sum("_new").alias("_count"))
    counts = counts.select(*KEYS, "_slice", F.coalesce(F.sum("_count").over(by_slice), F.lit(0)).alias("_base"))
    island = F.col("_base") + F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (flagged.join(counts, [*KEYS, "_slice"]).withColumn("_island", island)
            .groupBy(*KEYS, "_island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_island"))


def without(records: DataFrame, ranges: DataFrame, block: int = BLOCK) -> DataFrame:
    """The records whose offset lies in none of the (disjoint) ranges.

    Ranges are clipped to the offsets at hand and dealt to the blocks that
    they meet, one row a block, so the join is by equality and a block meets
    only its own ranges."""
    bounds = records.groupBy(*KEYS).agg(F.min("offset").alias("_min"), F.max("offset").alias("_max"))
    near = ranges.join(bounds, KEYS).select(*KEYS, F.greatest("lo", "_min").alias("lo"), F.least("hi", "_max").alias("hi")).filter("lo <= hi")
    blocks = near.select(*KEYS, "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor(F.col("hi") / block))).alias("_block"))
    held = sized(blocks.groupBy(*KEYS, "_block").agg(F.collect_list(F.struct("lo", "hi")).alias("_held")), "held")
    met = F.coalesce(F.exists("_held", lambda r: F.col("offset").between(r["lo"], r["hi"])), F.lit(False))
    return (records.withColumn("_block", F.floor(F.col("offset") / block))
            .join(held, [*KEYS, "_block"], "left").filter(~met).select(*records.columns))


def gaps(ranges: DataFrame) -> DataFrame:
    """topic, partition, lo, hi of what is missing between the ranges."""
    m = merged(ranges)
    before = F.lag("hi").over(Window.partitionBy(*KEYS).orderBy("lo"))
    return m.withColumn("_before", before).filter("_before IS NOT NULL").select(*KEYS, (F.col("_before") + 1).alias("lo"), (F.col("lo") - 1).alias("hi"))
