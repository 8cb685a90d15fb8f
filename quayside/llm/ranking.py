"""Exact places of the rows of a table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import written


def numbered(rows: DataFrame, *order, out: str = "rank") -> DataFrame:
    """``rows`` (a written table) with their places from 1 on in ``order``:
    range partitions, numbered inside, after the rows of those before.  Equal
    rows are dealt by their place in the table, so none fill one task."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    dealt = salted.repartitionByRange(n, *order, "_salt").sortWithinPartitions(*order, "_salt").withColumn("_at", F.monotonically_increasing_id())
    dealt = written(dealt.drop("_salt"), "ordered")
    part = F.shiftright("_at", 33)
    sizes = dealt.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))     # a row a partition
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return dealt.join(before, part == F.col("_part")).withColumn(out, place.cast("bigint")).drop("_at", "_part", "_before")
