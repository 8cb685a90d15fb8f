"""Live counters of a record stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import decode_value, utf16_length


def observed(records: DataFrame, name: str = "landing") -> DataFrame:
    """Messages and chars (UTF-16 units, a line break each) of every
    micro-batch via ``observe``; read them from
    ``query.lastProgress['observedMetrics']``.  A feed's own counters come
    with its manifest (``reload.feed_counters``)."""
    chars = utf16_length(F.coalesce(decode_value("value"), F.lit(""))) + 1
    return records.observe(name, F.count(F.lit(1)).alias("messages"), F.sum(chars).alias("chars"))
