"""A table's own columns beside an operator's.

A row's columns travel in one struct, ``row``, so no name of theirs meets a
name that an operator uses, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def rest(df: DataFrame, replaced: Iterable[str] = ()) -> list[str]:
    """Names of the columns but those that an operator's result replaces."""
    gone = {r.lower() for r in replaced}
    return [c for c in df.columns if c.lower() not in gone]


def packed(df: DataFrame, replaced: Iterable[str] = ()) -> Column:
    """The columns (but ``replaced``) as the struct ``row``."""
    return F.struct(*map(quoted, rest(df, replaced))).alias("row")


def unpacked(df: DataFrame, *more: Column | str) -> DataFrame:
    """The columns of ``row``, then ``more``."""
    fields = [F.col("row").getField(f.name).alias(f.name) for f in df.schema["row"].dataType]
    return df.select(*fields, *more)
