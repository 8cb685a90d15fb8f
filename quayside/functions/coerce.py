"""Null defaults and allowed-value checks for typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ZERO = {
    T.ByteType: 0, T.ShortType: 0, T.IntegerType: 0, T.LongType: 0,
    T.FloatType: 0.0, T.DoubleType: 0.0, T.BooleanType: False,
}


def primitive_default(dtype: T.DataType):
    for t, v in _ZERO.items():
        if isinstance(dtype, t):
            return v
    if isinstance(dtype, T.DecimalType):
        return 0
    return None


def null_defaults(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace nulls in primitive columns with the type's zero value."""
    cols = []
    for f in df.schema.fields:
        z = primitive_default(f.dataType) if (columns is None or f.name in columns) else None
        if z is None:
            cols.append(F.col(f.name))
        else:
            cols.append(F.coalesce(F.col(f.name), F.lit(z).cast(f.dataType)).alias(f.name))
    return df.select(*cols)


def allowed_value(c, allowed: list[str], case_sensitive: bool = True) -> Column:
    """True iff the value is one of ``allowed`` (an enum check)."""
    col = F.col(c) if isinstance(c, str) else c
    if case_sensitive:
        return col.isin(allowed)
    return F.lower(col).isin([a.lower() for a in allowed])


def try_int(c) -> Column:
    """Text -> int, null when it does not parse (never an error)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("int")


def first_failure(checks: list[tuple[Column, str]]) -> Column:
    """Name of the first failed check (a False or null condition), else null."""
    out = F.lit(None).cast("string")
    for ok, name in reversed(checks):
        out = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(out)
    return out
