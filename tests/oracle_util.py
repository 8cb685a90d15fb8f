"""Order-insensitive compare of a Spark result with DuckDB SQL."""

import hashlib

import duckdb
import pandas as pd

from quayside.sources.tables import TABLES


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
        return "∅"
    if isinstance(v, float):
        # a nullable integer column is float on one side and Int64 on the other
        return str(int(v)) if abs(v) < 2**53 and v == int(v) else repr(round(v, 6))
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows(df: pd.DataFrame) -> list[str]:
    cols = sorted(df.columns)
    return sorted("|".join(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None))


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def digest(df: pd.DataFrame) -> str:
    return hashlib.sha256("\n".join(rows(df)).encode()).hexdigest()
