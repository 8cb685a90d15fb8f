"""Greedy rolls of any bucket on all tasks.

A greedy roll starts a new file at the first row whose place ``x`` is at least
``limit`` past the place where the open file began, and so on from there.
``x`` is the time of a row (roll by interval) or the bytes before it in its
bucket (roll by size).  Which row starts the next file depends on all files
before, so one pass over a bucket is sequential; here it isn't made:

1. Rows are cut by ranges of (bucket, order), so a large bucket lies in many
   parts.  Only the first and the last bucket of a part go on in others.
2. For these, a part gives its *transfer table*: for each place where the file
   that is open at its beginning may close, the number of files begun in the
   part and the place where the last of them began.  "Next start" of every row
   is one binary search, the chain to the part's end is pointer doubling.  Only
   rows within the first ``limit`` can be such a place, and neighbours with the
   same result are one entry.
3. The tables of a bucket are composed, ``FAN`` parts at a time, then groups
   of parts, until one group is left; on the way back each part learns the
   file that is open at its beginning.
4. Every part then rolls its rows from there on: one pass in constant memory.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.sizing import sized

FAN = 64
TABLE = ["_upto", "_rolls", "_anchor"]


# --------------------------------------------------------------- transfer tables

def transfer(x: np.ndarray, limit: int) -> np.ndarray:
    """[entries, 3] of ascending places: for a file that must close at place v
    the first entry with upto >= v holds; without one the file stays open."""
    n = len(x)
    after = np.searchsorted(x, x + limit)
    jump, rolls = np.where(after < n, after, np.arange(n)), (after < n).astype(np.int64)
    while True:
        further = jump[jump]
        if (further == jump).all():
            break
        rolls, jump = rolls + rolls[jump], further
    reach = int(np.searchsorted(x, x[0] + limit)) + 1     # an open file began at x[0] at the latest
    return _thinned(np.column_stack([x, 1 + rolls, x[jump]])[:reach])


def _thinned(table: np.ndarray) -> np.ndarray:
    """Without entries whose result is the next one's."""
    same = (table[1:, 1:] == table[:-1, 1:]).all(axis=1)
    return table[np.append(~same, True)]


def through(table: np.ndarray, rolls: np.ndarray, anchor: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Files open at ``anchor`` after a part: (rolls, anchor)."""
    at = np.searchsorted(table[:, 0], anchor + limit)
    hit = at < len(table)
    rolls, anchor = rolls.copy(), anchor.copy()
    rolls[hit] += table[at[hit], 1]
    anchor[hit] = table[at[hit], 2]
    return rolls, anchor


def composed(tables: list[np.ndarray], first: int, limit: int) -> np.ndarray:
    """One table of consecutive parts, the first of which begins at ``first``."""
    whole = tables[0]
    for t in tables[1:]:
        rolls, anchor = through(t, whole[:, 1], whole[:, 2], limit)
        # Files that stay open in all parts before close here: the entries beyond.
        beyond = t[t[:, 0] > whole[-1, 0]] if whole[-1, 0] < first + limit else t[:0]
        whole = _thinned(np.concatenate([np.column_stack([whole[:, 0], rolls, anchor]), beyond]))
    return whole


# ------------------------------------------------------------------- kernels

def _key_runs(batch, keys: list[str]):
    """(key, from, to) of the runs of equal keys of an Arrow batch."""
    import pyarrow.compute as pc

    n = batch.num_rows
    change = np.zeros(n, dtype=bool)
    change[:1] = True
    cols = [batch.column(k) for k in keys]
    for c in cols:
        a, z = c.slice(1), c.slice(0, n - 1)
        neq = pc.or_kleene(pc.not_equal(a, z), pc.xor(pc.is_null(a), pc.is_null(z)))
        change[1:] |= np.asarray(pc.fill_null(neq, False).to_numpy(zero_copy_only=False), dtype=bool)
    starts = np.flatnonzero(change).tolist()
    for s, e in zip(starts, starts[1:] + [n]):
        yield tuple(c[s].as_py() for c in cols), s, e


def _measure(batch, name: str) -> np.ndarray:
    import pyarrow as pa
    import pyarrow.compute as pc

    return pc.fill_null(batch.column(name).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)


def _tables_kernel(keys: list[str], kind: str, limit: int, measure: str, arrow):
    """The transfer tables of the first and the last bucket of each part."""
    def places(parts: list[np.ndarray]) -> tuple[np.ndarray, int]:
        m = np.concatenate(parts)
        return (m, 0) if kind == "interval" else (np.cumsum(m) - m, int(m.sum()))

    def table(key, values):
        import pyarrow as pa

        x, total = places(values)
        t = transfer(x, limit)
        row = dict(zip(keys, key)) | {"_first": int(x[0]), "_total": total}
        fixed = [pa.array([row[f.name]] * len(t), f.type) for f in arrow if f.name not in TABLE]
        return pa.RecordBatch.from_arrays(fixed + [pa.array(np.ascontiguousarray(t[:, i])) for i in range(3)], schema=arrow)

    def run(batches):
        part = key = None
        held: list[np.ndarray] = []
        is_first = True
        for b in batches:
            m = _measure(b, measure)
            for k, s, e in _key_runs(b, keys):
                if k != key:
                    if key is not None and (is_first or k[-1] != part):
                        yield table(key, held)
                    is_first = k[-1] != part
                    key, part, held = k, k[-1], []
                held.append(m[s:e])
        if key is not None:
            yield table(key, held)
    return run


def _roll_kernel(keys: list[str], kind: str, limit: int, measure: str):
    """Rolls rows in order; a bucket begins with the file that is open before
    the part (``_seq0``, ``_open0``), else with its first row."""
    def run(batches):
        import pyarrow as pa

        cur, seq, fill, anchor = None, 0, 0, 0
        for b in batches:
            n = b.num_rows
            m = _measure(b, measure)
            out = np.empty(n, dtype=np.int64)
            for key, s, e in _key_runs(b, keys) if n else ():
                i = s
                if key != cur:
                    cur, before = key, b.column("_seq0")[s].as_py()
                    seq, open_ = (before, b.column("_open0")[s].as_py()) if before is not None else (0, None)
                    fill = 0 if open_ is None else -open_
                    anchor = m[s] if open_ is None else open_
                if kind == "size":
                    csum = np.cumsum(m[s:e])
                    while i < e:
                        if fill >= limit:
                            seq, fill = seq + 1, 0
                        prev = csum[i - s - 1] if i > s else 0
                        # first j >= i where fill + csum[j] - prev >= limit
                        j = int(np.searchsorted(csum, limit - fill + prev, side="left")) + s
                        j = max(j, i)
                        if j >= e:
                            out[i:e] = seq
                            fill = fill + int(csum[e - s - 1] - prev)
                            i = e
                        else:
                            out[i:j + 1] = seq
                            fill = fill + int(csum[j - s] - prev)
                            i = j + 1
                else:  # interval, m holds microseconds in order
                    seg = m[s:e]
                    while i < e:
                        if m[i] >= anchor + limit:
                            seq, anchor = seq + 1, m[i]
                        j = int(np.searchsorted(seg, anchor + limit, side="left")) + s
                        j = max(j, i + 1)
                        out[i:j] = seq
                        i = j
            yield b.append_column("roll_seq", pa.array(out, pa.int64()))
    return run


# ---------------------------------------------------------------------- plan

def _groups(tables: DataFrame, limit: int, fan: int) -> DataFrame:
    """The tables of ``fan`` neighbours each as one."""
    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [g[TABLE].to_numpy(np.int64) for _, g in pdf.sort_values(["_node", "_upto"]).groupby("_node")]
        first = int(pdf["_from"].min())
        whole = composed(parts, first, limit)
        return pd.DataFrame({"_bucket": pdf["_bucket"].iloc[0], "_node": pdf["_node"].iloc[0] // fan, "_from": first, **{c: whole[:, i] for i, c in enumerate(TABLE)}})

    return tables.groupBy("_bucket", F.floor(F.col("_node") / fan).alias("_group")).applyInPandas(compose, tables.schema)


def _opened(tables: DataFrame, entries: DataFrame, limit: int, fan: int) -> DataFrame:
    """The file open at the beginning of each node, from those of their groups
    (``entries``: _bucket, _node, _seq, _open)."""
    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        rolls, anchor = pdf["_seq"].to_numpy(np.int64)[:1], pdf["_open"].to_numpy(np.int64)[:1]
        out = []
        for node, g in pdf.sort_values(["_node", "_upto"]).groupby("_node"):
            out.append((pdf["_bucket"].iloc[0], node, int(rolls[0]), int(anchor[0])))
            rolls, anchor = through(g[TABLE].to_numpy(np.int64), rolls, anchor, limit)
        return pd.DataFrame(out, columns=["_bucket", "_node", "_seq", "_open"])

    group = F.floor(F.col("_node") / fan)
    up = entries.select("_bucket", F.col("_node").alias("_group"), "_seq", "_open")
    return (tables.withColumn("_group", group).join(up, ["_bucket", "_group"])
            .groupBy("_bucket", "_group").applyInPandas(walk, "_bucket bigint, _node bigint, _seq bigint, _open bigint"))


def open_files(tables: DataFrame, keys: list[str], kind: str, limit: int, fan: int = FAN) -> DataFrame:
    """(keys, part, _seq0, _open0): the file open at the beginning of each
    part that goes on with a bucket; ``_open0`` is where it began, as the part
    counts.  Parts and buckets that go on in others are the only rows here."""
    key = F.struct(*keys)
    parts = tables.groupBy(*keys, "_part").agg(F.first("_first").alias("_first"), F.first("_total").alias("_total"))
    in_turn = Window.partitionBy(*keys).orderBy("_part")
    parts = parts.withColumns({
        "_base": F.coalesce(F.sum("_total").over(in_turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_node": F.row_number().over(in_turn).cast("bigint") - 1,
        "_parts": F.count(F.lit(1)).over(Window.partitionBy(*keys)),
    }).filter("_parts > 1").withColumn("_bucket", F.min("_part").over(Window.partitionBy(*keys)))
    # (A part begins at most one bucket that goes on in others, so its number names the bucket.)
    # All tables here come from the written transfer tables; only what is composed again is written too.
    same = (F.col("p.key") == F.col("t.key")) & (F.col("p._part") == F.col("t._part"))
    placed = tables.withColumn("key", key).alias("t").join(parts.withColumn("key", key).alias("p"), same).select(
        "p._bucket", "p._node", (F.col("p._first") + F.col("p._base")).alias("_from"), (F.col("t._upto") + F.col("p._base")).alias("_upto"), "t._rolls", (F.col("t._anchor") + F.col("p._base")).alias("_anchor"))
    width = parts.agg(F.max("_node")).first()[0]
    levels = [placed if width is None or width < fan else sized(placed, "transfer")]
    while width is not None and width >= fan:
        levels.append(sized(_groups(levels[-1], limit, fan), "transfer"))
        width //= fan
    entries = parts.filter("_node = 0").select("_bucket", F.lit(0).cast("bigint").alias("_node"), F.lit(0).cast("bigint").alias("_seq"), F.col("_first").cast("bigint").alias("_open"))
    for level in reversed(levels):
        entries = _opened(level, entries, limit, fan)
    return (parts.join(entries, ["_bucket", "_node"]).filter("_node > 0")
            .select(*keys, "_part", F.col("_seq").alias("_seq0"), (F.col("_open") - F.col("_base")).alias("_open0")))


def greedy_roll(df: DataFrame, keys: list[str], order: list[str], measure: str, kind: str, limit: int,
                parts: int | None = None, fan: int = FAN) -> DataFrame:
    """``df`` with ``roll_seq``.  The rows are shuffled by ranges and written
    once to the scratch folder, so that all steps see the same parts; ``parts``
    is their number (by default Spark's, joined by size)."""
    from ..session import ship_package

    if limit < 1:
        raise ValueError("a roll needs a limit of 1 at least")
    ship_package(df.sparkSession)
    by = [*keys, *order]
    cut = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    placed = sized(cut.sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "rolled")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    in_parts = lambda d: d.repartition("_part").sortWithinPartitions("_at")
    part_keys = [*keys, "_part"]
    schema = T.StructType([*(placed.schema[k] for k in part_keys), *(T.StructField(c, T.LongType()) for c in ("_first", "_total", *TABLE))])
    from pyspark.sql.pandas.types import to_arrow_schema

    narrow = in_parts(placed.select(*part_keys, "_at", measure))
    tables = sized(narrow.mapInArrow(_tables_kernel(part_keys, kind, limit, measure, to_arrow_schema(schema)), schema), "tables")
    before = sized(open_files(tables, list(keys), kind, limit, fan), "open").withColumnsRenamed({k: f"_k_{k}" for k in keys})
    # One row a part at most.
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    rows = placed.join(before.withColumnRenamed("_part", "_p"), same, "left").select(*df.columns, "_at", "_part", "_seq0", "_open0")
    schema = T.StructType(rows.schema.fields + [T.StructField("roll_seq", T.LongType(), False)])
    return in_parts(rows).mapInArrow(_roll_kernel(part_keys, kind, limit, measure), schema).drop("_at", "_part", "_seq0", "_open0")
