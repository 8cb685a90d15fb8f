"""URL rules by a sort-merge range join.

A rule is (host, path): it fits its host and every subdomain of it when the
url's path starts with the rule's path.  Canonical key of a host and path:
the host's labels from the top (``org.example``), a separator, the path.  A
url asks with one key for each level of its host (``org``, ``org.example``,
``org.example.blog``), and a rule fits exactly if its key is a prefix of one
of them: the keys that begin with it are one interval of the sorted order,
and intervals of rules nest or are apart.

1. Distinct (host, path) pairs give their level keys; each distinct key is
   swept once, however many pairs share it (all home pages of ``org`` do).
2. Split points over the keys (a sample: they only decide the balance) cut
   the order into slices.  A key goes to its slice; a rule goes to every slice
   that its interval meets.  At a split point only prefixes of that point
   are open, so the copies are the nesting depth, not the number of rules.
3. Each slice is sorted; a sweep keeps a stack of the rules that are open and
   answers a key with the longest of them.
4. Answers go back to the pairs by key, and the longest rule over a pair's
   keys goes back to all rows with that (host, path).

Hot groups: a key or a pair that holds more than a ``slices``-th of its rows is
hot.  There are fewer than ``slices`` of them, whatever the input, so their
answers are broadcast, and their rows stay where they are or are spread.

No rule list is broadcast: both sides may be large.

Nulls and the like: a url that is null or has no ``://`` has an empty host
and path and fits no rule.  Longest means host and path together; ties go to
the longer host, then to the rule first by text (host/path are unique after
duplicates are dropped; of an allow and a block twin the block stays).
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import packed, quoted, unpacked
from .storage import written

ALLOW, BLOCK = "allow", "block"
SAMPLE_KEYS = 20_000       # keys that choose the split points
SLICES = 4                 # slices for each partition, so that partitions come out even
LEVEL_END = "\x01"         # ends the host in a key; below any character of a host
COLUMNS = ["key", "hot", "size", "host_size", "rule", "verdict"]
ANSWER = "key string, hot boolean, size int, host_size int, rule string, verdict string"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to ``/ ? #``, A-Z
    lower-cased; path then up to ``? #``; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.lit(2**31 - 1))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rules_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) tuples as a rule table."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _split_points(keys: DataFrame, n: int, slices: int) -> list[str]:
    if n == 0 or slices < 2:
        return []
    part = min(1.0, SAMPLE_KEYS / n)
    got = sorted(r[0] for r in (keys.sample(part, seed=7) if part < 1 else keys).collect())
    return sorted({got[len(got) * i // slices] for i in range(1, slices)}) if got else []


def _counted(rows: DataFrame, by: list[str], slices: int, name: str) -> tuple[DataFrame, int]:
    """Distinct ``by`` with ``hot`` (whether more than a ``slices``-th of the
    rows have it), written once, and how many there are."""
    counts = written(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), name)
    groups, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return counts.select(*by, (F.col("n") * slices > F.lit(total)).alias("hot")), groups


def _place(points: np.ndarray):
    """Adds ``slices``: one for a key, all that its interval meets for a rule."""
    def place(batches):
        for pdf in batches:
            key = pdf["key"].to_numpy(object)
            low = np.searchsorted(points, key, "right")
            high = np.where(pdf["size"].notna(), np.searchsorted(points, key + "\U0010ffff", "right"), low)
            yield pdf.assign(slices=[list(range(a, b + 1)) for a, b in zip(low, high)])

    return place


def _sweep(batches):
    """Rows sorted by (slice, key, rules first): answers keys from a stack of
    the rules that are open.  Rules open together share their level, so the
    longest is the top."""
    import pandas as pd

    at, stack = None, []
    for pdf in batches:
        found = []
        for s, key, hot, size, host_size, rule, verdict in pdf[["slice", *COLUMNS]].itertuples(index=False, name=None):
            if s != at:
                at, stack = s, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rule is not None:
                stack.append((key, size, host_size, rule, verdict))
            elif stack:
                found.append((key, hot, *stack[-1][1:]))
        yield pd.DataFrame(found, columns=COLUMNS)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url",
               partitions: int | None = None) -> DataFrame:
    """``pages`` with host, path, rule and the rule's verdict (both null
    where no rule fits) put beside its columns; columns of ``pages`` with
    these names are replaced."""
    n = partitions or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    host, path = url_parts(quoted(url).cast("string"))
    pages = pages.select(packed(pages, ["host", "path", "rule", "verdict"]), host.alias("host"), path.alias("path"))

    pairs, _ = _counted(pages.filter("host <> ''"), ["host", "path"], SLICES * n, "url-pairs")
    labels = F.reverse(F.split("host", r"\."))
    levels = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, F.lit(1), k), "."))
    asked = (pairs.select("host", "path", F.explode(levels).alias("level"))
             .select(F.concat("level", F.lit(LEVEL_END), "path").alias("key"), "host", "path"))
    keys, n_keys = _counted(asked, ["key"], SLICES * n, "url-keys")

    lower = F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rules = (rules.select(lower.alias("h"), F.coalesce("path", F.lit("")).alias("p"), "verdict").filter("h <> ''")
             .groupBy("h", "p").agg(F.max("verdict").alias("verdict"))   # block is above allow
             .select(F.concat(F.array_join(F.reverse(F.split("h", r"\.")), "."), F.lit(LEVEL_END), "p").alias("key"),
                     (F.length("h") + F.length("p")).alias("size"), F.length("h").alias("host_size"),
                     F.concat("h", "p").alias("rule"), "verdict"))

    points = np.array(_split_points(keys.select("key"), n_keys, SLICES * n), dtype=object)
    rows = keys.unionByName(rules, allowMissingColumns=True).select(*COLUMNS)
    answers = written(rows.mapInPandas(_place(points), f"{ANSWER}, slices array<int>")
                      .select(F.explode("slices").alias("slice"), *COLUMNS)
                      .repartition(n, "slice").sortWithinPartitions("slice", "key", F.col("rule").isNull())
                      .mapInPandas(_sweep, ANSWER), "url-answers")

    hot_keys = F.broadcast(keys.filter("hot").select("key"))
    fitting = (asked.join(F.broadcast(answers.filter("hot")), "key")
               .unionByName(asked.join(hot_keys, "key", "left_anti").join(answers.filter("not hot"), "key")))
    best = (fitting.groupBy("host", "path").agg(F.max(F.struct("size", "host_size", "rule", "verdict")).alias("best"))
            .select("host", "path", F.struct("best.rule", "best.verdict").alias("best")))

    # Rows of a hot pair take its answer from the broadcast and are spread, where no other answer meets them.
    hot_pairs = pairs.filter("hot").select("host", "path").join(best, ["host", "path"], "left")
    pages = pages.join(F.broadcast(hot_pairs.select("host", "path", F.lit(True).alias("hot"), F.col("best").alias("hot_best"))), ["host", "path"], "left")
    lone = F.col("hot") | (F.col("host") == "")
    pages = pages.withColumn("spread", F.when(lone, 1 + F.pmod(F.monotonically_increasing_id(), F.lit(SLICES * n))).otherwise(0))
    judged = pages.join(best.withColumn("spread", F.lit(0).cast("bigint")), ["host", "path", "spread"], "left")
    judged = judged.withColumn("best", F.coalesce("best", "hot_best"))
    return unpacked(judged, "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
