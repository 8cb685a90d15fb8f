"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard.

1. **Sets and signatures**, one pass over whole texts.  A document's set is its
   distinct 5-word shingles.  Two permutations of the 32-bit ring make all
   coordinates: ``h_k = min over the set of second(first(x) + k)``; the second
   is one permutation, shifted by k round the ring (C-MinHash).
2. **Equal sets collapse** to one node (key: a 128-bit digest of the set), so
   a group of exact copies, however large, is one node from here on.
3. **Banding.**  ``BANDS`` bands of ``ROWS`` coordinates; a pair with Jaccard
   0.75 shares no band with probability (1 - 0.75^ROWS)^BANDS = 5e-6.
4. **Exact Jaccard on full sets** decides every link.  In a bucket all members
   are first compared with one centre: the member that shares most buckets
   with most others, in a group of edited copies the text they come from.
   While a bucket still holds more than one component, members of different
   components are compared: more and more members (256, 65536 …
   in expectation, until all) serve as probes against the bucket's other
   components.  Members that remain apart must be compared with all others of
   their bucket, and no bucket is capped; but a sketch of the set (a bit for
   each shingle's hash class) bounds the similarity from above, and pairs that
   the bound rules out are never made.
5. **Components** of the verified links; the smallest doc_id names each.

Nulls and the like: texts without words have an empty set, are linked with
nothing and are their own component.  Rows with equal doc_id are told apart
by their sets.  A null doc_id counts as larger than any; a component of null
doc_ids alone has a null id and its rows are all kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import packed, unpacked
from .components import connected_components
from .storage import written
from .wordhash import BLANKS, blocks, hash_words, mix, shingles

SHINGLE = 5
BANDS, ROWS = 32, 4
PERCENT = 75
CHUNK = 1 << 16            # shingles whose coordinates are made at once
PROBES, GROWTH = 256, 256  # probes of a bucket in the first round, and of a round to those of the one before
TILE = 4096                # members of a bucket that meet its probes in one task
SKETCH_BITS = 2048
LONGS = SKETCH_BITS // 64


def permuted(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A bijection of the 32-bit ring, in place."""
    t = x >> np.uint32(16)
    x ^= t
    x *= np.uint32(a)
    np.right_shift(x, np.uint32(15), out=t)
    x ^= t
    x *= np.uint32(b)
    np.right_shift(x, np.uint32(16), out=t)
    x ^= t
    return x


def signatures(sets: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash of the non-empty sets ``first[i]:first[i + 1]``."""
    out = np.empty((len(first) - 1, size), np.uint32)
    at = 0
    while at < len(out):
        to = max(at + 1, int(np.searchsorted(first, first[at] + CHUNK, "right")) - 1)
        placed = permuted((sets[first[at]:first[to]] >> np.uint64(32)).astype(np.uint32), 0x7FEB352D, 0x846CA68B)
        starts = first[at:to] - first[at]
        for k in range(size):
            out[at:to, k] = np.minimum.reduceat(permuted(placed + np.uint32(k), 0x21F0AAAD, 0x735A2D97), starts)
        at = to
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band (the band's number is part of it)."""
    rows = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), rows.shape[:2]).copy()
    for r in range(ROWS):
        key = mix(key + rows[:, :, r])
    return key.view(np.int64)


def shingle_sets(texts) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles of each text, ascending; first of each text)."""
    every, first = shingles(hash_words(texts, BLANKS), SHINGLE)
    sets = [np.unique(every[a:b]) for a, b in zip(first[:-1], first[1:])]
    return (np.concatenate(sets) if sets else every), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def node_keys(sets: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """128-bit digest of each set, null for an empty one."""
    sums = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets ^ np.uint64(salt)), dtype=np.uint64)])
        sums.append(mix(upto[first[1:]] - upto[first[:-1]] + np.diff(first).astype(np.uint64)))
    raw = np.stack(sums, axis=1).tobytes()
    return [raw[16 * i:16 * i + 16] if first[i + 1] > first[i] else None for i in range(len(first) - 1)]


def _sign(batches):
    import pyarrow as pa

    for batch in batches:
        for a, b in blocks(batch.column("text")):
            rows = batch.slice(a, b - a)
            sets, first = shingle_sets(rows.column("text"))
            full = np.flatnonzero(np.diff(first))
            keys = band_keys(signatures(sets, np.append(first[full], first[-1]), BANDS * ROWS))
            bands: list = [None] * (b - a)
            for i, k in zip(full, keys):
                bands[i] = k
            yield pa.RecordBatch.from_pydict({
                "doc_id": rows.column("doc_id"), "text_hash": rows.column("text_hash"), "n": np.diff(first), "node": pa.array(node_keys(sets, first), pa.binary()),
                "bands": pa.array(bands, pa.list_(pa.int64()))})


def sketches(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of bits for each set: which of the hash classes it has shingles in."""
    bits = np.zeros((len(first) - 1, SKETCH_BITS), bool)
    bits[np.repeat(np.arange(len(bits)), np.diff(first)), (sets % np.uint64(SKETCH_BITS)).astype(np.int64)] = True
    return np.packbits(bits, axis=1).view(np.int64)


def _sets(batches):
    import pyarrow as pa

    for batch in batches:
        for a, b in blocks(batch.column("text")):
            rows = batch.slice(a, b - a)
            sets, first = shingle_sets(rows.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(sets.view(np.int64)))
            classes = pa.array(list(sketches(sets, first)), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column("node"), pa.array(node_keys(sets, first), pa.binary()), lists, classes], ["node", "found", "hashes", "sketch"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose full sets have the Jaccard similarity asked for."""
    left = sets.select(F.col("node").alias("u"), F.col("hashes").alias("hu"))
    right = sets.select(F.col("node").alias("v"), F.col("hashes").alias("hv"))
    both = F.size(F.array_intersect("hu", "hv"))
    return (pairs.select("u", "v").join(left, "u").join(right, "v")
            .filter(100 * both >= PERCENT * (F.size("hu") + F.size("hv") - both)).select("u", "v"))


def _alike_in_size(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _possible(a: list[Column], na: Column, b: list[Column], nb: Column) -> Column:
    """Whether the sketches (as longs) allow the similarity: a class of A
    without shingles of B holds a shingle of A alone.  Plain columns, so the
    test is compiled into the join."""
    terms = [F.bit_count(x.bitwiseAND(F.bitwise_not(y))) for x, y in zip(a, b)]
    while len(terms) > 1:
        terms = [sum(terms[i + 1:i + 2], terms[i]) for i in range(0, len(terms), 2)]
    both = F.least(na - terms[0], nb)
    return 100 * both >= PERCENT * (na + nb - both)


def _links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links that connect every two alike members of a bucket;
    members: band, node, n, size."""
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    centres = members.join(weight, "node").groupBy("band").agg(F.max(F.struct("weight", "node", "n")).alias("c"))
    stars = (members.join(centres, "band").filter("node <> c.node").filter(_alike_in_size(F.col("n"), F.col("c.n")))
             .select(F.col("node").alias("u"), F.col("c.node").alias("v")).distinct())
    links = written(_verified(stars, sets), "stars")
    # Place of a node among the probes: the same in all rounds, from 0 to 1.
    place = F.pmod(F.xxhash64("node"), F.lit(1 << 40)) / float(1 << 40)
    wide = members.filter("size > 2").withColumn("place", place)
    before, now, since = 0.0, float(PROBES), None
    while True:
        # Components only spare work, so they are made anew when many links have come.
        if since is None or 20 * since > apart_now:
            component = connected_components(links, "u", "v")
            own = wide.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
            open_ = own.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("band")
            own = written(own.join(open_, "band", "left_semi"), "open")
            largest, apart_now = own.agg(F.max("size"), F.count(F.lit(1))).first()
            wide, since = own.drop("component"), 0
            longs = [F.coalesce(F.get("sketch", F.lit(i)), F.lit(0)).alias(f"s{i}") for i in range(LONGS)]
            tiles = F.ceil(F.col("size") / TILE)
            seen = written(own.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("node"), tiles)).join(sets.select("node", *longs), "node"), "seen")
        if (largest or 0) <= before:
            return links
        asks, asked = F.lit(now) / F.col("size"), F.lit(before) / F.col("size")
        probes = (seen.filter((F.col("place") < asks) & (F.col("place") >= asked))
                  .select("band", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)).alias("tile"), F.col("node").alias("u"),
                          F.col("n").alias("nu"), F.col("component").alias("cu"), *[F.col(f"s{i}").alias(f"u{i}") for i in range(LONGS)]))
        # Earlier probes have met every other member, and of two new probes one asks.
        met = (F.col("place") < asked) | ((F.col("place") < asks) & (F.col("node") <= F.col("u")))
        apart = (F.col("component") != F.col("cu")) & ~met & _alike_in_size(F.col("n"), F.col("nu"))
        sketches_allow = _possible([F.col(f"u{i}") for i in range(LONGS)], F.col("nu"), [F.col(f"s{i}") for i in range(LONGS)], F.col("n"))
        # Tiles bound what meets in a task, so the sides are dealt here and not split again.
        parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        probes, met_by = probes.repartition(parts, "band", "tile"), seen.repartition(parts, "band", "tile")
        same = (probes["band"] == met_by["band"]) & (probes["tile"] == met_by["tile"])
        pairs = probes.join(met_by, same & apart & sketches_allow).select("u", F.col("node").alias("v")).distinct()
        new = written(_verified(pairs, sets), "links")
        links, since = links.unionByName(new), since + new.count()
        before, now = now, now * GROWTH


def texts_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, text: that of the row that stands for each of ``nodes`` (node,
    doc_id, text_hash).  Null and repeated ids are told apart by the text."""
    nodes = nodes.select("node", F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    return rows.join(nodes, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))).select("node", "text")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): doc_id, text_hash (tells
    rows of equal doc_id apart), n_shingles, component (its least node; null
    for an empty set) and component_id."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    signed = written(rows.mapInArrow(_sign, "doc_id bigint, text_hash bigint, n bigint, node binary, bands array<bigint>"), "signed")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    nodes = written(signed.filter("n > 0").groupBy("node").agg(smallest.alias("k"), F.first("n").alias("n"), F.first("bands").alias("bands"))
                     .select("node", "k.doc_id", "k.text_hash", "n", "bands"), "nodes")

    banded = nodes.select(F.explode("bands").alias("band"), "node", "n")
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = written(banded.join(shared, "band"), "members")

    wanted = members.select("node").distinct().join(nodes.select("node", "doc_id", "text_hash"), "node")
    sets = written(texts_of(rows, wanted).mapInArrow(_sets, "node binary, found binary, hashes array<bigint>, sketch array<bigint>")
                    .filter("node = found").drop("found").dropDuplicates(["node"]), "sets")

    component = connected_components(_links(members, sets), "u", "v")
    labelled = nodes.select("node", "doc_id").join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = labelled.select("node", "component").join(names, "component").select("node", "component", "component_id")
    return (signed.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "node").join(named, "node", "left")
            .select("doc_id", "text_hash", "n_shingles", "component",
                    F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay when one of each component
    does: that with the smallest doc_id (then text_hash), once if the row is
    repeated.  Rows with an empty set stay."""
    found = written(near_duplicates(docs), "found")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    kept = (found.filter("n_shingles > 0").groupBy("component").agg(smallest.alias("k")).select("k.doc_id", "k.text_hash")
            .unionByName(found.filter("n_shingles = 0").select("doc_id", "text_hash")))
    rows = docs.select(packed(docs), F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("hash"))

    def matching(keys: DataFrame) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias("id"), "text_hash")
        return rows.join(keys, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash")), "left_semi")

    repeated = found.groupBy(F.col("doc_id").alias("r"), F.col("text_hash").alias("t")).agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    again = F.col("doc_id").eqNullSafe(F.col("r")) & (F.col("text_hash") == F.col("t"))
    if repeated.isEmpty():
        return unpacked(matching(kept))
    once = matching(kept.join(repeated, again, "left_semi")).dropDuplicates(["doc_id", "hash"])
    return unpacked(matching(kept.join(repeated, again, "left_anti")).unionByName(once))
