"""Token-id files: independent zstandard frames, a trailing seek table and a
checksum for each frame, so a reader decompresses only the frames that hold
the documents it wants.

Layout of one shard (the public zstd *seekable format*):

    data frame …            ids of consecutive documents, little-endian uint32
    index frame             doc ids and id counts of the shard's documents
    skippable frame         seek table: (compressed, raw size, checksum) of
                            every frame above, then the footer

A document may span frames; frames are cut by size, so memory is bounded by
one frame however long a document is.  The index frame has the documents'
places, the seek table the frames': together they turn a document into the
frames to fetch.  ``zstd -d`` can read the file too, as skippable frames are
ignored.

Nulls, ties, repeats: a null text is an empty one, every document ends with
``end_id`` (so an empty one has that id alone), null doc_ids come first,
equal doc_ids are ordered by text and stay separate documents.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import committed_file, input_file
from .tokens import encoder

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_IDS = 1 << 18        # ids in a data frame
SHARD_IDS = 1 << 27        # ids after which a task starts another shard
LEVEL = 1
NULL_ID = -(1 << 63)       # stands for a null doc_id inside an index frame

MANIFEST = "part int, shard int, path string, n_docs bigint, n_ids bigint"
ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, path string"


class ShardWriter:
    """Writes one shard to an open stream."""

    def __init__(self, out):
        import zstandard

        self.out, self.zstd = out, zstandard.ZstdCompressor(level=LEVEL)
        self.table: list[tuple[int, int, int]] = []
        self.pending: list[np.ndarray] = []
        self.n_pending = self.n_ids = 0
        self.docs: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(doc_ids.astype("<i8"))
        self.counts.append(counts.astype("<i8"))
        self.n_ids += len(ids)
        self.pending.append(ids.astype("<u4"))
        self.n_pending += len(ids)
        if self.n_pending >= FRAME_IDS:
            every = np.concatenate(self.pending)
            cut = len(every) // FRAME_IDS * FRAME_IDS
            for at in range(0, cut, FRAME_IDS):
                self._frame(every[at:at + FRAME_IDS].tobytes())
            self.pending, self.n_pending = [every[cut:]], len(every) - cut

    def _frame(self, raw: bytes) -> None:
        import xxhash

        packed = self.zstd.compress(raw)
        self.out.write(packed)
        self.table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> tuple[int, int]:
        """Writes index and seek table; (documents, ids)."""
        if self.n_pending:
            self._frame(np.concatenate(self.pending).tobytes())
        docs = np.concatenate(self.docs) if self.docs else np.zeros(0, "<i8")
        counts = np.concatenate(self.counts) if self.counts else np.zeros(0, "<i8")
        self._frame(docs.tobytes() + counts.tobytes())
        entries = np.array(self.table, "<u4").tobytes()
        footer = np.array([len(self.table)], "<u4").tobytes() + bytes([CHECKSUM_FLAG]) + np.array([SEEKABLE_MAGIC], "<u4").tobytes()
        self.out.write(np.array([SKIPPABLE_MAGIC, len(entries) + len(footer)], "<u4").tobytes() + entries + footer)
        return len(docs), self.n_ids


class ShardReader:
    """Reads documents of one shard; fetches and checks only their frames."""

    def __init__(self, f):
        self.f = f
        size = f.size()
        f.seek(size - 9)
        foot = f.read(9)
        if int.from_bytes(foot[5:], "little") != SEEKABLE_MAGIC:
            raise ValueError("no seek table")
        n = int.from_bytes(foot[:4], "little")
        f.seek(size - 9 - 12 * n)
        self.table = np.frombuffer(f.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.packed_at = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        self.raw_at = np.concatenate([[0], np.cumsum(self.table[:-1, 1])])
        index = np.frombuffer(self.frame(n - 1), "<i8")
        self.doc_ids, self.counts = index[:len(index) // 2], index[len(index) // 2:]
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def frame(self, k: int) -> bytes:
        import xxhash
        import zstandard

        packed, raw, check = self.table[k]
        self.f.seek(int(self.packed_at[k]))
        data = zstandard.ZstdDecompressor().decompress(self.f.read(int(packed)), max_output_size=int(raw))
        if len(data) != raw or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k}: checksum differs")
        return data

    def documents(self, rows=None):
        """(row, ids) of the wanted rows (ascending; all by default).  Frames
        are decompressed once, and let go when their last document is out."""
        held: dict[int, bytes] = {}
        for i in range(len(self.doc_ids)) if rows is None else rows:
            lo, hi = 4 * int(self.first[i]), 4 * int(self.first[i + 1])
            k = int(np.searchsorted(self.raw_at, lo, "right")) - 1
            parts = []
            while lo < hi:
                if k not in held:
                    held = {j: x for j, x in held.items() if j >= k}
                    held[k] = self.frame(k)
                at = lo - int(self.raw_at[k])
                part = held[k][at:at + hi - lo]
                parts.append(part)
                lo += len(part)
                k += 1
            yield i, b"".join(parts)


def write_token_files(docs: DataFrame, out: str, tokenizer: str, end_id: int = 1,
                      partitions: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into shards
    under ``out``; returns the manifest, one row per shard, in the shards'
    order, with the ids before each (``start``)."""
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = (rows.repartitionByRange(n, "doc_id", F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text"), "text"))

    def write(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        part, shard = TaskContext.get().partitionId(), 0
        enc, end = encoder(tokenizer), np.array([end_id], np.uint32)

        def written(batches):
            """Writes one shard; (path, documents, ids), None at the end."""
            batch = next(batches, None)
            if batch is None:
                return None
            path = f"{out}/part-{part:06d}-{shard:04d}.tids"
            with committed_file(path) as f:
                w = ShardWriter(f)
                while batch is not None:
                    ids = pc.fill_null(batch.column("doc_id"), NULL_ID).to_numpy(zero_copy_only=False)
                    for a, b, lens, got in enc.blocks(batch.column("text")):
                        ends = np.cumsum(lens)
                        w.add(ids[a:b], lens + 1, np.insert(enc.ids(got), ends, np.repeat(end, b - a)))
                    if w.n_ids >= SHARD_IDS:
                        break
                    batch = next(batches, None)
                return path, *w.close()

        batches = (b for b in batches if b.num_rows)
        while done := written(batches):
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "path": [done[0]], "n_docs": [done[1]], "n_ids": [done[2]]})
            shard += 1

    ordered.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{out}/_manifest")
    return manifest(spark, out)


def manifest(spark: SparkSession, out: str) -> DataFrame:
    """The shards of a written folder; one row per shard, so the running
    total over them is a window over metadata."""
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return (spark.read.schema(MANIFEST).parquet(f"{out}/_manifest")
            .withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))))


def read_token_files(shards: DataFrame, partitions: int | None = None) -> DataFrame:
    """Every document of the shards from the files: doc_id, start, n_tokens,
    ids_crc32 (over the ids as little-endian uint32), path."""
    n = partitions or int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                with input_file(path) as f:
                    r = ShardReader(f)
                    crc = np.fromiter((zlib.crc32(raw) for _, raw in r.documents()), np.int64, len(r.doc_ids))
                    for a in range(0, len(crc), 1 << 16):
                        s = slice(a, a + (1 << 16))
                        ids = r.doc_ids[s]
                        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64(), mask=ids == NULL_ID), "start": start + r.first[:-1][s], "n_tokens": r.counts[s], "ids_crc32": crc[s], "path": [path] * len(ids)})

    return shards.select("path", "start").repartition(n).mapInArrow(read, ROWS)


def fetch_documents(shards: DataFrame, doc_ids: list[int]) -> DataFrame:
    """The ids of the asked documents only: doc_id, ids array<bigint>.  Each
    task reads its shard's index, picks the rows and decompresses just the
    frames that hold them."""
    want = np.array(sorted(set(doc_ids)), np.int64)

    def fetch(batches):
        import pyarrow as pa

        for batch in batches:
            for path in batch.column("path").to_pylist():
                with input_file(path) as f:
                    r = ShardReader(f)
                    for i, raw in r.documents(np.flatnonzero(np.isin(r.doc_ids, want))):
                        ids = pa.array([np.frombuffer(raw, "<u4").astype(np.int64)], pa.list_(pa.int64()))
                        yield pa.RecordBatch.from_pydict({"doc_id": [int(r.doc_ids[i])], "ids": ids})

    return shards.select("path").mapInArrow(fetch, "doc_id bigint, ids array<bigint>")
