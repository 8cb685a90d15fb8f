"""The landing sink: all buckets of all feeds in one pass, with a manifest.

Rows arrive sorted by file within a task; a task writes one file at a time
(framed bytes, compressed as the feed asks) under a hidden name and renames
it when it is complete.  Names carry the landing's tag and the task's number,
so a retried task writes the same files again.  What a task returns is the
manifest of its files, taken from the write itself.  Rejected records go to
Parquet files in the dead-letter folder in the same pass.

Input columns: ``FILE_COLUMNS``; a row with a ``reason`` is a rejected record.
"""

from __future__ import annotations

import bz2
import uuid
import zlib

from pyspark.sql import DataFrame

from ..plans.sizing import clustered
from .raw import _fs

FILE_COLUMNS = ["dir", "name", "feed_id", "codec", "extension", "topic", "partition", "offset", "clock", "bucket_start",
                "late", "chars", "data", "reason", "key", "timestamp_type"]
FILE_ORDER = ["dir", "name", "feed_id", "partition", "offset"]

# One row for each landed file.
MANIFEST = ("feed_id bigint, bucket_dir string, bucket_start timestamp, path string, codec string, n_records bigint, n_chars bigint, "
            "n_bytes bigint, file_bytes bigint, first_offset bigint, last_offset bigint, n_late bigint, max_clock timestamp")
# Hadoop's block codecs: bytes of plain text in a block.
BLOCK_BYTES = 64 << 10
PART_BYTES = 1 << 20       # bytes of a landed file that are read at once


class _Gzip:
    """gzip (with header) or zlib (``deflate``) stream."""

    def __init__(self, out, wbits: int):
        self.out, self.z = out, zlib.compressobj(wbits=wbits)

    def write(self, data) -> None:
        self.out.write(self.z.compress(data))

    def finish(self) -> None:
        self.out.write(self.z.flush())


class _Bzip2(_Gzip):
    def __init__(self, out):
        self.out, self.z = out, bz2.BZ2Compressor()


class _Blocks:
    """Blocks of (plain size, packed size, packed bytes), sizes big-endian."""

    def __init__(self, out, name: str):
        import pyarrow as pa

        self.out, self.codec, self.held = out, pa.Codec(name), b""

    def write(self, data) -> None:
        self.held += bytes(data)
        while len(self.held) >= BLOCK_BYTES:
            self._block(self.held[:BLOCK_BYTES])
            self.held = self.held[BLOCK_BYTES:]

    def _block(self, plain: bytes) -> None:
        packed = self.codec.compress(plain, asbytes=True)
        self.out.write(len(plain).to_bytes(4, "big") + len(packed).to_bytes(4, "big") + packed)

    def finish(self) -> None:
        if self.held:
            self._block(self.held)


class _Plain:
    def __init__(self, out):
        self.write = out.write

    def finish(self) -> None:
        pass


def compressor(out, codec: str | None):
    """A writer of a codec's bytes (Spark's names; None: as they are)."""
    make = {None: _Plain, "gzip": lambda o: _Gzip(o, 31), "deflate": lambda o: _Gzip(o, 15), "bzip2": _Bzip2,
            "snappy": lambda o: _Blocks(o, "snappy"), "lz4": lambda o: _Blocks(o, "lz4_raw")}
    return make[codec](out)


def decompressed(data: bytes, codec: str | None) -> bytes:
    """The plain bytes of a landed file."""
    import pyarrow as pa

    if codec is None:
        return data
    if codec in ("gzip", "deflate"):
        return zlib.decompress(data, wbits=31 if codec == "gzip" else 15) if data else b""
    if codec == "bzip2":
        return bz2.decompress(data)
    raw, out, at = pa.Codec({"lz4": "lz4_raw"}.get(codec, codec)), [], 0
    while at < len(data):
        plain, packed = (int.from_bytes(data[at + i:at + i + 4], "big") for i in (0, 4))
        out.append(raw.decompress(data[at + 8:at + 8 + packed], decompressed_size=plain, asbytes=True))
        at += 8 + packed
    return b"".join(out)


def plain_parts(f, codec: str | None, part_bytes: int = PART_BYTES):
    """The plain bytes of an open landed file, a part after the other; none
    is much larger than ``part_bytes``."""
    if codec is None:
        while part := f.read(part_bytes):
            yield part
    elif codec in ("gzip", "deflate", "bzip2"):
        new = bz2.BZ2Decompressor if codec == "bzip2" else lambda: zlib.decompressobj(wbits=31 if codec == "gzip" else 15)
        z = new()
        while data := f.read(part_bytes):
            while data:
                if z.eof:
                    z = new()       # members one after another
                if part := z.decompress(data, part_bytes):
                    yield part
                if z.eof:
                    data = z.unused_data
                elif codec == "bzip2":      # it keeps what it has not unpacked yet
                    while not z.needs_input and not z.eof and (part := z.decompress(b"", part_bytes)):
                        yield part
                    data = z.unused_data if z.eof else b""
                else:
                    data = z.unconsumed_tail
    else:
        while head := f.read(8):
            yield decompressed(head + f.read(int.from_bytes(head[4:], "big")), codec)


class _File:
    """One landed file while it is written."""

    def __init__(self, fs, root: str, first: dict, tag: str, task: int):
        ext = first["extension"] or ""
        folder = f"{root}/{first['dir'].strip('/')}"
        self.fs, self.first, self.final = fs, first, f"{folder}/{first['name']}_{tag}{task:05d}.0{ext}"
        self.staged = f"{folder}/_{first['name']}_{tag}{task:05d}.{uuid.uuid4().hex}{ext}.tmp"     # an attempt's own
        fs.create_dir(folder, recursive=True)
        self.out = fs.open_output_stream(self.staged, compression=None)
        self.packer = compressor(self.out, first["codec"])
        self.n = self.chars = self.bytes = self.late = 0
        self.lo = self.hi = self.clock = None

    def add(self, run) -> None:
        import numpy as np
        import pyarrow.compute as pc

        data = run.column("data")
        width = np.int64 if "large" in str(data.type) else np.int32
        ends = np.frombuffer(data.buffers()[1], width)[data.offset:data.offset + len(data) + 1]
        lo, hi = int(ends[0]), int(ends[-1])
        if hi > lo:
            self.packer.write(data.buffers()[2][lo:hi])
        offsets, clock = pc.min_max(run.column("offset")).as_py(), pc.max(run.column("clock")).as_py()
        self.n += run.num_rows
        self.chars += pc.sum(run.column("chars")).as_py() or 0
        self.bytes += hi - lo
        self.late += pc.sum(run.column("late")).as_py() or 0
        keep = lambda f, *x: f([v for v in x if v is not None], default=None)
        self.lo, self.hi, self.clock = keep(min, self.lo, offsets["min"]), keep(max, self.hi, offsets["max"]), keep(max, self.clock, clock)

    def close(self) -> dict:
        self.packer.finish()
        size = self.out.tell()
        self.out.close()
        self.fs.move(self.staged, self.final)
        return {"feed_id": self.first["feed_id"], "bucket_dir": self.first["dir"], "bucket_start": self.first["bucket_start"],
                "path": self.final, "codec": self.first["codec"], "n_records": self.n, "n_chars": self.chars, "n_bytes": self.bytes, "file_bytes": size,
                "first_offset": self.lo, "last_offset": self.hi, "n_late": self.late, "max_clock": self.clock}


def _dead_rows(run):
    """Rejected records in the record shape, with the reason."""
    import pyarrow as pa

    names = {"key": "key", "value": "data", "topic": "topic", "partition": "partition", "offset": "offset",
             "timestamp": "clock", "timestampType": "timestamp_type", "reason": "reason"}
    return pa.Table.from_arrays([run.column(c) for c in names.values()], list(names))


def write_task(batches, root: str, dead: str, tag: str, task: int):
    """Writes the files of one task; yields their manifest rows, a file's
    when it is complete."""
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    from .raw import _runs

    fs, base = _fs(root)
    now = dead_out = None
    for b in batches:
        bad = b.filter(pc.is_valid(b.column("reason")))
        if bad.num_rows:
            table = _dead_rows(bad)
            if dead_out is None:
                dead_fs, dead_base = _fs(dead)
                dead_fs.create_dir(dead_base, recursive=True)
                dead_final, dead_staged = f"{dead_base}/part-{tag}{task:05d}.parquet", f"{dead_base}/_part-{tag}{task:05d}.{uuid.uuid4().hex}.tmp"
                dead_out = pq.ParquetWriter(dead_staged, table.schema, filesystem=dead_fs)
            dead_out.write_table(table)
        good = b.filter(pc.is_null(b.column("reason")))
        if not good.num_rows:
            continue
        file_key = pc.binary_join_element_wise(good.column("dir"), good.column("name"), good.column("feed_id").cast("string"), "\x00")
        for s, e in _runs(file_key):
            run = good.slice(s, e - s)
            if now is None or now[0] != file_key[s].as_py():
                if now is not None:
                    yield now[1].close()
                first = {c: run.column(c)[0].as_py() for c in ("dir", "name", "feed_id", "codec", "extension", "bucket_start")}
                now = (file_key[s].as_py(), _File(fs, base, first, tag, task))
            now[1].add(run)
    if now is not None:
        yield now[1].close()
    if dead_out is not None:
        dead_out.close()
        dead_fs.move(dead_staged, dead_final)


def clear(root: str) -> None:
    """Empties a folder that a landing is about to write anew."""
    fs, base = _fs(root)
    fs.delete_dir_contents(base, missing_dir_ok=True)


def write_files(rows: DataFrame, root: str, dead: str, manifest: str, tag: str, cluster: str = "rebalance") -> DataFrame:
    """Land ``rows`` (``FILE_COLUMNS``) under ``root``; returns the manifest,
    read from ``manifest``.

    ``cluster="rebalance"`` (batches, history) brings a file's rows together,
    a hot bucket cut over several tasks whose files follow each
    other in that order by their numbers; ``"none"`` (live
    micro-batches) writes where the rows are.  Rows are in order of partition
    and offset inside every file either way."""
    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        for row in write_task(batches, root, dead, tag, TaskContext.get().partitionId()):
            yield pa.RecordBatch.from_pylist([row], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(MANIFEST)
    arrow = to_arrow_schema(schema)     # times in UTC, as the session's
    rows = rows.select(*FILE_COLUMNS)
    if cluster != "none":
        rows = clustered(rows, *FILE_ORDER[:2], order=tuple(FILE_ORDER[2:]))
    rows.sortWithinPartitions(*FILE_ORDER).mapInArrow(write, schema).write.mode("overwrite").parquet(manifest)
    return rows.sparkSession.read.schema(schema).parquet(manifest)


def read_back(manifest: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """path, at, body: the plain bytes of each file of a manifest (columns
    path and codec), in parts of bounded size that begin at byte ``at``; an
    empty file has one empty part."""
    def read(batches):
        import pyarrow as pa

        for b in batches:
            for path, codec in zip(b.column("path").to_pylist(), b.column("codec").to_pylist()):
                fs, name = _fs(path)
                with fs.open_input_stream(name, compression=None) as f:
                    at = 0
                    for body in plain_parts(f, codec, part_bytes):
                        yield pa.RecordBatch.from_pydict({"path": [path], "at": [at], "body": pa.array([body], pa.binary())})
                        at += len(body)
                    if not at:
                        yield pa.RecordBatch.from_pydict({"path": [path], "at": [0], "body": pa.array([b""], pa.binary())})

    return manifest.select("path", "codec").mapInArrow(read, "path string, at bigint, body binary")
