"""Raw concatenation sink: record bytes one after another, no separator.

Spark's text sink refuses an empty line separator, so bytes that want none
land through this Python data source (batch and stream).  Rows arrive as
Arrow batches sorted by bucket; a task keeps one file open, under a hidden
name, and renames it when the bucket changes.  Names carry the write's tag and
the task's partition, so a retried task or a replayed micro-batch writes the
same names again; ``abort`` removes the tag's files, and an overwrite ends by
removing all files of other tags.

Input columns: ``bucket`` (relative folder) and ``data`` (binary).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter,
                                    WriterCommitMessage)

FORMAT = "quayside_raw"


@dataclass
class _Files(WriterCommitMessage):
    paths: list = field(default_factory=list)
    n_records: int = 0
    n_bytes: int = 0


def _fs(root: str):
    import pyarrow.fs as pafs

    if "://" not in root:
        root = "file://" + root if root.startswith("/") else root
    if root.startswith("file:") and not root.startswith("file://"):
        root = "file://" + root[len("file:"):]
    return pafs.FileSystem.from_uri(root)


def _runs(col):
    """Start indexes of runs of equal values in an Arrow array."""
    import numpy as np
    import pyarrow.compute as pc

    n = len(col)
    change = np.zeros(n, dtype=bool)
    if n:
        change[0] = True
        a, z = col.slice(1), col.slice(0, n - 1)
        neq = pc.or_kleene(pc.not_equal(a, z), pc.xor(pc.is_null(a), pc.is_null(z)))
        change[1:] = np.asarray(pc.fill_null(neq, False).to_numpy(zero_copy_only=False), dtype=bool)
    starts = np.flatnonzero(change).tolist()
    return list(zip(starts, starts[1:] + [n]))


def _write_task(root: str, batches, tag: str) -> _Files:
    """Write Arrow batches (sorted by bucket): each run of one bucket is one
    slice of the binary column's value buffer, written with a single call -
    no per-record Python, one open file."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark import TaskContext

    fs, base = _fs(root)
    ctx = TaskContext.get()
    part = ctx.partitionId() if ctx else 0
    msg = _Files()
    now = out = staged = None
    seen: dict[str, int] = {}

    def finish() -> None:
        if out is not None:
            out.close()
            fs.move(staged, msg.paths[-1])

    for b in batches:
        b = b.filter(pc.is_valid(b.column("data")))
        if b.num_rows == 0:
            continue
        buckets, data = b.column("bucket"), b.column("data")
        off_type = np.int64 if pa.types.is_large_binary(data.type) else np.int32
        for s, e in _runs(buckets):
            bucket = buckets[s].as_py() or ""
            if out is None or bucket != now:
                finish()
                now, seen[bucket] = bucket, seen.get(bucket, -1) + 1
                folder, name = f"{base}/{bucket}".rstrip("/"), f"part-{tag}-{part:05d}-{seen[bucket]:03d}"
                fs.create_dir(folder, recursive=True)
                staged = f"{folder}/_{name}.{uuid.uuid4().hex}.tmp"
                out = fs.open_output_stream(staged)
                msg.paths.append(f"{folder}/{name}")
            run = data.slice(s, e - s)
            offs = np.frombuffer(run.buffers()[1], dtype=off_type)[run.offset: run.offset + len(run) + 1]
            lo, hi = int(offs[0]), int(offs[-1])
            if hi > lo:
                out.write(run.buffers()[2][lo:hi])
            msg.n_records += e - s
            msg.n_bytes += hi - lo
    finish()
    return msg


def _files(root: str):
    """(filesystem, paths of all files below root)."""
    import pyarrow.fs as pafs

    fs, base = _fs(root)
    found = fs.get_file_info(pafs.FileSelector(base, allow_not_found=True, recursive=True))
    return fs, [i.path for i in found if i.type == pafs.FileType.File]


def _mine(path: str, tag: str) -> bool:
    return path.rsplit("/", 1)[1].lstrip("_").startswith(f"part-{tag}-")


def _commit(root: str, tag: str, messages) -> None:
    """An overwrite's end: what other writes left goes, and so do files of
    this tag that an earlier, interrupted attempt left."""
    kept = {p for m in messages if m is not None for p in m.paths}
    fs, paths = _files(root)
    for p in paths:
        if p not in kept:
            fs.delete_file(p)


def _abort(root: str, tag: str) -> None:
    fs, paths = _files(root)
    for p in paths:
        if _mine(p, tag):
            fs.delete_file(p)


class _BatchWriter(DataSourceArrowWriter):
    def __init__(self, root: str, tag: str, overwrite: bool):
        self.root, self.tag, self.overwrite = root, tag, overwrite

    def write(self, iterator):
        return _write_task(self.root, iterator, self.tag)

    def commit(self, messages):
        if self.overwrite:
            _commit(self.root, self.tag, messages)

    def abort(self, messages):
        _abort(self.root, self.tag)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, root: str):
        self.root = root

    def write(self, iterator):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        batch = ctx.getLocalProperty("streaming.sql.batchId") if ctx else None
        return _write_task(self.root, iterator, f"b{int(batch or 0):010d}")

    def commit(self, messages, batchId):
        pass    # the tasks have named their files after the batch

    def abort(self, messages, batchId):
        _abort(self.root, f"b{batchId:010d}")


class RawConcatDataSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "bucket string, data binary"

    def writer(self, schema, overwrite):
        tag = self.options.get("tag") or uuid.uuid4().hex[:12]
        return _BatchWriter(self.options["path"], tag, overwrite)

    def streamWriter(self, schema, overwrite):
        return _StreamWriter(self.options["path"])


def register(spark) -> None:
    from ..session import ship_package

    ship_package(spark)
    spark.dataSource.register(RawConcatDataSource)


def write_raw(df, path: str, bucket_col: str = "bucket", data_col: str = "data", tag: str | None = None,
              order: tuple[str, ...] = ("partition", "offset"), mode: str = "append", cluster: str = "rebalance") -> None:
    """Bring a bucket's rows together like the text sink (a hot bucket is cut
    over tasks; ``cluster="none"``: no shuffle) and write them in the order of
    the ``order`` columns that ``df`` has; a bucket's files follow each other
    by their tasks' numbers."""
    from pyspark.sql import functions as F

    from ..plans.sizing import clustered

    register(df.sparkSession)
    by = [c for c in order if c in df.columns]
    d = df.select(F.col(bucket_col).alias("bucket"), F.col(data_col).cast("binary").alias("data"), *by)
    if cluster != "none":
        d = clustered(d, "bucket", order=tuple(by))
    w = d.sortWithinPartitions("bucket", *by).select("bucket", "data").write.format(FORMAT).mode(mode).option("path", path)
    if tag:
        w = w.option("tag", tag)
    w.save()
