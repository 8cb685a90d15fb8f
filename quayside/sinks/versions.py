"""Versions of a table of landed files.

Readers of a folder see files come and go while a compaction replaces them;
readers of a version see exactly its files.  The log is append-only: version
N is one small marker file, put in place by a rename that fails when N exists,
so of two writers one publishes N and the other tries N+1.  A marker names a
*delta* (files added and removed, as Parquet); every ``SNAPSHOT_EVERY``
versions a *snapshot* (all files) is written beside it.  Data files are written before they are
published and deleted only by ``expire``, when no kept or pinned version has
them; a crash in between leaves files that no version names
(``recovery.sweep`` finds them) and loses none.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.sizing import sized
from .files import MANIFEST

SNAPSHOT_EVERY = 10
TRIES = 100


class Conflict(Exception):
    """Another writer has removed files that this one wants to remove or to replace."""


class FileTable:
    """The files of a landing (rows of its manifest), by version.

    ``path`` holds the log only; the files lie where their rows say."""

    def __init__(self, spark: SparkSession, path: str, schema: str = MANIFEST):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.columns = spark.createDataFrame([], schema).columns
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------------ log

    def _marker(self, version: int) -> str:
        return f"{self.path}/_versions/{version:020d}.json"

    def _read(self, path: str) -> dict:
        stream = self._fs.open(self._path(path))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _snapshot(self, version: int) -> str | None:
        """The folder of a version's snapshot, if there is a whole one."""
        folder = f"{self.path}/_snapshots/{version:020d}"
        return folder if self._fs.exists(self._path(f"{folder}/_SUCCESS")) else None

    def _write_snapshot(self, version: int) -> None:
        if not self._snapshot(version):
            self.files(version).write.mode("overwrite").parquet(f"{self.path}/_snapshots/{version:020d}")

    def _put(self, path: str, what: dict) -> bool:
        """The file appears whole or, if it exists, not at all."""
        staged = self._path(f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}.tmp")
        out = self._fs.create(staged, False)
        out.write(json.dumps(what).encode())
        out.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(self._fs.makeQualified(staged), self._fs.makeQualified(self._path(path)),
                           gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as e:  # noqa: BLE001 - the JVM's exception class tells
            self._fs.delete(staged, False)
            if "FileAlreadyExistsException" in str(e):
                return False
            raise
        return True

    def versions(self) -> list[int]:
        """Published versions that can still be read, ascending."""
        folder = self._path(f"{self.path}/_versions")
        if not self._fs.exists(folder):
            return []
        return sorted(int(s.getPath().getName()[:-5]) for s in self._fs.listStatus(folder) if s.getPath().getName()[0] not in "._")

    def latest(self) -> int:
        """The newest version; 0 (no files) before the first."""
        return max(self.versions(), default=0)

    def history(self) -> list[dict]:
        return [self._read(self._marker(v)) for v in self.versions()]

    # ---------------------------------------------------------------- reading

    def files(self, version: int | None = None) -> DataFrame:
        """The files of a version (by default the newest)."""
        version = self.latest() if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], self.schema)
        if not self._fs.exists(self._path(self._marker(version))):
            raise ValueError(f"there is no version {version}, or it has expired")
        found, deltas = self.spark.createDataFrame([], self.schema), []
        for v in range(version, 0, -1):     # back to the last snapshot
            if folder := self._snapshot(v):
                found = self.spark.read.schema(self.schema).parquet(folder)
                break
            deltas.insert(0, self._delta(self._read(self._marker(v))["delta"]))
        return self._applied(found, deltas)

    def _delta(self, path: str) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, action string").parquet(path)

    def _applied(self, found: DataFrame, deltas: list[DataFrame]) -> DataFrame:
        """A file belongs to the table when its last action is to add it."""
        if not deltas:
            return found
        every = found.withColumns({"action": F.lit("add"), "_step": F.lit(0)})
        for step, d in enumerate(deltas, 1):
            every = every.unionByName(d.withColumn("_step", F.lit(step)), allowMissingColumns=True)
        row = F.struct(*self.columns, "action")
        last = every.groupBy(F.col("path").alias("_file")).agg(F.max_by(row, "_step").alias("r"))
        return last.filter("r.action = 'add'").select(*[F.col("r").getField(c).alias(c) for c in self.columns])

    # -------------------------------------------------------------- publishing

    def publish(self, adds: DataFrame | None = None, removes: DataFrame | None = None, note: str = "") -> int:
        """A new version: ``adds`` (manifest rows) come, ``removes`` (column
        path) go.  All removed files must be in the version before, else
        ``Conflict`` (another writer replaced them) and nothing changes."""
        none = self.spark.createDataFrame([], self.schema)
        new = (none if adds is None else adds.select(*self.columns)).withColumn("action", F.lit("add"))
        if removes is not None:
            gone = removes.select("path").distinct().withColumn("action", F.lit("remove"))
            new = new.unionByName(gone, allowMissingColumns=True)
        delta = f"{self.path}/_deltas/{uuid.uuid4().hex}"
        new.write.parquet(delta)
        wanted = self._delta(delta)
        for _ in range(TRIES):
            base = self.latest()
            lost = wanted.filter("action = 'remove'").join(self.files(base).select("path"), "path", "left_anti")
            if not lost.isEmpty():
                raise Conflict(f"version {base} lacks files that are to be removed: {lost.first()['path']}")
            self._fs.mkdirs(self._path(f"{self.path}/_versions"))
            if self._put(self._marker(base + 1), {"version": base + 1, "delta": delta, "note": note, "at": time.time()}):
                if (base + 1) % SNAPSHOT_EVERY == 0:
                    self._write_snapshot(base + 1)
                return base + 1
        raise Conflict(f"no version could be published in {TRIES} tries")

    # ------------------------------------------------------- pins and expiry

    def pin(self, reader: str, version: int | None = None, seconds: float = 86_400) -> int:
        """Keep a version for a reader, for so long at most."""
        version = self.latest() if version is None else version
        self.unpin(reader)
        self._fs.mkdirs(self._path(f"{self.path}/_pins"))
        self._put(f"{self.path}/_pins/{reader}.json", {"version": version, "until": time.time() + seconds})
        return version

    def unpin(self, reader: str) -> None:
        self._fs.delete(self._path(f"{self.path}/_pins/{reader}.json"), False)

    def pinned(self) -> set[int]:
        folder = self._path(f"{self.path}/_pins")
        if not self._fs.exists(folder):
            return set()
        pins = [self._read(s.getPath().toString()) for s in self._fs.listStatus(folder) if s.getPath().getName()[0] not in "._"]
        return {p["version"] for p in pins if p["until"] > time.time()}

    def expire(self, keep: int = 2) -> DataFrame:
        """Delete the files that only older versions have; the newest ``keep``
        and the pinned versions stay whole, the others can't be read any more.
        Returns path, removed."""
        from .recovery import delete_files

        every = self.versions()
        if not every:
            return self.spark.createDataFrame([], "path string, removed boolean")
        needed = (set(every[-keep:]) | self.pinned()) & set(every)
        for v in needed:        # they no longer need the versions before them
            self._write_snapshot(v)
        touched = [self._delta(self._read(self._marker(v))["delta"]) for v in every]
        past = [t if v not in needed else t.filter("action = 'remove'") for v, t in zip(every, touched)]
        gone, held = (reduce(DataFrame.unionByName, (f.select("path") for f in frames)).distinct()
                      for frames in (past, [self.files(v) for v in sorted(needed)]))
        deleted = delete_files(gone.join(held, "path", "left_anti"))
        for v in every:
            if v not in needed:
                self._fs.delete(self._path(self._marker(v)), False)
        return deleted


def compact_table(table: FileTable, out_root: str, complete=None, version: int | None = None, part_bytes: int | None = None) -> int | None:
    """Merge the files of each complete bucket (``complete``: a condition on
    the manifest; all by default) part by part (``compaction.in_parts``) and
    publish the result in their place, in one version.  None if no part has
    two files.  Readers of older versions keep the old files until ``expire``."""
    from .compaction import BUCKET, PART_BYTES, compact_files, in_parts

    keys = [*BUCKET, "codec", "part"]
    files = sized(in_parts(table.files(version).filter(F.lit(True) if complete is None else complete), part_bytes or PART_BYTES), "parts")

    def same(a: DataFrame, b: DataFrame):
        return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])

    several = files.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    old = sized(files.join(several, same(files, several), "left_semi").withColumn("complete", F.lit(True)), "merged")
    if old.isEmpty():
        return None
    merged = compact_files(old, f"{out_root.rstrip('/')}/{uuid.uuid4().hex[:12]}")
    sums = old.groupBy(*keys).agg(F.sum("n_chars").alias("n_chars"), F.sum("n_late").alias("n_late"), F.min("first_offset").alias("first_offset"),
                                  F.max("last_offset").alias("last_offset"), F.max("max_clock").alias("max_clock"))
    new = merged.join(sums, same(merged, sums)).select(
        *[merged[c] for c in (*BUCKET, "codec", "path", "n_records", "n_bytes")], "n_chars", "n_late", "first_offset", "last_offset", "max_clock",
        F.lit(None).cast("bigint").alias("file_bytes"))
    return table.publish(new, old.select("path"), note="compaction")
