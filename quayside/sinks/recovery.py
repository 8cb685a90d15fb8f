"""Recovery: what lies in a landing's folders against what its manifests say.

A writer that is killed leaves staged files, or whole files that no manifest
names; a folder that lost files leaves manifest rows without one.  The folders
are listed by tasks, one level a round, and reconciled with the manifest by a
full outer join on the path.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.sizing import sized
from .raw import _fs

LISTING = "path string, is_dir boolean, size bigint, modified timestamp"
#: Status of a path.
LANDED, CHANGED, MISSING, ORPHAN, STAGED = "landed", "changed", "missing", "orphan", "staged"


def plain(root: str) -> str:
    """A folder as manifests name it."""
    return _fs(root)[1].rstrip("/")


def listing(spark: SparkSession, root: str) -> DataFrame:
    """path, size, modified of all files below ``root``.

    A round lists the folders that the round before found, dealt over all
    tasks; folders are never collected.  Folders that begin with ``_`` or
    ``.`` (manifests, logs) are not entered."""
    def read(batches):
        import pyarrow as pa
        import pyarrow.fs as pafs

        for b in batches:
            for folder in b.column("path").to_pylist():
                fs, at = _fs(root)
                found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
                stamps = [f.mtime if f.mtime is None or f.mtime.tzinfo else f.mtime.replace(tzinfo=dt.timezone.utc) for f in found]
                yield pa.RecordBatch.from_pydict({
                    "path": pa.array([f.path for f in found], pa.string()), "is_dir": pa.array([f.type == pafs.FileType.Directory for f in found], pa.bool_()),
                    "size": pa.array([f.size for f in found], pa.int64()), "modified": pa.array(stamps, pa.timestamp("us", tz="UTC"))})

    name = F.regexp_extract("path", "([^/]*)$", 1)
    folders, found = spark.createDataFrame([(plain(root),)], "path string"), []
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while folders is not None:
        level = sized(folders.repartition(tasks).mapInArrow(read, LISTING), "listing")
        found.append(level.filter("NOT is_dir").drop("is_dir"))
        below = level.filter(F.col("is_dir") & ~name.rlike("^[_.]")).select("path")
        folders = None if below.isEmpty() else below
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def reconcile(manifest: DataFrame, root: str) -> DataFrame:
    """path, status, feed_id, n_records, size, modified of every file that
    lies below ``root`` or that ``manifest`` names.

    ``staged``: the hidden file of a writer; ``orphan``: a whole file that no
    manifest names; ``changed``: its size isn't the manifest's; ``missing``:
    there is no such file.  A manifest that names a file twice has it once."""
    spark = manifest.sparkSession
    name = F.regexp_extract("path", "([^/]*)$", 1)
    there = listing(spark, root).withColumn("_staged", name.rlike(r"^_.*\.tmp$")).filter(F.col("_staged") | ~name.rlike("^[_.]"))
    known = manifest.groupBy("path").agg(F.max("file_bytes").alias("file_bytes"), F.max("feed_id").alias("feed_id"), F.max("n_records").alias("n_records"))
    both = there.join(known.withColumn("_known", F.lit(True)), "path", "full_outer")
    status = (F.when(F.col("modified").isNull() & F.col("size").isNull(), MISSING).when(F.col("_known") & F.col("file_bytes").isNotNull() & (F.col("size") != F.col("file_bytes")), CHANGED)
              .when(F.col("_known"), LANDED).when(F.col("_staged"), STAGED).otherwise(ORPHAN))
    return both.select("path", status.alias("status"), "feed_id", "n_records", "size", "modified")


def delete_files(paths: DataFrame) -> DataFrame:
    """Delete the files (column path), by tasks; path, removed (false: there
    was none)."""
    def delete(batches):
        import pyarrow as pa
        import pyarrow.fs as pafs

        for b in batches:
            done = []
            for path in b.column("path").to_pylist():
                fs, at = _fs(path)
                there = fs.get_file_info(at).type == pafs.FileType.File
                if there:
                    fs.delete_file(at)
                done.append(there)
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(done, pa.bool_())], ["path", "removed"])

    tasks = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sized(paths.select("path").repartition(tasks).mapInArrow(delete, "path string, removed boolean"), "deleted")


def sweep(manifest: DataFrame, root: str, older_than_seconds: float = 3600, delete: bool = True) -> DataFrame:
    """Reconcile and delete staged files and orphans that were last written
    more than ``older_than_seconds`` ago (a running writer's are younger);
    returns ``reconcile``'s rows with ``removed``.  A sweep that is repeated
    finds nothing more to delete."""
    edge = dt.datetime.fromtimestamp(time.time() - older_than_seconds, dt.timezone.utc)
    found = sized(reconcile(manifest, root), "reconciled")
    if not delete:
        return found.withColumn("removed", F.lit(False))
    stale = found.filter(F.col("status").isin(STAGED, ORPHAN) & (F.col("modified") <= F.lit(edge)))
    return found.join(delete_files(stale.select("path")), "path", "left").withColumn("removed", F.coalesce("removed", F.lit(False)))
