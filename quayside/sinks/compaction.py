"""Small-file compaction of completed hours, as one distributed job.

``compact_hours`` works on key=value folders, ``compact_files`` on a feed
landing's own folders, through its manifest.

Each task lands its own file per bucket, so an hour may hold many small
files.  Completed hours are rewritten into a new versioned folder: the rows of
an hour come together (a hot hour is cut over several tasks),
and only the selected hours are read (partition pruning on ``d``/``h``).  Readers switch to the new version via the manifest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sizing import clustered


BUCKET = ["feed_id", "bucket_dir", "bucket_start"]
PART_BYTES = 1 << 30       # plain bytes that one merged file holds, roughly


def partition_keys(spark, landed_root: str) -> list[str]:
    """Names of the layout's partition folders, outermost first."""
    return [c for c in spark.read.text(landed_root).columns if c != "value"]


def landed_with_keys(spark, landed_root: str):
    """Landed lines with every partition key of the layout as exact text:
    given as strings, Spark unescapes ``%2F`` and leaves ``05`` alone."""
    keys = partition_keys(spark, landed_root)
    return spark.read.schema(", ".join(["value string", *(f"`{k}` string" for k in keys)])).text(landed_root), keys


def compact_hours(spark, landed_root: str, out_root: str, where: Column | None = None,
                  codec: str | None = None) -> str:
    """Rewrite the landed hours selected by ``where`` (a filter on the
    partition keys, e.g. d/h; all hours when None) into ``out_root``, keeping
    the layout (feed=/topic=/d=/h=...) with about one file per bucket and the
    lines of each old file in their order."""
    src, keys = landed_with_keys(spark, landed_root)
    if where is not None:
        src = src.filter(where)
    # The place of a line: its file, then its place in the reading task, which
    # reads a block of a file from the start to the end.
    placed = src.select("value", *keys, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                        F.monotonically_increasing_id().alias("_line"))
    d = (clustered(placed, *keys, order=("_file", "_block", "_line")).sortWithinPartitions(*keys, "_file", "_block", "_line").select("value", *keys))
    w = d.write.mode("overwrite").partitionBy(*keys)
    if codec:
        w = w.option("compression", codec)
    w.text(out_root)
    return out_root


def complete_before(cutoff_d: str, cutoff_h: str) -> Column:
    """Hours strictly before (cutoff_d, cutoff_h): the completed ones."""
    return (F.col("d") < cutoff_d) | ((F.col("d") == cutoff_d) & (F.col("h") < cutoff_h))


def compact_hour(spark, landed_root: str, d: str, h: str, out_root: str, codec: str | None = None) -> str:
    """One hour only (a filter on the same job)."""
    compact_hours(spark, landed_root, out_root, (F.col("d") == d) & (F.col("h") == h), codec)
    return f"{out_root.rstrip('/')}/d={d}/h={h}"


def in_parts(manifest: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``manifest`` with ``part``: the files of a bucket and codec, in the order
    of batches, fall into parts of about so many plain bytes.  The window over
    a bucket sees its files, a row each."""
    order = ["batch_id", "path"] if "batch_id" in manifest.columns else ["path"]
    in_turn = Window.partitionBy(*BUCKET, "codec").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("part", F.floor(F.coalesce(F.sum("n_bytes").over(in_turn), F.lit(0)) / part_bytes))


def compact_files(manifest: DataFrame, out_root: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Merge the landed files of each complete bucket (``manifest`` of a feed
    landing) under ``out_root``, same folders, codec and order of batches, into
    one file, or one for each ``part_bytes`` of a large bucket (``in_parts``),
    written by a task of its own; returns the new files: feed_id, bucket_dir,
    bucket_start, codec, part, path, n_files, n_records, n_bytes.  A part of
    one file is in memory at a time."""
    keys = [*BUCKET, "codec", "part"]
    schema = ("feed_id bigint, bucket_dir string, bucket_start timestamp, codec string, part bigint, path string, n_files bigint, "
              "n_records bigint, n_bytes bigint")
    if "part" not in manifest.columns:
        manifest = in_parts(manifest.filter("complete"), part_bytes)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    order = ["batch_id", "path"] if "batch_id" in manifest.columns else ["path"]

    def merge(batches):
        import pyarrow as pa

        import uuid

        from .files import compressor, plain_parts
        from .raw import _fs

        fs, base = _fs(out_root)
        now = None

        def finish():
            now["packer"].finish()
            now["out"].close()
            fs.move(now["staged"], now["row"]["path"])
            return pa.RecordBatch.from_pylist([now["row"]], schema=arrow)

        for b in batches:
            for r in b.to_pylist():
                key = tuple(r[k] for k in keys)
                if now is None or now["key"] != key:
                    if now is not None:
                        yield finish()
                    folder, name = f"{base}/{r['bucket_dir'].strip('/')}", r["path"].rsplit("/", 1)[1]
                    fs.create_dir(folder, recursive=True)
                    staged = f"{folder}/_{name}.{uuid.uuid4().hex}.tmp"
                    out = fs.open_output_stream(staged, compression=None)
                    row = {**{k: r[k] for k in keys}, "path": f"{folder}/{name}", "n_files": 0, "n_records": 0, "n_bytes": 0}
                    now = {"key": key, "staged": staged, "out": out, "packer": compressor(out, r["codec"]), "row": row}
                src, path = _fs(r["path"])
                with src.open_input_stream(path, compression=None) as f:
                    for part in plain_parts(f, r["codec"]):
                        now["packer"].write(part)
                for k, n in (("n_files", 1), ("n_records", r["n_records"]), ("n_bytes", r["n_bytes"])):
                    now["row"][k] += n
        if now is not None:
            yield finish()

    rows = manifest.filter("complete").select(*keys, "path", "n_records", "n_bytes", *[c for c in order if c != "path"])
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = rows.repartition(n, *keys).sortWithinPartitions(*keys, *order).mapInArrow(merge, schema)
    path = f"{out_root.rstrip('/')}/_manifest"
    merged.write.mode("overwrite").parquet(path)
    return manifest.sparkSession.read.parquet(path)
