"""Byte files under a shared folder, written and read by tasks.

Paths are URIs as Spark takes them (``file:/x``, ``/x``, ``hdfs://…``,
``s3://…``); ``pyarrow.fs`` opens them on the executor.  A file is written
under a name of the attempt's own and moved into place at the end, so a
retried or speculative task leaves either the whole file or none.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame

from ..session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows from a table in the shared folder: lineage ends there, its
    size is known, and many small parts are read as a few."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a Spark path."""
    from pyarrow import fs as pafs

    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def committed_file(uri: str):
    """An output stream whose file appears at ``uri`` when the block ends well."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    staged = f"{path}.{uuid.uuid4().hex}.tmp"
    out = fs.open_output_stream(staged)
    try:
        yield out
    except BaseException:
        out.close()
        fs.delete_file(staged)
        raise
    out.close()
    fs.move(staged, path)


@contextlib.contextmanager
def input_file(uri: str):
    """A seekable input file."""
    fs, path = filesystem(uri)
    with fs.open_input_file(path) as f:
        yield f
