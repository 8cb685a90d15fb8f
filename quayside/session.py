"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import threading

from pyspark.sql import SparkSession

# Settings the engine depends on for correct results, not for speed:
# UTC keeps date/hour buckets independent of the machine's zone.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Sensible defaults for a large cluster; each is only applied when unset.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "quayside",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's required settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **REQUIRED_CONF}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply required settings to an existing session (the driver's, say)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quayside`` importable in Python workers (Arrow kernels, the raw
    sink): zip the package once per application and ``addPyFile`` it, the
    same as ``--py-files`` on a cluster."""
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    fd, zpath = tempfile.mkstemp(prefix="quayside-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only when nothing is configured (local tests) do we fall back to
    a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="quayside-ckpt-")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)    # this process made it, for itself
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    unless the session itself is local)."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/quayside-{name}-{uuid.uuid4().hex[:12]}"
    if scopes := getattr(_SCRATCH, "scopes", None):
        scopes[-1].append(path)
    return path


_SCRATCH = threading.local()


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch folders that this thread makes inside the block go at its end:
    for a micro-batch, or a query whose result has been taken.  A DataFrame
    that still reads them must not be used afterwards."""
    if not hasattr(_SCRATCH, "scopes"):
        _SCRATCH.scopes = []
    made: list[str] = []
    _SCRATCH.scopes.append(made)
    try:
        yield
    finally:
        _SCRATCH.scopes.remove(made)
        for path in made:
            remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file access in tests."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.normpath(path)
