"""What a running landing tells, and how it is told to stop.

``ProgressLog`` listens to the queries of a session and writes one file a
micro-batch (progress, rows, durations, observed counters): a table that
survives the driver.  ``Drain`` is a request to stop, by signal or by a marker
file: the batch that runs is finished and committed, no other is begun.
"""

from __future__ import annotations

import json
import logging
import signal
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.metrics import flow_size

log = logging.getLogger(__name__)

PROGRESS = ("query string, run string, batch_id bigint, at timestamp, input_rows bigint, input_per_second double, processed_per_second double, "
            "batch_ms bigint, messages bigint, chars bigint")


class ProgressLog(StreamingQueryListener):
    """Writes each query's progress below ``path``: one small file a batch,
    under a name of the batch's own, so one that is told twice is there once.
    ``metrics`` is the name under which the records are observed
    (``windows.observed``).  ``states`` gets (query, "started" or
    "terminated", error)."""

    def __init__(self, spark: SparkSession, path: str, metrics: str = "landing", states=None):
        self.spark, self.path, self.metrics, self.states = spark, path.rstrip("/"), metrics, states or (lambda *a: None)

    def _write(self, name: str, row: dict) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        out = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(hadoop, True)
        out.write(json.dumps(row).encode())
        out.close()

    def onQueryStarted(self, event) -> None:
        self.states(str(event.id), "started", None)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(self.metrics) if p.observedMetrics else None
        counters = seen.asDict() if seen is not None else {}
        if not p.numInputRows and "addBatch" not in (p.durationMs or {}):
            return      # an idle trigger
        try:
            self._write(f"query={p.id}/{p.batchId:012d}.json", {
                "run": str(p.runId), "batch_id": p.batchId, "at": p.timestamp, "input_rows": p.numInputRows, "input_per_second": p.inputRowsPerSecond,
                "processed_per_second": p.processedRowsPerSecond, "batch_ms": p.batchDuration, "messages": counters.get("messages"), "chars": counters.get("chars")})
        except Exception as e:  # noqa: BLE001 - a log that can't be written must not stop the landing
            log.warning("progress of batch %s not written: %s", p.batchId, e)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.states(str(event.id), "terminated", event.exception)


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """The batches that a ``ProgressLog`` has written."""
    names = [c.split()[0] for c in PROGRESS.split(", ")]
    return spark.read.schema(PROGRESS).json(path).select(*names)


def batch_flow(progress: DataFrame) -> DataFrame:
    """Messages, chars, QPS and flow text of every batch, with the running
    totals of its query.  A running total is a window over the batches of a
    query, one row each."""
    so_far = Window.partitionBy("query").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    messages, chars = F.coalesce("messages", F.lit(0)), F.coalesce("chars", F.lit(0))
    return progress.select("query", "batch_id", "at", messages.alias("messages"), chars.alias("chars"),
                           F.when(F.col("batch_ms") > 0, messages * 1000 / F.col("batch_ms")).alias("qps"), flow_size("chars").alias("flow_size"),
                           F.sum(messages).over(so_far).alias("total_messages"), F.sum(chars).over(so_far).alias("total_chars"))


class Drained(Exception):
    """A batch that was not begun, for the landing is to stop."""


class Drain:
    """A request to stop after the running batch: ``stop()``, a signal
    (``on_signals``) or a marker file, which is removed when it was obeyed."""

    def __init__(self, spark: SparkSession | None = None, marker: str | None = None):
        self._event, self._marker, self._before = threading.Event(), None, {}
        if marker:
            self._marker = spark._jvm.org.apache.hadoop.fs.Path(marker)
            self._fs = self._marker.getFileSystem(spark._jsc.hadoopConfiguration())

    def stop(self) -> None:
        self._event.set()

    def on_signals(self, *which: int) -> "Drain":
        """Stop on these signals (SIGTERM and SIGINT), until ``restore``; main thread only."""
        self._before = {s: signal.signal(s, lambda number, frame: self.stop()) for s in which or (signal.SIGTERM, signal.SIGINT)}
        return self

    def restore(self) -> None:
        for s, handler in self._before.items():
            signal.signal(s, handler)
        self._before = {}

    def requested(self) -> bool:
        if self._marker is not None and not self._event.is_set() and self._fs.exists(self._marker):
            self.stop()
        return self._event.is_set()

    def obeyed(self) -> None:
        if self._marker is not None:
            self._fs.delete(self._marker, False)


def ended(query, stopping, poll_seconds: float) -> bool:
    """Wait until a query ends by itself (false) or, once ``stopping()`` says
    so, after the batch that runs has been committed (true).  The batch
    function must raise ``Drained`` at the beginning of a batch when
    ``stopping()``: between two batches there is then nothing to interrupt."""
    while True:
        try:
            if query.awaitTermination(poll_seconds):
                break
        except Exception as e:  # noqa: BLE001 - what the batch function raised
            if "Drained" in str(e) and stopping():
                return True
            raise
        if stopping() and not query.status["isTriggerActive"]:
            query.stop()
            return True
    if query.exception():
        raise query.exception()
    return False
