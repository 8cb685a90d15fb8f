"""Live feed reload: re-read the feed table every micro-batch.

Each micro-batch reads the config, compares it with the running snapshot
(``config_diff``: start / stop / restart), tells the watchers, and lands the
batch with the new feeds.  A failed config read leaves the running feeds as
they are.  Snapshots are written to the shared scratch folder, so they survive executor loss without re-reading the database.
A topic that comes, goes or changes its threads makes the source subscribe
anew (``run_feed_landing``).
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pyspark.sql import functions as F

from ..operators.feeds import config_diff, feed_validation, topic_threads
from ..operators.metrics import flow_size
from ..plans.landing import land_batch
from ..schemas import FEED_COLUMNS
from ..session import remove_folder, scratch_path, scratch_scope
from . import progress
from .monitor import Drain, Drained, ended
from .windows import observed

log = logging.getLogger(__name__)

# Change callbacks get the (small) list of changed feeds: (id, action).
Watcher = Callable[[list[tuple[int, str]]], None]


class FeedReloader:
    """Holds the running feed snapshot and refreshes it on demand."""

    def __init__(self, read_feeds: Callable[[SparkSession], DataFrame], watchers: list[Watcher] | None = None):
        self.read_feeds = read_feeds
        self.watchers = list(watchers or [])
        self.current: DataFrame | None = None
        self._folder: str | None = None

    def refresh(self, spark: SparkSession) -> DataFrame:
        try:
            folder = scratch_path(spark, "feeds")
            self.read_feeds(spark).select(*FEED_COLUMNS).write.parquet(folder)
            new = spark.read.parquet(folder)
        except Exception as e:  # noqa: BLE001 - a failed read keeps the running feeds
            if self.current is None:
                raise
            log.warning("feed reload failed, keeping the running feeds: %s", e)
            return self.current
        if self.current is None:
            changes = [(r["id"], "start") for r in new.select("id").collect()]
        else:
            changes = [(r["id"], r["action"]) for r in config_diff(self.current, new).collect()]
        # started or restarted feeds that cannot be landed: say why (they are skipped)
        if any(a in ("start", "restart") for _, a in changes):
            bad = feed_validation(new).filter("reject_reason IS NOT NULL").select("id", "reject_reason")
            touched = {i for i, a in changes if a in ("start", "restart")}
            changes += [(r["id"], f"reject:{r['reject_reason']}") for r in bad.collect() if r["id"] in touched]
        if self.current is not None and not changes:
            remove_folder(spark, folder)        # the running snapshot is the same
            return self.current
        if self._folder is not None:
            remove_folder(spark, self._folder)
        self.current, self._folder = new, folder
        if changes:
            for w in self.watchers:
                w(changes)
        return new


def feed_counters(manifest: DataFrame) -> DataFrame:
    """Messages, chars and the flow text of each feed in a manifest."""
    return (manifest.groupBy("feed_id").agg(F.sum("n_records").cast("bigint").alias("messages"), F.sum("n_chars").cast("bigint").alias("chars"))
            .withColumn("flow_size", flow_size("chars")))


def start_feed_landing(records: DataFrame, reloader: FeedReloader, out_path: str, checkpoint: str,
                       manifest_path: str | None = None, dead_letter_path: str | None = None,
                       trigger: dict | None = None, transform=None, late_delay_seconds: int = 3600,
                       cluster: str = "none", on_counters: Callable[[int, list], None] | None = None,
                       on_feeds: Callable[[DataFrame], None] | None = None,
                       topic_partitions: Callable[[SparkSession], DataFrame] | None = None, idle_seconds: float | None = 3600,
                       stopping: Callable[[], bool] | None = None, first_batch: int = 0) -> StreamingQuery:
    """Stream landing with per-batch config reload.  Batch N lands into
    ``out_path/batch_id=N``, its rejected records into
    ``dead_letter_path/batch_id=N`` and its manifest into
    ``manifest_path/batch_id=N`` (folders beside ``out_path`` by default), all
    overwritten when the batch comes again.

    Who of a consumer group gets a partition, and the watermark, follow from
    the progress table (``progress``; version N under
    ``manifest_path/_progress``), not from what the batch holds.
    ``topic_partitions`` may report the topics' partitions (topic, n_parts),
    so that the first batch need not show them all.

    Rows behind the watermark (smallest latest clock of the partitions that
    are not idle, less ``late_delay_seconds``) land in their own hour and are
    counted (``n_late``).  ``on_counters`` gets each batch's counters by feed,
    ``on_feeds`` the feeds it was landed with.  When ``stopping()``, no batch
    is begun any more (``Drained``).  ``first_batch``: number of the query's
    batch 0 in the landing."""
    root = out_path.rstrip("/")
    manifests = (manifest_path or f"{root}-manifest").rstrip("/")
    dead = (dead_letter_path or f"{root}-rejected").rstrip("/")
    versions = f"{manifests}/_progress"

    def land(batch: DataFrame, batch_id: int) -> None:
        if stopping and stopping():
            raise Drained(f"batch {batch_id} is left for the next start")
        spark, batch_id = batch.sparkSession, first_batch + batch_id
        feeds = reloader.refresh(spark)
        seen = progress.mark(progress.version(spark, versions, batch_id - 1), idle_seconds)
        now = progress.advance(batch, versions, batch_id, topic_partitions(spark) if topic_partitions else None)
        before, after = (m - dt.timedelta(seconds=late_delay_seconds) if m else None for m in (seen, progress.mark(now, idle_seconds)))
        with scratch_scope(spark):      # what the landing of a batch writes aside goes with it
            late = F.coalesce(F.col("timestamp").cast("timestamp") < F.lit(before), F.lit(False)) if before else F.lit(False)
            manifest = land_batch(batch.withColumn("late", late), feeds, f"{root}/batch_id={batch_id}", f"{dead}/batch_id={batch_id}",
                                  transform=transform, mode="overwrite", cluster=cluster, manifest_path=f"{manifests}/batch_id={batch_id}",
                                  watermark=after, partitions=progress.partition_totals(now))
            if on_counters:
                on_counters(batch_id, feed_counters(manifest).collect())
            if on_feeds:
                on_feeds(feeds)

    return (observed(records).writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "20 seconds"})).start())


def threads_by_topic(feeds: DataFrame) -> dict[str, int]:
    """Threads of each subscribed topic: a row a topic of the feed table."""
    return {r["topic"]: r["threads"] for r in topic_threads(feeds).collect()}


def topic_changes(running: dict[str, int], wanted: dict[str, int]) -> dict[str, str]:
    """What a running subscription must do: topic -> start, stop or resize."""
    moves = {t: "start" if t not in running else "stop" if t not in wanted else "resize" for t in running.keys() | wanted.keys()}
    return {t: m for t, m in moves.items() if running.get(t) != wanted.get(t)}


Source = Callable[[list[str], int], DataFrame]
#: The same with the offsets to start at: topic -> partition -> next offset (none: a new topic).
HandedSource = Callable[[list[str], int, dict[str, dict[int, int]]], DataFrame]


def run_feed_landing(spark: SparkSession, source: Source | HandedSource, reloader: FeedReloader, out_path: str, checkpoint: str,
                     poll_seconds: float = 1.0, drain: Drain | None = None, hand_over: bool = False, **landing) -> None:
    """Land what the feeds subscribe to until the stream ends (or raises), or
    until ``drain`` asks for the end: the running batch is committed first.

    ``source(topics, partitions)`` makes the record stream of the feeds'
    topics, read in as many partitions as the feeds have threads.  When a
    reload starts, stops or resizes a topic (``topic_changes``), the query
    ends after its batch and starts anew with the topics and threads of then.

    Without ``hand_over`` the new query goes on from the same checkpoint (file
    sources, which know what they have read).  With it, every subscription is
    a *generation* with a checkpoint of its own, and ``source`` is also given
    the offsets that the one before has committed, so a topic that goes or
    comes back leaves no trace in the source's state (``Generations``)."""
    drain = drain or Drain()
    generations = Generations(spark, checkpoint, f"{(landing.get('manifest_path') or f'{out_path.rstrip('/')}-manifest').rstrip('/')}/_progress") if hand_over else None
    while True:
        wanted = threads_by_topic(reloader.refresh(spark))
        changed = threading.Event()

        def check(feeds: DataFrame, running=wanted, changed=changed) -> None:
            if changes := topic_changes(running, threads_by_topic(feeds)):
                log.info("subscription changes: %s", changes)
                changed.set()

        def stopping(changed=changed) -> bool:
            return changed.is_set() or drain.requested()

        topics, threads = sorted(wanted), sum(wanted.values())
        if generations is None:
            records, folder, first = source(topics, threads), checkpoint, 0
        else:
            folder, first, starts = generations.enter(wanted)
            records = source(topics, threads, starts)
        query = start_feed_landing(records, reloader, out_path, folder, on_feeds=check, stopping=stopping, first_batch=first, **landing)
        try:
            drained = ended(query, stopping, poll_seconds)
        except KeyboardInterrupt:
            query.stop()
            return
        if drain.requested():
            drain.obeyed()
            return
        if not drained and not changed.is_set():
            return


class Generations:
    """The subscriptions of a landing one after another.

    Generation K has its own checkpoint and a record (topics and threads, its
    first batch's number, the offsets it started from), written before it
    runs.  Its batch N is the landing's batch first + N.  The next generation
    starts from the progress version of the last batch that Spark committed,
    and with the number after it: a batch that was begun and not committed is
    delivered and landed again, in the same folders."""

    def __init__(self, spark: SparkSession, checkpoint: str, versions: str):
        self.spark, self.root, self.versions = spark, checkpoint.rstrip("/"), versions
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return [f.getPath().getName() for f in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def _record(self, k: int) -> dict:
        stream = self._fs.open(self._path(f"{self.root}/generation={k}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def last(self) -> int:
        """The newest generation's number; -1 before the first."""
        return max((int(n[11:-5]) for n in self._names(self.root) if n.startswith("generation=") and n.endswith(".json")), default=-1)

    def committed(self, k: int) -> int:
        """Batches that Spark has committed in generation ``k``."""
        return max((int(n) for n in self._names(f"{self.root}/generation={k}/commits") if n.isdigit()), default=-1) + 1

    def enter(self, wanted: dict[str, int]) -> tuple[str, int, dict[str, dict[int, int]]]:
        """(checkpoint, first batch, offsets to start at) of the generation
        that lands these topics: the newest if its topics and threads are
        these (a restart), else a new one."""
        k, first, starts = self.last(), 0, {}
        if k >= 0:
            record = self._record(k)
            first, starts = record["first"], {t: {int(p): o for p, o in ps.items()} for t, ps in record["starts"].items()}
            if record["topics"] == wanted:
                return f"{self.root}/generation={k}", first, starts
            if done := self.committed(k):
                first += done
                starts = starts | self._offsets(first - 1)
        k += 1
        out = self._fs.create(self._path(f"{self.root}/generation={k}.json"), False)
        out.write(json.dumps({"topics": wanted, "first": first, "starts": starts}).encode())
        out.close()
        return f"{self.root}/generation={k}", first, starts

    def _offsets(self, batch_id: int) -> dict[str, dict[int, int]]:
        """Next offsets after a batch (a row a partition of the topics ever seen)."""
        out: dict[str, dict[int, int]] = {}
        for r in progress.version(self.spark, self.versions, batch_id).filter("last_offset IS NOT NULL").collect():
            out.setdefault(r["topic"], {})[r["partition"]] = r["last_offset"] + 1
        return out
