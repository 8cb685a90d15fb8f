"""Command line: run a landing stream, or compact completed hours.

    python -m quayside land --replay DIR | --bootstrap HOSTS
                            --feeds-jdbc URL | --feeds-parquet PATH
                            --out PATH --checkpoint PATH [--manifest PATH]
                            [--dead-letter PATH] [--ack-mode BATCH|TIME|COUNT|COUNT_TIME]
                            [--trigger-seconds N | --available-now] [--late-delay S] [--idle-seconds S]
                            [--stop-marker PATH] [--progress PATH]
    python -m quayside compact --manifest PATH | --landed PATH [--before-day D --before-hour H] --out PATH

The topics are those of the feeds.  The feed table is re-read every
micro-batch; a failed read keeps the running feeds.  SIGTERM, Ctrl-C or the
stop marker end the landing after the batch that runs; the checkpoint makes a
restart safe in any case.
"""

from __future__ import annotations

import argparse
import json
import sys
import threading

from .sources.feeds import CONFIG_TABLE

KAFKA_EARLIEST = -2     # fixed value of the Kafka source


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quayside")
    sub = p.add_subparsers(dest="cmd", required=True)
    land = sub.add_parser("land", help="run a landing stream")
    src = land.add_mutually_exclusive_group(required=True)
    src.add_argument("--replay", help="folder of recorded events (parquet) to replay")
    src.add_argument("--bootstrap", help="Kafka bootstrap servers")
    land.add_argument("--group-id")
    land.add_argument("--start", default="largest", help="largest/smallest (Kafka)")
    feeds = land.add_mutually_exclusive_group(required=True)
    feeds.add_argument("--feeds-jdbc", help="JDBC URL of the feed table")
    feeds.add_argument("--feeds-parquet", help="feed table as parquet")
    land.add_argument("--feeds-table", default=CONFIG_TABLE)
    land.add_argument("--out", required=True)
    land.add_argument("--checkpoint", required=True)
    land.add_argument("--manifest")
    land.add_argument("--dead-letter")
    land.add_argument("--ack-mode", default="BATCH")
    land.add_argument("--ack-time-ms", type=int)
    land.add_argument("--ack-count", type=int)
    land.add_argument("--trigger-seconds", type=int, default=20)
    land.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    land.add_argument("--late-delay", type=int, default=3600, help="seconds; rows further behind are counted as late")
    land.add_argument("--idle-seconds", type=float, default=3600, help="a partition silent for so long holds no hour open")
    land.add_argument("--stop-marker", help="a file that ends the landing after the running batch")
    land.add_argument("--progress", help="folder for the progress of every batch")
    land.add_argument("--cluster", default=None, help="none (live, default) or rebalance (backfill)")
    comp = sub.add_parser("compact", help="merge completed hours into a new version")
    what = comp.add_mutually_exclusive_group(required=True)
    what.add_argument("--landed", help="folder of key=value partitions")
    what.add_argument("--manifest", help="manifest folder of a feed landing")
    comp.add_argument("--out", required=True)
    comp.add_argument("--before-day")
    comp.add_argument("--before-hour", default="00")
    comp.add_argument("--codec")
    return p


def run_land(spark, a) -> None:
    from .sources.feeds import read_feeds_jdbc
    from .sources.records import events_as_records, kafka_records, replay_stream
    from .streaming.delivery import delivery_options
    from .streaming.monitor import Drain, ProgressLog
    from .streaming.reload import FeedReloader, run_feed_landing

    trigger, src_opts = delivery_options(a.ack_mode, a.ack_time_ms, a.ack_count)
    if a.available_now:
        trigger = {"availableNow": True}
    elif not trigger:
        trigger = {"processingTime": f"{a.trigger_seconds} seconds"}

    def replayed(topics, threads):
        schema = spark.read.parquet(a.replay).schema
        records = events_as_records(replay_stream(spark, a.replay, schema))
        return records.filter(records["topic"].isin(topics))

    def live(topics, threads, starts):
        # Topics that the generation before has read go on where it ended.
        # (The source wants an offset for each partition: those without a record yet begin at their first.)
        known = {t: {str(p): starts[t].get(p, KAFKA_EARLIEST) for p in range(max(starts[t]) + 1)} for t in topics if t in starts}
        new = [t for t in topics if t not in starts]
        stream = [kafka_records(spark, a.bootstrap, sorted(known), a.group_id, json.dumps(known), threads or None, options=src_opts)] if known else []
        stream += [kafka_records(spark, a.bootstrap, new, a.group_id, a.start, threads or None, options=src_opts)] if new else []
        return stream[0].unionByName(stream[1]) if len(stream) == 2 else stream[0]

    if a.feeds_jdbc:
        def read(sp):
            return read_feeds_jdbc(sp, a.feeds_jdbc, a.feeds_table)
    else:
        def read(sp):
            return sp.read.parquet(a.feeds_parquet).filter("isEnabled = 1")
    reloader = FeedReloader(read, [lambda changes: print(f"feeds changed: {changes}", flush=True)])
    if a.progress:
        spark.streams.addListener(ProgressLog(spark, a.progress))
    drain = Drain(spark, a.stop_marker)
    if threading.current_thread() is threading.main_thread():
        drain.on_signals()
    try:
        run_feed_landing(spark, replayed if a.replay else live, reloader, a.out, a.checkpoint, manifest_path=a.manifest, dead_letter_path=a.dead_letter,
                         drain=drain, hand_over=not a.replay, idle_seconds=a.idle_seconds, trigger=trigger, late_delay_seconds=a.late_delay, cluster=a.cluster or ("rebalance" if a.replay else "none"))
    finally:
        drain.restore()


def main(argv: list[str] | None = None, spark=None) -> int:
    a = _parser().parse_args(argv)
    from .session import build_session, configure

    spark = configure(spark) if spark is not None else build_session(app="quayside-" + a.cmd)
    if a.cmd == "land":
        run_land(spark, a)
        return 0
    from .plans.landing import landed_manifest
    from .sinks.compaction import compact_files, compact_hours, complete_before

    if a.manifest:
        compact_files(landed_manifest(spark, a.manifest), a.out)
        return 0

    where = complete_before(a.before_day, a.before_hour) if a.before_day else None
    compact_hours(spark, a.landed, a.out, where, a.codec)
    return 0


if __name__ == "__main__":
    sys.exit(main())
