"""Acknowledgement modes of the old consumer, as Spark trigger/source options.

Commits follow the micro-batch: offsets are written to the checkpoint after
the sink has committed, which is stronger than acknowledging on a timer.
"""

from __future__ import annotations

# The acknowledgement modes of the original consumer.
ACK_MODES = ["RECORD", "BATCH", "TIME", "COUNT", "COUNT_TIME", "MANUAL", "MANUAL_IMMEDIATE"]


def delivery_options(mode: str, ack_time_ms: int | None = None, ack_count: int | None = None
                     ) -> tuple[dict, dict]:
    """(trigger kwargs, Kafka source options) for an acknowledgement mode.

    BATCH -> one micro-batch per poll (default trigger); TIME -> a processing
    time trigger; COUNT -> at most ``ack_count`` offsets per batch;
    COUNT_TIME -> at least ``ack_count`` offsets or ``ack_time_ms``,
    whichever comes first.  Per-record and manual acknowledgement have no
    micro-batch equivalent and are refused.
    """
    m = mode.upper()
    if m not in ACK_MODES:
        raise ValueError(f"unknown ack mode {mode!r}")
    if m == "BATCH":
        return {}, {}
    if m == "TIME":
        return {"processingTime": f"{int(ack_time_ms or 1000)} milliseconds"}, {}
    if m == "COUNT":
        return {}, {"maxOffsetsPerTrigger": str(int(ack_count or 1))}
    if m == "COUNT_TIME":
        return {}, {"minOffsetsPerTrigger": str(int(ack_count or 1)),
                    "maxTriggerDelay": f"{int(ack_time_ms or 1000)}ms"}
    raise NotImplementedError(f"ack mode {m} has no micro-batch equivalent")
