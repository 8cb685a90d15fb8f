"""Record sources, all brought to the Kafka row shape.

* ``kafka_records`` - the live source (one thin function; the connector jar
  must be on the classpath).
* ``events_as_records`` - the replay stand-in used by tests and queries:
  topic = event_type, partition = user_id % 3, offset = event_id,
  timestamp = ts, value = props.
* ``replay_stream`` - re-read recorded rows as a file stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RECORD_SCHEMA

# Start policy names of the old consumer and their Spark equivalents.
START_POLICY = {"largest": "latest", "smallest": "earliest",
                "latest": "latest", "earliest": "earliest"}

# Replay stand-in: number of Kafka partitions the user ids are spread over.
REPLAY_PARTITIONS = 3


def kafka_records(spark: SparkSession, bootstrap: str, topics: str | list[str],
                  group_id: str | None = None, start: str = "largest",
                  min_partitions: int | None = None,
                  max_offsets_per_trigger: int | None = None,
                  stream: bool = True, options: dict | None = None) -> DataFrame:
    """Subscribe to one or more topics (comma list or list)."""
    if isinstance(topics, (list, tuple)):
        topics = ",".join(topics)
    reader = spark.readStream if stream else spark.read
    r = (reader.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topics)
         .option("startingOffsets", START_POLICY.get(start, start)))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    if max_offsets_per_trigger and stream:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load().select(*[f.name for f in RECORD_SCHEMA.fields])


def events_as_records(events: DataFrame) -> DataFrame:
    """The ``events`` table in the Kafka row shape (timestamps as UTC
    instants so that watermarks accept them)."""
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.col("event_type").alias("topic"),
        (F.col("user_id") % REPLAY_PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def replay_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """Re-read recorded rows as a stream (use ``trigger(availableNow=True)``).
    ``path`` is a folder; ``glob`` picks files inside it."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)
