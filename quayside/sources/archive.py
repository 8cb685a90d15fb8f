"""An archive of raw records, and replay from any offset of it.

``write_archive`` lands records as Parquet, cut by ranges of (topic,
partition, offset), so a file holds a short range of few partitions; its
manifest names the range of every (file, topic, partition).  A replay resolves
where each partition starts - an offset, or so many records from the end -
and reads only the files whose range reaches beyond it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.sizing import sized
from ..schemas import RECORD_SCHEMA

KEYS = ["topic", "partition"]
STARTS = "topic string, partition int, start bigint"
EARLIEST = 0


def write_archive(records: DataFrame, path: str, batch: str, files: int | None = None) -> DataFrame:
    """Archive a batch of records under its name, replacing what a batch of
    that name left before; returns its manifest.  The manifest is written
    last: data without it is never read.  ``files``: ranges to cut (by
    default Spark's, joined by size)."""
    spark = records.sparkSession
    root, by = path.rstrip("/"), [*KEYS, "offset"]
    rows = records.select(*[f.name for f in RECORD_SCHEMA.fields])
    cut = rows.repartitionByRange(files, *by) if files else rows.repartitionByRange(*by)
    cut.sortWithinPartitions(*by).write.mode("overwrite").parquet(f"{root}/batch={batch}")
    found = spark.read.schema(RECORD_SCHEMA).parquet(f"{root}/batch={batch}")
    manifest = (found.groupBy(F.col("_metadata.file_path").alias("path"), *KEYS)
                .agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.count(F.lit(1)).alias("n_records")))
    manifest.write.mode("overwrite").parquet(f"{root}/_manifest/batch={batch}")
    return archive_manifest(spark, root).filter(F.col("batch") == batch)


def archive_manifest(spark: SparkSession, path: str) -> DataFrame:
    schema = "path string, topic string, partition int, first_offset bigint, last_offset bigint, n_records bigint, batch string"
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/_manifest")


def offset_ends(manifest: DataFrame) -> DataFrame:
    """(topic, partition, first_offset, end_offset): the first archived offset
    and the one after the last."""
    return manifest.groupBy(*KEYS).agg(F.min("first_offset").alias("first_offset"), (F.max("last_offset") + 1).alias("end_offset"))


def resolve_starts(ends: DataFrame, starts: DataFrame) -> DataFrame:
    """(topic, partition, start_offset, end_offset) of the partitions asked for.

    ``starts`` (topic, partition, start): a null partition means all of the
    topic, a null topic all topics; what names a partition goes before what
    names its topic, and that before all.  A negative start counts from the
    end.  Starts beyond either end are the end's."""
    named = starts.select(*[F.col(c).alias(f"_{c}") for c in (*KEYS, "start")])
    rank = F.when(F.col("_partition").isNotNull(), 2).when(F.col("_topic").isNotNull(), 1).otherwise(0)
    # One equality join for each way of naming: none of them multiplies rows.
    levels = [ends.join(named.filter("_partition IS NOT NULL"), (F.col("topic") == F.col("_topic")) & (F.col("partition") == F.col("_partition"))),
              ends.join(named.filter("_partition IS NULL AND _topic IS NOT NULL"), F.col("topic") == F.col("_topic")),
              ends.withColumns({"_topic": F.lit(None).cast("string"), "_partition": F.lit(None).cast("int"),
                                "_start": starts.filter("partition IS NULL AND topic IS NULL").agg(F.min("start")).scalar()}).filter("_start IS NOT NULL")]
    every = levels[0].unionByName(levels[1]).unionByName(levels[2])
    best = every.groupBy(*KEYS, "first_offset", "end_offset").agg(F.max_by("_start", rank).alias("_start"))
    wanted = F.when(F.col("_start") < 0, F.col("end_offset") + F.col("_start")).otherwise(F.col("_start"))
    return best.select(*KEYS, F.greatest("first_offset", F.least("end_offset", wanted)).alias("start_offset"), "end_offset")


def replay_from(spark: SparkSession, path: str, starts: DataFrame) -> DataFrame:
    """The archived records from the resolved starts on.  Only files whose
    range reaches a start are opened; their names, as Spark's reader takes
    them, are all that comes to the driver."""
    manifest = archive_manifest(spark, path)
    resolved = sized(resolve_starts(offset_ends(manifest), starts), "starts")
    needed = manifest.join(resolved, KEYS).filter(F.col("last_offset") >= F.col("start_offset")).select("path").distinct()
    paths = [r["path"] for r in needed.collect()]
    if not paths:
        return spark.createDataFrame([], RECORD_SCHEMA)
    rows = spark.read.schema(RECORD_SCHEMA).parquet(*paths)
    return rows.join(resolved.drop("end_offset"), KEYS).filter(F.col("offset") >= F.col("start_offset")).select(*[f.name for f in RECORD_SCHEMA.fields])


def replay_stream_from(spark: SparkSession, path: str, starts: DataFrame, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream: history from the starts on, then every batch
    that is archived later (partitions that are new by then from the first record)."""
    resolved = sized(resolve_starts(offset_ends(archive_manifest(spark, path)), starts), "starts")
    r = spark.readStream.schema(RECORD_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = r.parquet(f"{path.rstrip('/')}/batch=*").join(resolved.drop("end_offset"), KEYS, "left")
    return rows.filter(F.col("offset") >= F.coalesce("start_offset", F.lit(EARLIEST))).select(*[f.name for f in RECORD_SCHEMA.fields])


def kafka_starting_offsets(resolved: DataFrame) -> str:
    """The resolved starts as the Kafka source's ``startingOffsets`` (a row a
    partition of the topics), for ``records.kafka_records(start=...)``."""
    out: dict[str, dict[str, int]] = {}
    for r in resolved.select(*KEYS, "start_offset").collect():
        out.setdefault(r["topic"], {})[str(r["partition"])] = r["start_offset"]
    return json.dumps(out, sort_keys=True)
