"""Fixed schemas: the record shape, the feed table and the landing manifest."""

from pyspark.sql import types as T

# Kafka row shape; every source (Kafka, replay, tests) is brought to it.
RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

# Feed configuration table (one row per feed).
FEED_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("topics", T.StringType(), False),
    T.StructField("groupID", T.StringType(), False),
    T.StructField("numThreads", T.IntegerType(), False),
    T.StructField("fileType", T.StringType(), False),
    T.StructField("codeC", T.StringType()),
    T.StructField("filePath", T.StringType()),
    T.StructField("filePathFormat", T.StringType(), False),
    T.StructField("filePathMode", T.StringType()),
    T.StructField("fileSuffix", T.StringType()),
    T.StructField("isWriteLineBreaks", T.IntegerType(), False),
    T.StructField("isEnabled", T.IntegerType(), False),
])

FEED_COLUMNS = [f.name for f in FEED_SCHEMA.fields]

# Defaults a feed row takes when a field is missing.
FEED_DEFAULTS = {"filePathFormat": "yyyy-MM-dd", "fileSuffix": ""}

# Bean type -> column type used when a table is created from a schema.
TYPE_MAP = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.DecimalType(10, 4),
    "double": T.DecimalType(13, 4),
    "boolean": T.BooleanType(),
    "date": T.TimestampType(),
}
