"""quayside: land and account log streams with Spark.

Records arrive in the Kafka row shape (``key, value, topic, partition,
offset, timestamp, timestampType``).  A table of feeds says which topics
to read, how to frame each message and where to put it.  Everything here
takes and returns DataFrames and stays lazy, so batch replays, streams and
tests share one code path.
"""

__version__ = "0.1.0"
