"""A file topic in time segments, with retention that removes data.

`path/segment=<start>/` holds the messages that arrived in one stretch of time (`width` seconds from the epoch on),
`path/_index/` the least and greatest arrival and the number of messages that each write added to a segment. Retention
removes whole segments whose greatest arrival is too old; of the segment at the boundary, readers leave out the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockyard.config import TOPIC_RETENTION_MS
from dockyard.operators.retention import instant, topic_retention
from dockyard.schema import WIRE
from dockyard.sinks.files import children, remove
from dockyard.sources.tables import scan

WIDTH = 3_600
_STORED = T.StructType([*WIRE.fields, T.StructField("segment", T.LongType())])
INDEX = "segment bigint, first timestamp, last timestamp, nb_messages bigint"


def write_segments(messages: DataFrame, path: str, width: int = WIDTH) -> None:
    """Append messages (`value`, `partition`, `offset`, `timestamp`), each to the segment of its arrival.

    The index row is written first: a write that stops half way leaves a row for messages that are not there, never
    messages that retention does not know of.
    """
    segment = (F.floor(F.unix_seconds("timestamp") / width) * width).cast("bigint")
    rows = messages.select(*WIRE.fieldNames()).withColumn("segment", segment)
    index = rows.groupBy("segment").agg(
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), F.count(F.lit(1)).alias("nb_messages"))
    index.coalesce(1).write.mode("append").parquet(f"{path}/_index")
    rows.hint("rebalance", "segment").write.mode("append").partitionBy("segment").parquet(path)


def segment_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per segment: least and greatest arrival, messages."""
    return scan(spark, f"{path}/_index", INDEX).groupBy("segment").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("nb_messages").alias("nb_messages"))


def expire_segments(spark: SparkSession, path: str, as_of=None, horizon_ms: int = TOPIC_RETENTION_MS) -> list[int]:
    """Remove the segments whose newest message is older than the horizon at `as_of` (now); returns their starts.

    The index is folded to one row per segment that stays. Segments are as many as hours, so their list is small.
    Safe to repeat: a segment is removed before its row.
    """
    cutoff = instant(as_of) - F.make_dt_interval(secs=F.lit(horizon_ms / 1000))
    index = [tuple(r) for r in segment_index(spark, path).withColumn("old", F.col("last") <= cutoff).collect()]
    gone = sorted(r[0] for r in index if r[4])
    there = set(children(spark, path))
    for start in gone:
        if f"segment={start}" in there:
            remove(spark, f"{path}/segment={start}")
    kept = spark.createDataFrame([r[:4] for r in index if not r[4]], INDEX)
    kept.coalesce(1).write.mode("overwrite").parquet(f"{path}/_index")
    return gone


def read_segments(spark: SparkSession, path: str, as_of=None, width: int = WIDTH) -> DataFrame:
    """The messages that the topic still holds at `as_of`; older segments are not read, the boundary's rest is left out."""
    low = spark.range(1).select(F.unix_seconds(instant(as_of))).first()[0] - TOPIC_RETENTION_MS // 1000
    rows = spark.read.schema(_STORED).parquet(path)
    rows = rows.where(F.col("segment") >= low // width * width)
    return topic_retention(rows, as_of).select("value", "partition", "offset", "timestamp")
