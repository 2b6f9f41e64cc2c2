"""The four fixed schemas of the pipeline.

Nothing is inferred anywhere: raw snapshots, messages, history rows and
metrics rows all have the hand-written shapes below.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The attribute keys a snapshot element carries and that the
# message keeps (string-valued and integer-valued ones).
STRING_ATTRIBUTES = ("Installed", "Locked")
INT_ATTRIBUTES = ("NbDocks", "NbBikes", "NbEBikes", "NbEmptyDocks")

# Fixed value: text form of `extraction_datetime` inside a message.
MESSAGE_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

PROPERTY = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("sourceSystemKey", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("modified", T.StringType()),
    ]
)

RAW_SNAPSHOT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("commonName", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("additionalProperties", T.ArrayType(PROPERTY)),
    ]
)

MESSAGE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("common_name", T.StringType()),
        T.StructField("lat", T.DecimalType(8, 6)),
        T.StructField("lon", T.DecimalType(9, 6)),
        T.StructField("Installed", T.StringType()),
        T.StructField("Locked", T.StringType()),
        T.StructField("NbBikes", T.IntegerType()),
        T.StructField("NbEBikes", T.IntegerType()),
        T.StructField("NbEmptyDocks", T.IntegerType()),
        T.StructField("NbDocks", T.IntegerType()),
        T.StructField("extraction_datetime", T.TimestampType()),
    ]
)

# Shape of a message on the wire, before decoding: the same columns a Kafka
# source yields (value, partition, offset, timestamp) minus the ones nobody reads.
WIRE = T.StructType(
    [
        T.StructField("value", T.BinaryType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Order of arrival: an offset counts within its partition only, so it comes last.
ARRIVAL = ("timestamp", "partition", "offset")

HISTORY = T.StructType(
    [
        T.StructField("bike_point_id", T.StringType()),
        T.StructField("common_name", T.StringType()),
        T.StructField("lat", T.DecimalType(8, 6)),
        T.StructField("lon", T.DecimalType(9, 6)),
        T.StructField("installed", T.BooleanType()),
        T.StructField("locked", T.BooleanType()),
        T.StructField("nb_bikes", T.IntegerType()),
        T.StructField("nb_ebikes", T.IntegerType()),
        T.StructField("nb_empty_docks", T.IntegerType()),
        T.StructField("nb_docks", T.IntegerType()),
        T.StructField("nb_broken_docks", T.IntegerType()),
        T.StructField("extraction_datetime", T.TimestampType()),
        T.StructField("extraction_date", T.DateType()),
        T.StructField("month_name", T.StringType()),
        T.StructField("month_number", T.IntegerType()),
        T.StructField("day_of_month", T.IntegerType()),
        T.StructField("week_of_year", T.IntegerType()),
        T.StructField("day_of_week", T.StringType()),
        T.StructField("day_of_week_number", T.IntegerType()),
        T.StructField("hour", T.StringType()),
        T.StructField("hour_interval", T.StringType()),
    ]
)

HISTORY_KEY = ("bike_point_id", "extraction_datetime")

METRICS = T.StructType(
    [
        T.StructField("min_extraction_datetime", T.TimestampType()),
        T.StructField("max_extraction_datetime", T.TimestampType()),
        T.StructField("nb_available_bikes", T.LongType()),
        T.StructField("percentage_available_bikes", T.DoubleType()),
        T.StructField("nb_available_ebikes", T.LongType()),
        T.StructField("percentage_available_ebikes", T.DoubleType()),
        T.StructField("nb_in_use_bikes", T.LongType()),
        T.StructField("percentage_in_use_bikes", T.DoubleType()),
        T.StructField("nb_broken_docks", T.LongType()),
        T.StructField("percentage_broken_docks", T.DoubleType()),
    ]
)

# The metrics store adds the write instant (for the 24 h lifetime) and the
# stream's id and micro-batch id (for last-write-wins among equal keys).
METRICS_STORED = T.StructType(
    METRICS.fields
    + [
        T.StructField("written_at", T.TimestampType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

METRICS_KEY = ("min_extraction_datetime", "max_extraction_datetime")
