"""Docking-point rows derived from the driver's `events` table.

The benchmark data has no bike-dock feed, so every registered query reads
`events` and derives one docking-point poll row per event with the fixed
recipe below (user -> docking point, props.k -> bike count, event_type ->
flags). The same recipe is written in SQL for the oracle; both must agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockyard.operators.staging import encode_messages
from dockyard.schema import ARRIVAL, MESSAGE


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table, in the splits that the session's file settings give."""
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _digits(x: Column, mult: int) -> Column:
    """Six decimal digits picked from `x` (fixed rule, text)."""
    return F.lpad(((x * mult) % 1_000_000).cast("string"), 6, "0")


def docking_rows(events: DataFrame, ts_unit: str = "second") -> DataFrame:
    """Message-shaped rows (+ `event_id`, `ts`) from events, one per event.

    Fixed recipe: docks = 15 + user % 25; k = props.k; bikes = 0 when k % 7 = 0
    else k % docks; e-bikes = bikes % 4; empty = max(docks - bikes - event_id % 3, 0);
    Installed is "false" for error events; Locked is "true" for signups. The
    instant is `ts` cut to `ts_unit` (second by default; "hour" gives many
    messages per key, which insert-ignore tests need).
    """
    user = F.col("user_id")
    # Step 1: the per-event numbers (props is parsed once; later steps reuse k).
    base = events.select(
        "event_id",
        "user_id",
        "event_type",
        "ts",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.lit(15) + user % 25).cast("int").alias("docks"),
    ).withColumn("bikes", F.when(F.col("k") % 7 == 0, F.lit(0)).otherwise(F.col("k") % F.col("docks")).cast("int"))
    bikes, docks = F.col("bikes"), F.col("docks")
    return base.select(
        F.col("event_id"),
        F.concat(F.lit("BikePoints_"), user.cast("string")).alias("id"),
        F.concat(F.lit("Dock "), (user % 40).cast("string")).alias("common_name"),
        F.concat(F.lit("51."), _digits(user, 7919)).alias("lat"),
        F.concat(F.lit("-0."), _digits(user, 104729)).alias("lon"),
        F.when(F.col("event_type") == "error", "false").otherwise("true").alias("Installed"),
        F.when(F.col("event_type") == "signup", "true").otherwise("false").alias("Locked"),
        bikes.alias("NbBikes"),
        (bikes % 4).cast("int").alias("NbEBikes"),
        F.greatest(docks - bikes - F.col("event_id") % 3, F.lit(0)).cast("int").alias("NbEmptyDocks"),
        docks.alias("NbDocks"),
        F.date_trunc(ts_unit, F.col("ts")).alias("extraction_datetime"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


MESSAGE_COLUMNS = tuple(MESSAGE.fieldNames())


def message_fields(rows: DataFrame) -> DataFrame:
    """The eleven message columns of derived rows (drops event_id and ts)."""
    return rows.select(*MESSAGE_COLUMNS)


def wire_messages(rows: DataFrame) -> DataFrame:
    """Derived rows as they travel on a topic of four partitions: JSON `value`, `partition`, `offset`, arrival
    `timestamp`."""
    framed = rows.select(
        *MESSAGE_COLUMNS,
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )
    return encode_messages(framed, keep=ARRIVAL).select("value", "partition", "offset", "timestamp")


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def snapshot_rows(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Derived rows in the nested snapshot form (attribute array), for the staging path; `keep` columns come last.

    Each element carries an unknown attribute (`TerminalName`), a stale
    `NbBikes` that a later one overrides, and attributes stamped up to the
    event instant; the newest `modified` is the event instant itself (UTC).
    """
    ts = F.col("ts")

    def prop(key: str, value: Column, modified: Column, category: str = "Description") -> Column:
        return F.struct(
            F.lit(category).alias("category"),
            F.lit(key).alias("key"),
            F.lit("BikePoints").alias("sourceSystemKey"),
            value.cast("string").alias("value"),
            _iso(modified).alias("modified"),
        )

    older = ts - F.expr("INTERVAL 90 SECONDS")
    props = F.array(
        prop("TerminalName", F.col("event_id") % 100000, older),
        prop("Installed", F.col("Installed"), older),
        prop("Locked", F.col("Locked"), older),
        prop("NbBikes", F.lit("999"), older),
        prop("NbBikes", F.col("NbBikes"), ts),
        prop("NbEBikes", F.col("NbEBikes"), older),
        prop("NbEmptyDocks", F.col("NbEmptyDocks"), ts),
        prop("NbDocks", F.col("NbDocks"), older),
    )
    return rows.select(
        "event_id",
        "id",
        F.col("common_name").alias("commonName"),
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
        props.alias("additionalProperties"),
        *keep,
    )
