"""Event-time windows over the topic: late and repeated messages, and chains of stateful operators.

Append mode throughout: a window's rows are put out once, when the watermark (the newest instant less `late_after`)
has passed its end, and never change. A message counts if its instant is later than the watermark that the data
before it had set; messages that arrive later than that are dropped, and so are repeated ones (`keys`) for as long as the watermark lets
them arrive at all. State is bounded by what can still change: about `late_after` of messages, and one window's points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockyard.config import STREAM_TRIGGER
from dockyard.functions import broken_docks
from dockyard.operators.decode import decode_messages
from dockyard.operators.metrics import COUNT_COLUMNS, fleet_metrics
from dockyard.schema import ARRIVAL
from dockyard.sources.tables import scan
from dockyard.streaming.metrics_stream import SPEED_FIELDS

_COUNTS = ", ".join(f"{c} int" for c in COUNT_COLUMNS)
STATES = f"window_start timestamp, id string, {_COUNTS}, extraction_datetime timestamp"
MOVES = "window_start timestamp, id string, before int, after int"


def window_states(messages: DataFrame, width: str, late_after: str,
                  keys: tuple[str, ...] = ("id", "extraction_datetime")) -> DataFrame:
    """Dedup within the watermark, then the newest state per (window, point): two chained stateful operators."""
    keep = tuple(c for c in ARRIVAL if c in messages.columns)
    msgs = decode_messages(messages, keep=keep, fields=SPEED_FIELDS, single_parse=True)
    msgs = msgs.where(F.col("id").isNotNull() & F.col("extraction_datetime").isNotNull())
    msgs = msgs.withWatermark("extraction_datetime", late_after).dropDuplicatesWithinWatermark(list(keys))
    msgs = msgs.withColumn("NbBrokenDocks", broken_docks())
    newest = F.max_by(F.struct(*COUNT_COLUMNS), F.struct("extraction_datetime", *keep))
    return msgs.groupBy(F.window("extraction_datetime", width), "id").agg(
        newest.alias("state"), F.max("extraction_datetime").alias("newest")
    )


def moves(messages: DataFrame, width: str, late_after: str,
          keys: tuple[str, ...] = ("id", "extraction_datetime")) -> DataFrame:
    """Bikes of each point in a window and in the next one: dedup, windowed newest state, then a join of both streams.

    The join's range condition on the windows' event times lets Spark drop a window's points from the join's state
    as soon as the next window has passed.
    """
    side = lambda p: window_states(messages, width, late_after, keys).select(
        F.col("id").alias(f"{p}_id"), F.col("window.start").alias(f"{p}_start"), F.col("window.end").alias(f"{p}_end"),
        F.window_time("window").alias(f"{p}_time"), F.col("state.NbBikes").alias(p),
    )
    wide = F.expr(f"INTERVAL {width}")
    on = (F.col("before_id") == F.col("after_id")) & (F.col("before_end") == F.col("after_start"))
    on = on & (F.col("after_time") >= F.col("before_time")) & (F.col("after_time") <= F.col("before_time") + wide)
    joined = side("before").join(side("after"), on)
    return joined.select(F.col("after_start").alias("window_start"), F.col("after_id").alias("id"), "before", "after")


def _run(rows: DataFrame, sink_path: str, checkpoint: str, trigger: str | dict) -> StreamingQuery:
    w = rows.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if isinstance(trigger, dict) else w.trigger(processingTime=trigger)).start(sink_path)


def run_windows_stream(messages: DataFrame, width: str, late_after: str, sink_path: str, checkpoint: str,
                       trigger: str | dict = STREAM_TRIGGER,
                       keys: tuple[str, ...] = ("id", "extraction_datetime")) -> StreamingQuery:
    """Start the stream of closed windows: one row per window and point, appended once to the Parquet sink."""
    rows = window_states(messages, width, late_after, keys)
    rows = rows.select(F.col("window.start").alias("window_start"), "id", "state.*", F.col("newest").alias("extraction_datetime"))
    return _run(rows, sink_path, checkpoint, trigger)


def window_metrics(spark: SparkSession, sink_path: str) -> DataFrame:
    """Fleet metrics of each closed window (`window_start` and the metrics' columns)."""
    return fleet_metrics(scan(spark, sink_path, STATES), group="window_start")


def run_moves_stream(messages: DataFrame, width: str, late_after: str, sink_path: str, checkpoint: str,
                     trigger: str | dict = STREAM_TRIGGER,
                     keys: tuple[str, ...] = ("id", "extraction_datetime")) -> StreamingQuery:
    """Start the stream of `moves`, appended to the Parquet sink."""
    return _run(moves(messages, width, late_after, keys), sink_path, checkpoint, trigger)


def turnover(spark: SparkSession, sink_path: str) -> DataFrame:
    """Per window: points also seen in the window before, bikes that came to and left them since."""
    gain = F.col("after") - F.col("before")
    return scan(spark, sink_path, MOVES).groupBy("window_start").agg(
        F.count(F.lit(1)).alias("nb_points"),
        F.sum(F.greatest(gain, F.lit(0))).alias("nb_arrived"),
        F.sum(F.greatest(-gain, F.lit(0))).alias("nb_left"),
    )
