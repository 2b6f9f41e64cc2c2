"""Fleet metrics per micro-batch, written to the metrics store.

Each micro-batch is reduced on its own: newest state per docking point inside
the batch, then one row of fleet totals (nothing is carried across batches, so
a poll split over two triggers gives two partial rows, as in the original
design). The checkpoint is mandatory: a restart resumes after the last
committed batch instead of skipping what arrived while the job was down. Rows
carry the stream's and the batch's id; a replayed batch adds its row again and
readers fold the two.

`run_polls_stream` stores a batch's newest state per (poll, point) instead, and
`poll_metrics` reduces what is stored: one row per poll however its messages
were split over files and micro-batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockyard.config import STREAM_TRIGGER
from dockyard.functions import broken_docks
from dockyard.operators.decode import decode_messages
from dockyard.operators.metrics import COUNT_COLUMNS, fleet_metrics, latest_per_key
from dockyard.schema import ARRIVAL
from dockyard.sinks.metrics import write_metrics

# The message fields the speed path reads (name, position and flags are not parsed).
SPEED_FIELDS = ("id", "NbBikes", "NbEBikes", "NbEmptyDocks", "NbDocks", "extraction_datetime")


def _arrival(messages: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in ARRIVAL if c in messages.columns)


def metrics_batch_writer(sink_path: str, fmt: str = "parquet", options: dict | None = None,
                         decoded: bool = False, drop_invalid: bool = False):
    """The `foreachBatch` callback: decode (unless already decoded), reduce, write.

    One distributed job per micro-batch: the reduction runs inside the write.
    An empty micro-batch (no docking point seen) writes no row.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        msgs = batch if decoded else decode_messages(batch, keep=_arrival(batch), fields=SPEED_FIELDS)
        metrics = fleet_metrics(msgs, tiebreak=_arrival(msgs), drop_invalid=drop_invalid, with_points=True)
        run_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        write_metrics(metrics.where(F.col("nb_points") > 0), sink_path, batch_id, fmt, options, run_id=run_id)

    return process


def run_metrics_stream(messages: DataFrame, sink_path: str, checkpoint: str,
                       trigger: str | dict = STREAM_TRIGGER, late_after: str | None = None,
                       drop_invalid: bool = False, fmt: str = "parquet",
                       options: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    """Start the metrics stream over a streaming message DataFrame; returns the running query.

    `trigger`: a processing-time interval ("3 seconds") or a dict such as
    {"availableNow": True} for backfills and tests.
    `late_after`: off by default, so no late message is ever dropped. When set
    (e.g. "4 minutes"), a watermark on `extraction_datetime` drops messages
    later than that and repeated (id, instant) messages within it.
    """
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    stream, decoded = messages, False
    if late_after:
        stream = (
            decode_messages(messages, keep=_arrival(messages))
            .withWatermark("extraction_datetime", late_after)
            .dropDuplicatesWithinWatermark(["id", "extraction_datetime"])
        )
        decoded = True
    w = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(metrics_batch_writer(sink_path, fmt, options, decoded, drop_invalid))
    )
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**trigger) if isinstance(trigger, dict) else w.trigger(processingTime=trigger)
    return w.start()


def run_polls_stream(messages: DataFrame, poll: Column, sink_path: str, checkpoint: str,
                     trigger: str | dict = STREAM_TRIGGER) -> StreamingQuery:
    """Start a stream that keeps, per micro-batch, each point's newest state in each poll (`poll` of the message).

    A micro-batch may hold several polls and a poll may span several of them.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        msgs = decode_messages(batch, keep=ARRIVAL, fields=SPEED_FIELDS).withColumn("poll", poll)
        msgs = msgs.withColumn("NbBrokenDocks", broken_docks()).withColumn("arrival", F.struct(*ARRIVAL))
        newest = latest_per_key(msgs, ["poll", "id"], values=(*COUNT_COLUMNS, "arrival"), tiebreak="arrival")
        newest.write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}")

    w = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(process)
    return (w.trigger(**trigger) if isinstance(trigger, dict) else w.trigger(processingTime=trigger)).start()


def poll_metrics(spark: SparkSession, sink_path: str) -> DataFrame:
    """One row of fleet metrics per poll, out of the partial states that `run_polls_stream` stored."""
    return fleet_metrics(spark.read.parquet(sink_path), tiebreak="arrival", group="poll")
