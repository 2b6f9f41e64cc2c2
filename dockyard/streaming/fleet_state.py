"""Fleet totals with each point's newest state carried from poll to poll, and across micro-batches.

A stateful aggregation keeps the newest state of every (poll, point) in the state store and puts out, per micro-batch,
those that it changed (update mode). Each micro-batch stores them as a layer, and from the difference to what the
layers before say, the changes of the fleet's totals: where a point's report in poll p changes by d, the totals from
p on change by d, up to the point's next report, which already stood for itself. `totals` are thus kept as one row of
differences per poll and micro-batch; nothing is ever summed over all points again. A poll split over micro-batches, a micro-batch of
many polls and reports that arrive out of order give the same rows.

Layout under `root`: `reports/b<number>/` and `deltas/b<number>/`, one folder per micro-batch. Every `fold_every`
micro-batches the layers so far are folded into one (`.../f<number>/`), so a micro-batch reads the last fold and
fewer than twice `fold_every` layers. A replayed micro-batch replaces its own layers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockyard.config import STREAM_TRIGGER
from dockyard.functions import broken_docks, percent_of
from dockyard.operators.decode import decode_messages
from dockyard.operators.metrics import COUNT_COLUMNS, REPORTED
from dockyard.schema import ARRIVAL
from dockyard.sinks.files import children, exists, remove
from dockyard.streaming.metrics_stream import SPEED_FIELDS

_COUNTS = ", ".join(f"{c} int" for c in COUNT_COLUMNS)
REPORTS = f"poll timestamp, id string, {_COUNTS}, extraction_datetime timestamp, layer bigint"
DELTAS = "poll timestamp, " + ", ".join(f"{c} bigint" for c in COUNT_COLUMNS) + ", nb_points bigint"
FOLD_EVERY = 50


def newest_reports(messages: DataFrame, poll_length: str, late_after: str | None = None) -> DataFrame:
    """Per poll (a window of `poll_length` over the instant) and point, the newest state; a streaming aggregation.

    Messages without id or instant take no part. With `late_after`, polls that ended so long before the newest
    instant leave the state store, and messages for them are dropped; without it the state grows with the polls.
    """
    keep = tuple(c for c in ARRIVAL if c in messages.columns)
    msgs = decode_messages(messages, keep=keep, fields=SPEED_FIELDS, single_parse=True)
    msgs = msgs.where(F.col("id").isNotNull() & F.col("extraction_datetime").isNotNull())
    if late_after:
        msgs = msgs.withWatermark("extraction_datetime", late_after)
    msgs = msgs.withColumn("NbBrokenDocks", broken_docks())
    newest = F.max_by(F.struct(*COUNT_COLUMNS), F.struct("extraction_datetime", *keep))
    found = msgs.groupBy(F.window("extraction_datetime", poll_length).alias("w"), "id").agg(
        newest.alias("state"), F.max("extraction_datetime").alias("extraction_datetime")
    )
    return found.select(F.col("w.start").alias("poll"), "id", "state.*", "extraction_datetime")


def _layers(spark: SparkSession, path: str, before: int | None = None) -> list[tuple[str, int]]:
    """(folder, number) of the newest complete fold and the layers after it, with numbers under `before`."""
    found = [(n, int(n[1:])) for n in children(spark, path) if exists(spark, f"{path}/{n}/_SUCCESS")]
    found = [x for x in found if before is None or x[1] < before]
    fold = max((x for x in found if x[0][0] == "f"), key=lambda x: x[1], default=None)
    later = [x for x in found if x[0][0] == "b" and (fold is None or x[1] > fold[1])]
    return ([fold] if fold else []) + sorted(later)


def _read(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    folders = [f"{path}/{name}" for name, _ in _layers(spark, path, before)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def reports(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The newest state of every (poll, point): the last layer that has it."""
    rows = _read(spark, f"{root}/reports", REPORTS, before)
    last = F.max_by(F.struct(*COUNT_COLUMNS, "extraction_datetime", "layer"), "layer").alias("last")
    return rows.groupBy("poll", "id").agg(last).select("poll", "id", "last.*")


def deltas(changed: DataFrame, known: DataFrame) -> DataFrame:
    """One row per poll whose totals' differences change as reports `known` become those of `changed`."""
    state = F.struct(*COUNT_COLUMNS)
    first = changed.groupBy("id").agg(F.min("poll").alias("first"))
    own = known.join(first, "id")  # of the changed points alone
    later = own.where("poll >= first").select("id", "poll", state.alias("old"))
    prior = own.where("poll < first").groupBy("id").agg(F.max_by(F.struct("poll", state.alias("old")), "poll").alias("r"))
    line = later.unionByName(prior.select("id", "r.poll", "r.old"))
    line = line.join(changed.select("id", "poll", state.alias("new")), ["id", "poll"], "full")
    so_far = Window.partitionBy("id").orderBy("poll").rowsBetween(Window.unboundedPreceding, 0)
    line = line.select(
        "id", "poll",
        F.last("old", ignorenulls=True).over(so_far).alias("old"),
        F.last(F.coalesce("new", "old"), ignorenulls=True).over(so_far).alias("new"),
    )
    by_poll = Window.partitionBy("id").orderBy("poll")
    zero = F.lit(0).cast("bigint")
    gains = {c: F.coalesce(F.col("new")[c], zero) - F.coalesce(F.col("old")[c], zero) for c in COUNT_COLUMNS}
    gains["nb_points"] = F.col("new").isNotNull().cast("bigint") - F.col("old").isNotNull().cast("bigint")
    line = line.select("id", "poll", *[g.alias(c) for c, g in gains.items()])
    # A gain holds from its poll on; at the next report the gain there takes its place.
    steps = [(F.col(c) - F.coalesce(F.lag(c).over(by_poll), zero)).alias(c) for c in gains]
    return line.select("poll", *steps).groupBy("poll").agg(*[F.sum(c).alias(c) for c in gains])


def fold(spark: SparkSession, root: str, through: int) -> None:
    """All layers up to `through` as one; what the fold before it had made needless goes."""
    last = reports(spark, root, through + 1)
    last.write.mode("overwrite").parquet(f"{root}/reports/f{through:012d}")
    added = _read(spark, f"{root}/deltas", DELTAS, through + 1)
    sums = added.groupBy("poll").agg(*[F.sum(c).alias(c) for c in added.columns[1:]])
    sums.coalesce(1).write.mode("overwrite").parquet(f"{root}/deltas/f{through:012d}")
    for name in ("reports", "deltas"):
        folds = sorted(int(n[1:]) for n in children(spark, f"{root}/{name}") if n[0] == "f")
        for n in children(spark, f"{root}/{name}"):
            if len(folds) > 1 and int(n[1:]) <= folds[-2] and n != f"f{folds[-2]:012d}":
                remove(spark, f"{root}/{name}/{n}")


def run_fleet_stream(messages: DataFrame, poll_length: str, root: str, checkpoint: str,
                     trigger: str | dict = STREAM_TRIGGER, late_after: str | None = None,
                     fold_every: int = FOLD_EVERY) -> StreamingQuery:
    """Start the stream that keeps reports and differences under `root`; a restart goes on where it stopped."""

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        layer = f"{root}/reports/b{batch_id:012d}"
        batch.withColumn("layer", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(layer)
        changed = spark.read.schema(REPORTS).parquet(layer)
        steps = deltas(changed, reports(spark, root, batch_id))
        steps.coalesce(1).write.mode("overwrite").parquet(f"{root}/deltas/b{batch_id:012d}")
        if (batch_id + 1) % fold_every == 0:
            fold(spark, root, batch_id)

    w = newest_reports(messages, poll_length, late_after).writeStream.outputMode("update")
    w = w.option("checkpointLocation", checkpoint).foreachBatch(process)
    return (w.trigger(**trigger) if isinstance(trigger, dict) else w.trigger(processingTime=trigger)).start()


def fleet_history(spark: SparkSession, root: str) -> DataFrame:
    """One row of fleet metrics per poll: totals over every point seen so far, each in its newest state.

    min/max are the instants of the points that reported in the poll; `nb_points` counts all points seen. The running
    sum passes one row per poll.
    """
    steps = _read(spark, f"{root}/deltas", DELTAS)
    steps = steps.groupBy("poll").agg(*[F.sum(c).alias(c) for c in steps.columns[1:]])
    so_far = Window.orderBy("poll").rowsBetween(Window.unboundedPreceding, 0)
    totals = steps.select("poll", *[F.sum(c).over(so_far).alias(c) for c in steps.columns[1:]])
    instants = reports(spark, root).groupBy("poll").agg(
        F.min("extraction_datetime").alias("min_extraction_datetime"),
        F.max("extraction_datetime").alias("max_extraction_datetime"),
    )
    out = []
    for src, name in REPORTED:
        out += [F.col(src).alias(f"nb_{name}"), percent_of(src, "NbDocks").alias(f"percentage_{name}")]
    both = totals.join(instants, "poll")
    return both.select("poll", "min_extraction_datetime", "max_extraction_datetime", *out, "nb_points")
