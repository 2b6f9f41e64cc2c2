"""The jobs: set-up, stage (snapshot -> topic), batch (topic -> history -> views), speed (topic -> metrics) and
the metrics store's upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockyard.config import STREAM_TRIGGER, Config
from dockyard.operators.enrich import enrich, history_from_wire
from dockyard.operators.staging import encode_messages, flatten_snapshot
from dockyard.operators.triage import observed, triage
from dockyard.schema import ARRIVAL, WIRE
from dockyard.sinks.files import exists
from dockyard.sinks.jdbc import write_jdbc
from dockyard.sinks.messages import kafka_writer_options, write_messages
from dockyard.sinks.metrics import compact_metrics, metrics_ddl
from dockyard.sinks.tables import (
    empty_like,
    history_ddl,
    insert_ignore,
    note_load,
    refresh_views,
    write_staging,
)
from dockyard.sinks.zones import note_zones
from dockyard.sources.messages import read_messages
from dockyard.sources.snapshots import read_snapshots
from dockyard.sources.tables import read_history
from dockyard.streaming.metrics_stream import run_metrics_stream


def setup_job(spark: SparkSession, cfg: Config, database: str = "dockyard") -> None:
    """Once per warehouse: the catalog's tables over its folders, and an empty staging table like history."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{cfg.warehouse}/_database'")
    spark.sql(history_ddl(f"{database}.bike_points", cfg.history_path))
    spark.sql(metrics_ddl(f"{database}.metrics", f"{cfg.metrics_path}/daily"))
    if not exists(spark, cfg.staging_path):
        write_staging(empty_like(read_history(spark, cfg.history_path)), cfg.staging_path)


def stage_job(spark: SparkSession, cfg: Config, snapshots_path: str | None = None,
              incremental: bool = True) -> None:
    """Landed snapshot files -> flat JSON messages on the topic.

    Default: a file stream over the landing directory with a checkpoint and an
    `availableNow` trigger, so each snapshot file is staged once across runs, as
    each poll is published once. `incremental=False`: one batch over every
    landed file, also those staged before.
    """
    raw = read_snapshots(spark, snapshots_path or cfg.landing_dir, streaming=incremental)
    flat = flatten_snapshot(raw, cfg.tz)
    if not incremental:
        publish(flat, cfg)
        return
    w = flat.writeStream.foreachBatch(lambda batch, _id: publish(batch, cfg))
    w.option("checkpointLocation", cfg.checkpoint("stage")).trigger(availableNow=True).start().awaitTermination()


def publish(flat: DataFrame, cfg: Config) -> None:
    """Append flat messages to the topic: Kafka, or files with the columns a broker would add.

    In files the publishing instant stands in for the broker's timestamp and
    orders the runs; within one run the task is the partition and its counter
    the offset, so no two messages share all three. A micro-batch replayed
    after a failure may publish again, as a producer's retry does; the load
    keeps the first message of a key.
    """
    if cfg.kafka_servers:
        write_messages(encode_messages(flat), "kafka", kafka_writer_options(cfg.kafka_servers, cfg.topic))
        return
    framed = (
        flat.withColumn("partition", F.spark_partition_id())
        .withColumn("offset", F.monotonically_increasing_id())
        .withColumn("timestamp", F.current_timestamp())
    )
    write_messages(encode_messages(framed, keep=ARRIVAL).select(*WIRE.fieldNames()), "parquet", {"path": cfg.topic_dir})


def sort_out(spark: SparkSession, cfg: Config, msgs: DataFrame, batch_id: int) -> tuple[DataFrame, dict]:
    """Triage of one load's messages: the good ones, decoded, and the numbers counted on the way.

    All are decoded and stored once; the rejected ones go to the quarantine, with reason and arrival, under the load's
    number, so that a load that is repeated replaces its own.
    """
    counts = Observation()
    path = f"{cfg.warehouse}/_triage"
    observed(triage(msgs, ARRIVAL), counts).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    bad = rows.where("reason IS NOT NULL").select("value", *ARRIVAL, "reason")
    bad.write.mode("overwrite").parquet(f"{cfg.quarantine_path}/load={batch_id}")
    return rows.where("reason IS NULL").drop("reason", "value"), counts.get


def load_messages(spark: SparkSession, cfg: Config, msgs: DataFrame, refresh: bool = True,
                  quarantine: int | None = None) -> dict:
    """One load: messages -> staging (replaced) -> insert-ignore into history -> zone map -> view refresh.

    Staging is written before the load, so the load reads a stored table and
    never goes back to the topic. Among messages with one key the first to
    arrive counts. The refresh covers the dates of this load and of earlier
    ones that went without it. With `quarantine` (a number of the load) rejected
    messages are kept (see `sort_out`) and their numbers returned.
    """
    if quarantine is None:
        rows, counts = history_from_wire(msgs, keep=ARRIVAL), {}
    else:
        good, counts = sort_out(spark, cfg, msgs, quarantine)
        rows = enrich(good, ARRIVAL)
    write_staging(rows, cfg.staging_path)
    staging = spark.read.parquet(cfg.staging_path)
    if cfg.jdbc_url:
        write_jdbc(staging.drop(*ARRIVAL), cfg.jdbc_url, "stg_bike_points", cfg.jdbc_properties(), "overwrite",
                   num_partitions=cfg.jdbc_connections)
    note_load(staging, cfg.views_path)
    insert_ignore(spark, staging, cfg.history_path, order_by=ARRIVAL)
    note_zones(spark, cfg.history_path, cfg.zones_path, staging)
    if refresh:
        refresh_views(spark, cfg.history_path, cfg.views_path)
    return counts


def batch_job(spark: SparkSession, cfg: Config, refresh: bool = True, incremental: bool = False,
              quarantine: bool = False) -> dict:
    """Topic -> staging -> insert-ignore into history -> refresh the four views.

    Default: one batch scan of everything the topic retains (the original
    daily run; already-stored keys are skipped). `incremental=True` runs the
    same load under Structured Streaming with an `availableNow` trigger and a
    checkpoint: each message is read once across runs instead of re-reading
    the whole retention every day. Any failure stops the chain. With
    `quarantine`, messages that the validity filter leaves out are stored with
    the reason; returned are the numbers of good and rejected messages (the
    whole topic is number 0, each incremental micro-batch has its own).
    """
    fmt, opts = cfg.message_source()
    if not incremental:
        return load_messages(spark, cfg, read_messages(spark, fmt, opts), refresh, 0 if quarantine else None)
    if fmt == "kafka":
        opts = {**opts, "startingOffsets": "earliest"}
    stream = read_messages(spark, fmt, opts, streaming=True)
    total: dict = {}

    def load(batch: DataFrame, batch_id: int) -> None:
        for name, n in load_messages(spark, cfg, batch, refresh, batch_id if quarantine else None).items():
            total[name] = total.get(name, 0) + n

    w = stream.writeStream.option("checkpointLocation", cfg.checkpoint("batch")).foreachBatch(load)
    w.trigger(availableNow=True).start().awaitTermination()
    return total


def compact_job(spark: SparkSession, cfg: Config, as_of=None) -> list[str]:
    """Daily upkeep of the file metrics store: past dates become one file each, expired ones go."""
    return compact_metrics(spark, cfg.metrics_path, as_of)


def speed_job(spark: SparkSession, cfg: Config, trigger: str | dict = STREAM_TRIGGER,
              late_after: str | None = None, wait: bool = True) -> StreamingQuery:
    """Topic stream -> one metrics row per micro-batch in the metrics store of the configuration."""
    fmt, opts = cfg.message_source()
    msgs = read_messages(spark, fmt, opts, streaming=True)
    store, store_opts = cfg.metrics_sink()
    q = run_metrics_stream(msgs, cfg.metrics_path, cfg.checkpoint("speed"), trigger, late_after,
                           fmt=store, options=store_opts)
    if wait:
        q.awaitTermination()
    return q
