"""The message topic: Kafka when a broker is configured, else files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dockyard.schema import WIRE


def message_reader_options(fmt: str, options: dict, streaming: bool, min_partitions: int | None = None) -> dict:
    """Options of a topic scan: a batch scan starts at the earliest retained offset, a stream at the latest.

    With a checkpoint, a restarted stream resumes from its committed offsets instead.
    `min_partitions` splits the offset ranges of few topic partitions into that
    many Spark tasks (a one-partition topic would otherwise be read by one task).
    """
    opts = dict(options)
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "latest" if streaming else "earliest")
        if not streaming:
            opts.setdefault("endingOffsets", "latest")
        if min_partitions:
            opts.setdefault("minPartitions", str(min_partitions))
    return opts


def read_messages(spark: SparkSession, fmt: str = "parquet", options: dict | None = None,
                  streaming: bool = False, max_files_per_trigger: int | None = None,
                  max_offsets_per_trigger: int | None = None, min_partitions: int | None = None) -> DataFrame:
    """Scan the topic; the result has at least `value` (binary JSON), `partition`, `offset`, `timestamp`.

    `min_partitions` is for a broker topic of few partitions; files split by the session's file settings
    (`spark.sql.files.maxPartitionBytes`, `spark.sql.files.minPartitionNum`).

    Streaming reads can bound each micro-batch (`maxOffsetsPerTrigger` for Kafka,
    `maxFilesPerTrigger` for files), so a restart after downtime does not turn
    the backlog into one huge batch.
    """
    opts = message_reader_options(fmt, options or {}, streaming, min_partitions)
    path = opts.pop("path", None)
    if streaming:
        r = spark.readStream.format(fmt).options(**opts)
        if fmt == "kafka":
            if max_offsets_per_trigger:
                r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        else:
            r = r.schema(WIRE)
            if max_files_per_trigger:
                r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.load(path) if path is not None else r.load()
    r = spark.read.format(fmt).options(**opts)
    if fmt == "kafka":
        return r.load()
    return r.schema(WIRE).load(path)
