"""Publish messages to the topic (Kafka, or Parquet files with the same `value` column)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def kafka_writer_options(servers: str, topic: str, extra: dict | None = None) -> dict:
    """Options of a Kafka write; messages carry no key (the broker spreads them)."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, **(extra or {})}


def write_messages(df: DataFrame, fmt: str = "parquet", options: dict | None = None) -> None:
    """Append encoded messages (`value`, plus any other wire columns for file topics)."""
    opts = dict(options or {})
    if fmt == "kafka":
        df.select("value").write.format("kafka").options(**opts).save()
        return
    path = opts.pop("path")
    df.write.mode("append").format(fmt).options(**opts).save(path)
