"""Metrics store on Parquet: one file per micro-batch under its write date, compacted to one file per date.

Layout `path/log/written_date=<yyyy-mm-dd>/` for what streams append and
`path/daily/written_date=<yyyy-mm-dd>/` for compacted dates. Every row carries
the stream's id and its micro-batch id, and nothing is ever overwritten: a
replayed micro-batch, or a stream that starts over on a new checkpoint, adds
rows, and readers fold them by key (the last write wins). Rows live 24 h;
`compact_metrics` merges past dates and removes expired ones.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockyard.config import METRICS_TTL_SECONDS
from dockyard.operators.retention import instant
from dockyard.schema import METRICS, METRICS_KEY, METRICS_STORED
from dockyard.sinks.files import children, remove
from dockyard.sources.tables import metrics_files


def metrics_ddl(name: str = "metrics", location: str | None = None) -> str:
    """CREATE TABLE IF NOT EXISTS for the compacted metrics store (partitioned by write date)."""
    cols = ",\n  ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in METRICS_STORED.fields)
    loc = f"\nLOCATION '{location}'" if location else ""
    return (f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols},\n  written_date DATE\n)"
            f" USING parquet\nPARTITIONED BY (written_date){loc}")


def write_metrics(metrics: DataFrame, path: str, batch_id: int, fmt: str = "parquet",
                  options: dict | None = None, written_date: str | None = None, run_id: str = "") -> None:
    """Store one batch's metrics rows, stamped with the write instant, the stream's id and the batch's.

    Parquet: appended to `path/log/written_date=<today, UTC>/` as one file. Connector
    formats (e.g. Cassandra) append; their key makes a replay an upsert.
    """
    rows = metrics.select(
        *METRICS.fieldNames(),
        F.current_timestamp().alias("written_at"),
        F.lit(run_id).alias("run_id"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )
    if fmt == "parquet":
        day = written_date or dt.datetime.now(dt.timezone.utc).date().isoformat()
        rows.coalesce(1).write.mode("append").parquet(f"{path}/log/written_date={day}")
    else:
        rows.select(*METRICS.fieldNames()).write.format(fmt).options(**(options or {})).mode("append").save()


def compact_metrics(spark: SparkSession, path: str, as_of=None, ttl_seconds: int = METRICS_TTL_SECONDS) -> list[str]:
    """Merge the log's past write dates into one file per date, newest row per key, and remove expired dates.

    Past means before the date of `as_of` (now by default) in UTC: no stream appends there any more. A date goes
    when its last instant is `ttl_seconds` and a day old. Safe to repeat after a failure: a date is removed from
    the log after it was written, and a row that stands in both is folded on read. Returns the merged dates.
    """
    at = spark.range(1).select(F.unix_seconds(instant(as_of))).first()[0]
    day = lambda s: dt.datetime.fromtimestamp(s, dt.timezone.utc).date().isoformat()
    today, last = day(at), day(at - ttl_seconds - 86_400)
    dates = [d for name in children(spark, f"{path}/log") if (d := name.removeprefix("written_date=")) < today]
    merged = [d for d in dates if d >= last]
    newest = F.max_by(F.struct(*METRICS_STORED.fieldNames()), F.struct("written_at", "run_id", "batch_id"))
    for d in merged:
        rows = metrics_files(spark, path).where(F.col("written_date") == F.lit(d).cast("date"))
        rows = rows.groupBy(*METRICS_KEY).agg(newest.alias("m")).select("m.*")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/_compacting/written_date={d}")
        done = spark.read.schema(METRICS_STORED).parquet(f"{path}/_compacting/written_date={d}")
        done.coalesce(1).write.mode("overwrite").parquet(f"{path}/daily/written_date={d}")
    for d in dates:
        remove(spark, f"{path}/log/written_date={d}")
    for name in children(spark, f"{path}/daily"):
        if name.removeprefix("written_date=") < last:
            remove(spark, f"{path}/daily/{name}")
    remove(spark, f"{path}/_compacting")
    return merged
