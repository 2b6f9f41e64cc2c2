"""Scans of the stored tables (history, staging, metrics, materialised views)."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockyard.config import METRICS_TTL_SECONDS
from dockyard.operators.retention import instant
from dockyard.schema import HISTORY, METRICS_STORED


def scan(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet table with a fixed schema; empty where nothing is stored."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The history table (Parquet, partitioned by `extraction_date`); empty if absent.

    Filters on `extraction_date` prune partitions; other filters and the column
    list reach the Parquet scan.
    """
    return scan(spark, path, HISTORY)


# Stored metrics as laid out on disk: the row, then the partition column.
METRICS_ON_DISK = T.StructType([*METRICS_STORED.fields, T.StructField("written_date", T.DateType())])


def metrics_files(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the Parquet metrics store, with their write date."""
    log, daily = (scan(spark, f"{path}/{part}", METRICS_ON_DISK) for part in ("log", "daily"))
    return log.unionByName(daily)


def read_metrics(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                 options: dict | None = None, alive_at=None, ttl_seconds: int = METRICS_TTL_SECONDS) -> DataFrame:
    """Stored metrics rows; empty if absent.

    Parquet store: `path/log/written_date=<d>/` (a file per micro-batch, recent
    dates) and `path/daily/written_date=<d>/` (compacted dates). No directory is
    per batch, so a listing sees one per date. With `alive_at` (an instant; its
    text is read in the session's zone) only the write dates that can hold a row
    alive then are scanned: from the date of `alive_at` - `ttl_seconds` to that
    of `alive_at`, in UTC, and a day more on either side. A connector store
    (e.g. format "org.apache.spark.sql.cassandra" with keyspace/table options)
    applies its own row lifetime and key upserts.
    """
    if fmt != "parquet":
        return spark.read.format(fmt).options(**(options or {})).load()
    rows = metrics_files(spark, path)
    if alive_at is not None:
        at = spark.range(1).select(F.unix_seconds(instant(alive_at))).first()[0]
        day = lambda s: dt.datetime.fromtimestamp(s, dt.timezone.utc).date()
        one = dt.timedelta(days=1)
        rows = rows.where(F.col("written_date").between(F.lit(day(at - ttl_seconds) - one), F.lit(day(at) + one)))
    return rows.select(*METRICS_STORED.fieldNames())
