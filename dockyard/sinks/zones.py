"""Lookup aids over history files: a zone map per file, for points, weekdays and days of the month.

Each history file has one row with the least and greatest point and instant and bitmaps of its weekdays and days of
the month, stored by date. A lookup reads the files that the map does not rule out, and of these the row groups that
Parquet's statistics and the Bloom filter on the point leave (`sinks.tables.POINT_BLOOM`).
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockyard.operators.history import on_dates_of
from dockyard.schema import HISTORY
from dockyard.sinks.files import exists
from dockyard.sources.tables import read_history, scan

ZONES = ("path string, nb_rows bigint, least_point string, greatest_point string, first_instant timestamp, "
         "last_instant timestamp, weekdays int, month_days int, extraction_date date")


def _bits(numbers: Column) -> Column:
    return F.bit_or(F.call_function("shiftleft", F.lit(1), numbers))


def note_zones(spark: SparkSession, history_path: str, zones_path: str, touched: DataFrame) -> None:
    """Bring the zone map up to date for the dates that `touched` holds (their entries are replaced)."""
    if not exists(spark, history_path):
        return
    history = spark.read.schema(HISTORY).parquet(history_path).select(
        "bike_point_id", "extraction_datetime", "extraction_date", "day_of_week_number", "day_of_month",
        F.col("_metadata.file_path").alias("path"),
    )
    zones = on_dates_of(history, touched).groupBy("path", "extraction_date").agg(
        F.count(F.lit(1)).alias("nb_rows"),
        F.min("bike_point_id").alias("least_point"),
        F.max("bike_point_id").alias("greatest_point"),
        F.min("extraction_datetime").alias("first_instant"),
        F.max("extraction_datetime").alias("last_instant"),
        _bits(F.col("day_of_week_number")).alias("weekdays"),
        _bits(F.col("day_of_month")).alias("month_days"),
    )
    zones.hint("rebalance", "extraction_date").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("extraction_date").parquet(zones_path)


def _mask(numbers) -> int:
    return sum(1 << n for n in set(numbers))


def files_for(spark: SparkSession, history_path: str, zones_path: str, points=(), weekdays=(), month_days=(),
              first=None, last=None) -> list[str]:
    """The history files that may hold rows asked for: those the zone map does not rule out or does not know yet.

    Empty `points`, `weekdays` or `month_days` ask for all; `first` and `last` bound the instant. The driver sees file
    names, as many as it lists for any scan of history.
    """
    zones = scan(spark, zones_path, ZONES)
    may = F.lit(True)
    if points:
        within = [(F.col("least_point") <= p) & (F.col("greatest_point") >= p) for p in points]
        may = within[0]
        for w in within[1:]:
            may = may | w
    if weekdays:
        may = may & (F.col("weekdays").bitwiseAND(F.lit(_mask(weekdays))) != 0)
    if month_days:
        may = may & (F.col("month_days").bitwiseAND(F.lit(_mask(month_days))) != 0)
    if first is not None:
        may = may & (F.col("last_instant") >= F.lit(first).cast("timestamp"))
    if last is not None:
        may = may & (F.col("first_instant") <= F.lit(last).cast("timestamp"))
    known = {_plain(r.path): r.may for r in zones.select("path", F.coalesce(may, F.lit(True)).alias("may")).collect()}
    return sorted(f for f in read_history(spark, history_path).inputFiles() if known.get(_plain(f), True))


def _plain(path: str) -> str:
    """A file's name whichever way it is written: `file:/a` and `file:///a`, with or without escapes."""
    return re.sub("^([A-Za-z0-9+.-]+):/+", r"\1:/", unquote(path))


def lookup(spark: SparkSession, history_path: str, zones_path: str, points=(), weekdays=(), month_days=(),
           first=None, last=None) -> DataFrame:
    """History rows of the given points, weekdays (1 = Sunday), days of the month and instants."""
    files = files_for(spark, history_path, zones_path, points, weekdays, month_days, first, last)
    if not files:
        return spark.createDataFrame([], HISTORY)
    rows = spark.read.schema(HISTORY).option("basePath", history_path).parquet(*map(unquote, files))
    for column, wanted in (("bike_point_id", points), ("day_of_week_number", weekdays), ("day_of_month", month_days)):
        if wanted:
            rows = rows.where(F.col(column).isin(list(wanted)))
    if first is not None:
        rows = rows.where(F.col("extraction_datetime") >= F.lit(first).cast("timestamp"))
    if last is not None:
        rows = rows.where(F.col("extraction_datetime") <= F.lit(last).cast("timestamp"))
    return rows.select(*HISTORY.fieldNames())
