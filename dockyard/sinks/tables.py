"""History table, staging table and materialised views on Parquet.

* History: partitioned by `extraction_date`, rebalanced on the date before each
  append; rows sorted by point inside each file so row-group statistics skip
  on point and weekday filters.
* Staging: replaced on each batch run (written once, read by the load; this
  also cuts the lineage back to the topic).
* Summaries: partitioned by date like history; a refresh replaces only the
  dates that loads touched since the last one (dynamic partition overwrite).
  A load notes its dates before it adds rows; a refresh fixes the notes it will
  cover, and removes them when it is done. A skipped or failed refresh is made
  up for by the next one, and no log grows with the number of loads.
* Point totals (rows without a bike over all dates): kept by the difference of
  the touched dates' summary rows, new less stored. Which points are the top
  ten follows from them, so the non-availability view reads the touched dates,
  and all dates only of a point that was not among the ten before.
* Per-row views: queries over history, nothing is copied.
* Ranked views (peak hours, non-availability): small; each refresh writes a
  new version directory, and readers take the newest complete one. The last
  two versions stay. No table is overwritten by a plan that reads it.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockyard.operators.history import new_rows, on_dates_of
from dockyard.operators.summaries import (
    daily_points_summary,
    hourly_summary,
    non_availability_refreshed,
    peak_hours_from_summary,
)
from dockyard.operators.views import broken_docks_history, in_use_by_day
from dockyard.schema import HISTORY, HISTORY_KEY
from dockyard.sinks.files import children, exists, remove
from dockyard.sources.tables import read_history, scan

# Upper bound on rows per output file, so a date with a huge share of rows
# still lands in files of bounded size.
MAX_RECORDS_PER_FILE = 5_000_000

# A Bloom filter on the point in every row group, as large as its number of points calls for (1 MB at most):
# a filter on one point skips row groups whose least and greatest point do not rule it out.
POINT_BLOOM = {"parquet.bloom.filter.enabled#bike_point_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def history_ddl(name: str = "bike_points", location: str | None = None) -> str:
    """CREATE TABLE IF NOT EXISTS for the history table (types of HISTORY, partitioned by date)."""
    cols = ",\n  ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in HISTORY.fields)
    loc = f"\nLOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols}\n) USING parquet\nPARTITIONED BY (extraction_date){loc}"


def empty_like(df: DataFrame) -> DataFrame:
    """An empty relation with the schema of `df` (a schema-only select)."""
    return df.where(F.lit(False))


def write_staging(df: DataFrame, path: str) -> None:
    """Replace the staging table with `df`: history columns first, then any extra
    ones (e.g. the message offset that orders repeated keys)."""
    extra = [c for c in df.columns if c not in HISTORY.fieldNames()]
    df.select(*HISTORY.fieldNames(), *extra).write.mode("overwrite").parquet(path)


def append_history(df: DataFrame, path: str) -> None:
    """Append history rows, partitioned by date, point-sorted inside each file.

    Rows are rebalanced on the date first: without it every task writes a file
    into every date it holds (tasks × dates small files per load). With the
    rebalance, AQE packs each date into files of the advisory size and splits a
    date that holds a large share of the rows over several tasks.
    """
    (
        df.select(*HISTORY.fieldNames())
        .hint("rebalance", "extraction_date")
        .sortWithinPartitions("extraction_date", "bike_point_id", "extraction_datetime")
        .write.mode("append")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .options(**POINT_BLOOM)
        .partitionBy("extraction_date")
        .parquet(path)
    )


def insert_ignore(spark: SparkSession, staging: DataFrame, history_path: str,
                  order_by: tuple[str, ...] = ()) -> None:
    """Load staging into history; stored keys win, repeated staging keys collapse to the first by `order_by`.

    Only the history partitions of the staging dates are scanned for conflicts.
    Safe to rerun after a failure: keys already written are skipped. One writer
    at a time (there is no lock on plain files).
    """
    history = read_history(spark, history_path)
    append_history(new_rows(staging, history, HISTORY_KEY, order_by, prune_on="extraction_date"), history_path)


# The two summaries: columns and types a reader sees, also where nothing is stored yet.
SUMMARIES = {
    "summary_hourly": "extraction_date date, day_of_week string, day_of_week_number int, hour_interval string, "
                      "hour string, sum_empty_docks bigint, nb_empty_docks_rows bigint",
    "summary_daily_points": "bike_point_id string, extraction_date date, day_of_week_number int, "
                            "day_of_week string, nb_rows bigint, nb_rows_without_bikes bigint, "
                            "max_broken_docks int",
}
RANKED_VIEWS = {
    "mvw_peak_hours_by_day": "day_of_week string, num_day_of_week string, hour_interval string, "
                             "avg_nb_empty_docks decimal(4,2)",
    "mvw_non_availability_by_day": "num_day_of_week string, extraction_date date, bike_point_id string",
    "point_totals": "bike_point_id string, empty_rows bigint",
}
ROW_VIEWS = {"mvw_in_use_bikes_by_day": in_use_by_day, "mvw_broken_docks_history": broken_docks_history}
NOTES = "load_id string, extraction_date date"


def note_load(staging: DataFrame, views_path: str) -> None:
    """Note the dates that a load is about to touch, for the next refresh."""
    load_id = uuid.uuid4().hex
    dates = staging.select(F.lit(load_id).alias("load_id"), "extraction_date").distinct()
    dates.coalesce(1).write.parquet(f"{views_path}/_loads/{load_id}")


def _complete(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under `path` that were written to the end."""
    return [n for n in children(spark, path) if exists(spark, f"{path}/{n}/_SUCCESS")]


def _open_refresh(spark: SparkSession, views_path: str) -> tuple[str, DataFrame]:
    """The refresh's name and the notes that it covers: those of one that was not finished, or all notes so far.

    They are fixed first: a load that notes its dates meanwhile is left for the next refresh.
    """
    opened = _complete(spark, f"{views_path}/_open")
    name = opened[0] if opened else f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    path = f"{views_path}/_open/{name}"
    if not opened:
        loads = _complete(spark, f"{views_path}/_loads")
        notes = spark.createDataFrame([(n, None) for n in loads], NOTES)  # also loads without rows
        if loads:
            notes = notes.unionByName(spark.read.schema(NOTES).parquet(*[f"{views_path}/_loads/{n}" for n in loads]))
        notes.coalesce(1).write.parquet(path)
    return name, spark.read.schema(NOTES).parquet(path)


def _close_refresh(spark: SparkSession, views_path: str, name: str, notes: DataFrame) -> None:
    for (load_id,) in notes.select("load_id").distinct().collect():
        remove(spark, f"{views_path}/_loads/{load_id}")
    remove(spark, f"{views_path}/_pending")
    remove(spark, f"{views_path}/_open/{name}")


def _version(spark: SparkSession, views_path: str, name: str) -> str | None:
    """The newest complete version of a ranked view."""
    path = f"{views_path}/{name}"
    done = _complete(spark, path)
    return f"{path}/{done[-1]}" if done else None


def materialize(df: DataFrame, views_path: str, name: str, tag: str | None = None) -> str:
    """Write `df` as a new version of `name`; all but the last two complete versions are removed (small tables)."""
    spark = df.sparkSession
    path = f"{views_path}/{name}"
    version = f"{path}/v={time.time_ns():020d}-{tag or uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").parquet(version)
    for old in _complete(spark, path)[:-2]:
        remove(spark, f"{path}/{old}")
    return version


def read_view(spark: SparkSession, history_path: str, views_path: str, name: str) -> DataFrame:
    """Current content of a view or summary; empty before its first refresh."""
    if name in ROW_VIEWS:
        return ROW_VIEWS[name](read_history(spark, history_path))
    if name in SUMMARIES:
        return scan(spark, f"{views_path}/{name}", SUMMARIES[name])
    return scan(spark, _version(spark, views_path, name) or f"{views_path}/{name}/none", RANKED_VIEWS[name])


def _write_by_date(df: DataFrame, path: str, sort_by: tuple[str, ...] = ()) -> None:
    """Replace the dates present in `df` of a date-partitioned table."""
    (
        df.hint("rebalance", "extraction_date")  # few, full files per date (see append_history)
        .sortWithinPartitions("extraction_date", *sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy("extraction_date")
        .parquet(path)
    )


def _refresh_totals(spark: SparkSession, history_path: str, views_path: str, name: str, fresh: DataFrame,
                    todo: DataFrame) -> None:
    """Add to each point's total what the touched dates have gained, once per refresh even if it is repeated."""
    if (_version(spark, views_path, "point_totals") or "").endswith(name):
        return
    stored = on_dates_of(read_view(spark, history_path, views_path, "summary_daily_points"), todo)
    n = F.col("nb_rows_without_bikes")
    gains = fresh.select("bike_point_id", n.alias("n")).unionByName(stored.select("bike_point_id", (-n).alias("n")))
    totals = read_view(spark, history_path, views_path, "point_totals")
    totals = totals.withColumnRenamed("empty_rows", "n").unionByName(gains.groupBy("bike_point_id").agg(F.sum("n").alias("n")))
    totals = totals.groupBy("bike_point_id").agg(F.sum("n").alias("empty_rows"))
    materialize(totals, views_path, "point_totals", name)


def refresh_views(spark: SparkSession, history_path: str, views_path: str) -> dict[str, str]:
    """Bring the summaries and the ranked views up to date with history.

    The summaries' dates that noted loads touched since the last refresh are
    computed again, from those history partitions only. The peak hours come
    from the hourly summary (at most 24 rows a date), the non-availability view
    from the point totals and the touched dates' rows. Same result as a full
    rebuild; safe to repeat after a failure.
    """
    name, notes = _open_refresh(spark, views_path)
    todo = notes.where("extraction_date IS NOT NULL")
    scope = on_dates_of(read_history(spark, history_path), todo)
    out = {n: f"{views_path}/{n}" for n in SUMMARIES}
    daily_points_summary(scope).write.mode("overwrite").parquet(f"{views_path}/_pending/daily")
    fresh = scan(spark, f"{views_path}/_pending/daily", SUMMARIES["summary_daily_points"])
    _refresh_totals(spark, history_path, views_path, name, fresh, todo)
    _write_by_date(fresh, out["summary_daily_points"], ("bike_point_id",))
    _write_by_date(hourly_summary(scope), out["summary_hourly"])
    view = {n: read_view(spark, history_path, views_path, n) for n in (*SUMMARIES, *RANKED_VIEWS)}
    ranked = {
        "mvw_peak_hours_by_day": peak_hours_from_summary(view["summary_hourly"]),
        "mvw_non_availability_by_day": non_availability_refreshed(
            view["mvw_non_availability_by_day"], view["point_totals"], fresh, todo, view["summary_daily_points"]),
    }
    out.update({n: materialize(df, views_path, n) for n, df in ranked.items()})
    _close_refresh(spark, views_path, name, notes)
    return out
