"""Date-keyed summaries of the history table, so the stored views refresh per touched date.

Two of the four views need the whole history: the peak-hours view (averages
per weekday and hour) and the non-availability view (rows without a bike per
point, then the dates of the top points). Both are computed here from small
summary tables keyed by `extraction_date`, the partition column of history:

* `hourly`: per (date, weekday, weekday number, two-hour slot, hour), the sum
  and non-null count of empty docks (at most 24 rows per date);
* `daily_points`: per (point, date, weekday number, weekday), rows, rows
  without a bike and the most broken docks (points × dates rows, far below
  the history's size).

A load recomputes the summary rows of the dates it touched, from those history
partitions only, and keeps the other dates' rows (stored partitioned by date
and replaced with a dynamic partition overwrite). This is exact and idempotent: a rerun after a
failure recomputes the same dates from what history holds. Views and the two
history-sized charts computed from summaries equal those from the full history
(`tests/test_summaries.py`, registry queries `*_from_summaries`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockyard.functions import day_label

HOURLY_KEYS = ("extraction_date", "day_of_week", "day_of_week_number", "hour_interval", "hour")
DAILY_KEYS = ("bike_point_id", "extraction_date", "day_of_week_number", "day_of_week")


def hourly_summary(hist: DataFrame) -> DataFrame:
    """Sum and non-null count of empty docks per date and hour."""
    return hist.groupBy(*HOURLY_KEYS).agg(
        F.sum("nb_empty_docks").cast("bigint").alias("sum_empty_docks"),
        F.count("nb_empty_docks").alias("nb_empty_docks_rows"),
    )


def daily_points_summary(hist: DataFrame) -> DataFrame:
    """Rows, rows without a bike, and the most broken docks per point and date."""
    return hist.groupBy(*DAILY_KEYS).agg(
        F.count(F.lit(1)).alias("nb_rows"),
        F.count(F.when(F.col("nb_bikes") == 0, F.lit(1))).alias("nb_rows_without_bikes"),
        F.max("nb_broken_docks").alias("max_broken_docks"),
    )


def peak_hours_from_summary(hourly: DataFrame, n: int = 3) -> DataFrame:
    """The peak-hours view from the hourly summary (exact average, dense rank <= n).

    Sums and counts add up over dates first (at most 7 × 24 groups remain).
    """
    per_hour = hourly.groupBy("day_of_week", "day_of_week_number", "hour_interval", "hour").agg(
        F.sum("sum_empty_docks").alias("s"), F.sum("nb_empty_docks_rows").alias("c")
    )
    s, c = F.col("s").cast("decimal(18,0)"), F.col("c").cast("decimal(18,0)")
    avg = F.when(F.col("c") > 0, s / c).cast("decimal(4,2)")
    w = Window.partitionBy("day_of_week").orderBy(F.col("avg_nb_empty_docks").desc_nulls_first())
    return (
        per_hour.select("day_of_week", "day_of_week_number", "hour_interval", avg.alias("avg_nb_empty_docks"))
        .select(
            "day_of_week",
            day_label("day_of_week_number", "day_of_week").alias("num_day_of_week"),
            "hour_interval",
            "avg_nb_empty_docks",
            F.dense_rank().over(w).alias("place"),
        )
        .where(F.col("place") <= n)
        .drop("place")
    )


def non_availability_from_summary(daily: DataFrame, n: int = 10, only_empty: bool = False) -> DataFrame:
    """The non-availability view from the per-point-and-date summary.

    Top `n` points by rows without a bike (ties: lower id), then their dates:
    every date with a row, or with `only_empty` only the dates with a row
    without a bike. The top side is bounded by `n` and broadcast.
    """
    top = (
        daily.groupBy("bike_point_id")
        .agg(F.sum("nb_rows_without_bikes").alias("empty_rows"))
        .where(F.col("empty_rows") > 0)
        .orderBy(F.desc("empty_rows"), F.asc("bike_point_id"))
        .limit(n)
        .select("bike_point_id")
    )
    rows = daily.where(F.col("nb_rows_without_bikes") > 0) if only_empty else daily
    return (
        rows.join(F.broadcast(top), "bike_point_id", "left_semi")
        .select(day_label("day_of_week_number", "day_of_week").alias("num_day_of_week"),
                "extraction_date", "bike_point_id")
        .distinct()
    )


def non_availability_refreshed(view: DataFrame, totals: DataFrame, fresh: DataFrame, touched: DataFrame,
                               daily: DataFrame, n: int = 10) -> DataFrame:
    """The non-availability view after some dates were touched, from the view before.

    `totals` has every point's rows without a bike over all dates, `fresh` the per-point rows of the touched dates,
    `daily` those of all dates. Points that stay among the top `n` keep their rows of other dates and get those of the
    touched ones; only points new among them are looked up in `daily`, with a filter that reaches the scan. The ids
    brought to the driver are `n` at most on either side.
    """
    best = totals.where(F.col("empty_rows") > 0).orderBy(F.desc("empty_rows"), F.asc("bike_point_id")).limit(n)
    top = {r.bike_point_id for r in best.select("bike_point_id").collect()}
    before = {r.bike_point_id for r in view.select("bike_point_id").distinct().collect()}
    of = lambda df, ids: df.where(F.col("bike_point_id").isin(sorted(ids)) if ids else F.lit(False))
    label = day_label("day_of_week_number", "day_of_week").alias("num_day_of_week")
    rows = of(fresh, top & before).select(label, "extraction_date", "bike_point_id")
    kept = of(view, top & before).join(touched.select("extraction_date").distinct(), "extraction_date", "left_anti")
    out = rows.unionByName(kept.select(*rows.columns))
    if top - before:
        out = out.unionByName(of(daily, top - before).select(label, "extraction_date", "bike_point_id"))
    return out.distinct()


def avg_in_use_from_summary(hourly: DataFrame) -> DataFrame:
    """Bar chart (average bikes in use per weekday) from the hourly summary.

    Equal to the average over every history row: the integer sum and the
    non-null count add up exactly, and the one division happens at the end.
    """
    return hourly.groupBy("day_of_week_number", "day_of_week").agg(
        F.try_divide(F.sum("sum_empty_docks").cast("double"), F.sum("nb_empty_docks_rows")).alias("avg_in_use_bikes")
    ).select(day_label("day_of_week_number", "day_of_week").alias("num_day_of_week"), "day_of_week",
             "avg_in_use_bikes")


def broken_docks_by_date_from_summary(daily: DataFrame) -> DataFrame:
    """Line chart (most broken docks per date) from the per-point-and-date summary."""
    return daily.groupBy("extraction_date").agg(F.max("max_broken_docks").alias("max_nb_broken_docks"))
