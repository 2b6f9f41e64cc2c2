"""The four stored summaries of the history table, as queries over history rows.

The two per-row views are served from the stored history itself. The two
ranked views are stored by `dockyard.sinks.tables.refresh_views` after each
load, from the date-keyed summaries of `dockyard.operators.summaries` (same
results as these queries).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockyard.functions import day_label

VIEW_NAMES = (
    "mvw_in_use_bikes_by_day",
    "mvw_broken_docks_history",
    "mvw_peak_hours_by_day",
    "mvw_non_availability_by_day",
)


def _label() -> F.Column:
    return day_label("day_of_week_number", "day_of_week")


def in_use_by_day(hist: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per history row: weekday label, weekday, empty docks (= bikes in use)."""
    return hist.select(_label().alias("num_day_of_week"), "day_of_week", "nb_empty_docks", *keep)


def most_unavailable(hist: DataFrame, n: int = 10) -> DataFrame:
    """The `n` docking points with the most rows without a bike (ties: lower id first).

    A partial+final count, then a bounded top-n (TakeOrderedAndProject): at most
    `n` rows ever leave the aggregation.
    """
    return (
        hist.where(F.col("nb_bikes") == 0)
        .groupBy("bike_point_id")
        .agg(F.count("bike_point_id").alias("empty_rows"))
        .orderBy(F.desc("empty_rows"), F.asc("bike_point_id"))
        .limit(n)
    )


def non_availability_by_day(hist: DataFrame, n: int = 10, only_empty: bool = False) -> DataFrame:
    """Distinct (weekday label, date, point) of the `n` points most often without a bike.

    By default every date on which such a point reported is listed (the stored
    view's SQL); `only_empty=True` lists only the dates on which it had no bike.
    The top-n side has at most `n` rows, so it is broadcast into a left-semi join.
    """
    top = most_unavailable(hist, n).select("bike_point_id")
    rows = hist.where(F.col("nb_bikes") == 0) if only_empty else hist
    return (
        rows.join(F.broadcast(top), "bike_point_id", "left_semi")
        .select(_label().alias("num_day_of_week"), "extraction_date", "bike_point_id")
        .distinct()
    )


def exact_avg_2(col: str) -> F.Column:
    """avg(int column) rounded half-up to decimal(4,2), computed exactly in decimals.

    sum/count as decimal(18,0) divide to decimal(37,19); the final cast rounds
    once more. A double average could land a tie like 1.005 on 1.00. Averages
    of 100 or more do not fit decimal(4,2) and raise an error, as the stored
    view's type does.
    """
    s = F.sum(col).cast("decimal(18,0)")
    c = F.count(col).cast("decimal(18,0)")
    return (s / c).cast("decimal(4,2)")


def peak_hours_by_day(hist: DataFrame, n: int = 3) -> DataFrame:
    """Per weekday, the hours whose average empty docks rank in the top `n` (dense rank).

    Grouped by hour but reported by two-hour slot, so a slot can appear twice
    in a day; ties share a rank, so a day can have more than `n` rows. An
    all-null group ranks first (nulls first under descending order).
    """
    per_hour = hist.groupBy("day_of_week", "day_of_week_number", "hour_interval", "hour").agg(
        exact_avg_2("nb_empty_docks").alias("avg_nb_empty_docks")
    )
    w = Window.partitionBy("day_of_week").orderBy(F.col("avg_nb_empty_docks").desc_nulls_first())
    return (
        per_hour.select(
            "day_of_week",
            _label().alias("num_day_of_week"),
            "hour_interval",
            "avg_nb_empty_docks",
            F.dense_rank().over(w).alias("place"),
        )
        .where(F.col("place") <= n)
        .select("day_of_week", "num_day_of_week", "hour_interval", "avg_nb_empty_docks")
    )


def broken_docks_history(hist: DataFrame) -> DataFrame:
    """(date, weekday, broken docks) of every history row.

    No order: that of a stored view is no guarantee, and a global sort on the
    date would be a shuffle that a large date cannot split. A reader sorts what
    it shows.
    """
    return hist.select("extraction_date", "day_of_week", "nb_broken_docks")
