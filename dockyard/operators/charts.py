"""Dashboard chart queries over the stored views and the metrics store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockyard.operators.retention import current_metrics


def current_state(metrics_log: DataFrame, as_of=None) -> DataFrame:
    """The newest live fleet-metrics row (counts and rates of bikes, e-bikes, in use, broken)."""
    live = current_metrics(metrics_log, as_of)
    return live.orderBy(F.desc("max_extraction_datetime"), F.desc("written_at"), F.desc("batch_id")).limit(1)


def avg_in_use_by_day(in_use: DataFrame) -> DataFrame:
    """Bar chart: average bikes in use per weekday."""
    return in_use.groupBy("num_day_of_week", "day_of_week").agg(
        F.avg("nb_empty_docks").alias("avg_in_use_bikes")
    )


def non_availability_heatmap(non_avail: DataFrame) -> DataFrame:
    """Heatmap: per weekday and docking point, the number of listed dates."""
    return non_avail.groupBy("num_day_of_week", "bike_point_id").agg(F.count("*").alias("nb_occurrences"))


def peak_hours_heatmap(peak: DataFrame) -> DataFrame:
    """Heatmap: per weekday and two-hour slot, the average of the stored hourly averages."""
    return peak.groupBy("num_day_of_week", "hour_interval").agg(
        F.round(F.avg(F.col("avg_nb_empty_docks").cast("double")), 6).alias("avg_nb_empty_docks")
    )


def broken_docks_by_date(broken: DataFrame) -> DataFrame:
    """Line chart: maximum broken docks per date."""
    return broken.groupBy("extraction_date").agg(F.max("nb_broken_docks").alias("max_nb_broken_docks"))
