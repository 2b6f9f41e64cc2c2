"""One SQL namespace over history, views and metrics (what the dashboard queries)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockyard.config import Config
from dockyard.operators.charts import current_state, non_availability_heatmap, peak_hours_heatmap
from dockyard.operators.retention import current_metrics
from dockyard.operators.summaries import avg_in_use_from_summary, broken_docks_by_date_from_summary
from dockyard.operators.views import VIEW_NAMES
from dockyard.sinks.tables import SUMMARIES, read_view
from dockyard.sources.tables import read_history, read_metrics


def register_tables(spark: SparkSession, cfg: Config, as_of=None) -> list[str]:
    """Temp views over history, metrics, the stored views and the five charts.

    `bike_points` (history), `metrics_log` (every stored metrics row),
    `metrics` (live rows, newest per key), the four `mvw_*` views, and the
    charts: `chart_current_state`, `chart_in_use_by_day`,
    `chart_non_availability`, `chart_peak_hours`, `chart_broken_docks_by_date`.
    The two charts that would otherwise scan history-sized views are read from
    the small date-keyed summaries. Users then call `spark.sql(...)` across all
    of them. Views not built yet are empty. Returns the names registered.
    """
    fmt, opts = cfg.metrics_sink()
    views: dict[str, DataFrame] = {"bike_points": read_history(spark, cfg.history_path),
                                   "metrics_log": read_metrics(spark, cfg.metrics_path, fmt, opts)}
    # Live rows are at most a day old: only the write dates that can hold one are scanned.
    if fmt == "parquet":
        recent = read_metrics(spark, cfg.metrics_path, alive_at=as_of or F.current_timestamp())
        views["metrics"] = current_metrics(recent, as_of)
        views["chart_current_state"] = current_state(recent, as_of)
    else:
        views["metrics"] = views["metrics_log"]  # the store itself expires rows and keeps one per key
    stored = {v: read_view(spark, cfg.history_path, cfg.views_path, v) for v in (*VIEW_NAMES, *SUMMARIES)}
    views.update({v: stored[v] for v in VIEW_NAMES})
    charts = {
        "chart_in_use_by_day": ("summary_hourly", avg_in_use_from_summary),
        "chart_non_availability": ("mvw_non_availability_by_day", non_availability_heatmap),
        "chart_peak_hours": ("mvw_peak_hours_by_day", peak_hours_heatmap),
        "chart_broken_docks_by_date": ("summary_daily_points", broken_docks_by_date_from_summary),
    }
    for name, (source, chart) in charts.items():
        views[name] = chart(stored[source])
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def sql(spark: SparkSession, text: str) -> DataFrame:
    """Run SQL over the registered namespace."""
    return spark.sql(text)
