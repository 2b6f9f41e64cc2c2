"""Views from date-keyed summaries == views from the whole history; incremental refresh == full."""

from pyspark.sql import functions as F

from dock_rows import SF_SMALL

from dockyard.config import Config
from dockyard.operators import views
from dockyard.operators import charts
from dockyard.operators.summaries import (
    avg_in_use_from_summary,
    broken_docks_by_date_from_summary,
    daily_points_summary,
    hourly_summary,
    non_availability_from_summary,
    peak_hours_from_summary,
)
from dockyard.plans.jobs import batch_job
from dockyard.plans.registry import _history, _rows
from dockyard.operators.views import VIEW_NAMES
from dockyard.sinks.files import children
from dockyard.sinks.tables import SUMMARIES, note_load, read_view, refresh_views
from dockyard.sources.events import wire_messages
from dockyard.sources.tables import read_history


def same(a, b):
    key = lambda r: tuple((v is None, str(v)) for v in r)
    return sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.select(*a.columns).collect()), key=key)


def test_summaries_equal_full_views(spark):
    h = _history(spark, SF_SMALL)
    hourly, daily = hourly_summary(h), daily_points_summary(h)
    assert same(views.peak_hours_by_day(h), peak_hours_from_summary(hourly))
    assert same(views.non_availability_by_day(h), non_availability_from_summary(daily))
    assert same(views.non_availability_by_day(h, only_empty=True), non_availability_from_summary(daily, only_empty=True))
    assert same(charts.avg_in_use_by_day(views.in_use_by_day(h)), avg_in_use_from_summary(hourly))
    assert same(charts.broken_docks_by_date(views.broken_docks_history(h)), broken_docks_by_date_from_summary(daily))


def test_incremental_refresh_equals_full(spark, tmp_dir):
    cfg = Config(warehouse=f"{tmp_dir}/wh", topic_dir=f"{tmp_dir}/topic")
    wire = wire_messages(_rows(spark, SF_SMALL))
    wire.where(F.col("timestamp") < F.lit("2024-01-12").cast("timestamp")).write.parquet(cfg.topic_dir)
    batch_job(spark, cfg)  # first load: full build
    # second load overlaps the first (days 10-11 again) and adds the rest
    wire.where(F.col("timestamp") >= F.lit("2024-01-10").cast("timestamp")).write.mode("append").parquet(cfg.topic_dir)
    batch_job(spark, cfg)  # incremental: touched dates only
    assert read_history(spark, cfg.history_path).count() == 1000
    check_views(spark, cfg)
    # repeating a refresh of some dates, or of none, changes nothing
    note_load(read_history(spark, cfg.history_path).where("extraction_date = '2024-01-20'"), cfg.views_path)
    for _ in range(2):
        refresh_views(spark, cfg.history_path, cfg.views_path)
        check_views(spark, cfg)
    for name in ("mvw_peak_hours_by_day", "mvw_non_availability_by_day"):
        assert len(children(spark, f"{cfg.views_path}/{name}")) == 2  # older versions are gone


def check_views(spark, cfg):
    h = read_history(spark, cfg.history_path)
    checks = {
        "mvw_in_use_bikes_by_day": views.in_use_by_day(h),
        "mvw_broken_docks_history": views.broken_docks_history(h),
        "mvw_peak_hours_by_day": views.peak_hours_by_day(h),
        "mvw_non_availability_by_day": views.non_availability_by_day(h),
        "summary_hourly": hourly_summary(h),
        "summary_daily_points": daily_points_summary(h),
    }
    for name, expected in checks.items():
        assert same(read_view(spark, cfg.history_path, cfg.views_path, name), expected), name


def test_skipped_refresh_and_empty_first_load_are_made_up_for(spark, tmp_dir):
    cfg = Config(warehouse=f"{tmp_dir}/wh", topic_dir=f"{tmp_dir}/topic")
    wire = wire_messages(_rows(spark, SF_SMALL))
    wire.withColumn("value", F.lit(b"{}")).limit(3).write.parquet(cfg.topic_dir)
    batch_job(spark, cfg)  # no valid row: empty history and views
    for name in (*VIEW_NAMES, *SUMMARIES):
        assert read_view(spark, cfg.history_path, cfg.views_path, name).count() == 0
    for low, high, refresh in (("01", "10", True), ("10", "20", False), ("20", "32", True)):
        part = wire.where((F.date_format("timestamp", "dd") >= low) & (F.date_format("timestamp", "dd") < high))
        part.write.mode("append").parquet(cfg.topic_dir)
        batch_job(spark, cfg, refresh=refresh, incremental=True)
    assert read_history(spark, cfg.history_path).count() == 1000
    check_views(spark, cfg)
