"""Jobs end to end: landed snapshots -> topic -> history + views; topic stream -> metrics; SQL surface."""

import json
import os

from pyspark.sql import functions as F

from dock_rows import SF_SMALL

from dockyard.config import Config
from dockyard.operators.enrich import history_from_wire
from dockyard.operators.history import first_per_key
from dockyard.plans.jobs import batch_job, speed_job, stage_job
from dockyard.plans.registry import _rows
from dockyard.plans.serving import register_tables
from dockyard.sinks.tables import read_view
from dockyard.sources.events import snapshot_rows, wire_messages
from dockyard.sources.tables import read_history, read_metrics


def land_snapshots(spark, landing):
    """Write the derived snapshot rows of three days as JSON-array files (one per day)."""
    rows = snapshot_rows(_rows(spark, SF_SMALL)).join(
        _rows(spark, SF_SMALL).select("event_id", F.to_date("ts").alias("day")), "event_id"
    ).where(F.col("day").isin("2024-01-03", "2024-01-04", "2024-01-05"))
    os.makedirs(landing, exist_ok=True)
    by_day = {}
    for r in rows.drop("event_id").collect():
        d = r["day"].isoformat()
        obj = r.asDict(recursive=True)
        obj.pop("day")
        by_day.setdefault(d, []).append(obj)
    for d, items in by_day.items():
        with open(f"{landing}/snapshot-{d}.json", "w") as f:
            json.dump(items, f)
    return sum(len(v) for v in by_day.values())


def test_stage_batch_speed_and_sql(spark, tmp_dir):
    cfg = Config(warehouse=f"{tmp_dir}/wh", landing_dir=f"{tmp_dir}/landing", topic_dir=f"{tmp_dir}/topic")
    n = land_snapshots(spark, cfg.landing_dir)
    stage_job(spark, cfg, incremental=False)
    topic = spark.read.parquet(cfg.topic_dir)
    assert topic.count() == n == topic.select("timestamp", "partition", "offset").distinct().count()

    batch_job(spark, cfg)
    hist = read_history(spark, cfg.history_path)
    keys = hist.select("bike_point_id", "extraction_datetime").distinct().count()
    assert hist.count() == keys
    expected = first_per_key(history_from_wire(topic)).count()
    assert keys == expected
    for v in ("mvw_in_use_bikes_by_day", "mvw_broken_docks_history", "mvw_peak_hours_by_day",
              "mvw_non_availability_by_day"):
        assert read_view(spark, cfg.history_path, cfg.views_path, v).count() > 0
    assert read_view(spark, cfg.history_path, cfg.views_path, "mvw_in_use_bikes_by_day").count() == keys

    batch_job(spark, cfg)  # the topic is read again from the start: nothing new is added
    assert read_history(spark, cfg.history_path).count() == keys

    speed_job(spark, cfg, trigger={"availableNow": True}, wait=True)
    metrics = read_metrics(spark, cfg.metrics_path)
    assert metrics.count() >= 1

    names = register_tables(spark, cfg)
    assert {"bike_points", "metrics", "metrics_log", "mvw_peak_hours_by_day", "chart_current_state",
            "chart_in_use_by_day", "chart_non_availability", "chart_peak_hours",
            "chart_broken_docks_by_date"} <= set(names)
    assert spark.table("chart_current_state").count() == 1  # written moments ago: live
    assert spark.table("chart_peak_hours").count() > 0 and spark.table("chart_non_availability").count() > 0
    out = spark.sql("""
        SELECT v.num_day_of_week, count(*) AS n
        FROM mvw_in_use_bikes_by_day v JOIN bike_points b ON v.day_of_week = b.day_of_week
        GROUP BY v.num_day_of_week""").collect()
    assert len(out) == 3
    assert spark.sql("SELECT count(*) AS c FROM metrics_log").first()["c"] == metrics.count()


def test_batch_job_reads_wire_rows(spark, tmp_dir):
    cfg = Config(warehouse=f"{tmp_dir}/wh", topic_dir=f"{tmp_dir}/topic")
    wire_messages(_rows(spark, SF_SMALL)).write.parquet(cfg.topic_dir)
    batch_job(spark, cfg, refresh=False)
    assert read_history(spark, cfg.history_path).count() == 1000


def test_incremental_batch_reads_each_message_once(spark, tmp_dir):
    cfg = Config(warehouse=f"{tmp_dir}/wh", topic_dir=f"{tmp_dir}/topic")
    wire = wire_messages(_rows(spark, SF_SMALL))
    cut = F.lit("2024-01-20").cast("timestamp")
    wire.where(F.col("timestamp") < cut).write.parquet(cfg.topic_dir)
    batch_job(spark, cfg, incremental=True)
    first = read_history(spark, cfg.history_path).count()
    wire.where(F.col("timestamp") >= cut).write.mode("append").parquet(cfg.topic_dir)
    batch_job(spark, cfg, incremental=True)
    # the second run staged only the new files' messages
    assert spark.read.parquet(cfg.staging_path).count() == wire.where(F.col("timestamp") >= cut).count()
    assert read_history(spark, cfg.history_path).count() == 1000 > first
    batch_job(spark, cfg, incremental=True)  # nothing new: history unchanged
    assert read_history(spark, cfg.history_path).count() == 1000
    assert read_view(spark, cfg.history_path, cfg.views_path, "mvw_in_use_bikes_by_day").count() == 1000


def test_served_charts_equal_charts_over_history(spark, tmp_dir):
    from dockyard.operators import charts, views

    cfg = Config(warehouse=f"{tmp_dir}/wh", topic_dir=f"{tmp_dir}/topic")
    wire_messages(_rows(spark, SF_SMALL)).write.parquet(cfg.topic_dir)
    batch_job(spark, cfg)
    register_tables(spark, cfg)
    h = read_history(spark, cfg.history_path)
    want_in_use = sorted(map(tuple, charts.avg_in_use_by_day(views.in_use_by_day(h)).collect()))
    got_in_use = sorted(map(tuple, spark.table("chart_in_use_by_day").collect()))
    assert got_in_use == want_in_use
    want_broken = sorted(map(tuple, charts.broken_docks_by_date(views.broken_docks_history(h)).collect()))
    assert sorted(map(tuple, spark.table("chart_broken_docks_by_date").collect())) == want_broken


def test_incremental_stage_publishes_each_snapshot_once(spark, tmp_dir):
    cfg = Config(warehouse=f"{tmp_dir}/wh", landing_dir=f"{tmp_dir}/landing", topic_dir=f"{tmp_dir}/topic")
    n = land_snapshots(spark, cfg.landing_dir)
    stage_job(spark, cfg)
    assert spark.read.parquet(cfg.topic_dir).count() == n
    stage_job(spark, cfg)  # nothing new landed: nothing published
    assert spark.read.parquet(cfg.topic_dir).count() == n
    extra = [{"id": "BikePoints_x", "commonName": "x", "lat": 51.5, "lon": -0.1,
              "additionalProperties": [{"category": "Description", "key": "NbBikes", "sourceSystemKey": "s",
                                        "value": "3", "modified": "2024-01-06T10:00:00.000Z"}]}]
    with open(f"{cfg.landing_dir}/snapshot-extra.json", "w") as f:
        json.dump(extra, f)
    stage_job(spark, cfg)
    assert spark.read.parquet(cfg.topic_dir).count() == n + 1
    batch_job(spark, cfg, refresh=False)
    assert read_history(spark, cfg.history_path).where("bike_point_id = 'BikePoints_x'").count() == 1


def test_setup_makes_empty_staging_and_tables(spark, tmp_dir):
    from dockyard.plans.jobs import setup_job
    from dockyard.schema import HISTORY

    cfg = Config(warehouse=f"{tmp_dir}/wh", topic_dir=f"{tmp_dir}/topic")
    for _ in range(2):
        setup_job(spark, cfg, "set_up_twice")
    staging = spark.read.parquet(cfg.staging_path)
    assert staging.columns == HISTORY.fieldNames() and staging.count() == 0
    tables = spark.sql("SHOW TABLES IN set_up_twice").where("NOT isTemporary")
    assert {r.tableName for r in tables.collect()} == {"bike_points", "metrics"}
    wire_messages(_rows(spark, SF_SMALL)).write.parquet(cfg.topic_dir)
    batch_job(spark, cfg, refresh=False)
    setup_job(spark, cfg, "set_up_twice")
    assert spark.read.parquet(cfg.staging_path).count() == 1000  # set-up never clears what is there
