"""Zone map and Bloom filters, the bucketed history's plan, and what a refresh of the top ten reads."""

import glob
import os
import re
import shutil

from dock_rows import SF_SMALL
from pyspark.sql import functions as F

from dockyard.config import Config
from dockyard.operators import views
from dockyard.operators.history import first_per_key
from dockyard.plans.jobs import batch_job
from dockyard.plans.registry import _history, _rows
from dockyard.schema import ARRIVAL, HISTORY
from dockyard.sinks import bucketed, tables, zones
from dockyard.sources.events import wire_messages
from dockyard.sources.tables import read_history


def loaded(spark, tmp_dir, rows=None):
    cfg = Config(warehouse=f"{tmp_dir}/wh", topic_dir=f"{tmp_dir}/topic")
    wire_messages(_rows(spark, SF_SMALL) if rows is None else rows).write.mode("append").parquet(cfg.topic_dir)
    batch_job(spark, cfg)
    return cfg


def keys(df):
    return sorted((r.bike_point_id, r.extraction_datetime) for r in df.collect())


def test_lookup_reads_the_files_that_the_zone_map_leaves(spark, tmp_dir):
    cfg = loaded(spark, tmp_dir)
    h = read_history(spark, cfg.history_path)
    every = h.inputFiles()
    known = spark.read.parquet(cfg.zones_path)
    assert known.count() == len(every) and known.agg(F.sum("nb_rows")).first()[0] == h.count()
    monday = zones.files_for(spark, cfg.history_path, cfg.zones_path, weekdays=[2])
    assert 0 < len(monday) == h.where("day_of_week_number = 2").select("extraction_date").distinct().count() < len(every)
    assert len(zones.files_for(spark, cfg.history_path, cfg.zones_path, month_days=[3])) == 1
    one = sorted(r.bike_point_id for r in h.select("bike_point_id").distinct().collect())[0]  # the least point of all
    files = zones.files_for(spark, cfg.history_path, cfg.zones_path, points=[one], weekdays=[2, 3])
    some = h.where(F.col("bike_point_id") == one).where("day_of_week_number IN (2, 3)")
    assert len(files) == some.select("extraction_date").distinct().count() < len(every)
    got = zones.lookup(spark, cfg.history_path, cfg.zones_path, points=[one], weekdays=[2, 3])
    assert keys(got) == keys(some) and got.columns == h.columns
    assert zones.files_for(spark, cfg.history_path, cfg.zones_path, points=["~ after all"]) == []
    assert zones.lookup(spark, cfg.history_path, cfg.zones_path, points=["~ after all"]).count() == 0
    between = h.where("extraction_datetime BETWEEN '2024-01-05 06:00:00' AND '2024-01-06 18:00:00'")
    got = zones.lookup(spark, cfg.history_path, cfg.zones_path, first="2024-01-05 06:00:00", last="2024-01-06 18:00:00")
    assert keys(got) == keys(between)
    assert len(zones.files_for(spark, cfg.history_path, cfg.zones_path, first="2024-01-05 06:00:00", last="2024-01-06 18:00:00")) == 2


def test_files_that_the_map_does_not_know_are_read(spark, tmp_dir):
    cfg = loaded(spark, tmp_dir)
    more = read_history(spark, cfg.history_path).limit(1).withColumn("bike_point_id", F.lit("unmapped"))
    tables.append_history(more, cfg.history_path)  # a load that stopped before it noted zones
    assert zones.lookup(spark, cfg.history_path, cfg.zones_path, points=["unmapped"]).count() == 1
    zones.note_zones(spark, cfg.history_path, cfg.zones_path, more)
    assert len(zones.files_for(spark, cfg.history_path, cfg.zones_path, points=["unmapped"])) == 1


def test_history_files_have_bloom_filters_on_the_point(spark, tmp_dir, monkeypatch):
    """Where a row group's points fill more than a dictionary (below that Parquet's dictionary does the same)."""
    one = _history(spark, SF_SMALL).limit(1)
    names = F.concat(F.lit("BikePoints_"), F.sha2(F.col("n").cast("string"), 256))
    rows = one.crossJoin(spark.range(60_000).withColumnRenamed("id", "n")).withColumn("bike_point_id", names)
    tables.append_history(rows, f"{tmp_dir}/with")
    monkeypatch.setattr(tables, "POINT_BLOOM", {})
    tables.append_history(rows, f"{tmp_dir}/without")
    size = lambda name: sum(os.path.getsize(f) for f in glob.glob(f"{tmp_dir}/{name}/*/*.parquet"))
    assert size("with") > size("without") + 60_000  # eight bits a point at least
    assert read_history(spark, f"{tmp_dir}/with").where(F.col("bike_point_id") == "BikePoints_none").count() == 0


def test_bucketed_history_is_not_shuffled(spark, tmp_dir):
    bucketed.create_bucketed_history(spark, "bucketed_test", f"{tmp_dir}/history", 8)
    rows = _history(spark, SF_SMALL, keep=ARRIVAL, unit="hour")
    early, late = (rows.where(F.col("timestamp") < "2024-01-20"), rows.where(F.col("timestamp") >= "2024-01-15"))
    bucketed.insert_ignore_bucketed(spark, early, "bucketed_test", ARRIVAL)
    new = bucketed.new_rows_bucketed(spark, late, "bucketed_test", ARRIVAL)
    plan = new._jdf.queryExecution().executedPlan().toString()
    tree = plan[plan.index("SortMergeJoin"):]
    scan = tree.index("bucketed_test") if "bucketed_test" in tree else tree.rindex("FileScan")
    right = tree[tree.rindex("+- Sort") if "+- Sort" in tree else 0 : scan]  # from the join down to the history scan
    assert "Exchange" not in right and plan.count("Exchange hashpartitioning") == 1, plan
    assert re.search(r"Bucketed: true", plan) and "PartitionFilters: [extraction_date" in plan
    bucketed.insert_ignore_bucketed(spark, late, "bucketed_test", ARRIVAL)
    bucketed.insert_ignore_bucketed(spark, late, "bucketed_test", ARRIVAL)  # again: nothing is added
    stored = spark.table("bucketed_test")
    want = first_per_key(rows, order_by=ARRIVAL).select(*HISTORY.fieldNames())
    assert sorted(map(str, stored.select(*HISTORY.fieldNames()).collect())) == sorted(map(str, want.collect()))
    files = glob.glob(f"{tmp_dir}/history/extraction_date=2024-01-05/*.parquet")
    assert 1 < len(files) <= 8
    spark.sql("DROP TABLE bucketed_test")


def same_view(spark, cfg):
    got = tables.read_view(spark, cfg.history_path, cfg.views_path, "mvw_non_availability_by_day")
    want = views.non_availability_by_day(read_history(spark, cfg.history_path))
    return sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_refresh_of_the_top_ten_reads_touched_dates_only(spark, tmp_dir):
    rows = _rows(spark, SF_SMALL)
    # Ten points stand out before and after the last day, so no point enters the ten.
    points = sorted(r.id for r in rows.select("id").distinct().collect())[:10]
    often = rows.withColumn("NbBikes", F.when(F.col("id").isin(points), 0).otherwise(F.greatest("NbBikes", F.lit(1))))
    cfg = loaded(spark, tmp_dir, often.where("ts < '2024-01-29'"))
    assert same_view(spark, cfg)
    hidden = glob.glob(f"{cfg.views_path}/summary_daily_points/extraction_date=2024-01-1*")
    assert len(hidden) == 10
    for path in hidden:  # untouched dates of the summary can't be read any more
        shutil.move(path, path.replace("summary_daily_points/", "hidden-"))
    loaded(spark, tmp_dir, often.where("ts >= '2024-01-28'"))
    assert same_view(spark, cfg)


def test_points_that_enter_and_leave_the_top_ten(spark, tmp_dir):
    rows = _rows(spark, SF_SMALL)
    cfg = loaded(spark, tmp_dir, rows.where("ts < '2024-01-10'"))
    assert same_view(spark, cfg)
    before = {r.bike_point_id for r in tables.read_view(spark, cfg.history_path, cfg.views_path, "mvw_non_availability_by_day").collect()}
    for low, high in (("2024-01-08", "2024-01-20"), ("2024-01-20", "2024-02-01")):
        loaded(spark, tmp_dir, rows.where(f"ts >= '{low}' AND ts < '{high}'"))
        assert same_view(spark, cfg)
    after = {r.bike_point_id for r in tables.read_view(spark, cfg.history_path, cfg.views_path, "mvw_non_availability_by_day").collect()}
    assert before != after
    totals = tables.read_view(spark, cfg.history_path, cfg.views_path, "point_totals").where("empty_rows > 0")
    want = read_history(spark, cfg.history_path).where("nb_bikes = 0").groupBy("bike_point_id").count()
    assert sorted(map(tuple, totals.collect())) == sorted(map(tuple, want.collect()))
    assert not glob.glob(f"{cfg.views_path}/_loads/*") and not glob.glob(f"{cfg.views_path}/_open/*")


def test_a_refresh_that_stopped_half_way_is_finished_once(spark, tmp_dir, monkeypatch):
    rows = _rows(spark, SF_SMALL)
    cfg = loaded(spark, tmp_dir, rows.where("ts < '2024-01-10'"))
    for stop in ("_write_by_date", "non_availability_refreshed", "_close_refresh"):
        def broken(*args, **kwargs):
            raise RuntimeError("stopped")

        with monkeypatch.context() as m:
            m.setattr(tables, stop, broken)
            day = {"_write_by_date": 12, "non_availability_refreshed": 16, "_close_refresh": 20}[stop]
            try:
                loaded(spark, tmp_dir, rows.where(f"ts >= '2024-01-{day - 3:02d}' AND ts < '2024-01-{day + 2}'"))
            except RuntimeError:
                pass
        tables.refresh_views(spark, cfg.history_path, cfg.views_path)
        assert same_view(spark, cfg), stop
