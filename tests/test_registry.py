"""Registered queries vs their DuckDB oracles on sf0.001, and plan checks."""

import importlib.util
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from dock_rows import SF_SMALL

import __spark_entry__ as E
from dockyard.plans import registry
from dockyard.plans.registry import QUERIES

_spec = importlib.util.spec_from_file_location(
    "oracle_check", os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools", "oracle_check.py"))
oc = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(oc)

FAST = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in oc.TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[name])
    o_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert oc.rows_of(df.columns, [tuple(r) for r in df.collect()]) == oc.rows_of(o_cols, cur.fetchall())


@pytest.mark.parametrize("name", FAST)
def test_no_python_in_plans(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan and "FlatMapGroupsInPandas" not in plan


def test_landed_snapshots_are_bounded(spark, tmp_dir):
    """A poll with most of the elements lands in many files, each with a bounded share of them, and none is lost."""
    rows = spark.range(3000).selectExpr("id as event_id", "if(id < 20, 'a', 'b') as poll", "concat('p', id) as id")
    registry._land_snapshots(rows, f"{tmp_dir}/landing", 100)
    back = spark.read.option("multiLine", True).json(f"{tmp_dir}/landing").withColumn("file", F.input_file_name())
    assert sorted(r.id for r in back.collect()) == sorted(f"p{i}" for i in range(3000))
    sizes = {(r.poll, r.file): r["count"] for r in back.groupBy("poll", "file").count().collect()}
    assert max(sizes.values()) <= 200 and [p for p, _ in sizes].count("a") == 1 and len(sizes) == 31


def test_landed_snapshots_move_flat_rows_and_land_compressed(spark, tmp_dir):
    """The elements take their nested form after the rows are dealt to files, and the files are compressed (F1, F2)."""
    rows = spark.range(400).selectExpr("id as event_id", "if(id < 20, 'a', 'b') as poll", "concat('p', id) as id")
    moved = []

    def form(dealt, keep):
        moved.append(dealt._jdf.queryExecution().optimizedPlan().toString())
        wide = F.array(*[F.struct(F.lit(f"attribute {i}").alias("key"), F.col("id").alias("value")) for i in range(9)])
        return dealt.select("event_id", "id", wide.alias("props"), *keep)

    registry._land_snapshots(rows, f"{tmp_dir}/landing", 100, form=form)
    assert len(moved) == 1 and moved[0].startswith("RepartitionByExpression")
    files = [f for _, _, names in os.walk(f"{tmp_dir}/landing") for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    back = spark.read.option("multiLine", True).json(f"{tmp_dir}/landing")
    assert sorted((r.id, len(r.props), r.props[8].value) for r in back.collect()) == sorted(
        (f"p{i}", 9, f"p{i}") for i in range(400))


def test_stage_rows_are_joined_once_for_both_runs(spark, monkeypatch):
    """What the two runs land comes from stored rows: neither joins the events again, nor the count of files (F2)."""
    plans = []
    monkeypatch.setattr(registry, "_CHAINS", {})
    monkeypatch.setattr(registry, "stage_job", lambda *a: None)
    monkeypatch.setattr(registry, "batch_job", lambda *a: None)
    monkeypatch.setattr(registry, "_land_snapshots", lambda rows, *a, **k: plans.append(
        (rows._jdf.queryExecution().optimizedPlan().toString(), rows.groupBy("poll").count().count(), rows.count())))
    registry._staged(spark, SF_SMALL)
    assert [n for _, _, n in plans] == [1000, 1000] and [n for _, n, _ in plans] == [30, 30]
    assert not any("Join" in plan for plan, _, _ in plans)


def _loads_of_one_split(spark, monkeypatch, tmp_dir):
    """The loads' chain over events in one file and row group, with the jobs left out; rows and files of the topic."""
    events = spark.range(20_000).selectExpr(
        "id as event_id", "timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id * 2) as ts",
        "id % 50 as user_id", "if(id % 5 = 0, 'signup', 'view') as event_type", "0.5D as value",
        "concat('{\"k\": ', id % 90, '}') as props")
    events.coalesce(1).write.parquet(f"{tmp_dir}/sf/events.parquet")
    monkeypatch.setattr(registry, "_CHAINS", {})
    for job in ("setup_job", "batch_job", "write_metrics"):
        monkeypatch.setattr(registry, job, lambda *a, **k: None)
    topic = spark.read.parquet(registry._loaded(spark, f"{tmp_dir}/sf").topic_dir)
    return topic.count(), topic.select(F.input_file_name()).distinct().count()


def test_loads_are_dealt_evenly(spark, monkeypatch, tmp_dir):
    """Events that come as one split are landed, and so loaded, by more tasks than one a load (F3)."""
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        rows, files = _loads_of_one_split(spark, monkeypatch, tmp_dir)
    finally:
        for k in small:
            spark.conf.unset(k)
    assert rows == 4_000 + 20_000 + 1_755 + 1_440  # invalid ones, all of two minutes each, two overlaps of the loads
    assert files >= 8


def test_entry(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["nb_available_bikes"] > 0
