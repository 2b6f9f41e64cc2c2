"""Objects that last: a session that registered nothing queries them; triage and quarantine; metrics tables."""

import pytest
from dock_rows import SF_SMALL
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from dockyard.config import Config
from dockyard.functions import broken_docks, day_label, hour_bucket, is_true, percent_of
from dockyard.operators import charts, views
from dockyard.operators.decode import decode_valid
from dockyard.operators.triage import REASONS, observed, triage
from dockyard.plans.catalog import ask, publish
from dockyard.plans.jobs import batch_job, speed_job
from dockyard.plans.registry import _rows
from dockyard.sources.events import wire_messages
from dockyard.sources.messages import read_messages
from dockyard.sources.tables import read_history


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_new_session_queries_without_registration(spark, tmp_dir):
    cfg = Config(warehouse=f"{tmp_dir}/wh", topic_dir=f"{tmp_dir}/topic")
    wire = wire_messages(_rows(spark, SF_SMALL))
    publish(spark, cfg, "lasting")  # before anything is stored: all is there, and empty
    assert spark.newSession().sql("SELECT * FROM lasting.mvw_peak_hours_by_day").count() == 0
    for part in ("timestamp < '2024-01-12'", "timestamp >= '2024-01-12'"):
        wire.where(part).write.mode("append").parquet(cfg.topic_dir)
        batch_job(spark, cfg)
        speed_job(spark, cfg, {"availableNow": True})
        publish(spark, cfg, "lasting")
        other = spark.newSession()
        other.conf.set("spark.sql.session.timeZone", "UTC")
        h = read_history(spark, cfg.history_path)
        assert other.table("lasting.bike_points").count() == h.count()
        for name, want in (
            ("mvw_in_use_bikes_by_day", views.in_use_by_day(h)), ("mvw_broken_docks_history", views.broken_docks_history(h)),
            ("mvw_peak_hours_by_day", views.peak_hours_by_day(h)), ("mvw_non_availability_by_day", views.non_availability_by_day(h)),
            ("chart_in_use_by_day", charts.avg_in_use_by_day(views.in_use_by_day(h))),
            ("chart_broken_docks_by_date", charts.broken_docks_by_date(views.broken_docks_history(h))),
            ("chart_non_availability", charts.non_availability_heatmap(views.non_availability_by_day(h))),
        ):
            got = other.table(f"lasting.{name}")
            assert rows_of(got.select(*want.columns)) == rows_of(want), name
        assert other.table("lasting.chart_peak_hours").count() == charts.peak_hours_heatmap(views.peak_hours_by_day(h)).count()
    assert other.table("lasting.live_metrics").count() == 2 and other.table("lasting.chart_current_state").count() == 1
    point = h.first().bike_point_id
    got = ask(other, "SELECT count(*) AS n FROM lasting.bike_points WHERE bike_point_id = :point", point=point).first().n
    assert got == h.where(F.col("bike_point_id") == point).count()
    assert ask(other, "SELECT count(*) AS n FROM lasting.bike_points WHERE bike_point_id = :point", point="x' OR '1'='1").first().n == 0
    with pytest.raises(AnalysisException):
        other.table("bike_points_that_nobody_made")


def test_sql_functions_equal_the_column_functions(spark, tmp_dir):
    publish(spark, Config(warehouse=f"{tmp_dir}/wh", topic_dir=f"{tmp_dir}/topic"), "lasting_functions")
    given = [(h, n, d, b, e, f) for h, n, d, b, e, f in (
        (0, 1, 20, 5, 15, "true"), (23, 7, 0, 0, 0, "false"), (13, 2, 10, 7, 1, "TRUE"), (None, None, None, None, None, None))]
    df = spark.createDataFrame(given, "hour int, n int, docks int, bikes int, empty int, flag string").withColumn("day", F.lit("Friday"))
    df.createOrReplaceTempView("given_rows")
    got = spark.sql("""SELECT lasting_functions.hour_bucket(hour) AS a, lasting_functions.day_label(n, day) AS b,
        lasting_functions.broken_docks(docks, bikes, empty) AS c, lasting_functions.is_true(flag) AS d,
        lasting_functions.percent_of(bikes, docks) AS e FROM given_rows""")
    want = df.select(hour_bucket(F.make_timestamp(F.lit(2024), F.lit(1), F.lit(1), "hour", F.lit(0), F.lit(0))).alias("a"),
                     day_label("n", "day").alias("b"), broken_docks("docks", "bikes", "empty").alias("c"),
                     is_true("flag").alias("d"), percent_of("bikes", "docks").alias("e"))
    assert rows_of(got) == rows_of(want)


BAD = {
    "unreadable": [b"", b"{", b"[1]", b"7", b'"text"', b"null", b"\xff\xfe{}", None],
    "no_id": [b"{}", b'{"extraction_datetime":"2024-01-01 00:00:00"}', b'{"id":null}'],
    "no_instant": [b'{"id":"a"}', b'{"id":"a","extraction_datetime":null}'],
    "bad_instant": [b'{"id":"a","extraction_datetime":"soon"}', b'{"id":"a","extraction_datetime":""}'],
}


def bad_messages(spark):
    rows = [(v if v is None else bytearray(v), 0, i, None) for i, v in enumerate(x for vs in BAD.values() for x in vs)]
    return spark.createDataFrame(rows, "value binary, partition int, offset long, timestamp timestamp")


def test_every_message_is_good_or_has_one_reason(spark):
    wire = wire_messages(_rows(spark, SF_SMALL)).unionByName(bad_messages(spark))
    seen = Observation()
    out = observed(triage(wire), seen)
    by = {r.reason: r["count"] for r in out.groupBy("reason").count().collect()}
    good = by.pop(None)
    assert by == {k: len(v) for k, v in BAD.items()} and good == decode_valid(wire).count() == 1000
    assert seen.get == {"messages": good + sum(by.values()), "good": good, **by}
    assert set(by) == set(REASONS)


@pytest.mark.parametrize("incremental", [False, True])
def test_quarantine_of_the_batch_job(spark, tmp_dir, incremental):
    cfg = Config(warehouse=f"{tmp_dir}/wh", topic_dir=f"{tmp_dir}/topic")
    wire_messages(_rows(spark, SF_SMALL)).unionByName(bad_messages(spark)).coalesce(1).write.parquet(cfg.topic_dir)
    counts = batch_job(spark, cfg, refresh=False, incremental=incremental, quarantine=True)
    assert counts["good"] == 1000 and counts["messages"] == 1000 + sum(map(len, BAD.values()))
    kept = spark.read.parquet(cfg.quarantine_path)
    assert {r.reason: r["count"] for r in kept.groupBy("reason").count().collect()} == {k: len(v) for k, v in BAD.items()}
    assert read_history(spark, cfg.history_path).count() == 1000
    n = kept.count()
    if not incremental:
        batch_job(spark, cfg, refresh=False, quarantine=True)  # the whole topic again: the quarantine is the same
        assert spark.read.parquet(cfg.quarantine_path).count() == n


def test_counters_in_the_progress_of_a_stream(spark, tmp_dir):
    wire_messages(_rows(spark, SF_SMALL)).unionByName(bad_messages(spark)).write.parquet(f"{tmp_dir}/topic")
    stream = read_messages(spark, "parquet", {"path": f"{tmp_dir}/topic"}, streaming=True)
    rows = observed(triage(stream), "triage").where("reason IS NOT NULL").select("value", "reason")
    q = rows.writeStream.format("parquet").option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start(f"{tmp_dir}/bad")
    q.awaitTermination()
    found = q.lastProgress["observedMetrics"]["triage"]
    assert found["good"] == 1000 and found["bad_instant"] == len(BAD["bad_instant"])
    assert spark.read.parquet(f"{tmp_dir}/bad").count() == sum(map(len, BAD.values()))
