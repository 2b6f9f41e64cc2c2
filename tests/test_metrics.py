"""newest state per point and fleet metrics."""

import datetime as dt

from pyspark.sql import functions as F

from dock_rows import messages, point

from dockyard.operators.metrics import fleet_metrics, latest_per_key
from dockyard.schema import METRICS


def test_later_row_wins_and_min_max_over_latest(spark):
    rows = [point("a", "2024-01-01 10:00:00", bikes=1), point("a", "2024-01-01 11:00:00", bikes=7),
            point("b", "2024-01-01 09:00:00", bikes=2)]
    m = fleet_metrics(messages(spark, rows)).first()
    assert m["nb_available_bikes"] == 9
    assert m["min_extraction_datetime"] == dt.datetime(2024, 1, 1, 9)
    assert m["max_extraction_datetime"] == dt.datetime(2024, 1, 1, 11)


def test_null_value_at_latest_instant_stays_null(spark):
    rows = [point("a", "2024-01-01 10:00:00", bikes=4), point("a", "2024-01-01 11:00:00", bikes=None)]
    r = latest_per_key(messages(spark, rows).withColumn("NbBrokenDocks", F.lit(0))).first()
    assert r["NbBikes"] is None


def test_all_null_instants_give_null_values(spark):
    rows = [point("a", None, bikes=4), point("a", None, bikes=5)]
    r = latest_per_key(messages(spark, rows).withColumn("NbBrokenDocks", F.lit(0))).first()
    assert r["NbBikes"] is None and r["extraction_datetime"] is None


def test_equal_instants_settled_by_tiebreak(spark):
    rows = [point("a", "2024-01-01 10:00:00", bikes=1), point("a", "2024-01-01 10:00:00", bikes=2)]
    df = messages(spark, rows).withColumn("offset", F.when(F.col("NbBikes") == 2, 9).otherwise(3))
    assert fleet_metrics(df, tiebreak="offset").first()["nb_available_bikes"] == 2
    df = messages(spark, rows).withColumn("offset", F.when(F.col("NbBikes") == 2, 1).otherwise(3))
    assert fleet_metrics(df, tiebreak="offset").first()["nb_available_bikes"] == 1


def test_empty_input_sentinel(spark):
    m = fleet_metrics(messages(spark, [])).collect()
    assert len(m) == 1
    r = m[0]
    assert r["min_extraction_datetime"] == dt.datetime(2000, 1, 1) == r["max_extraction_datetime"]
    assert r["nb_available_bikes"] is None and r["percentage_available_bikes"] is None
    assert [(f.name, f.dataType) for f in fleet_metrics(messages(spark, [])).schema] == [
        (f.name, f.dataType) for f in METRICS
    ]


def test_zero_docks_gives_null_rate(spark):
    r = fleet_metrics(messages(spark, [point("a", "2024-01-01 00:00:00", bikes=0, ebikes=0, empty=0, docks=0)])).first()
    assert r["nb_available_bikes"] == 0 and r["percentage_available_bikes"] is None


def test_rate_half_up(spark):
    rows = [point("a", "2024-01-01 00:00:00", bikes=1, ebikes=0, empty=799, docks=800)]
    r = fleet_metrics(messages(spark, rows)).first()
    assert r["percentage_available_bikes"] == 0.13
    assert r["percentage_in_use_bikes"] == 99.88
    assert r["nb_broken_docks"] == 0 and r["percentage_broken_docks"] == 0.0


def test_rates_times_docks_match_counts(spark):
    rows = [point(f"p{i}", "2024-01-01 00:00:00", bikes=i % 7, ebikes=i % 3, empty=10 - i % 7, docks=12)
            for i in range(50)]
    r = fleet_metrics(messages(spark, rows)).first()
    docks = 12 * 50
    for n, p in (("nb_available_bikes", "percentage_available_bikes"), ("nb_in_use_bikes", "percentage_in_use_bikes")):
        assert abs(r[p] * docks / 100 - r[n]) <= docks * 0.005 / 100 + 1e-9


def test_null_id_group_counts_unless_dropped(spark):
    rows = [point("a", "2024-01-01 00:00:00", bikes=3), point(None, "2024-01-01 00:00:00", bikes=4)]
    df = messages(spark, rows)
    assert fleet_metrics(df).first()["nb_available_bikes"] == 7
    assert fleet_metrics(df, drop_invalid=True).first()["nb_available_bikes"] == 3


def test_grouped_equals_per_group(spark):
    rows = [point("a", "2024-01-01 10:00:00", bikes=1), point("a", "2024-01-02 10:00:00", bikes=3),
            point("b", "2024-01-02 11:00:00", bikes=5)]
    df = messages(spark, rows).withColumn("day", F.to_date("extraction_datetime"))
    grouped = {r["day"]: r["nb_available_bikes"] for r in fleet_metrics(df, group="day").collect()}
    for day, total in grouped.items():
        assert fleet_metrics(df.where(F.col("day") == day)).first()["nb_available_bikes"] == total
