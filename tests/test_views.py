"""the four stored views and the chart queries over them."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dock_rows import messages, point

from dockyard.operators import charts, views
from dockyard.operators.enrich import enrich

MONDAY = "2024-01-01"  # a Monday


def hist(spark, rows):
    return enrich(messages(spark, rows))


def at(hour, day=MONDAY, minute=0):
    return f"{day} {hour:02d}:{minute:02d}:00"


def test_peak_hours_ties_share_rank(spark):
    rows = [point(f"p{h}", at(h), empty=e) for h, e in ((8, 10), (9, 10), (10, 9), (11, 8), (12, 7))]
    out = views.peak_hours_by_day(hist(spark, rows)).collect()
    assert len(out) == 4
    assert sorted((r["hour_interval"], float(r["avg_nb_empty_docks"])) for r in out) == [
        ("[10, 12[", 8.0), ("[10, 12[", 9.0), ("[8, 10[", 10.0), ("[8, 10[", 10.0)]
    assert {r["num_day_of_week"] for r in out} == {"2: Monday"}


def test_peak_hours_exact_half_up(spark):
    rows = [point(f"p{i}", at(7), empty=1) for i in range(199)] + [point("px", at(7), empty=2)]
    out = views.peak_hours_by_day(hist(spark, rows)).collect()
    assert out[0]["avg_nb_empty_docks"] == Decimal("1.01")


def test_peak_hours_same_slot_twice(spark):
    rows = [point("a", at(0), empty=9), point("b", at(1), empty=8), point("c", at(5), empty=1)]
    out = views.peak_hours_by_day(hist(spark, rows)).collect()
    assert sorted(r["hour_interval"] for r in out) == ["[0, 2[", "[0, 2[", "[4, 6["]


def test_peak_hours_null_group_ranks_first(spark):
    rows = [point("a", at(3), empty=None), point("b", at(5), empty=4), point("c", at(6), empty=3),
            point("d", at(9), empty=2)]
    out = views.peak_hours_by_day(hist(spark, rows)).collect()
    slots = {r["hour_interval"]: r["avg_nb_empty_docks"] for r in out}
    assert slots["[2, 4["] is None and "[8, 10[" not in slots and len(out) == 3


def test_peak_hours_average_of_100_fails(spark):
    with pytest.raises(Exception):
        views.peak_hours_by_day(hist(spark, [point("a", at(3), empty=100)])).collect()


def test_peak_hours_plan_uses_group_limit(spark):
    out = views.peak_hours_by_day(hist(spark, [point("a", at(3))]))
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def eleven_points(spark):
    rows = []
    counts = [11, 10, 9, 8, 7, 6, 5, 4, 3, 2, 2]
    for i, n in enumerate(counts, start=1):
        for j in range(n):
            rows.append(point(f"p{i:02d}", f"2024-01-{j + 1:02d} 10:00:00", bikes=0))
    rows.append(point("p01", "2024-01-20 10:00:00", bikes=4))  # a date with bikes
    return hist(spark, rows)


def test_non_availability_top10_ties_keep_lower_id(spark):
    out = views.non_availability_by_day(eleven_points(spark)).collect()
    ids = {r["bike_point_id"] for r in out}
    assert ids == {f"p{i:02d}" for i in range(1, 11)}


def test_non_availability_lists_all_dates_by_default(spark):
    h = eleven_points(spark)
    default = views.non_availability_by_day(h).where(F.col("bike_point_id") == "p01")
    only = views.non_availability_by_day(h, only_empty=True).where(F.col("bike_point_id") == "p01")
    assert dt.date(2024, 1, 20) in {r["extraction_date"] for r in default.collect()}
    assert dt.date(2024, 1, 20) not in {r["extraction_date"] for r in only.collect()}
    assert default.count() == 12 and only.count() == 11


def test_non_availability_plan(spark):
    plan = views.non_availability_by_day(eleven_points(spark))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "LeftSemi" in plan and "Broadcast" in plan


def test_in_use_and_broken_views(spark):
    rows = [point("a", "2024-01-02 10:00:00", empty=3, bikes=5, docks=10),
            point("b", "2024-01-05 10:00:00", empty=1, bikes=5, docks=10)]
    h = hist(spark, rows)
    assert sorted(tuple(r) for r in views.in_use_by_day(h).collect()) == [
        ("3: Tuesday", "Tuesday", 3), ("6: Friday", "Friday", 1)]
    b = views.broken_docks_history(h).collect()
    assert {(r["extraction_date"], r["nb_broken_docks"]) for r in b} == {
        (dt.date(2024, 1, 5), 4), (dt.date(2024, 1, 2), 2)}


def test_charts(spark):
    rows = [point("a", at(8), empty=4, bikes=0), point("b", at(8), empty=2, bikes=0),
            point("a", at(9, "2024-01-02"), empty=6, bikes=3)]
    h = hist(spark, rows)
    in_use = {r["day_of_week"]: r["avg_in_use_bikes"] for r in charts.avg_in_use_by_day(views.in_use_by_day(h)).collect()}
    assert in_use == {"Monday": 3.0, "Tuesday": 6.0}
    heat = {(r["num_day_of_week"], r["bike_point_id"]): r["nb_occurrences"]
            for r in charts.non_availability_heatmap(views.non_availability_by_day(h)).collect()}
    assert heat == {("2: Monday", "a"): 1, ("2: Monday", "b"): 1, ("3: Tuesday", "a"): 1}
    peak = charts.peak_hours_heatmap(views.peak_hours_by_day(h)).collect()
    assert {(r["num_day_of_week"], r["hour_interval"], r["avg_nb_empty_docks"]) for r in peak} == {
        ("2: Monday", "[8, 10[", 3.0), ("3: Tuesday", "[8, 10[", 6.0)}
    broken = {r["extraction_date"]: r["max_nb_broken_docks"]
              for r in charts.broken_docks_by_date(views.broken_docks_history(h)).collect()}
    assert broken == {dt.date(2024, 1, 1): 8, dt.date(2024, 1, 2): 1}
