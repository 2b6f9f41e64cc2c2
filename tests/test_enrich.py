"""history rows (calendar fields, flags, broken docks, validity)."""

import pytest

from dock_rows import messages, point

from dockyard.operators.enrich import enrich, history_rows
from dockyard.schema import HISTORY

CAL = [
    ("2024-12-29 23:59:59", "December", 12, 29, 52, "Sunday", 1, "23", "[22, 0["),
    ("2024-12-30 00:00:00", "December", 12, 30, 1, "Monday", 2, "0", "[0, 2["),
    ("2025-01-01 01:00:00", "January", 1, 1, 1, "Wednesday", 4, "1", "[0, 2["),
    ("2021-01-03 09:05:00", "January", 1, 3, 53, "Sunday", 1, "9", "[8, 10["),
]


@pytest.mark.parametrize("when,month,mnum,dom,week,dow,downum,hour,interval", CAL)
def test_calendar(spark, when, month, mnum, dom, week, dow, downum, hour, interval):
    r = enrich(messages(spark, [point("p", when)])).first()
    assert (r["month_name"], r["month_number"], r["day_of_month"], r["week_of_year"]) == (month, mnum, dom, week)
    assert (r["day_of_week"], r["day_of_week_number"], r["hour"], r["hour_interval"]) == (dow, downum, hour, interval)
    assert str(r["extraction_date"]) == when[:10]


def test_schema_is_history(spark):
    out = enrich(messages(spark, [point("p", "2024-01-01 00:00:00")]))
    assert out.schema == HISTORY or [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in HISTORY
    ]


def test_flags(spark):
    rows = [point(f"p{i}", "2024-01-01 00:00:00", Installed=v) for i, v in enumerate(["true", "false", "True", None])]
    got = {r["bike_point_id"]: r["installed"] for r in enrich(messages(spark, rows)).collect()}
    assert got == {"p0": True, "p1": False, "p2": False, "p3": None}


def test_broken_docks(spark):
    rows = [point("a", "2024-01-01 00:00:00", bikes=10, empty=8, docks=19),
            point("b", "2024-01-01 00:00:00", bikes=12, empty=8, docks=19),
            point("c", "2024-01-01 00:00:00", bikes=None, empty=8, docks=19)]
    got = {r["bike_point_id"]: r["nb_broken_docks"] for r in enrich(messages(spark, rows)).collect()}
    assert got == {"a": 1, "b": -1, "c": None}


def test_validity_filter(spark):
    rows = [point("a", "2024-01-01 00:00:00"), point(None, "2024-01-01 00:00:00"), point("c", None)]
    assert [r["bike_point_id"] for r in history_rows(messages(spark, rows)).collect()] == ["a"]
