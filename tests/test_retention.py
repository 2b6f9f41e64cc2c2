"""metrics lifetime, last write wins, topic retention, current state."""

import datetime as dt

from dockyard.operators.charts import current_state
from dockyard.operators.retention import current_metrics, topic_retention
from dockyard.schema import METRICS_STORED
from dockyard.sinks.files import children
from dockyard.sinks.metrics import compact_metrics
from dockyard.sources.tables import read_metrics

NOW = dt.datetime(2024, 3, 1, 12, 0, 0)


def row(mn, mx, bikes, written, batch):
    return (mn, mx, bikes, 1.0, 0, 0.0, 0, 0.0, 0, 0.0, written, "stream", batch)


def test_lifetime_and_last_write_wins(spark):
    k1 = (dt.datetime(2024, 3, 1, 11), dt.datetime(2024, 3, 1, 11, 30))
    k2 = (dt.datetime(2024, 2, 29, 11), dt.datetime(2024, 2, 29, 11, 30))
    log = spark.createDataFrame([
        row(*k1, 10, NOW - dt.timedelta(hours=23, minutes=59), 1),
        row(*k1, 12, NOW - dt.timedelta(minutes=5), 2),
        row(*k2, 7, NOW - dt.timedelta(hours=24, minutes=1), 0),
    ], METRICS_STORED)
    cur = current_metrics(log, NOW).collect()
    assert len(cur) == 1 and cur[0]["nb_available_bikes"] == 12
    state = current_state(log, NOW).collect()
    assert len(state) == 1 and state[0]["nb_available_bikes"] == 12
    assert current_metrics(log, NOW + dt.timedelta(days=2)).count() == 0


def test_lifetime_edges(spark):
    k = (dt.datetime(2024, 3, 1, 1), dt.datetime(2024, 3, 1, 2))
    live = spark.createDataFrame([row(*k, 1, NOW - dt.timedelta(hours=23, minutes=59), 0)], METRICS_STORED)
    gone = spark.createDataFrame([row(*k, 1, NOW - dt.timedelta(hours=24, minutes=1), 0)], METRICS_STORED)
    assert current_metrics(live, NOW).count() == 1
    assert current_metrics(gone, NOW).count() == 0


def test_topic_retention(spark):
    df = spark.createDataFrame(
        [(b"x", 1, NOW - dt.timedelta(hours=47)), (b"y", 2, NOW - dt.timedelta(hours=49))],
        "value binary, offset long, timestamp timestamp",
    )
    assert [r["offset"] for r in topic_retention(df, NOW).collect()] == [1]


def store(spark, path, rows, day):
    spark.createDataFrame(rows, METRICS_STORED).coalesce(1).write.mode("append").parquet(f"{path}/log/written_date={day}")


def test_compaction_merges_past_dates_and_removes_expired(spark, tmp_dir):
    k, path = (dt.datetime(2024, 3, 1, 11), dt.datetime(2024, 3, 1, 11, 30)), f"{tmp_dir}/m"
    other = (dt.datetime(2024, 2, 29, 1), dt.datetime(2024, 2, 29, 2))
    store(spark, path, [row(*k, 1, NOW - dt.timedelta(days=5), 0)], "2024-02-25")
    store(spark, path, [row(*k, 2, NOW - dt.timedelta(hours=20), 0)], "2024-02-29")
    store(spark, path, [row(*k, 3, NOW - dt.timedelta(hours=19), 1), row(*other, 7, NOW - dt.timedelta(hours=19), 1)],
          "2024-02-29")
    store(spark, path, [row(*k, 4, NOW - dt.timedelta(hours=1), 2)], "2024-03-01")
    before = sorted(map(tuple, current_metrics(read_metrics(spark, path, alive_at=NOW), NOW).collect()), key=str)
    for _ in range(2):  # repeating it changes nothing
        merged = compact_metrics(spark, path, NOW)
        live = current_metrics(read_metrics(spark, path, alive_at=NOW), NOW)
        assert sorted(map(tuple, live.collect()), key=str) == before
        assert children(spark, f"{path}/log") == ["written_date=2024-03-01"]
        assert children(spark, f"{path}/daily") == ["written_date=2024-02-29"]
    assert merged == [] and read_metrics(spark, path).count() == 3


def test_live_read_scans_only_dates_that_can_hold_live_rows(spark, tmp_dir):
    path = f"{tmp_dir}/m"
    k = (dt.datetime(2024, 3, 1, 1), dt.datetime(2024, 3, 1, 2))
    for n, day in enumerate(["2024-02-01", "2024-02-28", "2024-02-29", "2024-03-01", "2024-03-02", "2024-03-03"]):
        store(spark, path, [row(*k, n, NOW, n)], day)
    recent = read_metrics(spark, path, alive_at=NOW)
    assert sorted(r["batch_id"] for r in recent.collect()) == [1, 2, 3, 4]
    assert read_metrics(spark, f"{tmp_dir}/nothing", alive_at=NOW).count() == 0


def test_live_read_in_a_zone_behind_utc(spark, tmp_dir):
    path, zone = f"{tmp_dir}/m", spark.conf.get("spark.sql.session.timeZone")
    k = (dt.datetime(2024, 3, 1, 1), dt.datetime(2024, 3, 1, 2))
    # written at 19:30 in Los Angeles: the next day in UTC
    store(spark, path, [row(*k, 1, dt.datetime(2024, 3, 2, 3, 30), 0)], "2024-03-02")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        at = "2024-03-01 20:00:00"
        assert current_metrics(read_metrics(spark, path, alive_at=at), at).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_live_clock_retention(spark):
    from dockyard.operators.retention import within_retention

    now = dt.datetime.now()
    df = spark.createDataFrame(
        [(1, now - dt.timedelta(hours=1)), (2, now - dt.timedelta(hours=30)), (3, now + dt.timedelta(hours=1))],
        "n int, written_at timestamp",
    )
    # without an explicit clock: now - 24 h < written_at; later stamps are kept (writer clocks may run ahead)
    assert sorted(r["n"] for r in within_retention(df, "written_at", 86_400).collect()) == [1, 3]
