"""Carried fleet state and event-time windows: the same rows however the topic is split, and what lateness drops."""

import random

import pytest
from dock_rows import messages, point, ts
from pyspark.sql import functions as F

from dockyard.operators.staging import encode_messages
from dockyard.sinks.files import children
from dockyard.sources.messages import read_messages
from dockyard.streaming import fleet_state, windows

COUNTS = fleet_state.COUNT_COLUMNS


def wire(spark, rows):
    """Topic rows of (point, minute, bikes), in the order given."""
    points = [point(p, f"2024-01-03 {m // 60:02d}:{m % 60:02d}:00", bikes=b, empty=10 - b) for p, m, b in rows]
    msgs = messages(spark, points).withColumn("offset", F.monotonically_increasing_id())
    msgs = msgs.withColumn("partition", F.lit(0)).withColumn("timestamp", F.to_timestamp(F.lit("2024-01-03 00:00:00")))
    return encode_messages(msgs, keep=("timestamp", "partition", "offset")).select("value", "partition", "offset", "timestamp")


def expected(rows):
    """Per poll of an hour: sums over every point's newest state so far."""
    out = []
    for poll in sorted({m // 60 for _, m, _ in rows}):
        state = {}
        for p, m, b in sorted(rows, key=lambda r: r[1]):
            if m // 60 <= poll:
                state[p] = b
        out.append((poll, sum(state.values()), len(state)))
    return out


def feed(n_points=12, n=400, seed=1):
    rng = random.Random(seed)
    seen, rows = set(), []
    while len(rows) < n:
        p, m = f"P{rng.randrange(n_points)}", rng.randrange(600)
        if (p, m) not in seen:  # no ties: the order of arrival then plays no part
            seen.add((p, m))
            rows.append((p, m, rng.randrange(10)))
    return rows


@pytest.mark.parametrize("files,restart_at,fold_every", [(1, None, 50), (3, 1, 50), (20, 7, 4)])
def test_same_rows_for_any_number_of_micro_batches(spark, tmp_dir, files, restart_at, fold_every):
    rows = feed()
    parts = [rows[i::files] for i in range(files)]  # every file holds parts of every poll
    for i, part in enumerate(parts):
        wire(spark, part).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/topic")
        if restart_at is not None and i == restart_at or i == files - 1:
            stream = read_messages(spark, "parquet", {"path": f"{tmp_dir}/topic"}, streaming=True, max_files_per_trigger=1)
            fleet_state.run_fleet_stream(stream, "1 hour", f"{tmp_dir}/state", f"{tmp_dir}/ckpt", {"availableNow": True},
                                         fold_every=fold_every).awaitTermination()
    got = fleet_state.fleet_history(spark, f"{tmp_dir}/state").orderBy("poll").collect()
    assert [(r.poll.hour, r.nb_available_bikes, r.nb_points) for r in got] == expected(rows)
    assert all(r.min_extraction_datetime.hour == r.poll.hour == r.max_extraction_datetime.hour for r in got)
    layers = children(spark, f"{tmp_dir}/state/reports")
    assert len(layers) <= 2 * fold_every + 2
    if files > 2 * fold_every:
        assert sum(n[0] == "f" for n in layers) == 2  # the last fold, and the one before


def test_a_replayed_micro_batch_changes_nothing(spark, tmp_dir):
    rows = feed(4, 60, 2)
    wire(spark, rows).coalesce(1).write.parquet(f"{tmp_dir}/topic")
    for checkpoint in ("one", "two"):  # a lost checkpoint: all batches again, from number 0
        stream = read_messages(spark, "parquet", {"path": f"{tmp_dir}/topic"}, streaming=True)
        fleet_state.run_fleet_stream(stream, "1 hour", f"{tmp_dir}/state", f"{tmp_dir}/{checkpoint}", {"availableNow": True}).awaitTermination()
    got = fleet_state.fleet_history(spark, f"{tmp_dir}/state").orderBy("poll").collect()
    assert [(r.poll.hour, r.nb_available_bikes, r.nb_points) for r in got] == expected(rows)


def test_deltas_against_sums_over_all_points(spark):
    """Reports that come, change and fill gaps, batch by batch: running sums of the differences are the carried totals."""
    rng = random.Random(5)
    known: dict = {}
    total: dict = {}
    for _ in range(6):
        changed = {(rng.randrange(6), f"P{rng.randrange(4)}"): tuple(rng.randrange(9) for _ in COUNTS) for _ in range(5)}
        frame = lambda rs: spark.createDataFrame(
            [(ts(f"2024-01-0{k[0] + 1} 00:00:00"), k[1], *v, None, 0) for k, v in rs.items()], fleet_state.REPORTS)
        for r in fleet_state.deltas(frame(changed), frame(known)).collect():
            old = total.setdefault(r.poll.day - 1, [0] * 6)
            total[r.poll.day - 1] = [a + b for a, b in zip(old, r[1:], strict=True)]
        known |= changed
        sums = [0] * 6
        for poll in range(6):
            sums = [a + b for a, b in zip(sums, total.get(poll, [0] * 6), strict=True)]
            state = {}
            for (q, p), v in sorted(known.items()):
                if q <= poll:
                    state[p] = v
            assert sums == [sum(v[i] for v in state.values()) for i in range(5)] + [len(state)]


def run_windows(spark, root, deliveries, late_after="30 minutes", run=windows.run_windows_stream):
    for rows in deliveries:
        wire(spark, rows).coalesce(1).write.mode("append").parquet(f"{root}/topic")
        stream = read_messages(spark, "parquet", {"path": f"{root}/topic"}, streaming=True)
        run(stream, "1 hour", late_after, f"{root}/sink", f"{root}/ckpt", {"availableNow": True}).awaitTermination()


def test_windows_admit_what_the_watermark_lets_in(spark, tmp_dir):
    deliveries = [
        [("A", 10, 1), ("B", 20, 2), ("A", 50, 3), ("A", 50, 3)],  # newest 0:50, one message twice
        [("A", 70, 4), ("B", 25, 9)],  # later than 0:20: admitted
        [("B", 30, 7), ("B", 65, 5), ("A", 130, 6)],  # 0:30 is not later than 1:10 less 30 minutes: dropped
        [("B", 66, 1), ("B", 110, 8), ("A", 300, 0)],  # 1:06 is dropped, 1:50 admitted
    ]
    run_windows(spark, tmp_dir, deliveries)
    got = windows.window_metrics(spark, f"{tmp_dir}/sink").orderBy("window_start").collect()
    # Windows of hours 0, 1 and 2 are closed (newest 5:00); hour 5 is still open.
    assert [(r.window_start.hour, r.nb_available_bikes) for r in got] == [(0, 3 + 9), (1, 4 + 8), (2, 6)]
    stored = spark.read.parquet(f"{tmp_dir}/sink")
    assert stored.count() == stored.select("window_start", "id").distinct().count() == 5


def test_moves_join_consecutive_windows(spark, tmp_dir):
    deliveries = [[("A", 10, 1), ("A", 50, 3), ("B", 5, 2), ("A", 70, 7)], [("B", 125, 9), ("A", 130, 4), ("A", 130, 4)], [("Z", 500, 0)]]
    run_windows(spark, tmp_dir, deliveries, run=windows.run_moves_stream)
    moved = spark.read.parquet(f"{tmp_dir}/sink").orderBy("window_start").collect()
    assert [(r.window_start.hour, r.id, r.before, r.after) for r in moved] == [(1, "A", 3, 7), (2, "A", 7, 4)]
    got = windows.turnover(spark, f"{tmp_dir}/sink").orderBy("window_start").collect()
    assert [(r.window_start.hour, r.nb_points, r.nb_arrived, r.nb_left) for r in got] == [(1, 1, 4, 0), (2, 1, 0, 3)]


def test_states_leave_the_store_behind_the_watermark(spark, tmp_dir):
    wire(spark, [("A", 10, 1), ("B", 15, 1)]).coalesce(1).write.parquet(f"{tmp_dir}/topic")
    wire(spark, [("A", 500, 1)]).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/topic")
    stream = read_messages(spark, "parquet", {"path": f"{tmp_dir}/topic"}, streaming=True, max_files_per_trigger=1)
    q = fleet_state.run_fleet_stream(stream, "1 hour", f"{tmp_dir}/state", f"{tmp_dir}/ckpt", {"availableNow": True}, late_after="30 minutes")
    q.awaitTermination()
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 1
