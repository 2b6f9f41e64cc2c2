"""Stream = batch per micro-batch; restart does not replay; optional late-data handling."""

import glob
import os

from pyspark.sql import functions as F

from dock_rows import SF_SMALL

from dockyard.operators.decode import decode_messages
from dockyard.operators.metrics import fleet_metrics
from dockyard.plans.registry import _rows
from dockyard.schema import ARRIVAL
from dockyard.sources.events import wire_messages
from dockyard.sources.messages import read_messages
from dockyard.sources.tables import read_metrics
from dockyard.streaming import run_metrics_stream
from dockyard.streaming.metrics_stream import poll_metrics, run_polls_stream

DAYS = ("2024-01-03", "2024-01-04", "2024-01-05")


def land(spark, root):
    wire = wire_messages(_rows(spark, SF_SMALL)).withColumn("day", F.to_date("timestamp"))
    wire = wire.where(F.col("day").isin(*DAYS))
    wire.repartition("day").write.partitionBy("day").parquet(f"{root}/landing")
    return wire


def run(spark, root, **kw):
    stream = read_messages(spark, "parquet", {"path": f"{root}/landing"}, streaming=True, max_files_per_trigger=1)
    q = run_metrics_stream(stream, f"{root}/sink", f"{root}/ckpt", trigger={"availableNow": True}, **kw)
    q.awaitTermination()
    return read_metrics(spark, f"{root}/sink")


def test_stream_equals_batch_per_file_and_restart(spark, tmp_dir):
    wire = land(spark, tmp_dir)
    got = run(spark, tmp_dir)
    assert got.count() == len(DAYS)
    expected = decode_messages(wire, keep=(*ARRIVAL, "day"))
    expected = fleet_metrics(expected, tiebreak=ARRIVAL, group="day").drop("day")
    cols = expected.columns
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, expected.collect()))
    assert got.where(F.col("written_at").isNull()).count() == 0
    files = sorted(glob.glob(f"{tmp_dir}/sink/log/written_date=*/*.parquet"))
    assert not glob.glob(f"{tmp_dir}/sink/log/*/*/")  # no directory per batch
    again = run(spark, tmp_dir)  # same checkpoint: nothing new
    assert sorted(glob.glob(f"{tmp_dir}/sink/log/written_date=*/*.parquet")) == files and again.count() == len(DAYS)


def test_late_after_drops_repeated_messages(spark, tmp_dir):
    wire = land(spark, tmp_dir)
    # the same day's messages landed a second time
    wire.where(F.col("day") == DAYS[0]).write.mode("append").partitionBy("day").parquet(f"{tmp_dir}/landing")
    got = run(spark, tmp_dir, late_after="4 minutes")
    # duplicates of the first day are dropped, so no extra metrics row carries them
    total = got.where("nb_available_bikes is not null").count()
    assert total == len(DAYS)
    assert os.path.isdir(f"{tmp_dir}/ckpt")


def test_new_checkpoint_keeps_earlier_rows(spark, tmp_dir):
    land(spark, tmp_dir)
    run(spark, tmp_dir)
    stream = read_messages(spark, "parquet", {"path": f"{tmp_dir}/landing"}, streaming=True)
    q = run_metrics_stream(stream, f"{tmp_dir}/sink", f"{tmp_dir}/other", trigger={"availableNow": True})
    q.awaitTermination()  # starts at batch 0 again
    got = read_metrics(spark, f"{tmp_dir}/sink")
    assert got.count() == len(DAYS) + 1 and got.select("run_id").distinct().count() == 2


def test_polls_do_not_depend_on_the_split(spark, tmp_dir):
    wire = land(spark, tmp_dir)
    want = fleet_metrics(decode_messages(wire, keep=(*ARRIVAL, "day")), tiebreak=ARRIVAL, group="day").drop("day")
    wire.drop("day").repartition(7).write.parquet(f"{tmp_dir}/mixed")  # every file holds parts of every day
    stream = read_messages(spark, "parquet", {"path": f"{tmp_dir}/mixed"}, streaming=True, max_files_per_trigger=2)
    day = F.to_date("extraction_datetime")
    run_polls_stream(stream, day, f"{tmp_dir}/polls", f"{tmp_dir}/ckpt2", {"availableNow": True}).awaitTermination()
    got = poll_metrics(spark, f"{tmp_dir}/polls")
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
