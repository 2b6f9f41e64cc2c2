"""Topic segments that expire, and attributes beyond the fixed six."""

import datetime as dt
import glob

from dock_rows import SF_SMALL
from pyspark.sql import functions as F

from dockyard.operators.decode import decode_messages
from dockyard.operators.extras import decode_extras, flatten_with_extras
from dockyard.operators.retention import topic_retention
from dockyard.operators.staging import encode_messages, flatten_snapshot
from dockyard.plans.registry import _rows
from dockyard.schema import RAW_SNAPSHOT
from dockyard.sinks import topic
from dockyard.sources.events import wire_messages

AS_OF = "2024-01-20 00:30:00"  # 48 h before: the middle of an hourly segment


def offsets(df):
    return sorted(r.offset for r in df.select("offset").collect())


def test_whole_segments_go_and_the_boundary_is_filtered(spark, tmp_dir):
    path, wire = f"{tmp_dir}/topic", wire_messages(_rows(spark, SF_SMALL))
    for part in ("offset % 2 = 0", "offset % 2 = 1"):  # two writes into the same segments
        topic.write_segments(wire.where(part), path)
    index = topic.segment_index(spark, path)
    assert index.agg(F.sum("nb_messages")).first()[0] == wire.count()
    newest = {r.segment: r.last.replace(tzinfo=dt.timezone.utc).timestamp() for r in index.collect()}
    before = {int(p.split("=")[-1]) for p in glob.glob(f"{path}/segment=*")}
    want = topic_retention(wire, AS_OF)
    assert offsets(topic.read_segments(spark, path, AS_OF)) == offsets(want)  # also before anything is removed
    gone = topic.expire_segments(spark, path, AS_OF)
    left = {int(p.split("=")[-1]) for p in glob.glob(f"{path}/segment=*")}
    cutoff = int(dt.datetime(2024, 1, 18, 0, 30, tzinfo=dt.timezone.utc).timestamp())
    assert set(gone) == {s for s in before if newest[s] <= cutoff} and left == before - set(gone) and gone
    assert all(s + topic.WIDTH > cutoff for s in left)
    held = topic.read_segments(spark, path, AS_OF)
    assert offsets(held) == offsets(want)
    assert "PartitionFilters: [isnotnull(segment" in held._jdf.queryExecution().executedPlan().toString()
    assert topic.expire_segments(spark, path, AS_OF) == []  # again: nothing more goes, the index is as it was
    assert topic.segment_index(spark, path).count() == len(left) and len(glob.glob(f"{path}/_index/*.parquet")) == 1
    topic.expire_segments(spark, path, "2025-01-01 00:00:00")
    assert not glob.glob(f"{path}/segment=*") and topic.segment_index(spark, path).count() == 0


def snapshot(spark, *elements):
    rows = [
        (f"P{i}", "n", 1.0, 2.0, None if props is None else [("c", k, "s", v, "2024-01-01T00:00:00.000Z") for k, v in props])
        for i, props in enumerate(elements)
    ]
    return spark.createDataFrame(rows, RAW_SNAPSHOT)


def test_unknown_attributes_by_key_and_type(spark):
    raw = snapshot(
        spark,
        [("NbBikes", "3"), ("TerminalName", "12"), ("InstallDate", "1278947280000"), ("TerminalName", "13")],
        [("NbBikes", "4")], [], None, [("TerminalName", "twelve"), ("it's", "odd"), ("a.b", "dot"), (None, "no key"), ("Temporary", None)],
    )
    flat = flatten_with_extras(raw, "UTC")
    assert flat.columns == [*flatten_snapshot(raw, "UTC").columns, "extra"]
    wire = encode_messages(flat)
    wanted = {"terminal": ("TerminalName", "int"), "text": ("TerminalName", "string"), "since": ("InstallDate", "bigint"),
              "odd": ("it's", "string"), "dot": ("a.b", "string"), "bikes": ("NbBikes", "int")}
    got = {r.id: tuple(r)[2:] for r in decode_extras(wire, wanted).collect()}
    none = (None,) * 6
    assert got == {"P0": (13, "13", 1278947280000, None, None, None), "P1": none, "P2": none, "P3": none,
                   "P4": (None, "twelve", None, "odd", "dot", None)}
    fixed = lambda w: sorted(map(str, decode_messages(w).collect()))
    assert fixed(wire) == fixed(encode_messages(flatten_snapshot(raw, "UTC")))  # the fixed fields are as before
    plan = decode_extras(wire, wanted)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan
    bad = spark.createDataFrame([(bytearray(b"{"),), (None,)], "value binary")
    assert decode_extras(bad, wanted).where("coalesce(id, terminal) IS NULL").count() == 2
