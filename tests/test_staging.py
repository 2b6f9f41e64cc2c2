"""snapshot -> message flattening, and message encoding."""

import json

from pyspark.sql import functions as F

from dockyard.operators.decode import decode_messages
from dockyard.operators.staging import encode_messages, flatten_snapshot
from dockyard.schema import RAW_SNAPSHOT


def prop(key, value, modified="2023-06-07T05:43:21.747Z"):
    return ("Description", key, "BikePoints", value, modified)


def raw(spark, props, pid="BikePoints_1", name="Quay Lane, Harbour", lat=48.123456, lon=-4.98765):
    return spark.createDataFrame([(pid, name, lat, lon, props)], RAW_SNAPSHOT)


NORMAL = [prop("NbBikes", "10"), prop("NbEmptyDocks", "8"), prop("NbDocks", "19")]


def test_normal(spark):
    r = flatten_snapshot(raw(spark, NORMAL), tz="UTC").first().asDict()
    assert r["id"] == "BikePoints_1"
    assert r["common_name"] == "Quay Lane, Harbour"
    assert (r["NbBikes"], r["NbEmptyDocks"], r["NbDocks"]) == (10, 8, 19)
    assert r["extraction_datetime"] == "2023-06-07 05:43:21"
    assert r["NbEBikes"] is None and r["Installed"] is None and r["Locked"] is None
    assert float(r["lat"]) == 48.123456 and float(r["lon"]) == -4.98765


def test_absent_attributes_leave_no_json_key(spark):
    value = encode_messages(flatten_snapshot(raw(spark, NORMAL), tz="UTC")).first()["value"]
    obj = json.loads(bytes(value).decode("utf-8"))
    assert "NbEBikes" not in obj and "Installed" not in obj
    assert obj["NbBikes"] == 10 and obj["extraction_datetime"] == "2023-06-07 05:43:21"


def test_repeated_key_last_wins(spark):
    r = flatten_snapshot(raw(spark, [prop("NbBikes", "9"), prop("NbBikes", "10")]), tz="UTC").first()
    assert r["NbBikes"] == 10


def test_newest_modified_over_all_attributes(spark):
    props = NORMAL + [prop("Installed", "true", "2023-06-07T05:44:21.999Z")]
    assert flatten_snapshot(raw(spark, props), tz="UTC").first()["extraction_datetime"] == "2023-06-07 05:44:21"


def test_unknown_key_ignored_but_counts_for_instant(spark):
    props = NORMAL + [prop("TerminalName", "000777", "2023-06-07T06:00:00.000Z")]
    r = flatten_snapshot(raw(spark, props), tz="UTC").first().asDict()
    assert "TerminalName" not in r
    assert r["extraction_datetime"] == "2023-06-07 06:00:00"


def test_bad_integer_is_null_row_kept(spark):
    r = flatten_snapshot(raw(spark, [prop("NbBikes", ""), prop("NbDocks", "19")]), tz="UTC").first()
    assert r["NbBikes"] is None and r["NbDocks"] == 19


def test_no_attributes(spark):
    r = flatten_snapshot(raw(spark, []), tz="UTC").first().asDict()
    assert r["extraction_datetime"] is None
    assert all(r[k] is None for k in ("NbBikes", "NbDocks", "Installed"))


def test_zone_conversion(spark):
    props = [prop("NbBikes", "1", "2024-07-01T12:00:00.999Z")]
    assert flatten_snapshot(raw(spark, props), tz="Europe/London").first()["extraction_datetime"] == "2024-07-01 13:00:00"
    assert flatten_snapshot(raw(spark, props), tz="UTC").first()["extraction_datetime"] == "2024-07-01 12:00:00"


def test_flatten_encode_decode_round_trip(spark):
    props = NORMAL + [prop("Installed", "true"), prop("Locked", "false"), prop("NbEBikes", "2")]
    back = decode_messages(encode_messages(flatten_snapshot(raw(spark, props), tz="UTC"))).first()
    assert back["id"] == "BikePoints_1" and back["NbEBikes"] == 2 and back["Installed"] == "true"
    assert str(back["lat"]) == "48.123456" and str(back["lon"]) == "-4.987650"
    assert back["extraction_datetime"].strftime("%Y-%m-%d %H:%M:%S") == "2023-06-07 05:43:21"


def test_flatten_is_one_projection_without_python(spark):
    plan = flatten_snapshot(raw(spark, NORMAL), tz="UTC")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert F  # keep import


def test_wall_clock_near_both_clock_changes_of_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    cases = [  # instant, zone of the text, text
        ("2024-03-31T00:30:00.000Z", "UTC", "2024-03-31 00:30:00"),
        ("2024-03-31T01:30:00.000Z", "UTC", "2024-03-31 01:30:00"),
        ("2024-03-31T00:30:00.000Z", "Europe/Paris", "2024-03-31 01:30:00"),
        ("2024-03-31T01:30:00.000Z", "Europe/Paris", "2024-03-31 03:30:00"),
        ("2024-10-27T00:30:00.000Z", "UTC", "2024-10-27 00:30:00"),
        ("2024-10-27T01:30:00.000Z", "Europe/London", "2024-10-27 01:30:00"),
        ("2024-10-27T00:30:00.000Z", "Europe/London", "2024-10-27 01:30:00"),
        ("1969-12-31T23:59:59.500Z", "UTC", "1969-12-31 23:59:59"),
    ]
    try:
        for session in ("Europe/London", "America/Los_Angeles", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", session)
            for instant, tz, want in cases:
                got = flatten_snapshot(raw(spark, [prop("NbBikes", "1", instant)]), tz=tz).first()
                assert got["extraction_datetime"] == want, (session, instant, tz)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
