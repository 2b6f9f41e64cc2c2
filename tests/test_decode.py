"""message decoding (permissive, strict typing)."""

import pytest

from dockyard.operators.decode import decode_messages, decode_valid


def dec(spark, text, **kw):
    df = spark.createDataFrame([(text,)], "value string")
    return decode_messages(df, **kw).first().asDict()


NORMAL = ('{"id":"a","lat":"48.123456","lon":"-4.98765","Installed":"true","NbBikes":10,"NbDocks":19,'
          '"extraction_datetime":"2023-06-07 05:43:21"}')


@pytest.mark.parametrize("single", [False, True])
def test_normal(spark, single):
    r = dec(spark, NORMAL, single_parse=single)
    assert r["id"] == "a" and r["NbBikes"] == 10 and r["NbDocks"] == 19 and r["Installed"] == "true"
    assert str(r["lat"]) == "48.123456" and str(r["lon"]) == "-4.987650"
    assert r["extraction_datetime"].strftime("%Y-%m-%d %H:%M:%S") == "2023-06-07 05:43:21"


def test_binary_value(spark):
    df = spark.createDataFrame([(bytearray(NORMAL.encode()),)], "value binary")
    assert decode_messages(df).first()["id"] == "a"


def test_rounding_overflow_exponent(spark):
    r = dec(spark, '{"lat":"48.1234565","lon":"-4.9876504"}')
    assert str(r["lat"]) == "48.123457" and str(r["lon"]) == "-4.987650"
    r = dec(spark, '{"id":"x","lat":"151.5","NbBikes":3}')
    assert r["lat"] is None and r["id"] == "x" and r["NbBikes"] == 3
    assert str(dec(spark, '{"lon":"-1e-05"}')["lon"]) == "-0.000010"


def test_strict_integer_typing(spark):
    assert dec(spark, '{"id":"x","NbBikes":"10"}')["NbBikes"] is None
    assert dec(spark, '{"id":"x","NbBikes":10.0}')["NbBikes"] is None


def test_json_bool_as_text(spark):
    assert dec(spark, '{"Installed":true}')["Installed"] == "true"


def test_bad_timestamp(spark):
    r = dec(spark, '{"id":"x","extraction_datetime":"garbage"}')
    assert r["extraction_datetime"] is None and r["id"] == "x"


def test_repeated_key_and_case(spark):
    assert dec(spark, '{"NbBikes":1,"NbBikes":2}')["NbBikes"] == 2
    assert dec(spark, '{"nbbikes":7}')["NbBikes"] is None


@pytest.mark.parametrize("text", ["not json", '{"id":"a",', '[{"id":"a"},{"id":"b"}]', "{}", "null"])
def test_unreadable_gives_row_of_nulls(spark, text):
    r = dec(spark, text)
    assert all(v is None for v in r.values())


def test_decode_valid_drops_invalid_and_parses_once(spark):
    df = spark.createDataFrame(
        [(NORMAL,), ('{"id":"x","extraction_datetime":"garbage"}',), ('{"extraction_datetime":"2024-01-01 00:00:00"}',),
         ("not json",)],
        "value string",
    )
    out = decode_valid(df)
    assert [r["id"] for r in out.collect()] == ["a"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1, plan


@pytest.mark.parametrize("single", [False, True])
def test_null_value_gives_row_of_nulls(spark, single):
    df = spark.createDataFrame([(None,), ('{"id":"a"}',)], "value string")
    rows = decode_messages(df, single_parse=single).collect()
    assert len(rows) == 2 and sorted(str(r["id"]) for r in rows) == ["None", "a"]


def test_subset_of_fields(spark):
    df = spark.createDataFrame([(NORMAL,)], "value string")
    r = decode_messages(df, fields=("id", "NbBikes")).first().asDict()
    assert r == {"id": "a", "NbBikes": 10}
