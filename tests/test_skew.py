"""One docking point carrying a third of all messages: results stay exact, hot keys reduce map-side."""

from pyspark.sql import functions as F

from dock_rows import SF_SMALL

from dockyard.operators.decode import decode_messages
from dockyard.operators.enrich import history_from_wire
from dockyard.operators.history import first_per_key
from dockyard.operators.metrics import fleet_metrics
from dockyard.plans.registry import _rows
from dockyard.sources.events import wire_messages


def skewed_rows(spark):
    """Derived rows where every third user reports as the same point, at one shared instant per hour."""
    rows = _rows(spark, SF_SMALL)
    hot = F.col("event_id") % 3 == 0
    return (
        rows.withColumn("id", F.when(hot, F.lit("BikePoints_hot")).otherwise(F.col("id")))
        .withColumn("extraction_datetime",
                    F.when(hot, F.date_trunc("hour", "extraction_datetime")).otherwise(F.col("extraction_datetime")))
    )


def test_hot_point_fleet_metrics_match_model(spark):
    rows = skewed_rows(spark)
    assert rows.where("id = 'BikePoints_hot'").count() * 3 >= rows.count() - 3
    got = fleet_metrics(decode_messages(wire_messages(rows), keep=("offset",)), tiebreak="offset").first()
    latest = {}
    for r in rows.collect():
        k = (r["extraction_datetime"], r["event_id"])
        if r["id"] not in latest or k > latest[r["id"]][0]:
            latest[r["id"]] = (k, r)
    bikes = sum(r["NbBikes"] for _, r in latest.values())
    assert got["nb_available_bikes"] == bikes
    assert got["max_extraction_datetime"] == max(k[0] for k, _ in latest.values())


def test_hot_point_is_reduced_before_the_shuffle(spark):
    rows = skewed_rows(spark)
    plan = fleet_metrics(decode_messages(wire_messages(rows), keep=("offset",)), tiebreak="offset")
    text = plan._jdf.queryExecution().executedPlan().toString()
    # partial aggregation sits below the exchange on the point id
    assert text.index("Exchange hashpartitioning(id") < text.index("partial_max_by")


def test_hot_key_dedup_matches_model_and_reduces_map_side(spark):
    staging = history_from_wire(wire_messages(skewed_rows(spark)), keep=("offset",))
    out = first_per_key(staging, order_by=("offset",))
    got = {(r["bike_point_id"], r["extraction_datetime"]): r["offset"] for r in out.collect()}
    want = {}
    for r in staging.select("bike_point_id", "extraction_datetime", "offset").collect():
        k = (r[0], r[1])
        want[k] = min(want.get(k, r[2]), r[2])
    assert got == want
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange hashpartitioning(bike_point_id") < text.index("partial_min")
