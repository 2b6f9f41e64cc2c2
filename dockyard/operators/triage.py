"""Triage of topic messages: what the batch path loads, and why it leaves out the rest.

A message is good if it has an id and a readable instant (the batch path's validity filter). Any other is rejected for
one reason, the first of REASONS that holds:

* `unreadable`: the value is no JSON object;
* `no_id`: no text in `id`;
* `no_instant`: no `extraction_datetime`;
* `bad_instant`: an `extraction_datetime` that is not of the fixed form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dockyard.operators.decode import decode_messages

REASONS = ("unreadable", "no_id", "no_instant", "bad_instant")


def _reason() -> Column:
    text = F.col("value").cast("string")
    readable = F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))
    return (
        F.when(F.col("id").isNotNull() & F.col("extraction_datetime").isNotNull(), F.lit(None).cast("string"))
        .when(~readable, "unreadable")  # only rejected messages are looked at once more
        .when(F.col("id").isNull(), "no_id")
        .when(F.get_json_object(text, "$.extraction_datetime").isNull(), "no_instant")
        .otherwise("bad_instant")
    )


def triage(wire: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Message fields, `keep`, `value` and `reason` (null for good messages) of every message; each is parsed once."""
    rows = decode_messages(wire, keep=("value", *keep), single_parse=True)
    return rows.withColumn("reason", _reason())


def counters() -> list[Column]:
    """Numbers of messages: all, good, and rejected by reason."""
    by = [F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
    return [F.count(F.lit(1)).alias("messages"), F.count_if(F.col("reason").isNull()).alias("good"), *by]


def observed(triaged: DataFrame, to: Observation | str) -> DataFrame:
    """`triaged` with `counters` taken as its rows pass: into an Observation of a batch run, or, by name, into the
    progress reports of a streaming query (`observedMetrics`)."""
    return triaged.observe(to, *counters())
