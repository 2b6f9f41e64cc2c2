"""Decoded message -> history row (21 columns, table order)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockyard.functions import broken_docks, calendar_columns, is_true
from dockyard.operators.decode import decode_valid, valid_only
from dockyard.schema import HISTORY


def enrich(msgs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rename to snake case, turn flags into booleans, add broken docks and calendar fields.

    Expects decoded messages (see `decode_messages`); does not filter.
    """
    ts = F.col("extraction_datetime")
    cols = {
        "bike_point_id": F.col("id"),
        "common_name": F.col("common_name"),
        "lat": F.col("lat").cast("decimal(8,6)"),
        "lon": F.col("lon").cast("decimal(9,6)"),
        "installed": is_true("Installed"),
        "locked": is_true("Locked"),
        "nb_bikes": F.col("NbBikes"),
        "nb_ebikes": F.col("NbEBikes"),
        "nb_empty_docks": F.col("NbEmptyDocks"),
        "nb_docks": F.col("NbDocks"),
        "nb_broken_docks": broken_docks(),
        "extraction_datetime": ts,
        **calendar_columns(ts),
    }
    assert list(cols) == HISTORY.fieldNames()
    return msgs.select(*[c.alias(n) for n, c in cols.items()], *keep)


def history_rows(msgs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Batch path on decoded messages: keep valid ones, then enrich."""
    return enrich(valid_only(msgs), keep)


def history_from_wire(wire: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Batch path on raw topic rows (`value` + `keep`): decode once, keep valid, enrich."""
    return enrich(decode_valid(wire, keep), keep)
