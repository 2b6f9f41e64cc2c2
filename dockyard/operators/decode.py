"""Message -> typed row: decode the JSON payload with the fixed message schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockyard.schema import MESSAGE


def decode_messages(df: DataFrame, keep: tuple[str, ...] = (), single_parse: bool = False,
                    fields: tuple[str, ...] | None = None) -> DataFrame:
    """`value` (binary or text JSON) -> the message fields (+ `keep` columns).

    Permissive: unreadable text gives a row of nulls; one bad field gives a null
    field and keeps the others. Field names are case-sensitive and typing is
    strict ("10" or 10.0 into an int field is null).

    `fields` parses only those message fields (the parser skips the others), for
    paths that read a few of them. When later steps *filter* on decoded fields,
    pass `single_parse=True` (see `decode_valid`): otherwise the filter is
    pushed below the projection and each message is parsed once per predicate
    plus once for the projection.
    """
    schema = MESSAGE if fields is None else T.StructType([MESSAGE[f] for f in fields])
    bp = F.from_json(F.col("value").cast("string"), schema)
    if single_parse:
        return df.select(F.inline(F.array(bp)), *keep)
    return df.select(bp.alias("bp"), *keep).select("bp.*", *keep)


def valid_only(df: DataFrame, key: str = "id", ts: str = "extraction_datetime") -> DataFrame:
    """Rows with both a docking-point id and a readable instant (batch path only)."""
    return df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())


def decode_valid(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """`decode_messages` + `valid_only`, parsing each message exactly once.

    The struct is expanded with a generator (`inline` of a one-element array):
    the validity filter reads the generator's output and cannot be pushed
    beneath it, so the JSON parse stays in one place.
    """
    return valid_only(decode_messages(df, keep, single_parse=True))
