"""Attributes beyond the six fixed ones: kept on the wire, and read by path and type when somebody asks for them.

The feed may add attributes at any time. `unknown_attributes` collects those that the message has no field for, as a
map under one more key of the message (`extra`); readers of the fixed fields skip it. `decode_extras` parses a message
to a VARIANT and takes out what is asked for, with a type; what is absent or not of that type is null.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockyard.operators.staging import PROPS, flatten_snapshot
from dockyard.schema import INT_ATTRIBUTES, STRING_ATTRIBUTES

EXTRA = "extra"
KNOWN = (*STRING_ATTRIBUTES, *INT_ATTRIBUTES)


def unknown_attributes(props: str = PROPS) -> Column:
    """Map of key -> value text of the attributes outside the fixed six; of a repeated key the last value."""
    others = F.filter(props, lambda p: p["key"].isNotNull() & ~p["key"].isin(*KNOWN))
    later = lambda i: F.slice(others, i + 2, F.size(others))
    last = F.filter(others, lambda p, i: ~F.exists(later(i), lambda q: q["key"] == p["key"]))
    pairs = F.map_from_entries(F.transform(last, lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value"))))
    return F.when(F.size(others) > 0, pairs)


def flatten_with_extras(raw: DataFrame, tz: str | None = None) -> DataFrame:
    """`flatten_snapshot` with one more column, `extra`; null where an element has no unknown attribute."""
    taken = raw.withColumn(EXTRA, unknown_attributes())
    flat = flatten_snapshot(raw, tz).columns
    return flatten_snapshot(taken, tz, keep=(EXTRA,)).select(*flat, EXTRA)


def decode_extras(wire: DataFrame, wanted: Mapping[str, tuple[str, str]], keep: tuple[str, ...] = ()) -> DataFrame:
    """`id`, `extraction_datetime`, `keep` and the attributes asked for: name -> (attribute key, SQL type).

    One parse per message, whatever the number of attributes.
    """
    parsed = wire.select(F.try_parse_json(F.col("value").cast("string")).alias("v"), *keep)
    return parsed.select(
        F.try_variant_get("v", "$.id", "string").alias("id"),
        F.try_to_timestamp(F.try_variant_get("v", "$.extraction_datetime", "string"), F.lit("yyyy-MM-dd HH:mm:ss")).alias("extraction_datetime"),
        *keep,
        *[F.try_variant_get("v", _path(key), kind).alias(name) for name, (key, kind) in wanted.items()],
    )


def _path(key: str) -> str:
    quote = next((q for q in "\"'" if q not in key), None)
    if quote is None:
        raise ValueError(f"a path can't name {key!r}: it has both kinds of quotes")
    return f"$.{EXTRA}[{quote}{key}{quote}]"
