"""Snapshot -> message: flatten the nested docking-point snapshot.

A snapshot element carries its counts as an entity-attribute-value array
(`additionalProperties`: key, value, modified). One message per element keeps
six attributes, pivoted into columns, and stamps it with the newest `modified`
instant of *all* its attributes, as wall-clock text in the given zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockyard.schema import INT_ATTRIBUTES, MESSAGE_TS_FORMAT, STRING_ATTRIBUTES

PROPS = "additionalProperties"


def attribute(key: str, props: str = PROPS) -> Column:
    """Value of attribute `key`; the last one wins when it repeats; null when absent."""
    matches = F.filter(F.col(props), lambda p: p["key"] == F.lit(key))
    return F.try_element_at(matches, F.lit(-1))["value"]


def newest_modified(props: str = PROPS) -> Column:
    """Newest `modified` instant over every attribute; null for none or unreadable text."""
    return F.array_max(F.transform(F.col(props), lambda p: F.try_to_timestamp(p["modified"])))


def wall_clock(ts: Column, tz: str | None) -> Column:
    """Text `yyyy-MM-dd HH:mm:ss` of instant `ts` in zone `tz` (the session's by default; milliseconds cut).

    The instant moved by the zone's own offset is counted from the epoch as a
    zone-less timestamp, so no offset of the session's zone takes part.
    """
    if tz is None:
        return F.date_format(ts, MESSAGE_TS_FORMAT)
    micros = F.unix_micros(F.from_utc_timestamp(ts, tz))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    local = epoch + F.make_dt_interval(days=F.floor(micros / 86_400_000_000).cast("int"),
                                       secs=(F.pmod(micros, F.lit(86_400_000_000)) / 1_000_000).cast("decimal(18,6)"))
    return F.substring(local.cast("string"), 1, len("yyyy-MM-dd HH:mm:ss"))


def flatten_snapshot(raw: DataFrame, tz: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One flat message row per snapshot element (no UDF, one projection); `keep` columns come after its own.

    Bad integer text gives a null field and an element without attributes a
    null `extraction_datetime`; the row is kept either way (it is dropped later
    by the batch path's validity filter), instead of failing the whole poll.
    """
    cols = [
        F.col("id"),
        F.col("commonName").alias("common_name"),
        F.col("lat").cast("string").alias("lat"),
        F.col("lon").cast("string").alias("lon"),
    ]
    cols += [attribute(k).alias(k) for k in STRING_ATTRIBUTES]
    cols += [attribute(k).try_cast("int").alias(k) for k in INT_ATTRIBUTES]
    cols.append(wall_clock(newest_modified(), tz).alias("extraction_datetime"))
    return raw.select(*cols, *keep)


def encode_messages(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Serialise every non-`keep` column of each row to one UTF-8 JSON `value`.

    Null fields are left out of the JSON, as an absent attribute leaves no key.
    A timestamp `extraction_datetime` is written as `yyyy-MM-dd HH:mm:ss` text,
    the form the messages carry.
    """
    payload = []
    for f in df.schema.fields:
        if f.name in keep:
            continue
        c = F.col(f.name)
        if f.name == "extraction_datetime" and f.dataType.typeName() in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, MESSAGE_TS_FORMAT)
        payload.append(c.alias(f.name))
    value = F.encode(F.to_json(F.struct(*payload)), "UTF-8").alias("value")
    return df.select(value, *keep)
