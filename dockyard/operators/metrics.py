"""Fleet metrics: newest state per docking point, then one row of fleet totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockyard.functions import broken_docks, percent_of

# Fixed value: instant reported for min/max when a batch holds no instant at all.
SENTINEL_INSTANT = "2000-01-01 00:00:00"

COUNT_COLUMNS = ("NbBikes", "NbEBikes", "NbDocks", "NbEmptyDocks", "NbBrokenDocks")

# (source column, metric name) of the four reported counts.
REPORTED = (
    ("NbBikes", "available_bikes"),
    ("NbEBikes", "available_ebikes"),
    ("NbEmptyDocks", "in_use_bikes"),
    ("NbBrokenDocks", "broken_docks"),
)


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest_per_key(df: DataFrame, key="id", ts: str = "extraction_datetime",
                   values: tuple[str, ...] = COUNT_COLUMNS,
                   tiebreak: str | tuple[str, ...] | None = None) -> DataFrame:
    """Per key (a column or a list of columns): the values of the row with the newest `ts`.

    Rows whose `ts` is null never win; a key whose instants are all null gets
    null values. A null value at the newest instant stays null (it is not
    replaced by an older value). Equal instants are settled by `tiebreak`
    (one column or several, e.g. the order of arrival) when given. One hash aggregate: partial results
    are combined map-side, so a key with a huge share of rows does not pile up
    in one task.
    """
    order: Column = F.struct(ts, *(_keys(tiebreak) if tiebreak else ()))
    guarded = F.when(F.col(ts).isNotNull(), order)
    newest = F.max_by(F.struct(*[F.col(v) for v in values]), guarded)
    keys = _keys(key)
    return (
        df.groupBy(*keys)
        .agg(newest.alias("_latest"), F.max(ts).alias(ts))
        .select(*keys, *[F.col(f"_latest.{v}").alias(v) for v in values], ts)
    )


def _totals(ts: str, with_points: bool = False) -> list[Column]:
    sentinel = F.to_timestamp(F.lit(SENTINEL_INSTANT))
    docks = F.sum("NbDocks")
    out = [
        F.coalesce(F.min(ts), sentinel).alias("min_extraction_datetime"),
        F.coalesce(F.max(ts), sentinel).alias("max_extraction_datetime"),
    ]
    for src, name in REPORTED:
        total = F.sum(src)
        out += [total.alias(f"nb_{name}"), percent_of(total, docks).alias(f"percentage_{name}")]
    if with_points:
        out.append(F.count(F.lit(1)).alias("nb_points"))
    return out


def fleet_metrics(msgs: DataFrame, key: str = "id", ts: str = "extraction_datetime",
                  tiebreak: str | tuple[str, ...] | None = None, drop_invalid: bool = False,
                  group=None, with_points: bool = False) -> DataFrame:
    """One row: min/max of the per-point newest instants, and four counts with their rates.

    * available bikes / e-bikes: sums of the newest NbBikes / NbEBikes;
    * in-use bikes: sum of the newest NbEmptyDocks (a dock without a bike);
    * broken docks: sum of the newest docks - (bikes + empty).
    Each rate is round(100 * count / sum of the newest NbDocks of all points, 2),
    null when that sum is 0. With no row at all, min/max read 2000-01-01.
    Unreadable messages form one null-id group unless `drop_invalid` is set.

    With `group` (a column or list of columns, e.g. a poll or file column) the
    same row is computed for every group value independently, as one two-level
    aggregation. `with_points` adds
    `nb_points`, the number of docking points seen (0 for an empty input).
    """
    df = msgs.where(F.col(key).isNotNull()) if drop_invalid else msgs
    outer = _keys(group) if group else []
    broken = F.col("NbBrokenDocks") if "NbBrokenDocks" in df.columns else broken_docks()
    cols = [*outer, key, *[c for c in COUNT_COLUMNS if c != "NbBrokenDocks"], broken.alias("NbBrokenDocks"), ts]
    cols += _keys(tiebreak) if tiebreak else []
    latest = latest_per_key(df.select(*cols), [*outer, key], ts, COUNT_COLUMNS, tiebreak)
    if outer:
        return latest.groupBy(*outer).agg(*_totals(ts, with_points))
    return latest.agg(*_totals(ts, with_points))
