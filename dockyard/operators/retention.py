"""Lifetimes and last-write-wins for the two stores that expire rows.

The topic drops messages 48 h after they arrived; a metrics row lives 24 h after
it was written, and a later write of the same (min, max) instants replaces an
earlier one. On plain files both are read-side filters plus a compaction.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockyard.config import METRICS_TTL_SECONDS, TOPIC_RETENTION_MS
from dockyard.schema import METRICS, METRICS_KEY


def instant(as_of) -> Column:
    """The instant as a column: now without one; text is read in the session's zone."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp(F.lit(str(as_of)))


def within_retention(df: DataFrame, ts: str, horizon_seconds: int, as_of=None) -> DataFrame:
    """Rows alive at `as_of`: `ts` later than `as_of` - horizon.

    Without `as_of` the clock is now. With an explicit `as_of` (a replay of the
    past), rows stamped after it did not exist yet and are left out too.
    """
    now = instant(as_of)
    alive = F.col(ts) > now - F.make_dt_interval(secs=F.lit(horizon_seconds))
    if as_of is not None:
        alive = alive & (F.col(ts) <= now)
    return df.where(alive)


def topic_retention(msgs: DataFrame, as_of=None, ts: str = "timestamp") -> DataFrame:
    """Messages the topic still holds at `as_of` (48 h after their arrival)."""
    return within_retention(msgs, ts, TOPIC_RETENTION_MS // 1000, as_of)


def current_metrics(log: DataFrame, as_of=None, ttl_seconds: int = METRICS_TTL_SECONDS) -> DataFrame:
    """Live metrics rows, one per (min, max) key: the latest write wins.

    Lifetime counts from `written_at` (write time), not from the event instants.
    """
    live = within_retention(log, "written_at", ttl_seconds, as_of)
    cols = METRICS.fieldNames() + ["written_at", "run_id", "batch_id"]
    newest = F.max_by(F.struct(*cols), F.struct("written_at", "run_id", "batch_id"))
    return live.groupBy(*METRICS_KEY).agg(newest.alias("_m")).select("_m.*")
