"""Insert-ignore of staging rows into the history table.

Semantics of `INSERT ... SELECT ... ON CONFLICT DO NOTHING` on the key
(bike_point_id, extraction_datetime): rows whose key is already stored are
skipped (stored rows win), and several staging rows with one key collapse to
the one that comes first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockyard.schema import HISTORY_KEY


def first_per_key(df: DataFrame, keys=HISTORY_KEY, order_by: tuple[str, ...] = ()) -> DataFrame:
    """One row per key: the one with the smallest `order_by` values (then smallest row).

    A `min` over a struct, i.e. a hash aggregate with map-side partial results:
    a key repeated a billion times is reduced inside each task before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(c) for c in (*order_by, *rest)])
    return df.groupBy(*keys).agg(F.min(packed).alias("_first")).select(
        *keys, *[F.col(f"_first.{c}") for c in (*order_by, *rest)]
    ).select(*df.columns)


def new_rows(staging: DataFrame, history: DataFrame, keys=HISTORY_KEY,
             order_by: tuple[str, ...] = (), prune_on: str | None = None) -> DataFrame:
    """Staging rows that an insert-ignore would add: deduplicated, then not yet stored.

    `prune_on` names the column history is partitioned by; only the partitions
    that staging holds are then scanned (see `on_dates_of`).
    """
    keys = list(keys)
    stored = on_dates_of(history, staging, prune_on) if prune_on else history
    fresh = first_per_key(staging, keys, order_by)
    return fresh.join(stored.select(*keys), keys, "left_anti")


def on_dates_of(history: DataFrame, touched: DataFrame, date_col: str = "extraction_date") -> DataFrame:
    """The rows of `history` on the dates that `touched` holds, as one plan at any number of dates.

    The least and the greatest date (one row, the only thing brought to the
    driver) bound the scan statically; within them a semi-join with the dates
    prunes partitions at run time.
    """
    dates = touched.select(date_col).distinct()
    low, high = touched.agg(F.min(date_col), F.max(date_col)).first()
    if low is None:
        return history.where(F.lit(False))
    within = F.col(date_col).between(F.lit(low), F.lit(high))
    return history.where(within).join(dates.where(within), date_col, "left_semi").select(*history.columns)
