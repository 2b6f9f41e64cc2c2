"""Dock arithmetic shared by the batch and the speed path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def broken_docks(docks="NbDocks", bikes="NbBikes", empty="NbEmptyDocks") -> Column:
    """Docks that hold no bike and take none: docks - (bikes + empty).

    Null when any input is null; negative when the counts disagree (kept as is).
    """
    return _c(docks) - (_c(bikes) + _c(empty))


def is_true(flag) -> Column:
    """Exactly the text "true" -> true; any other text -> false; null stays null.

    Deliberately not a cast to boolean, which would also accept "t", "yes", "1".
    """
    return _c(flag) == F.lit("true")


def percent_of(part, whole, digits: int = 2) -> Column:
    """round(100 * part / whole, digits) as double; null when `whole` is 0 or null."""
    return F.round(F.try_divide(F.lit(100) * _c(part), _c(whole)), digits)
