"""Calendar fields of an instant, in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_text(ts) -> Column:
    """Hour of day as unpadded text ("0" .. "23"); text order is not numeric order."""
    return F.date_format(_c(ts), "H")


def hour_bucket(ts, width: int = 2) -> Column:
    """Label of the `width`-hour slot holding `ts`: "[0, 2[" .. "[22, 0[" for width 2.

    The end wraps at 24, so the last slot of the day reads "[22, 0[".
    """
    start = F.floor(F.hour(_c(ts)) / width) * width
    return F.concat(F.lit("["), start, F.lit(", "), (start + width) % 24, F.lit("["))


def day_label(day_number, day_name) -> Column:
    """"<n>: <Day>", e.g. "1: Sunday", so that labels sort in weekday order."""
    return F.concat(_c(day_number).cast("string"), F.lit(": "), _c(day_name))


def calendar_columns(ts) -> dict[str, Column]:
    """The calendar columns of a history row, in table order.

    Weekday numbers run Sunday = 1 .. Saturday = 7; the week is the ISO week.
    """
    t = _c(ts)
    return {
        "extraction_date": F.to_date(t),
        "month_name": F.date_format(t, "MMMM"),
        "month_number": F.month(t),
        "day_of_month": F.dayofmonth(t),
        "week_of_year": F.weekofyear(t),
        "day_of_week": F.date_format(t, "EEEE"),
        "day_of_week_number": F.dayofweek(t),
        "hour": hour_text(t),
        "hour_interval": hour_bucket(t, 2),
    }
