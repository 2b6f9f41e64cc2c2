"""Column-level building blocks (all built-in expressions, no UDFs)."""

from dockyard.functions.calendar import (
    calendar_columns,
    day_label,
    hour_bucket,
    hour_text,
)
from dockyard.functions.fleet import broken_docks, is_true, percent_of

__all__ = [
    "broken_docks",
    "calendar_columns",
    "day_label",
    "hour_bucket",
    "hour_text",
    "is_true",
    "percent_of",
]
