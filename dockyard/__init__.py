"""dockyard: bike-dock availability analytics on Spark.

Snapshots of docking points are flattened into JSON messages; a batch path
loads them into a date-partitioned history table (existing keys win) and keeps
four summary views fresh; a Structured Streaming path turns each micro-batch
into one row of fleet metrics with a limited lifetime. Everything is DataFrame,
SQL and Structured Streaming built-ins.
"""

from dockyard.config import Config, session_for
from dockyard.operators.charts import (
    avg_in_use_by_day,
    broken_docks_by_date,
    current_state,
    non_availability_heatmap,
    peak_hours_heatmap,
)
from dockyard.operators.decode import decode_messages, decode_valid, valid_only
from dockyard.operators.enrich import enrich, history_from_wire, history_rows
from dockyard.operators.history import first_per_key, new_rows
from dockyard.operators.metrics import fleet_metrics, latest_per_key
from dockyard.operators.retention import current_metrics, topic_retention, within_retention
from dockyard.operators.staging import encode_messages, flatten_snapshot
from dockyard.operators.views import (
    broken_docks_history,
    in_use_by_day,
    non_availability_by_day,
    peak_hours_by_day,
)
from dockyard.plans.jobs import batch_job, compact_job, setup_job, speed_job, stage_job
from dockyard.plans.serving import register_tables
from dockyard.sinks.tables import insert_ignore, refresh_views
from dockyard.streaming.metrics_stream import run_metrics_stream

__version__ = "0.1.0"

__all__ = [
    "Config", "session_for",
    "flatten_snapshot", "encode_messages", "decode_messages", "decode_valid", "valid_only",
    "enrich", "history_rows", "history_from_wire", "first_per_key", "new_rows", "insert_ignore",
    "latest_per_key", "fleet_metrics", "within_retention", "topic_retention", "current_metrics",
    "in_use_by_day", "non_availability_by_day", "peak_hours_by_day", "broken_docks_history", "refresh_views",
    "current_state", "avg_in_use_by_day", "non_availability_heatmap", "peak_hours_heatmap", "broken_docks_by_date",
    "run_metrics_stream", "stage_job", "batch_job", "speed_job", "compact_job", "setup_job", "register_tables",
]
