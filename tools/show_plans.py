"""Print the physical plans of the key operators (used to write PLANS.md).

Usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def _scan_summary(line: str) -> str:
    """The filter and schema parts of a FileScan line, which the cut would hide."""
    parts = []
    for key in ("PartitionFilters: ", "PushedFilters: ", "ReadSchema: "):
        if key in line:
            rest = line.split(key, 1)[1]
            value = rest.split("], ", 1)[0] + "]" if rest.startswith("[") else rest.split(" ", 1)[0]
            parts.append(key + value[:220])
    return "      [scan] " + " | ".join(parts)


def plan(df) -> str:
    # Run this very plan once, so the adaptive plan shows its final, re-optimised form.
    executed = df._jdf.queryExecution().executedPlan()
    executed.execute().count()
    text = executed.toString()
    out = []
    for line in text.splitlines():
        out.append(line[:150])
        if "FileScan" in line:
            out.append(_scan_summary(line))
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from dockyard.operators import views
    from dockyard.operators.decode import decode_messages
    from dockyard.operators.history import new_rows
    from dockyard.operators.metrics import fleet_metrics
    from dockyard.plans.registry import _history, _rows
    from dockyard.schema import ARRIVAL
    from dockyard.sinks.tables import insert_ignore
    from dockyard.sources.events import wire_messages
    from dockyard.sources.tables import read_history
    from dockyard.streaming.metrics_stream import SPEED_FIELDS

    wire = wire_messages(_rows(spark, sf))
    hist = _history(spark, sf)
    root = tempfile.mkdtemp(prefix="dockyard-plans-")
    insert_ignore(spark, hist, f"{root}/history")
    stored = read_history(spark, f"{root}/history")
    staging = hist.where(F.col("extraction_date") == "2024-01-20")
    shown = {
        "speed path: decode + fleet metrics": fleet_metrics(
            decode_messages(wire, keep=ARRIVAL, fields=SPEED_FIELDS), tiebreak=ARRIVAL),
        "batch path: decode once, validity filter, enrich": hist,
        "insert-ignore: dedup + anti-join on the staging dates' partitions": new_rows(
            staging, stored, order_by=(), prune_on="extraction_date"),
        "non-availability view": views.non_availability_by_day(stored),
        "peak-hours view": views.peak_hours_by_day(stored),
        "refresh scope of one touched date": stored.where(F.col("extraction_date").isin(["2024-01-20"]))
        .groupBy("extraction_date", "hour").count(),
    }
    for title, df in shown.items():
        print(f"### {title}\n\n```\n{plan(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
