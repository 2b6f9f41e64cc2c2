"""Catalog objects that last: tables over the warehouse, views, and SQL functions of the library's arithmetic.

Created once (and brought up to date after a refresh), they serve any session of the catalog by plain SQL, without
`register_tables`. With a persistent catalog (a metastore) they outlive the application.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dockyard.config import METRICS_TTL_SECONDS, Config
from dockyard.schema import METRICS, METRICS_KEY
from dockyard.sinks.files import exists
from dockyard.sinks.metrics import metrics_ddl
from dockyard.sinks.tables import RANKED_VIEWS, SUMMARIES, _version, history_ddl

#: SQL functions: name -> (parameters, return type, body).
FUNCTIONS = {
    "day_label": ("n INT, day STRING", "STRING", "concat(CAST(n AS STRING), ': ', day)"),
    "hour_bucket": ("h INT", "STRING",
                    "concat('[', CAST(h DIV 2 * 2 AS STRING), ', ', CAST((h DIV 2 * 2 + 2) % 24 AS STRING), '[')"),
    "broken_docks": ("docks INT, bikes INT, empty INT", "INT", "docks - (bikes + empty)"),
    "is_true": ("flag STRING", "BOOLEAN", "flag = 'true'"),
    "percent_of": ("part BIGINT, whole BIGINT", "DOUBLE", "round(try_divide(100 * part, whole), 2)"),
}


def _views(db: str) -> dict[str, str]:
    """Views over the tables of `db`: name -> SQL."""
    cols = ", ".join(f"m.{c}" for c in METRICS.fieldNames())
    stored = ", ".join((*METRICS.fieldNames(), "written_at", "run_id", "batch_id"))
    label = f"{db}.day_label(day_of_week_number, day_of_week)"
    return {
        "mvw_in_use_bikes_by_day": f"SELECT {label} AS num_day_of_week, day_of_week, nb_empty_docks FROM {db}.bike_points",
        "mvw_broken_docks_history": f"SELECT extraction_date, day_of_week, nb_broken_docks FROM {db}.bike_points",
        "live_metrics":
            f"SELECT {cols}, m.written_at FROM (SELECT max_by(struct({stored}), struct(written_at, run_id, batch_id)) AS m "
            f"FROM (SELECT * FROM {db}.metrics UNION ALL SELECT * FROM {db}.metrics_log) "
            f"WHERE written_at > current_timestamp() - INTERVAL '{METRICS_TTL_SECONDS}' SECOND GROUP BY {', '.join(METRICS_KEY)})",
        "chart_current_state":
            f"SELECT * FROM {db}.live_metrics ORDER BY max_extraction_datetime DESC, written_at DESC LIMIT 1",
        "chart_in_use_by_day":
            f"SELECT {label} AS num_day_of_week, day_of_week, "
            "try_divide(CAST(sum(sum_empty_docks) AS DOUBLE), sum(nb_empty_docks_rows)) AS avg_in_use_bikes "
            f"FROM {db}.summary_hourly GROUP BY day_of_week_number, day_of_week",
        "chart_broken_docks_by_date":
            f"SELECT extraction_date, max(max_broken_docks) AS max_nb_broken_docks FROM {db}.summary_daily_points GROUP BY extraction_date",
        "chart_peak_hours":
            "SELECT num_day_of_week, hour_interval, avg(avg_nb_empty_docks) AS avg_nb_empty_docks "
            f"FROM {db}.mvw_peak_hours_by_day GROUP BY num_day_of_week, hour_interval",
        "chart_non_availability":
            "SELECT num_day_of_week, bike_point_id, count(DISTINCT extraction_date) AS nb_occurrences "
            f"FROM {db}.mvw_non_availability_by_day GROUP BY num_day_of_week, bike_point_id",
    }


def _table(spark: SparkSession, name: str, ddl: str, location: str) -> None:
    """The table, with the partitions that its folder holds now."""
    spark.sql(ddl)
    if exists(spark, location):
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def publish(spark: SparkSession, cfg: Config, database: str = "dockyard") -> list[str]:
    """Create or bring up to date all objects of the warehouse in `database`; returns the tables' and views' names.

    Run it after a refresh: the ranked views then read their newest version, and new partitions are known.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{cfg.warehouse}/_database'")
    for name, (params, returns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE FUNCTION {database}.{name}({params}) RETURNS {returns} RETURN {body}")
    at = {"bike_points": cfg.history_path, "metrics": f"{cfg.metrics_path}/daily", "metrics_log": f"{cfg.metrics_path}/log"}
    at.update({name: f"{cfg.views_path}/{name}" for name in SUMMARIES})
    ddl = {"bike_points": history_ddl, "metrics": metrics_ddl, "metrics_log": metrics_ddl}
    for name, location in at.items():
        full = f"{database}.{name}"
        make = ddl[name](full, location) if name in ddl else (
            f"CREATE TABLE IF NOT EXISTS {full} ({SUMMARIES[name]}) USING parquet "
            f"PARTITIONED BY (extraction_date) LOCATION '{location}'")
        _table(spark, full, make, location)
    views = {}
    for name, cols in RANKED_VIEWS.items():
        version = _version(spark, cfg.views_path, name)
        names = ", ".join(c.split()[0] for c in cols.split(", "))
        nothing = ", ".join("CAST(NULL AS {1}) AS {0}".format(*c.split()) for c in cols.split(", "))
        stored = version and exists(spark, version)
        views[name] = f"SELECT {names} FROM parquet.`{version}`" if stored else f"SELECT {nothing} WHERE false"
    for name, sql in {**views, **_views(database)}.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {sql}")
    return [*at, *views, *_views(database)]


def ask(spark: SparkSession, text: str, **args) -> DataFrame:
    """SQL with named parameters (`:point`), which are bound as values and never become part of the text."""
    return spark.sql(text, args=args)
