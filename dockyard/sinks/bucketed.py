"""History as a bucketed catalog table: insert-ignore without moving stored rows.

The table is partitioned by date and bucketed by the key (point, instant). A scan of it is already dealt by key, so
the anti-join with staging shuffles staging alone, to the table's buckets; what comes out is dealt by bucket too and is
appended as it is, one file per date and bucket. A point with very many rows is spread over buckets, as its instants differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockyard.operators.history import first_per_key
from dockyard.schema import HISTORY, HISTORY_KEY

BUCKETS = 64
# Dates of a load that are named one by one for partition pruning; a load of more is bounded by its first and last.
MAX_DATES = 400


def create_bucketed_history(spark: SparkSession, table: str, location: str, buckets: int = BUCKETS) -> None:
    """CREATE TABLE IF NOT EXISTS, with the history's columns. As many buckets as tasks that a full load should have."""
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in HISTORY.fields)
    keys = ", ".join(HISTORY_KEY)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet PARTITIONED BY (extraction_date) "
              f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{location}'")


def new_rows_bucketed(spark: SparkSession, staging: DataFrame, table: str,
                      order_by: tuple[str, ...] = ()) -> DataFrame:
    """Staging rows that an insert-ignore would add (see `operators.history.new_rows`), dealt by the table's buckets.

    The dates are literals in the plan, so that they prune partitions without a join that would shuffle history.
    """
    dates = [r[0] for r in staging.select("extraction_date").distinct().limit(MAX_DATES + 1).collect()]
    stored = spark.table(table)
    if len(dates) <= MAX_DATES:
        stored = stored.where(F.col("extraction_date").isin(dates) if dates else F.lit(False))
    else:
        low, high = staging.agg(F.min("extraction_date"), F.max("extraction_date")).first()
        stored = stored.where(F.col("extraction_date").between(F.lit(low), F.lit(high)))
    keys = list(HISTORY_KEY)
    fresh = first_per_key(staging, keys, order_by)
    return fresh.join(stored.select(*keys).hint("merge"), keys, "left_anti")


def insert_ignore_bucketed(spark: SparkSession, staging: DataFrame, table: str,
                           order_by: tuple[str, ...] = ()) -> None:
    """Load staging into the bucketed history; stored keys win. Safe to rerun; one writer at a time."""
    rows = new_rows_bucketed(spark, staging, table, order_by)
    rows.select(*spark.table(table).columns).write.insertInto(table)  # by position: partition columns come last
    spark.catalog.refreshTable(table)
