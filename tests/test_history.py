"""insert-ignore of staging into history (operator and Parquet table)."""

from pyspark.sql import functions as F

from dock_rows import messages, point

from dockyard.operators.enrich import enrich
from dockyard.operators.history import first_per_key, new_rows
from dockyard.schema import ARRIVAL
from dockyard.sinks.tables import insert_ignore
from dockyard.sources.tables import read_history


def hist(spark, rows, offsets=None):
    df = enrich(messages(spark, rows))
    if offsets is not None:
        df = df.withColumn("offset", F.element_at(F.array(*[F.lit(o) for o in offsets]),
                                                  F.monotonically_increasing_id().cast("int") + 1))
    return df


def keyset(df):
    return sorted((r["bike_point_id"], str(r["extraction_datetime"]), r["nb_bikes"]) for r in df.collect())


def test_existing_rows_win_and_new_added(spark):
    stored = hist(spark, [point("a", "2024-01-01 10:00:00", bikes=1)])
    staging = hist(spark, [point("a", "2024-01-01 10:00:00", bikes=9), point("b", "2024-01-01 10:00:00", bikes=2)])
    add = new_rows(staging, stored)
    assert keyset(add) == [("b", "2024-01-01 10:00:00", 2)]


def test_staging_duplicates_collapse_to_lowest_order(spark):
    rows = [point("a", "2024-01-01 10:00:00", bikes=b) for b in (5, 3, 8)]
    offsets = F.when(F.col("nb_bikes") == 5, 30).when(F.col("nb_bikes") == 3, 20).otherwise(10)
    staging = enrich(messages(spark, rows)).withColumn("offset", offsets)
    out = first_per_key(staging, order_by=("offset",)).collect()
    assert len(out) == 1 and out[0]["nb_bikes"] == 8 and out[0]["offset"] == 10


def test_empty_sides(spark):
    rows = [point("a", "2024-01-01 10:00:00"), point("a", "2024-01-01 10:00:00")]
    staging = hist(spark, rows)
    empty = staging.where(F.lit(False))
    assert len(new_rows(staging, empty).collect()) == 1
    assert new_rows(empty, staging).count() == 0


def test_parquet_insert_ignore_idempotent(spark, tmp_dir):
    path = f"{tmp_dir}/history"
    day1 = hist(spark, [point("a", "2024-01-01 10:00:00", bikes=1), point("b", "2024-01-02 10:00:00", bikes=2)])
    insert_ignore(spark, day1, path)
    assert read_history(spark, path).count() == 2
    overlap = hist(spark, [point("a", "2024-01-01 10:00:00", bikes=7), point("c", "2024-01-03 10:00:00", bikes=3),
                           point("c", "2024-01-03 10:00:00", bikes=4)])
    insert_ignore(spark, overlap, path)
    insert_ignore(spark, overlap, path)  # rerun: no change
    h = read_history(spark, path)
    assert keyset(h.select("bike_point_id", "extraction_datetime", "nb_bikes")) in (
        [("a", "2024-01-01 10:00:00", 1), ("b", "2024-01-02 10:00:00", 2), ("c", "2024-01-03 10:00:00", 3)],
        [("a", "2024-01-01 10:00:00", 1), ("b", "2024-01-02 10:00:00", 2), ("c", "2024-01-03 10:00:00", 4)],
    )
    assert h.groupBy("bike_point_id", "extraction_datetime").count().where("count > 1").count() == 0
    insert_ignore(spark, day1.where(F.lit(False)), path)  # empty staging: no change
    assert read_history(spark, path).count() == 3


def test_history_scan_is_pruned_to_staging_dates(spark, tmp_dir):
    path = f"{tmp_dir}/history"
    insert_ignore(spark, hist(spark, [point("a", f"2024-01-0{d} 10:00:00") for d in range(1, 9)]), path)
    staging = hist(spark, [point("a", "2024-01-03 10:00:00"), point("b", "2024-01-06 10:00:00")])
    staging.write.parquet(f"{tmp_dir}/staging")
    add = new_rows(spark.read.parquet(f"{tmp_dir}/staging"), read_history(spark, path), prune_on="extraction_date")
    plan = add._jdf.queryExecution().executedPlan().toString()
    # a static range from the first to the last staging date, and the dates themselves at run time
    scan = [x for x in plan.splitlines() if "FileScan" in x and "/history" in x][0]
    assert ">= 2024-01-03" in scan.split("PartitionFilters")[1] and "dynamicpruning" in plan
    assert "RoundRobin" not in plan
    assert keyset(add) == [("b", "2024-01-06 10:00:00", 5)]


def test_earliest_arrival_wins_across_partitions(spark):
    rows = [point("a", "2024-01-01 10:00:00", bikes=b) for b in (5, 3, 8)]
    arrived = F.when(F.col("nb_bikes") == 3, F.lit("2024-01-01 10:00:01")).otherwise(F.lit("2024-01-01 10:00:09"))
    staging = enrich(messages(spark, rows)).withColumn("timestamp", arrived.cast("timestamp"))
    # a later message with a smaller offset, in another partition
    staging = staging.withColumn("partition", F.col("nb_bikes") % 2).withColumn("offset", F.lit(10) - F.col("nb_bikes"))
    assert [r["nb_bikes"] for r in first_per_key(staging, order_by=ARRIVAL).collect()] == [3]
