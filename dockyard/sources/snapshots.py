"""Raw snapshot files: JSON arrays of nested docking-point objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dockyard.schema import RAW_SNAPSHOT


def read_snapshots(spark: SparkSession, path: str, streaming: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """One row per array element of every landed snapshot file (fixed schema, no inference).

    Each file is one JSON array, read whole by one task (multi-line JSON does
    not split); many files are read in parallel.
    """
    if streaming:
        r = spark.readStream.schema(RAW_SNAPSHOT).option("multiLine", True)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.json(path)
    return spark.read.schema(RAW_SNAPSHOT).option("multiLine", True).json(path)
