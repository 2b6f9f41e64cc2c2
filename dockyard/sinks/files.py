"""Directories of a shared store, through the file system API that Spark itself uses (any Hadoop URI)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly under `path`, ascending; none where it does not exist."""
    _, p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    _, p, fs = _path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    _, p, fs = _path(spark, path)
    fs.delete(p, True)
