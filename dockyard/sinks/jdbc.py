"""JDBC sink (the staging table of a relational history store)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_options(url: str, table: str, properties: dict | None = None, **extra) -> dict:
    """Option dict of a JDBC read or write: url, table, driver, credentials, tuning."""
    opts = {"url": url, "dbtable": table}
    opts.update(properties or {})
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "overwrite", truncate: bool = False, batchsize: int = 10_000,
               num_partitions: int | None = None) -> None:
    """Write `df` to a JDBC table; overwrite replaces the table (truncate keeps its DDL).

    Each Spark partition writes through its own connection; `num_partitions`
    caps the number of concurrent connections the database sees.
    """
    opts = jdbc_options(url, table, properties, batchsize=batchsize, truncate=str(truncate).lower())
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    df.write.format("jdbc").options(**opts).mode(mode).save()
