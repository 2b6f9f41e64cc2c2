"""Job configuration and session set-up.

One `Config` holds every endpoint and path the three jobs need; `from_env`
reads it from environment variables (all named there). `session_for` builds the
session for a profile ("batch" or "speed") without hard-coding a master: that is
spark-submit's job.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

PROFILES = ("batch", "speed")

# Lifetimes of the two stores.
METRICS_TTL_SECONDS = 86_400  # metrics rows live 24 h after they are written
TOPIC_RETENTION_MS = 172_800_000  # the topic keeps messages 48 h
STREAM_TRIGGER = "3 seconds"


@dataclass(frozen=True)
class Config:
    """Where things live. Every path may be any Hadoop URI (s3a://, abfss://, hdfs://)."""

    warehouse: str = ""  # a folder that driver and executors share
    landing_dir: str | None = None  # raw snapshot files (JSON arrays)
    topic_dir: str | None = None  # file-backed topic when no broker is given
    kafka_servers: str | None = None  # "host:port[,host:port]"
    topic: str | None = None
    tz: str = "UTC"
    shuffle_partitions: int | None = None
    jdbc_url: str | None = None
    jdbc_user: str | None = None
    jdbc_password: str | None = None
    jdbc_driver: str = "org.postgresql.Driver"
    jdbc_connections: int = 8  # connections a JDBC write opens at most
    metrics_format: str = "parquet"  # or a connector's, e.g. "org.apache.spark.sql.cassandra"
    metrics_keyspace: str | None = None
    metrics_table: str = "metrics"
    metrics_host: str | None = None
    metrics_port: str | None = None
    metrics_user: str | None = None
    metrics_password: str | None = None
    extra: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.warehouse:
            raise ValueError("set warehouse to a folder that driver and executors share")

    # Table locations inside the warehouse.
    @property
    def history_path(self) -> str:
        return f"{self.warehouse}/bike_points"

    @property
    def staging_path(self) -> str:
        return f"{self.warehouse}/stg_bike_points"

    @property
    def metrics_path(self) -> str:
        return f"{self.warehouse}/metrics"

    @property
    def views_path(self) -> str:
        return f"{self.warehouse}/views"

    @property
    def quarantine_path(self) -> str:
        return f"{self.warehouse}/quarantine"

    @property
    def zones_path(self) -> str:
        return f"{self.warehouse}/zones"

    def checkpoint(self, name: str) -> str:
        return f"{self.warehouse}/_checkpoints/{name}"

    def message_source(self) -> tuple[str, dict]:
        """(format, options) of the topic: Kafka when a broker is set, else Parquet files."""
        if self.kafka_servers and not self.topic:
            raise ValueError("set the topic's name")
        if self.kafka_servers:
            return "kafka", {"kafka.bootstrap.servers": self.kafka_servers, "subscribe": self.topic}
        if not self.topic_dir:
            raise ValueError("set kafka_servers or topic_dir")
        return "parquet", {"path": self.topic_dir}

    def jdbc_properties(self) -> dict:
        props = {"driver": self.jdbc_driver}
        if self.jdbc_user is not None:
            props["user"] = self.jdbc_user
        if self.jdbc_password is not None:
            props["password"] = self.jdbc_password
        return props

    def metrics_sink(self) -> tuple[str, dict]:
        """(format, options) of the metrics store: Parquet files, or a connector's table with row lifetimes."""
        if self.metrics_format == "parquet":
            return "parquet", {}
        if not self.metrics_keyspace:
            raise ValueError("set metrics_keyspace for a metrics store other than files")
        return self.metrics_format, {
            "keyspace": self.metrics_keyspace, "table": self.metrics_table, "ttl": str(METRICS_TTL_SECONDS)
        }

    def metrics_connection(self) -> dict:
        """Session settings of the metrics store's connector, for the settings that are given."""
        given = {"host": self.metrics_host, "port": self.metrics_port}
        out = {f"spark.cassandra.connection.{k}": v for k, v in given.items() if v}
        given = {"username": self.metrics_user, "password": self.metrics_password}
        return out | {f"spark.cassandra.auth.{k}": v for k, v in given.items() if v}

    @classmethod
    def from_env(cls, env: dict | None = None) -> "Config":
        """Build from environment variables.

        DOCKYARD_WAREHOUSE, DOCKYARD_LANDING_DIR, DOCKYARD_TOPIC_DIR, DOCKYARD_TZ, DOCKYARD_SHUFFLE_PARTITIONS;
        the topic: DOCKYARD_KAFKA_SERVERS, or BROKER1 and PORT1, and TOPIC_DATA; the relational copy:
        DOCKYARD_JDBC_URL, or POSTGRES_HOST, POSTGRES_PORT and POSTGRES_HISTORICAL_DATA_DB, and POSTGRES_USER,
        POSTGRES_PASSWORD; the metrics store: METRICS_FORMAT, METRICS_KEYSPACE, METRICS_TABLE, METRICS_HOST,
        METRICS_PORT, METRICS_USER, METRICS_PASSWORD.
        """
        e = os.environ if env is None else env
        broker, port = e.get("BROKER1"), e.get("PORT1")
        servers = e.get("DOCKYARD_KAFKA_SERVERS") or (f"{broker}:{port}" if broker and port else None)
        host, pport, db = e.get("POSTGRES_HOST"), e.get("POSTGRES_PORT"), e.get("POSTGRES_HISTORICAL_DATA_DB")
        url = e.get("DOCKYARD_JDBC_URL") or (
            f"jdbc:postgresql://{host}:{pport}/{db}" if host and pport and db else None
        )
        parts = e.get("DOCKYARD_SHUFFLE_PARTITIONS")
        return cls(
            warehouse=e.get("DOCKYARD_WAREHOUSE", cls.warehouse),
            landing_dir=e.get("DOCKYARD_LANDING_DIR"),
            topic_dir=e.get("DOCKYARD_TOPIC_DIR"),
            kafka_servers=servers,
            topic=e.get("TOPIC_DATA", cls.topic),
            tz=e.get("DOCKYARD_TZ", cls.tz),
            shuffle_partitions=int(parts) if parts else None,
            jdbc_url=url,
            jdbc_user=e.get("POSTGRES_USER"),
            jdbc_password=e.get("POSTGRES_PASSWORD"),
            metrics_format=e.get("METRICS_FORMAT", cls.metrics_format),
            metrics_keyspace=e.get("METRICS_KEYSPACE"),
            metrics_table=e.get("METRICS_TABLE", cls.metrics_table),
            metrics_host=e.get("METRICS_HOST"),
            metrics_port=e.get("METRICS_PORT"),
            metrics_user=e.get("METRICS_USER"),
            metrics_password=e.get("METRICS_PASSWORD"),
        )


def session_for(profile: str, tz: str = "UTC", config: Config | None = None,
                builder: SparkSession.Builder | None = None, ui: bool = False) -> SparkSession:
    """Session for the batch or the speed job.

    AQE re-plans joins and coalesces shuffle partitions at run time; skew-join
    splitting is on because one docking point may carry a large share of rows.
    The session time zone is pinned: messages carry wall-clock times in `tz`.
    Every write states its own overwrite mode, so no session default is changed.
    The web UI stays off unless `ui=True` (it is a server with an open port).
    """
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}, not {profile!r}")
    b = builder or SparkSession.builder
    b = (
        b.appName(f"dockyard-{profile}")
        .config("spark.ui.enabled", str(ui).lower())
        .config("spark.sql.session.timeZone", tz)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Coalesce to the advisory size rather than to the most tasks: rebalanced writes then
        # produce files of about that size, and tiny post-aggregation partitions are merged.
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if config is not None and config.shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(config.shuffle_partitions))
    if profile == "speed":
        # Micro-batches every few seconds: small state, and the connector that only this job writes to.
        b = b.config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
        for k, v in (config.metrics_connection() if config is not None else {}).items():
            b = b.config(k, v)
    if config is not None:
        for k, v in config.extra.items():
            b = b.config(k, v)
    return b.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    The folder comes from the session (the `spark.checkpoint.dir` setting, or
    the context's checkpoint dir). Only a local master may go without (tests):
    it gets a temporary directory, which is registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="dockyard-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
