"""Configuration, session profiles and connector option builders."""

import pytest

from dockyard.config import Config, session_for
from dockyard.sinks.jdbc import jdbc_options
from dockyard.sinks.messages import kafka_writer_options
from dockyard.sinks.metrics import metrics_ddl
from dockyard.sinks.tables import history_ddl
from dockyard.sources.messages import message_reader_options


def test_from_env():
    cfg = Config.from_env({"BROKER1": "b", "PORT1": "9092", "TOPIC_DATA": "t", "POSTGRES_HOST": "h",
                           "POSTGRES_PORT": "5432", "POSTGRES_HISTORICAL_DATA_DB": "db",
                           "POSTGRES_USER": "u", "POSTGRES_PASSWORD": "p", "DOCKYARD_WAREHOUSE": "/w"})
    assert cfg.kafka_servers == "b:9092" and cfg.topic == "t"
    assert cfg.jdbc_url == "jdbc:postgresql://h:5432/db"
    assert cfg.jdbc_properties() == {"driver": "org.postgresql.Driver", "user": "u", "password": "p"}
    assert cfg.message_source() == ("kafka", {"kafka.bootstrap.servers": "b:9092", "subscribe": "t"})
    assert cfg.history_path == "/w/bike_points"


def test_file_topic_and_missing_topic():
    assert Config("/w", topic_dir="/x").message_source() == ("parquet", {"path": "/x"})
    with pytest.raises(ValueError):
        Config("/w").message_source()
    with pytest.raises(ValueError):
        Config("/w", kafka_servers="b:1").message_source()  # no topic named
    with pytest.raises(ValueError):
        Config()


def test_session_profile_check():
    with pytest.raises(ValueError):
        session_for("nightly")


def test_reader_options():
    assert message_reader_options("kafka", {"subscribe": "t"}, streaming=False)["startingOffsets"] == "earliest"
    assert message_reader_options("kafka", {"subscribe": "t"}, streaming=True)["startingOffsets"] == "latest"
    assert "startingOffsets" not in message_reader_options("parquet", {"path": "/x"}, streaming=True)


def test_writer_options():
    assert kafka_writer_options("b:1", "t") == {"kafka.bootstrap.servers": "b:1", "topic": "t"}
    o = jdbc_options("jdbc:x", "stg_bike_points", {"driver": "d"}, batchsize=5)
    assert o == {"url": "jdbc:x", "dbtable": "stg_bike_points", "driver": "d", "batchsize": "5"}


def test_history_ddl(spark, tmp_dir):
    ddl = history_ddl("bike_points_t", f"{tmp_dir}/bp")
    assert "PARTITIONED BY (extraction_date)" in ddl
    spark.sql(ddl)
    spark.sql(ddl)  # IF NOT EXISTS
    assert spark.table("bike_points_t").columns[0] == "bike_point_id"


def test_metrics_ddl(spark, tmp_dir):
    ddl = metrics_ddl("metrics_t", f"{tmp_dir}/m")
    assert "PARTITIONED BY (written_date)" in ddl and "run_id STRING" in ddl and "written_at TIMESTAMP" in ddl
    spark.sql(ddl)
    spark.sql(ddl)
    assert "percentage_broken_docks" in spark.table("metrics_t").columns


def test_session_for_settings(spark):
    keys = ("spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst", "spark.sql.parquet.compression.codec")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        s = session_for("batch")  # the active session, with the settings applied
        assert s.conf.get("spark.sql.session.timeZone") == "UTC"
        assert s.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
        assert s.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "256m"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


STORE = {"DOCKYARD_WAREHOUSE": "/w", "METRICS_FORMAT": "org.apache.spark.sql.cassandra", "METRICS_KEYSPACE": "ks",
         "METRICS_HOST": "h", "METRICS_PORT": "9042", "METRICS_USER": "u", "METRICS_PASSWORD": "p"}


def test_metrics_store_from_env():
    assert Config("/w").metrics_sink() == ("parquet", {})
    cfg = Config.from_env(STORE)
    assert cfg.metrics_sink() == (
        "org.apache.spark.sql.cassandra", {"keyspace": "ks", "table": "metrics", "ttl": "86400"})
    assert cfg.metrics_connection() == {
        "spark.cassandra.connection.host": "h", "spark.cassandra.connection.port": "9042",
        "spark.cassandra.auth.username": "u", "spark.cassandra.auth.password": "p"}
    with pytest.raises(ValueError):
        Config("/w", metrics_format="x").metrics_sink()


def test_store_settings_are_the_speed_sessions_alone(spark):
    class Recorder:
        """Takes settings as a session builder does and keeps them."""

        def __init__(self):
            self.conf = {}

        def appName(self, name):
            return self

        def config(self, key, value):
            self.conf[key] = value
            return self

        def getOrCreate(self):
            return self.conf

    cfg = Config.from_env(STORE)
    speed, batch = (session_for(p, config=cfg, builder=Recorder()) for p in ("speed", "batch"))
    assert cfg.metrics_connection().items() <= speed.items()
    assert not any("cassandra" in k for k in batch)


def test_speed_job_writes_to_the_configured_store(spark, tmp_dir, monkeypatch):
    from dockyard.plans import jobs

    seen = {}
    monkeypatch.setattr(jobs, "run_metrics_stream", lambda *a, **kw: seen.update(kw))
    jobs.speed_job(spark, Config(tmp_dir, topic_dir=tmp_dir, metrics_format="x", metrics_keyspace="k"), wait=False)
    assert seen == {"fmt": "x", "options": {"keyspace": "k", "table": "metrics", "ttl": "86400"}}
