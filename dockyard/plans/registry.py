"""Registered queries and their DuckDB oracles.

Every query reads the driver's tables (`events`) and derives docking-point
messages from them with the fixed recipe of `dockyard.sources.events`, then
runs the library's operators over the whole table. Each oracle is the same
computation written independently in DuckDB SQL over the `events` view.

Output convention (both sides): decimals are returned as DOUBLE and dates as
TIMESTAMP, so values compare equal whatever container the comparing tool
converts them to. The library functions themselves keep decimal/date types.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockyard.config import Config, scratch_dir
from dockyard.operators import charts, views
from dockyard.operators.decode import decode_messages, decode_valid
from dockyard.operators.enrich import history_from_wire
from dockyard.operators.extras import decode_extras, flatten_with_extras
from dockyard.operators.history import first_per_key, new_rows
from dockyard.operators.metrics import latest_per_key, fleet_metrics
from dockyard.operators.retention import current_metrics, topic_retention, within_retention
from dockyard.operators.staging import encode_messages, flatten_snapshot
from dockyard.operators.summaries import (
    avg_in_use_from_summary,
    broken_docks_by_date_from_summary,
    non_availability_from_summary,
    peak_hours_from_summary,
)
from dockyard.plans.catalog import ask, publish
from dockyard.plans.jobs import batch_job, setup_job, speed_job, stage_job
from dockyard.plans.serving import register_tables
from dockyard.schema import ARRIVAL, HISTORY, WIRE
from dockyard.sinks.bucketed import create_bucketed_history, insert_ignore_bucketed
from dockyard.sinks.files import exists
from dockyard.sinks.metrics import compact_metrics, write_metrics
from dockyard.sinks.tables import read_view
from dockyard.sinks.topic import expire_segments, read_segments, write_segments
from dockyard.sinks.zones import lookup
from dockyard.sources.events import (
    MESSAGE_COLUMNS,
    docking_rows,
    read_events,
    snapshot_rows,
    wire_messages,
)
from dockyard.sources.messages import read_messages
from dockyard.sources.tables import metrics_files, read_history, read_metrics
from dockyard.streaming.fleet_state import fleet_history, run_fleet_stream
from dockyard.streaming.windows import run_moves_stream, run_windows_stream, turnover, window_metrics
from dockyard.streaming.metrics_stream import SPEED_FIELDS, poll_metrics, run_metrics_stream, run_polls_stream

# Fixed parameters of the checked queries.
HISTORY_BEFORE = "2024-01-20 00:00:00"  # insert-ignore: stored rows arrived before this
STAGING_FROM = "2024-01-15 00:00:00"  # insert-ignore: staging rows arrived from this on
# The three overlapping loads of the stored chain: from, to.
LOADS = (("", "2024-01-12 10:30:00"), ("2024-01-10 00:00:00", "2024-01-20 00:00:00"), ("2024-01-18 00:00:00", ""))
CURRENT_AS_OF = "2024-01-30 12:00:00"  # chart_current_state / metrics_ttl clock
TTL_AS_OF = "2024-01-25 00:30:00"
TOPIC_AS_OF = "2024-01-20 00:00:00"
UPSERT_AS_OF = "2024-01-31 00:00:00"
COMPACT_AS_OF = "2024-01-26 09:00:00"
COMPACT_TTL_SECONDS = 10 * 86_400
UPSERT_TTL_SECONDS = 40 * 86_400  # keeps every row alive, so only last-write-wins acts


# --------------------------------------------------------------------------- helpers


def oracle_types(df: DataFrame) -> DataFrame:
    """Decimals -> double, dates -> timestamp (output convention of this registry)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _rows(spark: SparkSession, sf: str, unit: str = "second") -> DataFrame:
    return docking_rows(read_events(spark, sf), unit)


def _decoded(spark: SparkSession, sf: str, unit: str = "second") -> DataFrame:
    """Derived rows -> JSON messages -> decoded messages (+ offset, arrival timestamp)."""
    return decode_messages(wire_messages(_rows(spark, sf, unit)), keep=ARRIVAL, single_parse=True)


def _history(spark: SparkSession, sf: str, keep: tuple[str, ...] = (), unit: str = "second") -> DataFrame:
    """History rows the batch path builds from the derived topic (decode once, valid only, enrich)."""
    return history_from_wire(wire_messages(_rows(spark, sf, unit)), keep=keep)


def _metrics_log(spark: SparkSession, sf: str) -> DataFrame:
    """A metrics store as the stream would fill it, one poll = one day of messages.

    Each day is written once (round 0: all messages, written_at = newest
    instant + 1 min) and again from its non-error messages only (round 1, one
    minute later); where both writes share (min, max) the second one must win.
    One scan serves both rounds: each message is tagged with the rounds it
    belongs to, and the rounds are aggregated side by side.
    """
    rounds = F.when(F.col("Installed") == "true", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    dec = (
        _decoded(spark, sf)
        .withColumn("day", F.to_date("extraction_datetime"))
        .withColumn("round", F.explode(rounds))
    )
    both = fleet_metrics(dec, tiebreak=ARRIVAL, group=["day", "round"])
    return both.select(
        *[c for c in both.columns if c not in ("day", "round")],
        (F.col("max_extraction_datetime") + F.make_dt_interval(mins=F.col("round") + 1)).alias("written_at"),
        F.lit("stream").alias("run_id"),
        ((F.datediff("day", F.lit("2024-01-01")) * 2) + F.col("round")).cast("bigint").alias("batch_id"),
    )


# --------------------------------------------------------------------------- queries


def q_decode_messages(spark, sf):
    return oracle_types(_decoded(spark, sf).select(*MESSAGE_COLUMNS))


def q_flatten_snapshot(spark, sf):
    raw = snapshot_rows(_rows(spark, sf))
    flat = flatten_snapshot(raw, tz="UTC")
    return oracle_types(decode_messages(encode_messages(flat)))


def q_unknown_attributes(spark, sf):
    """An attribute that is not among the six fixed ones: snapshot -> message -> read by key and type, per point."""
    flat = flatten_with_extras(snapshot_rows(_rows(spark, sf)), tz="UTC")
    wanted = {"terminal": ("TerminalName", "int"), "absent": ("NoSuchAttribute", "string")}
    rows = decode_extras(encode_messages(flat), wanted)
    return rows.groupBy("id").agg(
        F.count("terminal").alias("nb_terminals"), F.min("terminal").alias("least_terminal"),
        F.max("terminal").alias("greatest_terminal"), F.count("absent").alias("nb_absent"),
        F.max("extraction_datetime").alias("newest"))


def q_valid_rows(spark, sf):
    rows = _rows(spark, sf)
    good = wire_messages(rows).select("value")
    bad_ts = encode_messages(
        rows.where(F.col("Installed") == "false").select(
            *[F.lit("garbage").alias(c) if c == "extraction_datetime" else F.col(c) for c in MESSAGE_COLUMNS]
        )
    )
    no_id = encode_messages(rows.where(F.col("Locked") == "true").select(*MESSAGE_COLUMNS).drop("id"))
    msgs = good.unionByName(bad_ts).unionByName(no_id)
    return oracle_types(decode_valid(msgs))


def q_broken_docks(spark, sf):
    return _history(spark, sf).select(
        "bike_point_id", "extraction_datetime", "nb_docks", "nb_bikes", "nb_empty_docks", "nb_broken_docks"
    )


def q_calendar_fields(spark, sf):
    return oracle_types(
        _history(spark, sf).select(
            "bike_point_id", "extraction_datetime", "extraction_date", "month_name", "month_number",
            "day_of_month", "week_of_year", "day_of_week", "day_of_week_number", "hour",
        )
    )


def q_hour_buckets(spark, sf):
    return _history(spark, sf).select("bike_point_id", "extraction_datetime", "hour", "hour_interval")


def q_history_rows(spark, sf):
    return oracle_types(_history(spark, sf))


def q_insert_ignore(spark, sf):
    """As the sink does it: staging and history are stored tables, history partitioned by date."""
    root = scratch_dir(spark, "insert_ignore")
    rows = _history(spark, sf, keep=ARRIVAL, unit="hour")
    split = rows.withColumn("old", F.col("timestamp") < F.to_timestamp(F.lit(HISTORY_BEFORE))).withColumn(
        "new", F.col("timestamp") >= F.to_timestamp(F.lit(STAGING_FROM)))
    split.write.parquet(f"{root}/rows")
    split = spark.read.parquet(f"{root}/rows")
    first = first_per_key(split.where("old").drop("old", "new"), order_by=ARRIVAL)
    first.hint("rebalance", "extraction_date").write.partitionBy("extraction_date").parquet(f"{root}/history")
    split.where("new").drop("old", "new").write.parquet(f"{root}/staging")
    stored, staging = (spark.read.parquet(f"{root}/{t}") for t in ("history", "staging"))
    added = new_rows(staging, stored, order_by=ARRIVAL, prune_on="extraction_date")
    cols = ["bike_point_id", "extraction_datetime", "nb_bikes", "nb_empty_docks", "offset"]
    return stored.select(*cols, F.lit("old").alias("origin")).unionByName(
        added.select(*cols, F.lit("new").alias("origin")))


def q_insert_ignore_bucketed(spark, sf):
    """Insert-ignore into a bucketed catalog table, in two loads: only staging is shuffled (tests/test_history.py)."""
    root = scratch_dir(spark, "insert_ignore_bucketed")
    table = f"history_{uuid.uuid4().hex[:12]}"
    create_bucketed_history(spark, table, f"{root}/history", 4)
    rows = _history(spark, sf, keep=ARRIVAL, unit="hour")
    for name, part in (("old", F.col("timestamp") < F.to_timestamp(F.lit(HISTORY_BEFORE))),
                       ("new", F.col("timestamp") >= F.to_timestamp(F.lit(STAGING_FROM)))):
        rows.where(part).write.parquet(f"{root}/{name}")
        insert_ignore_bucketed(spark, spark.read.parquet(f"{root}/{name}"), table, ARRIVAL)
    return oracle_types(spark.table(table).select(*HISTORY.fieldNames()))


# Lookup: two points, Mondays and Saturdays.
LOOKUP_POINTS, LOOKUP_WEEKDAYS = ("BikePoints_7", "BikePoints_42"), (2, 7)


def q_history_lookup(spark, sf):
    """History rows of two points on two weekdays, from the files that the zone map leaves."""
    cfg = _loaded(spark, sf)
    return oracle_types(lookup(spark, cfg.history_path, cfg.zones_path, LOOKUP_POINTS, LOOKUP_WEEKDAYS))


def q_latest_per_point(spark, sf):
    dec = _decoded(spark, sf).withColumn("NbBrokenDocks", F.col("NbDocks") - (F.col("NbBikes") + F.col("NbEmptyDocks")))
    return latest_per_key(dec, "id", tiebreak=ARRIVAL)


def q_fleet_metrics(spark, sf):
    return fleet_metrics(_decoded(spark, sf), tiebreak=ARRIVAL)


def q_metrics_per_batch(spark, sf):
    dec = _decoded(spark, sf).withColumn("day", F.to_date("extraction_datetime"))
    return fleet_metrics(dec, tiebreak=ARRIVAL, group="day").drop("day")


def _land(rows: DataFrame, path: str, files_per_day: int = 4) -> None:
    """The derived messages as a file topic: several files for each day, so no day is one task's or one batch's."""
    wire = wire_messages(rows).withColumn("day", F.to_date("timestamp"))
    part = F.pmod(F.xxhash64("value", "offset"), F.lit(files_per_day))
    wire.repartition(F.col("day"), part).write.partitionBy("day").parquet(path)


#: Elements of a landed snapshot file, on average: a file is one JSON string, built and parsed by one task.
SNAPSHOT_ELEMENTS = 5_000
#: Landed files that one task builds, on average: each is a hundred times its size in the shuffle before.
SNAPSHOT_FILES_PER_TASK = 8


def _land_snapshots(rows: DataFrame, path: str, most: int = SNAPSHOT_ELEMENTS,
                    form: Callable[[DataFrame, tuple[str, ...]], DataFrame] | None = None) -> None:
    """`rows` (with event_id and poll) as JSON arrays, compressed: each poll in as many files as its elements call for.

    `form` makes elements of rows (and keeps the columns named to it). It comes after the rows are dealt to files, so that
    the flat rows are moved and not the elements, which say every name over again.
    """
    files = rows.groupBy("poll").agg(F.ceil(F.count(F.lit(1)) / most).alias("files"))
    tasks = -(-(files.agg(F.sum("files")).first()[0] or 0) // SNAPSHOT_FILES_PER_TASK)
    part = F.pmod(F.xxhash64("event_id"), F.col("files")).alias("part")
    dealt = rows.join(F.broadcast(files), "poll").select(*rows.columns, part)  # polls are few: a row for each
    dealt = dealt.repartition(max(tasks, rows.sparkSession.sparkContext.defaultParallelism), "poll", "part")
    elements = form(dealt, ("poll", "part")) if form else dealt
    fields = [c for c in elements.columns if c not in ("event_id", "poll", "part")]
    arrays = elements.groupBy("poll", "part").agg(F.to_json(F.collect_list(F.struct(*fields))).alias("value"))
    # A folder for each array: a file with two of them would be read as the first.
    arrays.write.mode("append").partitionBy("poll", "part").option("compression", "gzip").text(path)


def q_metrics_stream(spark, sf):
    """The streaming path end to end: a poll is a day, its files are spread over micro-batches."""
    root = scratch_dir(spark, "metrics_stream")
    _land(_rows(spark, sf), f"{root}/landing")
    stream = read_messages(spark, "parquet", {"path": f"{root}/landing"}, streaming=True, max_files_per_trigger=50)
    q = run_polls_stream(stream, F.to_date("extraction_datetime"), f"{root}/sink", f"{root}/checkpoint",
                         {"availableNow": True})
    q.awaitTermination()
    return poll_metrics(spark, f"{root}/sink").drop("poll")


def q_metrics_after_restart(spark, sf):
    """Two runs of the speed job's stream on different checkpoints into one store: no row is lost."""
    root = scratch_dir(spark, "metrics_restart")
    rows = _rows(spark, sf)
    split = F.col("ts") < F.to_timestamp(F.lit(STAGING_FROM))
    for run, part in (("one", split), ("two", ~split)):
        _land(rows.where(part), f"{root}/{run}")
        stream = read_messages(spark, "parquet", {"path": f"{root}/{run}"}, streaming=True)
        run_metrics_stream(stream, f"{root}/store", f"{root}/checkpoint-{run}", {"availableNow": True}).awaitTermination()
    return current_metrics(read_metrics(spark, f"{root}/store", alive_at=F.current_timestamp())).drop(
        "written_at", "run_id", "batch_id")


def q_fleet_state_by_poll(spark, sf):
    """Fleet totals with carried states: two thirds of all messages in four micro-batches, then, after a restart, the
    rest, which falls into polls (days) that are there already."""
    root = scratch_dir(spark, "fleet_state")
    for run, part in enumerate(("event_id % 3 != 0", "event_id % 3 = 0")):
        wire = wire_messages(_rows(spark, sf).where(part))
        wire.repartition(4, F.xxhash64("offset")).write.mode("append").parquet(f"{root}/landing")
        stream = read_messages(spark, "parquet", {"path": f"{root}/landing"}, streaming=True,
                               max_files_per_trigger=None if run else 1)
        run_fleet_stream(stream, "1 day", f"{root}/state", f"{root}/checkpoint", {"availableNow": True},
                         fold_every=3).awaitTermination()
    return fleet_history(spark, f"{root}/state")


# Late messages: one in 17 arrives a group of days later, one in 29 two groups later, one in 13 twice.
GROUP_DAYS, LATE_AFTER = 8, "4 days"
REDELIVERED = ("id", "extraction_datetime", "offset")


def _arrivals(rows: DataFrame) -> DataFrame:
    """Derived rows with `arrival`, the number of the delivery that a message comes with; repeated ones come twice."""
    group = F.floor(F.datediff("ts", F.lit("2024-01-01")) / GROUP_DAYS)
    late = F.when(F.col("event_id") % 29 == 0, 2).when(F.col("event_id") % 17 == 0, 1).otherwise(0)
    times = F.when(F.col("event_id") % 13 == 0, 2).otherwise(1)
    return rows.withColumn("arrival", group + late).withColumn("n", F.explode(F.sequence(F.lit(1), times))).drop("n")


def _deliver(spark, rows: DataFrame, root: str, run: Callable[[DataFrame], object]) -> None:
    """The deliveries in turn: each lands on the topic and is taken in by a run of the stream, which then stops."""
    _arrivals(rows).write.partitionBy("arrival").parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    for (n,) in sorted(rows.select("arrival").distinct().collect()):
        wire_messages(rows.where(F.col("arrival") == n)).write.mode("append").parquet(f"{root}/landing")
        run(read_messages(spark, "parquet", {"path": f"{root}/landing"}, streaming=True)).awaitTermination()


def q_late_windows(spark, sf):
    """Daily windows in append mode over late and repeated messages; the stream stops and restarts between deliveries."""
    root = scratch_dir(spark, "late_windows")
    _deliver(spark, _rows(spark, sf), root, lambda stream: run_windows_stream(
        stream, "1 day", LATE_AFTER, f"{root}/sink", f"{root}/checkpoint", {"availableNow": True}, REDELIVERED))
    return window_metrics(spark, f"{root}/sink")


def q_window_turnover(spark, sf):
    """Dedup, windowed newest state and a stream-stream join of consecutive days, in two runs of the stream."""
    root = scratch_dir(spark, "window_turnover")
    rows = _rows(spark, sf)
    for part in (F.col("ts") < F.to_timestamp(F.lit(STAGING_FROM)), F.col("ts") >= F.to_timestamp(F.lit(STAGING_FROM))):
        twice = rows.where(part).unionByName(rows.where(part & (F.col("event_id") % 13 == 0)))
        wire_messages(twice).write.mode("append").parquet(f"{root}/landing")
        stream = read_messages(spark, "parquet", {"path": f"{root}/landing"}, streaming=True)
        run_moves_stream(stream, "1 day", LATE_AFTER, f"{root}/sink", f"{root}/checkpoint", {"availableNow": True},
                         REDELIVERED).awaitTermination()
    return turnover(spark, f"{root}/sink")


def q_speed_job(spark, sf):
    """The speed job as users run it: its 3 s trigger over a file topic, stopped when it has seen everything, then
    started again, when it finds nothing new and adds no row."""
    root = scratch_dir(spark, "speed_job")
    cfg = Config(warehouse=f"{root}/warehouse", topic_dir=f"{root}/topic")
    wire_messages(_rows(spark, sf)).write.parquet(cfg.topic_dir)
    for _ in range(2):
        q = speed_job(spark, cfg, wait=False)
        q.processAllAvailable()
        q.stop()
    return read_metrics(spark, cfg.metrics_path).drop("written_at", "run_id", "batch_id")


def q_compacted_metrics(spark, sf):
    """A metrics store of one write date per poll (day), compacted at a fixed instant: expired dates are gone, the
    others are one file each, and rows written twice are folded."""
    root = scratch_dir(spark, "compacted_metrics")
    log = _metrics_log(spark, sf).select("*", F.to_date("written_at").alias("written_date"))
    log.coalesce(4).write.partitionBy("written_date").parquet(f"{root}/log")
    compact_metrics(spark, root, COMPACT_AS_OF, COMPACT_TTL_SECONDS)
    return metrics_files(spark, root).withColumn("written_date", F.col("written_date").cast("timestamp"))


def q_rejected_messages(spark, sf):
    """Messages by what became of them in the batch job: loaded, or in the quarantine with a reason."""
    root = scratch_dir(spark, "rejected")
    cfg = Config(warehouse=f"{root}/warehouse", topic_dir=f"{root}/topic")
    rows = _rows(spark, sf)
    wire = wire_messages(rows)
    text, of = F.col("value").cast("string"), lambda n: F.col("offset") % n == 0
    changed = F.when(of(7), F.expr("substring(text, 1, length(text) - 9)")).when(of(11), F.lit("[1, 2]")).when(
        of(13), F.regexp_replace("text", '"id":"[^"]*",', "")).when(
        of(17), F.regexp_replace("text", ',"extraction_datetime":"[^"]*"', "")).when(
        of(19), F.regexp_replace("text", '"extraction_datetime":"[^"]*"', '"extraction_datetime":"soon"')).otherwise(F.col("text"))
    wire = wire.withColumn("text", text).withColumn("value", F.encode(changed, "UTF-8")).drop("text")
    wire.write.parquet(cfg.topic_dir)
    counts = batch_job(spark, cfg, refresh=False, quarantine=True)
    kept = spark.read.parquet(cfg.quarantine_path).groupBy("reason").agg(F.count(F.lit(1)).alias("nb_stored"))
    loaded = spark.read.parquet(cfg.staging_path).agg(F.lit("good").alias("reason"), F.count(F.lit(1)).alias("nb_stored"))
    seen = spark.createDataFrame([(k, v) for k, v in counts.items()], "reason string, nb_counted bigint")
    every = spark.read.parquet(cfg.topic_dir).agg(F.lit("messages").alias("reason"), F.count(F.lit(1)).alias("nb_stored"))
    return kept.unionByName(loaded).unionByName(every).join(seen, "reason")


def q_catalog_sql(spark, sf):
    """Plain SQL in a session that never registered anything: permanent views, SQL functions, a bound parameter."""
    cfg = _loaded(spark, sf)
    database = f"served_{uuid.uuid4().hex[:12]}"
    publish(spark, cfg, database)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    return ask(other, f"""
        SELECT CAST(b.extraction_date AS TIMESTAMP) AS extraction_date, {database}.day_label(b.day_of_week_number, b.day_of_week) AS label,
               b.nb_rows, b.nb_bikes, {database}.percent_of(b.nb_bikes, b.nb_docks) AS percentage_bikes, b.nb_broken,
               c.max_nb_broken_docks, {database}.hour_bucket(b.last_hour) AS last_slot, v.nb_points
        FROM (SELECT extraction_date, day_of_week_number, day_of_week, count(*) AS nb_rows, sum(nb_bikes) AS nb_bikes,
                     sum(nb_docks) AS nb_docks, max(CAST(hour AS INT)) AS last_hour,
                     sum({database}.broken_docks(nb_docks, nb_bikes, nb_empty_docks)) AS nb_broken
              FROM {database}.bike_points WHERE extraction_date >= :first GROUP BY ALL) b
        JOIN {database}.chart_broken_docks_by_date c USING (extraction_date)
        LEFT JOIN (SELECT extraction_date, count(*) AS nb_points FROM {database}.mvw_non_availability_by_day
                   GROUP BY extraction_date) v USING (extraction_date)""", first=dt.date(2024, 1, 8))


def q_view_in_use(spark, sf):
    return views.in_use_by_day(_history(spark, sf))


def q_view_non_availability(spark, sf):
    return oracle_types(views.non_availability_by_day(_history(spark, sf)))


def q_view_non_availability_only_empty(spark, sf):
    return oracle_types(views.non_availability_by_day(_history(spark, sf), only_empty=True))


def q_view_peak_hours(spark, sf):
    return oracle_types(views.peak_hours_by_day(_history(spark, sf)))


def q_view_broken_docks(spark, sf):
    return oracle_types(views.broken_docks_history(_history(spark, sf)))


# --------------------------------------------------------------------------- stored chain

_CHAINS: dict[tuple, Config] = {}


def _once(build: Callable[[SparkSession, str], Config]) -> Callable[[SparkSession, str], Config]:
    """What `build` stored for this application and input is used again by the other queries that read it."""

    def chain(spark: SparkSession, sf: str) -> Config:
        key = (build.__name__, spark.sparkContext.applicationId, sf)
        if key not in _CHAINS or not exists(spark, _CHAINS[key].warehouse):
            _CHAINS[key] = build(spark, sf)
        return _CHAINS[key]

    return chain


@_once
def _loaded(spark: SparkSession, sf: str) -> Config:
    """A warehouse after four runs of the batch job over a growing topic, and a filled metrics store.

    The first run finds invalid messages only, the next three overlap in dates, and the third leaves the views
    alone, so the fourth must refresh its dates as well.
    """
    root = scratch_dir(spark, "loads")
    cfg = Config(warehouse=f"{root}/warehouse", topic_dir=f"{root}/topic")
    # Derived once, from rows that are dealt evenly first: the events may come in few splits, and the topic's files, and
    # so the tasks of each load, are as many as those that land them.
    dealt = read_events(spark, sf).select("event_id", "user_id", "event_type", "ts", "props").hint("rebalance")
    docking_rows(dealt, "hour").write.parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    land = lambda part: wire_messages(rows.where(part)).write.mode("append").parquet(cfg.topic_dir)
    setup_job(spark, cfg, f"loads_{uuid.uuid4().hex[:12]}")
    bad = rows.where("Locked = 'true'").withColumn("extraction_datetime", F.lit(None).cast("timestamp"))
    wire_messages(bad).write.parquet(cfg.topic_dir)
    batch_job(spark, cfg)
    land(f"ts < '{LOADS[0][1]}'")
    batch_job(spark, cfg)
    land(f"ts >= '{LOADS[1][0]}' AND ts < '{LOADS[1][1]}'")
    batch_job(spark, cfg, refresh=False)
    land(f"ts >= '{LOADS[2][0]}'")
    batch_job(spark, cfg)
    seconds = rows.withColumn("extraction_datetime", F.date_trunc("second", "ts"))
    daily = decode_messages(wire_messages(seconds), keep=ARRIVAL, fields=SPEED_FIELDS)
    daily = fleet_metrics(daily.withColumn("day", F.to_date("extraction_datetime")), tiebreak=ARRIVAL, group="day")
    write_metrics(daily, cfg.metrics_path, 0)
    return cfg


@_once
def _staged(spark: SparkSession, sf: str) -> Config:
    """Snapshot files (JSON arrays, some per day) staged twice: each point's counts differ in the second
    run, and the history loaded from the topic must hold the first ones."""
    root = scratch_dir(spark, "stage")
    cfg = Config(warehouse=f"{root}/warehouse", landing_dir=f"{root}/landing", topic_dir=f"{root}/topic")
    rows = _rows(spark, sf).withColumn("id", F.concat(F.lit("BikePoints_"), F.col("event_id").cast("string")))
    day = F.floor(F.unix_seconds("ts") / 86_400).alias("day")
    rows.join(rows.select("event_id", day), "event_id").write.parquet(f"{root}/rows")  # once, for both runs
    rows = spark.read.parquet(f"{root}/rows")
    for run in (0, 1):
        polls = rows.withColumn("NbBikes", F.col("NbBikes") + run).withColumn("poll", F.concat_ws("-", F.lit(run), "day"))
        _land_snapshots(polls.drop("day"), cfg.landing_dir, form=snapshot_rows)
        stage_job(spark, cfg)
    batch_job(spark, cfg)
    return cfg


def q_staged_messages(spark, sf):
    """What two stage runs published: every snapshot element once per run."""
    topic = spark.read.schema(WIRE).parquet(_staged(spark, sf).topic_dir)
    return oracle_types(decode_messages(topic).select(*MESSAGE_COLUMNS))


def q_history_first_stage_wins(spark, sf):
    hist = read_history(spark, _staged(spark, sf).history_path)
    return hist.select("bike_point_id", "extraction_datetime", "nb_bikes", "nb_docks")


def q_history_after_loads(spark, sf):
    return oracle_types(read_history(spark, _loaded(spark, sf).history_path))


def _stored(spark, sf, name):
    cfg = _loaded(spark, sf)
    return read_view(spark, cfg.history_path, cfg.views_path, name)


def q_stored_view_in_use(spark, sf):
    return _stored(spark, sf, "mvw_in_use_bikes_by_day")


def q_stored_view_broken_docks(spark, sf):
    return oracle_types(_stored(spark, sf, "mvw_broken_docks_history"))


def q_stored_view_peak_hours(spark, sf):
    return oracle_types(_stored(spark, sf, "mvw_peak_hours_by_day"))


def q_stored_view_non_availability(spark, sf):
    return oracle_types(_stored(spark, sf, "mvw_non_availability_by_day"))


def q_view_peak_hours_from_summaries(spark, sf):
    return oracle_types(peak_hours_from_summary(_stored(spark, sf, "summary_hourly")))


def q_view_non_availability_from_summaries(spark, sf):
    return oracle_types(non_availability_from_summary(_stored(spark, sf, "summary_daily_points")))


def q_chart_in_use_from_summaries(spark, sf):
    return avg_in_use_from_summary(_stored(spark, sf, "summary_hourly"))


def q_chart_broken_docks_from_summaries(spark, sf):
    return oracle_types(broken_docks_by_date_from_summary(_stored(spark, sf, "summary_daily_points")))


def q_chart_current_state(spark, sf):
    return charts.current_state(_metrics_log(spark, sf), CURRENT_AS_OF)


def q_chart_in_use(spark, sf):
    return charts.avg_in_use_by_day(views.in_use_by_day(_history(spark, sf)))


def q_chart_non_availability(spark, sf):
    return charts.non_availability_heatmap(views.non_availability_by_day(_history(spark, sf)))


def q_chart_peak_hours(spark, sf):
    return charts.peak_hours_heatmap(views.peak_hours_by_day(_history(spark, sf)))


def q_chart_broken_docks(spark, sf):
    return oracle_types(charts.broken_docks_by_date(views.broken_docks_history(_history(spark, sf))))


def q_metrics_upsert(spark, sf):
    return current_metrics(_metrics_log(spark, sf), UPSERT_AS_OF, UPSERT_TTL_SECONDS)


def q_metrics_ttl(spark, sf):
    return within_retention(_metrics_log(spark, sf), "written_at", 86_400, TTL_AS_OF)


def q_topic_retention(spark, sf):
    live = topic_retention(wire_messages(_rows(spark, sf)), TOPIC_AS_OF)
    return decode_messages(live, keep=("offset", "timestamp")).select("id", "extraction_datetime", "offset", "timestamp")


def q_topic_after_retention(spark, sf):
    """The topic in hourly segments: expired ones are removed, then what is still held is read and decoded."""
    path = f"{scratch_dir(spark, 'segments')}/topic"
    write_segments(wire_messages(_rows(spark, sf)), path)
    expire_segments(spark, path, TOPIC_AS_OF)
    held = read_segments(spark, path, TOPIC_AS_OF)
    return decode_messages(held, keep=("offset", "timestamp")).select("id", "extraction_datetime", "offset", "timestamp")


def q_unified_sql(spark, sf):
    """SQL over the served namespace: the stored history and the metrics store, each by date, joined."""
    register_tables(spark, _loaded(spark, sf))
    return spark.sql(
        """
        SELECT CAST(h.extraction_date AS TIMESTAMP) AS extraction_date, h.day_of_week, h.nb_rows, h.nb_bikes,
               h.max_broken_docks, m.fleet_available_bikes
        FROM (SELECT extraction_date, day_of_week, count(*) AS nb_rows, sum(nb_bikes) AS nb_bikes,
                     max(nb_broken_docks) AS max_broken_docks
              FROM bike_points GROUP BY extraction_date, day_of_week) h
        JOIN (SELECT CAST(max_extraction_datetime AS DATE) AS d, max(nb_available_bikes) AS fleet_available_bikes
              FROM metrics_log GROUP BY 1) m
          ON h.extraction_date = m.d
        """
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "decode_messages": q_decode_messages,
    "flatten_snapshot": q_flatten_snapshot,
    "unknown_attributes": q_unknown_attributes,
    "valid_rows": q_valid_rows,
    "broken_docks": q_broken_docks,
    "calendar_fields": q_calendar_fields,
    "hour_buckets": q_hour_buckets,
    "history_rows": q_history_rows,
    "insert_ignore": q_insert_ignore,
    "insert_ignore_bucketed": q_insert_ignore_bucketed,
    "history_lookup": q_history_lookup,
    "latest_per_point": q_latest_per_point,
    "fleet_metrics": q_fleet_metrics,
    "metrics_per_batch": q_metrics_per_batch,
    "metrics_stream": q_metrics_stream,
    "fleet_state_by_poll": q_fleet_state_by_poll,
    "late_windows": q_late_windows,
    "window_turnover": q_window_turnover,
    "speed_job": q_speed_job,
    "compacted_metrics": q_compacted_metrics,
    "rejected_messages": q_rejected_messages,
    "catalog_sql": q_catalog_sql,
    "view_in_use": q_view_in_use,
    "view_non_availability": q_view_non_availability,
    "view_non_availability_only_empty": q_view_non_availability_only_empty,
    "view_peak_hours": q_view_peak_hours,
    "view_broken_docks": q_view_broken_docks,
    "view_peak_hours_from_summaries": q_view_peak_hours_from_summaries,
    "view_non_availability_from_summaries": q_view_non_availability_from_summaries,
    "chart_current_state": q_chart_current_state,
    "chart_in_use": q_chart_in_use,
    "chart_non_availability": q_chart_non_availability,
    "chart_peak_hours": q_chart_peak_hours,
    "chart_broken_docks": q_chart_broken_docks,
    "chart_in_use_from_summaries": q_chart_in_use_from_summaries,
    "chart_broken_docks_from_summaries": q_chart_broken_docks_from_summaries,
    "metrics_upsert": q_metrics_upsert,
    "metrics_ttl": q_metrics_ttl,
    "topic_retention": q_topic_retention,
    "topic_after_retention": q_topic_after_retention,
    "unified_sql": q_unified_sql,
    "metrics_after_restart": q_metrics_after_restart,
    "staged_messages": q_staged_messages,
    "history_first_stage_wins": q_history_first_stage_wins,
    "history_after_loads": q_history_after_loads,
    "stored_view_in_use": q_stored_view_in_use,
    "stored_view_broken_docks": q_stored_view_broken_docks,
    "stored_view_peak_hours": q_stored_view_peak_hours,
    "stored_view_non_availability": q_stored_view_non_availability,
}
