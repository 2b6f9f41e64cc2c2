"""DuckDB SQL oracles of the registered queries (views `events` etc. pre-registered).

Written directly from the semantics, independent of the Spark code: the
docking-point recipe, the history calendar fields, insert-ignore with
`QUALIFY` + `NOT EXISTS`, latest-per-point with `row_number`, the exact
half-up average in integer arithmetic, and so on. DuckDB differences handled
here: `dayofweek` starts at 0, `/` on integers is a double division, `sum`
of ints is HUGEINT, month/week functions return BIGINT.
"""

from __future__ import annotations


def _derived(unit: str = "second") -> str:
    """CTEs `e`, `b`, `d`: one docking-point row per event (same fixed recipe as the Spark side)."""
    return f"""
e AS (
  SELECT event_id, user_id, event_type, ts,
         date_trunc('{unit}', ts) AS extraction_datetime,
         CAST(15 + user_id % 25 AS INTEGER) AS nb_docks,
         CAST(props->>'k' AS INTEGER) AS k
  FROM events),
b AS (
  SELECT *, CAST(CASE WHEN k % 7 = 0 THEN 0 ELSE k % nb_docks END AS INTEGER) AS nb_bikes FROM e),
d AS (
  SELECT event_id, ts,
         concat('BikePoints_', CAST(user_id AS VARCHAR)) AS id,
         concat('Dock ', CAST(user_id % 40 AS VARCHAR)) AS common_name,
         concat('51.', lpad(CAST((user_id * 7919) % 1000000 AS VARCHAR), 6, '0')) AS lat,
         concat('-0.', lpad(CAST((user_id * 104729) % 1000000 AS VARCHAR), 6, '0')) AS lon,
         CASE WHEN event_type = 'error' THEN 'false' ELSE 'true' END AS Installed,
         CASE WHEN event_type = 'signup' THEN 'true' ELSE 'false' END AS Locked,
         nb_bikes AS NbBikes,
         CAST(nb_bikes % 4 AS INTEGER) AS NbEBikes,
         CAST(greatest(nb_docks - nb_bikes - event_id % 3, 0) AS INTEGER) AS NbEmptyDocks,
         nb_docks AS NbDocks,
         extraction_datetime
  FROM b)"""


MESSAGE_SELECT = """id, common_name,
       CAST(CAST(lat AS DECIMAL(8,6)) AS DOUBLE) AS lat,
       CAST(CAST(lon AS DECIMAL(9,6)) AS DOUBLE) AS lon,
       Installed, Locked, NbBikes, NbEBikes, NbEmptyDocks, NbDocks, extraction_datetime"""


def _history(unit: str = "second") -> str:
    """CTE `h`: history rows (21 columns + event_id, ts), decimals kept as decimals."""
    return _derived(unit) + """,
h AS (
  SELECT id AS bike_point_id, common_name,
         CAST(lat AS DECIMAL(8,6)) AS lat, CAST(lon AS DECIMAL(9,6)) AS lon,
         Installed = 'true' AS installed, Locked = 'true' AS locked,
         NbBikes AS nb_bikes, NbEBikes AS nb_ebikes, NbEmptyDocks AS nb_empty_docks, NbDocks AS nb_docks,
         CAST(NbDocks - (NbBikes + NbEmptyDocks) AS INTEGER) AS nb_broken_docks,
         extraction_datetime,
         CAST(extraction_datetime AS DATE) AS extraction_date,
         monthname(extraction_datetime) AS month_name,
         CAST(month(extraction_datetime) AS INTEGER) AS month_number,
         CAST(dayofmonth(extraction_datetime) AS INTEGER) AS day_of_month,
         CAST(weekofyear(extraction_datetime) AS INTEGER) AS week_of_year,
         dayname(extraction_datetime) AS day_of_week,
         CAST(dayofweek(extraction_datetime) + 1 AS INTEGER) AS day_of_week_number,
         CAST(hour(extraction_datetime) AS VARCHAR) AS hour,
         concat('[', (hour(extraction_datetime) // 2) * 2, ', ',
                ((hour(extraction_datetime) // 2) * 2 + 2) % 24, '[') AS hour_interval,
         event_id, ts
  FROM d)"""


HISTORY_SELECT = """bike_point_id, common_name, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon,
       installed, locked, nb_bikes, nb_ebikes, nb_empty_docks, nb_docks, nb_broken_docks,
       extraction_datetime, CAST(extraction_date AS TIMESTAMP) AS extraction_date, month_name, month_number,
       day_of_month, week_of_year, day_of_week, day_of_week_number, hour, hour_interval"""

LABEL = "concat(CAST(day_of_week_number AS VARCHAR), ': ', day_of_week)"


def _fleet(source: str, group: str | None = None, lp: str = "lp", fm: str = "fm") -> str:
    """Fleet metrics over rows of CTE `source` (columns of `d`), optionally per `group` column."""
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {g}id"
    select_g = f"{group}, " if group else ""
    group_by = f"GROUP BY {group}" if group else ""
    sums = []
    for src, name in (("NbBikes", "available_bikes"), ("NbEBikes", "available_ebikes"),
                      ("NbEmptyDocks", "in_use_bikes"), ("NbBrokenDocks", "broken_docks")):
        sums.append(f"CAST(sum({src}) AS BIGINT) AS nb_{name}")
        sums.append(f"round(100 * sum({src}) / sum(NbDocks), 2) AS percentage_{name}")
    sums_sql = ",\n         ".join(sums)
    return f"""
{lp} AS (
  SELECT {select_g}id, NbBikes, NbEBikes, NbDocks, NbEmptyDocks,
         NbDocks - (NbBikes + NbEmptyDocks) AS NbBrokenDocks, extraction_datetime
  FROM {source}
  QUALIFY row_number() OVER ({part} ORDER BY extraction_datetime DESC, ts DESC, event_id % 4 DESC, event_id DESC) = 1),
{fm} AS (
  SELECT {select_g}coalesce(min(extraction_datetime), TIMESTAMP '2000-01-01 00:00:00') AS min_extraction_datetime,
         coalesce(max(extraction_datetime), TIMESTAMP '2000-01-01 00:00:00') AS max_extraction_datetime,
         {sums_sql}
  FROM {lp} {group_by})"""


METRICS_COLS = """min_extraction_datetime, max_extraction_datetime,
       nb_available_bikes, percentage_available_bikes, nb_available_ebikes, percentage_available_ebikes,
       nb_in_use_bikes, percentage_in_use_bikes, nb_broken_docks, percentage_broken_docks"""


def _metrics_log() -> str:
    """CTE `log`: per-day metrics written twice (all messages, then Installed ones only)."""
    first = _fleet("dd", "day", "lp0", "fm0")
    second = _fleet("di", "day", "lp1", "fm1")
    return _derived() + """,
dd AS (SELECT *, CAST(extraction_datetime AS DATE) AS day FROM d),
di AS (SELECT * FROM dd WHERE Installed = 'true'),""" + first + "," + second + f""",
log AS (
  SELECT {METRICS_COLS},
         max_extraction_datetime + INTERVAL 1 MINUTE AS written_at, 'stream' AS run_id,
         CAST((day - DATE '2024-01-01') * 2 AS BIGINT) AS batch_id
  FROM fm0
  UNION ALL
  SELECT {METRICS_COLS},
         max_extraction_datetime + INTERVAL 2 MINUTE AS written_at, 'stream' AS run_id,
         CAST((day - DATE '2024-01-01') * 2 + 1 AS BIGINT) AS batch_id
  FROM fm1)"""


def _w(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["decode_messages"] = _w(_derived()) + f"\nSELECT {MESSAGE_SELECT} FROM d"
ORACLE_SQL["flatten_snapshot"] = ORACLE_SQL["decode_messages"]
ORACLE_SQL["valid_rows"] = ORACLE_SQL["decode_messages"]

ORACLE_SQL["broken_docks"] = _w(_history()) + """
SELECT bike_point_id, extraction_datetime, nb_docks, nb_bikes, nb_empty_docks, nb_broken_docks FROM h"""

ORACLE_SQL["calendar_fields"] = _w(_history()) + """
SELECT bike_point_id, extraction_datetime, CAST(extraction_date AS TIMESTAMP) AS extraction_date, month_name,
       month_number, day_of_month, week_of_year, day_of_week, day_of_week_number, hour FROM h"""

ORACLE_SQL["hour_buckets"] = _w(_history()) + """
SELECT bike_point_id, extraction_datetime, hour, hour_interval FROM h"""

ORACLE_SQL["history_rows"] = _w(_history()) + f"\nSELECT {HISTORY_SELECT} FROM h"

ORACLE_SQL["insert_ignore"] = _w(_history("hour")) + """,
old AS (
  SELECT * FROM h WHERE ts < TIMESTAMP '2024-01-20 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY bike_point_id, extraction_datetime
                             ORDER BY ts, event_id % 4, event_id) = 1),
stg AS (
  SELECT * FROM h WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY bike_point_id, extraction_datetime
                             ORDER BY ts, event_id % 4, event_id) = 1)
SELECT bike_point_id, extraction_datetime, nb_bikes, nb_empty_docks, event_id AS "offset", 'old' AS origin FROM old
UNION ALL
SELECT bike_point_id, extraction_datetime, nb_bikes, nb_empty_docks, event_id AS "offset", 'new' AS origin FROM stg s
WHERE NOT EXISTS (SELECT 1 FROM old o
                  WHERE o.bike_point_id = s.bike_point_id AND o.extraction_datetime = s.extraction_datetime)"""

ORACLE_SQL["latest_per_point"] = _w(_derived()) + """
SELECT id, NbBikes, NbEBikes, NbDocks, NbEmptyDocks,
       NbDocks - (NbBikes + NbEmptyDocks) AS NbBrokenDocks, extraction_datetime
FROM d
QUALIFY row_number() OVER (PARTITION BY id ORDER BY extraction_datetime DESC, ts DESC, event_id % 4 DESC, event_id DESC) = 1"""

ORACLE_SQL["fleet_metrics"] = _w(_derived(), _fleet("d")) + f"\nSELECT {METRICS_COLS} FROM fm"

_PER_DAY = _w(_derived(), "\ndd AS (SELECT *, CAST(extraction_datetime AS DATE) AS day FROM d)", _fleet("dd", "day"))
ORACLE_SQL["metrics_per_batch"] = _PER_DAY + f"\nSELECT {METRICS_COLS} FROM fm"
ORACLE_SQL["metrics_stream"] = ORACLE_SQL["metrics_per_batch"]

ORACLE_SQL["view_in_use"] = _w(_history()) + f"""
SELECT {LABEL} AS num_day_of_week, day_of_week, nb_empty_docks FROM h"""

_TOP10 = """,
emptiest AS (
  SELECT bike_point_id FROM h GROUP BY bike_point_id HAVING count(*) FILTER (nb_bikes = 0) > 0
  QUALIFY row_number() OVER (ORDER BY count(*) FILTER (nb_bikes = 0) DESC, bike_point_id) <= 10)"""


def _non_availability(history: str, only_empty: bool = False) -> str:
    """Dates (all, or those without a bike) of the ten points most often without a bike."""
    having = "HAVING bool_or(nb_bikes = 0)" if only_empty else ""
    return _w(history) + _TOP10 + f"""
SELECT {LABEL} AS num_day_of_week, CAST(extraction_date AS TIMESTAMP) AS extraction_date, bike_point_id
FROM h SEMI JOIN emptiest USING (bike_point_id)
GROUP BY day_of_week_number, day_of_week, extraction_date, bike_point_id {having}"""


ORACLE_SQL["view_non_availability"] = _non_availability(_history())
ORACLE_SQL["view_non_availability_only_empty"] = _non_availability(_history(), only_empty=True)

def _peak(history: str) -> str:
    """CTE `peak`: exact average rounded half-up to cents in integers, (200*s + c) // (2*c) (values are >= 0 here)."""
    return _w(history) + f""",
per_hour AS (
  SELECT day_of_week, {LABEL} AS num_day_of_week, hour_interval, hour,
         (200 * sum(nb_empty_docks) + count(nb_empty_docks)) // (2 * count(nb_empty_docks)) AS cents
  FROM h GROUP BY ALL),
peak AS (
  SELECT day_of_week, num_day_of_week, hour_interval, CAST(cents AS DOUBLE) / 100 AS avg_nb_empty_docks
  FROM per_hour
  WHERE (SELECT count(DISTINCT o.cents) FROM per_hour o
           WHERE o.day_of_week = per_hour.day_of_week AND o.cents > per_hour.cents) < 3)"""


_PEAK = _peak(_history())
ORACLE_SQL["view_peak_hours"] = _PEAK + "\nSELECT * FROM peak"

ORACLE_SQL["view_broken_docks"] = _w(_history()) + """
SELECT CAST(extraction_date AS TIMESTAMP) AS extraction_date, day_of_week, nb_broken_docks FROM h"""

ORACLE_SQL["chart_in_use"] = _w(_history()) + f"""
SELECT {LABEL} AS num_day_of_week, day_of_week, avg(nb_empty_docks) AS avg_in_use_bikes
FROM h GROUP BY 1, 2"""

ORACLE_SQL["chart_non_availability"] = _w(_history()) + _TOP10 + f"""
SELECT {LABEL} AS num_day_of_week, bike_point_id, count(DISTINCT extraction_date) AS nb_occurrences
FROM h SEMI JOIN emptiest USING (bike_point_id) GROUP BY day_of_week_number, day_of_week, bike_point_id"""

ORACLE_SQL["chart_peak_hours"] = _PEAK + """
SELECT num_day_of_week, hour_interval, round(avg(avg_nb_empty_docks), 6) AS avg_nb_empty_docks
FROM peak GROUP BY 1, 2"""

ORACLE_SQL["chart_broken_docks"] = _w(_history()) + """
SELECT CAST(extraction_date AS TIMESTAMP) AS extraction_date, max(nb_broken_docks) AS max_nb_broken_docks
FROM h GROUP BY 1"""

_LATEST_WRITE = """
cur AS (
  SELECT * FROM log
  WHERE written_at > TIMESTAMP '{as_of}' - INTERVAL {ttl} SECOND AND written_at <= TIMESTAMP '{as_of}'
  QUALIFY row_number() OVER (PARTITION BY min_extraction_datetime, max_extraction_datetime
                             ORDER BY written_at DESC, batch_id DESC) = 1)"""

ORACLE_SQL["chart_current_state"] = _w(_metrics_log(), _LATEST_WRITE.format(as_of="2024-01-30 12:00:00", ttl=86400)) + f"""
SELECT {METRICS_COLS}, written_at, run_id, batch_id FROM cur
ORDER BY max_extraction_datetime DESC, written_at DESC, batch_id DESC LIMIT 1"""

ORACLE_SQL["metrics_upsert"] = _w(_metrics_log(), _LATEST_WRITE.format(as_of="2024-01-31 00:00:00", ttl=40 * 86400)) + f"""
SELECT {METRICS_COLS}, written_at, run_id, batch_id FROM cur"""

ORACLE_SQL["metrics_ttl"] = _w(_metrics_log()) + f"""
SELECT {METRICS_COLS}, written_at, run_id, batch_id FROM log
WHERE written_at > TIMESTAMP '2024-01-25 00:30:00' - INTERVAL 86400 SECOND
  AND written_at <= TIMESTAMP '2024-01-25 00:30:00'"""

ORACLE_SQL["topic_retention"] = _w(_derived()) + """
SELECT id, extraction_datetime, event_id AS "offset", CAST(ts AS TIMESTAMP) AS "timestamp" FROM d
WHERE ts > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 172800 SECOND AND ts <= TIMESTAMP '2024-01-20 00:00:00'"""

def _first_arrived() -> str:
    """CTE `h` after the loads: hourly keys, the first message to arrive of each."""
    return _history("hour").replace("\nh AS (", "\nevery AS (") + """,
h AS (
  SELECT * FROM every
  QUALIFY row_number() OVER (PARTITION BY bike_point_id, extraction_datetime
                             ORDER BY ts, event_id % 4, event_id) = 1)"""


ORACLE_SQL["history_after_loads"] = _w(_first_arrived()) + f"\nSELECT {HISTORY_SELECT} FROM h"
ORACLE_SQL["history_lookup"] = ORACLE_SQL["history_after_loads"] + """
WHERE bike_point_id IN ('BikePoints_7', 'BikePoints_42') AND day_of_week_number IN (2, 7)"""
ORACLE_SQL["insert_ignore_bucketed"] = _w(_history("hour")) + f""",
old AS (
  SELECT * FROM h WHERE ts < TIMESTAMP '2024-01-20 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY bike_point_id, extraction_datetime ORDER BY ts, event_id % 4, event_id) = 1),
stg AS (
  SELECT * FROM h WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY bike_point_id, extraction_datetime ORDER BY ts, event_id % 4, event_id) = 1)
SELECT {HISTORY_SELECT} FROM old
UNION ALL
SELECT {HISTORY_SELECT} FROM stg s
WHERE NOT EXISTS (SELECT 1 FROM old o
                  WHERE o.bike_point_id = s.bike_point_id AND o.extraction_datetime = s.extraction_datetime)"""
ORACLE_SQL["stored_view_in_use"] = _w(_first_arrived()) + f"""
SELECT {LABEL} AS num_day_of_week, day_of_week, nb_empty_docks FROM h"""
ORACLE_SQL["stored_view_broken_docks"] = _w(_first_arrived()) + """
SELECT CAST(extraction_date AS TIMESTAMP) AS extraction_date, day_of_week, nb_broken_docks FROM h"""
ORACLE_SQL["stored_view_peak_hours"] = _peak(_first_arrived()) + "\nSELECT * FROM peak"
ORACLE_SQL["stored_view_non_availability"] = _non_availability(_first_arrived())
ORACLE_SQL["view_peak_hours_from_summaries"] = ORACLE_SQL["stored_view_peak_hours"]
ORACLE_SQL["view_non_availability_from_summaries"] = ORACLE_SQL["stored_view_non_availability"]
ORACLE_SQL["chart_in_use_from_summaries"] = _w(_first_arrived()) + f"""
SELECT {LABEL} AS num_day_of_week, day_of_week, avg(nb_empty_docks) AS avg_in_use_bikes FROM h GROUP BY 1, 2"""
ORACLE_SQL["chart_broken_docks_from_summaries"] = _w(_first_arrived()) + """
SELECT CAST(extraction_date AS TIMESTAMP) AS extraction_date, max(nb_broken_docks) AS max_nb_broken_docks
FROM h GROUP BY 1"""

ORACLE_SQL["unified_sql"] = _w(_first_arrived(), "\ndd AS (SELECT *, CAST(extraction_datetime AS DATE) AS day FROM ("
                               "SELECT * REPLACE (date_trunc('second', ts) AS extraction_datetime) FROM d))",
                               _fleet("dd", "day")) + """,
by_date AS (
  SELECT extraction_date, day_of_week, count(*) AS nb_rows, CAST(sum(nb_bikes) AS BIGINT) AS nb_bikes,
         max(nb_broken_docks) AS max_broken_docks
  FROM h GROUP BY ALL)
SELECT CAST(extraction_date AS TIMESTAMP) AS extraction_date, day_of_week, nb_rows, nb_bikes, max_broken_docks,
       nb_available_bikes AS fleet_available_bikes
FROM by_date JOIN fm ON CAST(max_extraction_datetime AS DATE) = extraction_date"""

_RUNS = "\nruns AS (SELECT *, ts < TIMESTAMP '2024-01-15 00:00:00' AS run FROM d)"
ORACLE_SQL["metrics_after_restart"] = _w(_derived(), _RUNS, _fleet("runs", "run")) + f"\nSELECT {METRICS_COLS} FROM fm"

ORACLE_SQL["staged_messages"] = _w(_derived()) + f"""
SELECT * REPLACE (NbBikes + run AS NbBikes)
FROM (SELECT {MESSAGE_SELECT.replace("id,", "concat('BikePoints_', event_id) AS id,", 1)} FROM d),
  (SELECT unnest([0, 1]::INTEGER[]) AS run)"""
ORACLE_SQL["staged_messages"] = f"SELECT * EXCLUDE (run) FROM ({ORACLE_SQL['staged_messages']})"
ORACLE_SQL["history_first_stage_wins"] = _w(_derived()) + """
SELECT concat('BikePoints_', event_id) AS bike_point_id, extraction_datetime, NbBikes AS nb_bikes, NbDocks AS nb_docks
FROM d"""

_NEWEST = """row_number() OVER (PARTITION BY day, id ORDER BY extraction_datetime DESC, ts DESC, event_id % 4 DESC, event_id DESC) = 1"""
_DAYS = "\ndd AS (SELECT *, date_trunc('day', ts) AS day, NbDocks - (NbBikes + NbEmptyDocks) AS NbBrokenDocks FROM d)"


def _totals(prefix: str = "") -> str:
    return ",\n       ".join(
        f"CAST(sum({prefix}{src}) AS BIGINT) AS nb_{name}, round(100 * sum({prefix}{src}) / sum({prefix}NbDocks), 2) AS percentage_{name}"
        for src, name in (("NbBikes", "available_bikes"), ("NbEBikes", "available_ebikes"),
                          ("NbEmptyDocks", "in_use_bikes"), ("NbBrokenDocks", "broken_docks")))


ORACLE_SQL["fleet_state_by_poll"] = _w(_derived(), _DAYS) + f""",
r AS (SELECT * FROM dd QUALIFY {_NEWEST}),
polls AS (SELECT day AS poll, min(extraction_datetime) AS low, max(extraction_datetime) AS high FROM r GROUP BY day),
carried AS (
  SELECT poll, low, high, r.* FROM polls JOIN r ON r.day <= poll
  QUALIFY row_number() OVER (PARTITION BY poll, id ORDER BY day DESC) = 1)
SELECT poll, low AS min_extraction_datetime, high AS max_extraction_datetime,
       {_totals()}, count(*) AS nb_points
FROM carried GROUP BY poll, low, high"""

# A message counts if it is later than the newest instant of the deliveries before it, less four days; a day is
# closed once the newest instant of all deliveries, less four days, has reached its end.
ORACLE_SQL["late_windows"] = _w(_derived(), _DAYS) + f""",
a AS (
  SELECT *, CAST(day AS DATE) - DATE '2024-01-01' AS n,
         (CAST(day AS DATE) - DATE '2024-01-01') // 8
           + CASE WHEN event_id % 29 = 0 THEN 2 WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS arrival FROM dd),
m AS (SELECT arrival, max(extraction_datetime) AS newest FROM a GROUP BY arrival),
seen AS (SELECT arrival, max(newest) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM m),
admitted AS (
  SELECT a.* FROM a JOIN seen USING (arrival)
  WHERE newest IS NULL OR extraction_datetime > newest - INTERVAL 4 DAY),
r AS (SELECT * FROM admitted QUALIFY {_NEWEST})
SELECT day AS window_start, min(extraction_datetime) AS min_extraction_datetime, max(extraction_datetime) AS max_extraction_datetime,
       {_totals()}
FROM r WHERE day + INTERVAL 1 DAY <= (SELECT max(newest) - INTERVAL 4 DAY FROM m) GROUP BY day"""

ORACLE_SQL["window_turnover"] = _w(_derived(), _DAYS) + f""",
r AS (SELECT * FROM dd QUALIFY {_NEWEST}),
closed AS (SELECT * FROM r WHERE day + INTERVAL 1 DAY <= (SELECT max(extraction_datetime) - INTERVAL 4 DAY FROM d))
SELECT after.day AS window_start, count(*) AS nb_points,
       CAST(sum(greatest(after.NbBikes - before.NbBikes, 0)) AS BIGINT) AS nb_arrived,
       CAST(sum(greatest(before.NbBikes - after.NbBikes, 0)) AS BIGINT) AS nb_left
FROM closed AS before JOIN closed AS after ON after.id = before.id AND after.day = before.day + INTERVAL 1 DAY
GROUP BY after.day"""

ORACLE_SQL["speed_job"] = ORACLE_SQL["fleet_metrics"]

# At 2024-01-26 09:00 with ten days to live: dates from 2024-01-15 on stay; those before the 26th are folded.
ORACLE_SQL["compacted_metrics"] = _w(_metrics_log()) + f""",
dated AS (SELECT *, CAST(written_at AS DATE) AS written_date FROM log),
folded AS (
  SELECT * FROM dated WHERE written_date < DATE '2024-01-26'
  QUALIFY row_number() OVER (PARTITION BY written_date, min_extraction_datetime, max_extraction_datetime
                             ORDER BY written_at DESC, batch_id DESC) = 1)
SELECT {METRICS_COLS}, written_at, run_id, batch_id, CAST(written_date AS TIMESTAMP) AS written_date FROM folded
WHERE written_date >= DATE '2024-01-15'
UNION ALL
SELECT {METRICS_COLS}, written_at, run_id, batch_id, CAST(written_date AS TIMESTAMP) AS written_date FROM dated
WHERE written_date >= DATE '2024-01-26'"""

ORACLE_SQL["rejected_messages"] = """
WITH m AS (
  SELECT CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 'unreadable' WHEN event_id % 13 = 0 THEN 'no_id'
              WHEN event_id % 17 = 0 THEN 'no_instant' WHEN event_id % 19 = 0 THEN 'bad_instant' ELSE 'good' END AS reason
  FROM events),
n AS (SELECT reason, count(*) AS n FROM m GROUP BY reason UNION ALL SELECT 'messages', count(*) FROM m)
SELECT reason, n AS nb_stored, n AS nb_counted FROM n"""

ORACLE_SQL["catalog_sql"] = _w(_first_arrived()) + _TOP10 + f""",
by_date AS (
  SELECT extraction_date, {LABEL} AS label, count(*) AS nb_rows, CAST(sum(nb_bikes) AS BIGINT) AS nb_bikes,
         round(100 * sum(nb_bikes) / sum(nb_docks), 2) AS percentage_bikes, CAST(sum(nb_broken_docks) AS BIGINT) AS nb_broken,
         max(nb_broken_docks) AS max_nb_broken_docks, max(hour(extraction_datetime)) AS last_hour
  FROM h GROUP BY ALL),
points AS (
  SELECT extraction_date, count(DISTINCT bike_point_id) AS nb_points FROM h SEMI JOIN emptiest USING (bike_point_id) GROUP BY 1)
SELECT CAST(extraction_date AS TIMESTAMP) AS extraction_date, label, nb_rows, nb_bikes, percentage_bikes, nb_broken,
       max_nb_broken_docks, concat('[', (last_hour // 2) * 2, ', ', ((last_hour // 2) * 2 + 2) % 24, '[') AS last_slot, nb_points
FROM by_date LEFT JOIN points USING (extraction_date) WHERE extraction_date >= DATE '2024-01-08'"""

ORACLE_SQL["topic_after_retention"] = ORACLE_SQL["topic_retention"]
ORACLE_SQL["unknown_attributes"] = _w(_derived()) + """
SELECT id, count(*) AS nb_terminals, CAST(min(event_id % 100000) AS INTEGER) AS least_terminal,
       CAST(max(event_id % 100000) AS INTEGER) AS greatest_terminal, CAST(0 AS BIGINT) AS nb_absent,
       max(extraction_datetime) AS newest
FROM d GROUP BY id"""
