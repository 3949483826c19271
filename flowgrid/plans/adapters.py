"""Stand-in mobility tables derived from the driver tables.

There is no bike data in the sandbox, so trips, stations, hourly weather and
holidays are *derived by Spark* from ``events`` (their size grows with it).
The same definitions exist as a DuckDB ``WITH`` prefix (``ADAPTER_SQL``) for
the oracle.  Fixed derivation rules:

* events: those of every other pair of users (user_id // 2 odd) take place 31
  days later, so there are two months and a rest.
* trips: per user ordered by (ts, event_id) the trip starts at an event and
  ends at the user's next event; there are 40 + events // 500 station numbers
  from 100 on, every third event is at one of the first 7 (busy stations); the
  raw id is written ``NNN.1`` for even ids and ``NNN.10`` for odd ones
  (normalisation folds them together); member_casual is null for ids divisible
  by 53.
* stations: distinct station numbers except 120..122; station 101 has no name.
* weather: every event; temperatures are null in hours 3, 4 and 13 (so the
  as-of fill has gaps to fill); code text
  id % 28 (``n/a`` for id % 19 = 0, null for id % 31 = 0, ``.0`` suffix for
  id % 5 = 0, ``.7`` suffix for id % 7 = 0).
* holidays: the holiday calendar of every year present in ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowgrid.operators.series import holiday_calendar, years_of

STATION_BASE = 100
BUSY_STATIONS = 7
SHIFT_DAYS = 31
EXCLUDED_STATIONS = [120, 121, 122]
NAMELESS_STATION = 101
WEATHER_GAP_HOURS = [3, 4, 13]  # hours of the day without a temperature
BASE_LAT, STEP_LAT = 40.70, 0.004
BASE_LNG, STEP_LNG = -74.00, 0.003

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def n_stations(events: DataFrame) -> int:
    """Grows with the data (a count of the table, from Parquet footers)."""
    return 40 + events.count() // 500


def shifted(events: DataFrame) -> DataFrame:
    late = F.floor(F.col("user_id") / 2) % 2 == 1
    return events.withColumn("ts", F.when(late, F.timestamp_add("DAY", F.lit(SHIFT_DAYS), F.col("ts"))).otherwise(F.col("ts")))


def station_index(eid, k: int):
    return F.when(eid % 3 == 0, eid % BUSY_STATIONS).otherwise(eid % k)


def _station_text(eid, k: int):
    num = (F.lit(STATION_BASE) + station_index(eid, k)).cast("string")
    return F.concat(num, F.lit("."), F.when(eid % 2 == 0, F.lit("1")).otherwise(F.lit("10")))


def _lat(eid, k: int):
    return F.lit(BASE_LAT) + station_index(eid, k).cast("double") * F.lit(STEP_LAT)


def _lng(eid, k: int):
    return F.lit(BASE_LNG) + station_index(eid, k).cast("double") * F.lit(STEP_LNG)


def trips(events: DataFrame) -> DataFrame:
    """Trip rows: start at an event, end at the same user's next event."""
    from flowgrid.operators.scan import lead_in_order

    k = n_stations(events)
    e = shifted(events).select("event_id", "ts", "user_id", "event_type")
    e = lead_in_order(e, by=["user_id"], order=["ts", "event_id"],
                      cols={"ts": "_nts", "event_id": "_nid"})
    eid, nid = F.col("event_id"), F.col("_nid")
    return e.select(
        eid.alias("id"),
        F.col("ts").alias("started_at"),
        F.col("_nts").alias("ended_at"),
        _station_text(eid, k).alias("start_station_id"),
        F.when(nid.isNotNull(), _station_text(nid, k)).alias("end_station_id"),
        F.col("event_type").alias("rideable_type"),
        F.when(eid % 53 == 0, F.lit(None).cast("string"))
         .when(F.col("user_id") % 2 == 0, F.lit("member")).otherwise(F.lit("casual")).alias("member_casual"),
        _lat(eid, k).alias("start_lat"), _lng(eid, k).alias("start_lng"),
        _lat(nid, k).alias("end_lat"), _lng(nid, k).alias("end_lng"),
    )


def stations(events: DataFrame) -> DataFrame:
    sn = (F.lit(STATION_BASE) + station_index(F.col("event_id"), n_stations(events))).alias("sn")
    d = events.select(sn).distinct().where(~F.col("sn").isin(*EXCLUDED_STATIONS))
    k = F.col("sn") - STATION_BASE
    return d.select(
        F.col("sn").cast("long").alias("id"),
        F.concat(F.col("sn").cast("string"), F.lit(".10")).alias("short_name"),
        F.concat(F.lit("st-"), F.col("sn").cast("string")).alias("station_id"),
        F.when(F.col("sn") == NAMELESS_STATION, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Station "), F.col("sn").cast("string"))).alias("name"),
        (F.lit(10) + F.col("sn") % 17).cast("int").alias("capacity"),
        (F.lit(BASE_LAT) + k.cast("double") * F.lit(STEP_LAT)).alias("lat"),
        (F.lit(BASE_LNG) + k.cast("double") * F.lit(STEP_LNG)).alias("lon"),
    )


def weather(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    code = (eid % 28).cast("string")
    return shifted(events).select(
        F.col("ts").alias("time"),
        F.when(~F.hour("ts").isin(*WEATHER_GAP_HOURS), F.col("value")).alias("temp"),
        (F.lit(50) + eid % 50).cast("double").alias("relative_humidity"),
        ((eid % 13).cast("double") * F.lit(0.5)).alias("precipitation_total"),
        ((eid % 11).cast("double") * F.lit(1.5)).alias("average_wind_speed"),
        F.when(eid % 19 == 0, F.lit("n/a"))
         .when(eid % 31 == 0, F.lit(None).cast("string"))
         .when(eid % 5 == 0, F.concat(code, F.lit(".0")))
         .when(eid % 7 == 0, F.concat(code, F.lit(".7")))
         .otherwise(code).alias("coco"),
    )


def holidays(events: DataFrame) -> DataFrame:
    return holiday_calendar(years_of(shifted(events), "ts"))


def mobility(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    ev = table(spark, sf_dir, "events")
    return {"trips": trips(ev), "stations": stations(ev), "weather": weather(ev), "holidays": holidays(ev)}


# ---------------------------------------------------------------------------
# The same derivations for DuckDB (oracle side).  CTE names are prefixed with
# ``a_`` so they never shadow the pre-registered driver views.
# ---------------------------------------------------------------------------
def sql_station_index(x: str) -> str:
    return f"(CASE WHEN {x} % 3 = 0 THEN {x} % {BUSY_STATIONS} ELSE {x} % (SELECT k FROM a_k) END)"


def _sql_station_text(x: str) -> str:
    return (f"CAST({STATION_BASE} + {sql_station_index(x)} AS VARCHAR) || '.' || "
            f"CASE WHEN {x} % 2 = 0 THEN '1' ELSE '10' END")


def _sql_coordinate(x: str, base: float, step: float) -> str:
    return f"CAST({base} AS DOUBLE) + CAST({sql_station_index(x)} AS DOUBLE) * CAST({step} AS DOUBLE)"


def _sql_holidays() -> str:
    # DuckDB dayofweek: 0 = Sunday (Spark dayofweek - 1).
    parts = []
    for m, d, since in [(1, 1, None), (6, 19, 2021), (7, 4, None), (11, 11, None), (12, 25, None)]:
        actual = f"make_date(y, {m}, {d})"
        cond = f"y >= {since}" if since else "TRUE"
        parts.append(f"SELECT {actual} AS date FROM yrs WHERE {cond}")
        parts.append(f"SELECT CASE dayofweek({actual}) WHEN 6 THEN {actual} - INTERVAL 1 DAY "
                     f"WHEN 0 THEN {actual} + INTERVAL 1 DAY END AS date FROM yrs WHERE {cond}")
    for m, dow, n in [(1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)]:
        first = f"make_date(y, {m}, 1)"
        parts.append(f"SELECT {first} + INTERVAL (((({dow} - dayofweek({first})) % 7 + 7) % 7) + {7 * (n - 1)}) DAY AS date FROM yrs")
    last = "last_day(make_date(y, 5, 1))"
    parts.append(f"SELECT {last} - INTERVAL (((dayofweek({last}) - 1) % 7 + 7) % 7) DAY AS date FROM yrs")
    u = " UNION ALL ".join(parts)
    return f"SELECT DISTINCT CAST(date AS DATE) AS date, TRUE AS is_holiday FROM ({u}) WHERE date IS NOT NULL"


ADAPTER_SQL = f"""
a_k AS (SELECT 40 + count(*) // 500 AS k FROM events),
a_events AS (
  SELECT * REPLACE (CASE WHEN (user_id // 2) % 2 = 1 THEN ts + INTERVAL {SHIFT_DAYS} DAY ELSE ts END AS ts) FROM events
),
a_lead AS (
  SELECT event_id, ts, user_id, event_type,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nts,
         lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nid
  FROM a_events
),
a_trips AS (
  SELECT event_id AS id, ts AS started_at, nts AS ended_at,
         {_sql_station_text('event_id')} AS start_station_id,
         CASE WHEN nid IS NULL THEN NULL ELSE {_sql_station_text('nid')} END AS end_station_id,
         event_type AS rideable_type,
         CASE WHEN event_id % 53 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'member' ELSE 'casual' END AS member_casual,
         {_sql_coordinate('event_id', BASE_LAT, STEP_LAT)} AS start_lat,
         {_sql_coordinate('event_id', BASE_LNG, STEP_LNG)} AS start_lng,
         {_sql_coordinate('nid', BASE_LAT, STEP_LAT)} AS end_lat,
         {_sql_coordinate('nid', BASE_LNG, STEP_LNG)} AS end_lng
  FROM a_lead
),
a_sn AS (
  SELECT DISTINCT {STATION_BASE} + {sql_station_index('event_id')} AS sn FROM events
),
a_stations AS (
  SELECT CAST(sn AS BIGINT) AS id, CAST(sn AS VARCHAR) || '.10' AS short_name,
         'st-' || CAST(sn AS VARCHAR) AS station_id,
         CASE WHEN sn = {NAMELESS_STATION} THEN NULL ELSE 'Station ' || CAST(sn AS VARCHAR) END AS name,
         CAST(10 + sn % 17 AS INTEGER) AS capacity,
         CAST({BASE_LAT} AS DOUBLE) + CAST(sn - {STATION_BASE} AS DOUBLE) * CAST({STEP_LAT} AS DOUBLE) AS lat,
         CAST({BASE_LNG} AS DOUBLE) + CAST(sn - {STATION_BASE} AS DOUBLE) * CAST({STEP_LNG} AS DOUBLE) AS lon
  FROM a_sn WHERE sn NOT IN ({', '.join(map(str, EXCLUDED_STATIONS))})
),
a_weather AS (
  SELECT ts AS time, CASE WHEN hour(ts) NOT IN ({', '.join(map(str, WEATHER_GAP_HOURS))}) THEN value END AS temp,
         CAST(50 + event_id % 50 AS DOUBLE) AS relative_humidity,
         CAST(event_id % 13 AS DOUBLE) * 0.5 AS precipitation_total,
         CAST(event_id % 11 AS DOUBLE) * 1.5 AS average_wind_speed,
         CASE WHEN event_id % 19 = 0 THEN 'n/a'
              WHEN event_id % 31 = 0 THEN NULL
              WHEN event_id % 5 = 0 THEN CAST(event_id % 28 AS VARCHAR) || '.0'
              WHEN event_id % 7 = 0 THEN CAST(event_id % 28 AS VARCHAR) || '.7'
              ELSE CAST(event_id % 28 AS VARCHAR) END AS coco
  FROM a_events
),
yrs AS (SELECT DISTINCT CAST(year(ts) AS INTEGER) AS y FROM a_events),
a_holidays AS ({_sql_holidays()})
"""
