"""Registered mobility queries: trip cleaning, flows, weather and the grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgrid.functions.columns import hour_floor, normalize_station_id, weather_code_parse
from flowgrid.operators import clean, flow
from flowgrid.plans import adapters, sqlparts as S
from flowgrid.plans.memo import memo
from flowgrid.plans.registry import query, with_adapters

WEATHER_DIGITS = 6  # hourly weather means are rounded to 1e-6 (float-sum order differs between engines)


def mob(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Stand-in mobility tables.  Trips (the ordered lead that builds them is
    the expensive step) and the two small dimensions are materialised once per
    session, like the warehouse tables they stand in for, so size checks and
    joins read a few files instead of rescanning ``events``.  Weather stays a
    lazy projection of ``events`` (read once per use)."""
    ev = adapters.table(spark, sf_dir, "events")
    # builders run only on a memo miss (building trips already counts the
    # groups of the ordered lead)
    m = {name: memo(spark, sf_dir, name, lambda f=f: f(ev))
         for name, f in (("trips", adapters.trips), ("stations", adapters.stations), ("holidays", adapters.holidays))}
    m["weather"] = adapters.weather(ev)
    return m


def valid_trips(spark, sf_dir) -> DataFrame:
    m = mob(spark, sf_dir)
    t = clean.filter_complete_rows(m["trips"], clean.TRIP_REQUIRED)
    t = clean.normalize_ids(t)
    st = clean.filter_complete_rows(m["stations"], clean.STATION_REQUIRED)
    return clean.semi_valid_stations(t, st)


def final_trips(spark, sf_dir) -> DataFrame:
    """Cleaned and trimmed trips, written once per session."""
    m = mob(spark, sf_dir)
    return memo(spark, sf_dir, "trips-final", lambda: clean.clean_trips(m["trips"], m["stations"]))


def net_flow(spark, sf_dir) -> DataFrame:
    return flow.dedup_keep_best(flow.net_flow_single_pass(final_trips(spark, sf_dir), "taken_minus_dropped"))


def weather_hourly(spark, sf_dir) -> DataFrame:
    return flow.weather_hourly_dedup(mob(spark, sf_dir)["weather"], WEATHER_DIGITS)


# --------------------------------------------------------------------------- flagship
@query("station_hour_grid", with_adapters(S.GRID + "\nSELECT * FROM g_grid"))
def q_station_hour_grid(spark, sf_dir):
    """Dense grid + weather + holiday + calendar + lags + rolls (24 columns):
    the table that all grid queries read."""
    from flowgrid.plans.q_grid import grid
    return grid(spark, sf_dir)


# --------------------------------------------------------------------------- trip chain
@query("filter_complete_rows", with_adapters("""
SELECT id, start_station_id, end_station_id, rideable_type, member_casual FROM a_trips
WHERE started_at IS NOT NULL AND ended_at IS NOT NULL AND start_station_id IS NOT NULL
  AND end_station_id IS NOT NULL AND rideable_type IS NOT NULL AND member_casual IS NOT NULL"""))
def q_filter_complete_rows(spark, sf_dir):
    t = clean.filter_complete_rows(mob(spark, sf_dir)["trips"], clean.TRIP_REQUIRED)
    return t.select("id", "start_station_id", "end_station_id", "rideable_type", "member_casual")


@query("normalize_station_id", with_adapters(f"""
SELECT start_station_id AS raw_id, {S.norm_sql('start_station_id')} AS station_id, count(*) AS n_trips
FROM a_trips GROUP BY 1, 2"""))
def q_normalize_station_id(spark, sf_dir):
    t = mob(spark, sf_dir)["trips"]
    return (t.groupBy(F.col("start_station_id").alias("raw_id"),
                      normalize_station_id("start_station_id").alias("station_id"))
            .agg(F.count(F.lit(1)).alias("n_trips")))


@query("semi_valid_stations", with_adapters(S.VALID_TRIPS + """
SELECT id, start_station_id, end_station_id FROM c_valid"""))
def q_semi_valid_stations(spark, sf_dir):
    return valid_trips(spark, sf_dir).select("id", "start_station_id", "end_station_id")


@query("anti_unknown_stations", with_adapters(f"""
seen AS (
  SELECT {S.norm_sql('start_station_id')} AS station_id FROM a_trips WHERE start_station_id IS NOT NULL
  UNION SELECT {S.norm_sql('end_station_id')} FROM a_trips WHERE end_station_id IS NOT NULL
)
SELECT station_id FROM seen WHERE station_id NOT IN (SELECT short_name FROM a_stations)"""))
def q_anti_unknown_stations(spark, sf_dir):
    m = mob(spark, sf_dir)
    t = clean.normalize_ids(m["trips"])
    return clean.anti_unknown_stations(t, m["stations"])


@query("trip_duration_minutes", with_adapters(S.TRIMMED_TRIPS + """
SELECT id, duration_minutes FROM c_dur"""))
def q_trip_duration_minutes(spark, sf_dir):
    t = clean.with_duration(valid_trips(spark, sf_dir))
    return t.select("id", "duration_minutes")


@query("filter_duration_range", with_adapters(S.TRIMMED_TRIPS + """
SELECT id FROM c_range"""))
def q_filter_duration_range(spark, sf_dir):
    t = clean.filter_duration_range(clean.with_duration(valid_trips(spark, sf_dir)))
    return t.select("id")


@query("trim_quantiles", with_adapters(S.TRIMMED_TRIPS + """
SELECT id FROM c_qtrim"""))
def q_trim_quantiles(spark, sf_dir):
    t = clean.filter_duration_range(clean.with_duration(valid_trips(spark, sf_dir)))
    return clean.trim_quantiles(t, "duration_minutes", 0.01, 0.99).select("id")


@query("trim_quantiles_by_bounds", with_adapters(S.TRIMMED_TRIPS + """
SELECT id FROM c_qtrim"""))
def q_trim_quantiles_by_bounds(spark, sf_dir):
    """The same trim, exact: a rank sketch limits the values that are ordered."""
    t = clean.filter_duration_range(clean.with_duration(valid_trips(spark, sf_dir)))
    return clean.trim_quantiles(t, "duration_minutes", 0.01, 0.99, method="bounds").select("id")


@query("exact_percentiles", with_adapters("""
SELECT event_type, quantile_cont(value, 0.01) AS p01, quantile_cont(value, 0.5) AS p50,
       quantile_cont(value, 0.99) AS p99 FROM events GROUP BY event_type"""))
def q_exact_percentiles(spark, sf_dir):
    """Per-group exact interpolated percentiles (skew-safe grouped scan)."""
    from flowgrid.operators.scan import grouped_percentiles
    ev = adapters.table(spark, sf_dir, "events")
    return grouped_percentiles(ev, ["event_type"], "value", [0.01, 0.5, 0.99], ["p01", "p50", "p99"])


@query("haversine_km", with_adapters(S.TRIMMED_TRIPS + """
SELECT id, distance_km_rounded FROM c_dist"""))
def q_haversine_km(spark, sf_dir):
    t = clean.filter_duration_range(clean.with_duration(valid_trips(spark, sf_dir)))
    t = clean.with_distance(clean.trim_quantiles(t, "duration_minutes"))
    return t.select("id", "distance_km_rounded")


@query("trim_sigma", with_adapters(S.TRIMMED_TRIPS + """
SELECT id, distance_km_rounded FROM c_final"""))
def q_trim_sigma(spark, sf_dir):
    return final_trips(spark, sf_dir).select("id", "distance_km_rounded")


@query("time_parts", with_adapters(S.TRIMMED_TRIPS + """
SELECT id, CAST(date_trunc('day', started_at) AS DATE) AS started_at_date,
       CAST(hour(started_at) AS INTEGER) AS started_at_hour,
       CAST(date_trunc('day', ended_at) AS DATE) AS ended_at_date,
       CAST(hour(ended_at) AS INTEGER) AS ended_at_hour,
       CAST(year(started_at) AS INTEGER) AS year, CAST(month(started_at) AS INTEGER) AS month,
       CAST(day(started_at) AS INTEGER) AS day, date_trunc('hour', started_at) AS start_hour
FROM c_final"""))
def q_time_parts(spark, sf_dir):
    t = final_trips(spark, sf_dir)
    return t.select("id", F.to_date("started_at").alias("started_at_date"), F.hour("started_at").alias("started_at_hour"),
                    F.to_date("ended_at").alias("ended_at_date"), F.hour("ended_at").alias("ended_at_hour"),
                    F.year("started_at").alias("year"), F.month("started_at").alias("month"),
                    F.dayofmonth("started_at").alias("day"), hour_floor("started_at").alias("start_hour"))


# --------------------------------------------------------------------------- counts
@query("hourly_pickups", with_adapters(S.NET_FLOW + "\nSELECT * FROM f_pick"))
def q_hourly_pickups(spark, sf_dir):
    return flow.hourly_pickups(final_trips(spark, sf_dir))


@query("hourly_drops", with_adapters(S.NET_FLOW + "\nSELECT * FROM f_drop"))
def q_hourly_drops(spark, sf_dir):
    return flow.hourly_drops(final_trips(spark, sf_dir))


@query("full_outer_flow", with_adapters(S.NET_FLOW + "\nSELECT * FROM f_net"))
def q_full_outer_flow(spark, sf_dir):
    t = final_trips(spark, sf_dir)
    return flow.full_outer_flow(flow.hourly_pickups(t), flow.hourly_drops(t), "taken_minus_dropped")


@query("dedup_keep_best", with_adapters(S.NET_FLOW + "\nSELECT * FROM f_dedup"))
def q_dedup_keep_best(spark, sf_dir):
    return net_flow(spark, sf_dir)


@query("reaggregate_flow", with_adapters(S.NET_FLOW + """
SELECT station_id, date_trunc('hour', date_hour) AS date_hour, CAST(sum(num_bikes_taken) AS BIGINT) AS num_bikes_taken
FROM f_pick GROUP BY 1, 2"""))
def q_reaggregate_flow(spark, sf_dir):
    return flow.reaggregate_flow(flow.hourly_pickups(final_trips(spark, sf_dir)), "num_bikes_taken")


@query("station_day_summary", with_adapters(S.NET_FLOW + """
SELECT station_id, CAST(date_hour AS DATE) AS date, CAST(sum(num_bikes_taken) AS BIGINT) AS num_bikes_taken,
       CAST(sum(num_bikes_dropped) AS BIGINT) AS num_bikes_dropped, CAST(sum(net_flow) AS BIGINT) AS net_flow
FROM f_dedup GROUP BY 1, 2"""))
def q_station_day_summary(spark, sf_dir):
    return flow.station_day_summary(net_flow(spark, sf_dir))


# --------------------------------------------------------------------------- weather
@query("weather_code_parse", with_adapters("""
SELECT coco AS raw_code,
       CASE WHEN regexp_full_match(coco, '^\\d+(\\.\\d+)?$') THEN CAST(round(CAST(coco AS DOUBLE)) AS INTEGER) END AS coco,
       count(*) AS n
FROM a_weather GROUP BY 1, 2"""))
def q_weather_code_parse(spark, sf_dir):
    w = mob(spark, sf_dir)["weather"]
    return w.groupBy(F.col("coco").alias("raw_code"), weather_code_parse("coco").alias("coco")).agg(
        F.count(F.lit(1)).alias("n"))


@query("weather_hourly_dedup", with_adapters(S.WEATHER + "\nSELECT * FROM w_clean"))
def q_weather_hourly_dedup(spark, sf_dir):
    return weather_hourly(spark, sf_dir)


@query("weather_code_group", with_adapters(S.WEATHER + """
SELECT coco_group, count(*) AS n_hours FROM w_clean GROUP BY 1"""))
def q_weather_code_group(spark, sf_dir):
    return weather_hourly(spark, sf_dir).groupBy("coco_group").agg(F.count(F.lit(1)).alias("n_hours"))


@query("asof_backward", with_adapters(S.WEATHER + "\nSELECT * FROM w_filled"))
def q_asof_backward(spark, sf_dir):
    return flow.weather_hourly_filled(weather_hourly(spark, sf_dir))
