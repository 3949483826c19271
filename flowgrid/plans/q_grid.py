"""Registered queries over the station x hour grid: grid parts, windows,
features, profiles, top-k and ordered operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgrid.functions.columns import (COCO_LABELS, HOUR_BAND_EVENING, HOUR_BAND_MORNING, HOUR_BAND_REST,
                                        calendar_features, hour_band, weather_code_label, weather_flags)
from flowgrid.operators import flow, profile, series, sketches, windows
from flowgrid.plans import sqlparts as S
from flowgrid.plans.q_mobility import WEATHER_DIGITS, final_trips, mob
from flowgrid.plans.registry import query, with_adapters
from flowgrid.plans.memo import clear_memo, memo  # noqa: F401
from flowgrid.operators.joins import shuffled, with_scalars


def net(spark, sf_dir) -> DataFrame:
    return memo(spark, sf_dir, "net-flow", lambda: flow.dedup_keep_best(
        flow.net_flow_single_pass(final_trips(spark, sf_dir), "taken_minus_dropped")))


def wfilled(spark, sf_dir) -> DataFrame:
    return memo(spark, sf_dir, "weather-filled", lambda: flow.weather_hourly_filled(
        flow.weather_hourly_dedup(mob(spark, sf_dir)["weather"], WEATHER_DIGITS)))


def grid(spark, sf_dir) -> DataFrame:
    def build():
        g = flow.left_grid_fill(flow.dense_index(net(spark, sf_dir)), net(spark, sf_dir))
        g = flow.left_weather(g, wfilled(spark, sf_dir))
        g = g.withColumns({"year": F.year("date_hour"), "month": F.month("date_hour"),
                           "day": F.dayofmonth("date_hour"),
                           "jour_semaine": flow.weekday_label("date_hour")})
        g = flow.left_holiday(g, mob(spark, sf_dir)["holidays"])
        return flow.add_lags_and_rolls(g).select(*flow.GRID_COLUMNS)
    return memo(spark, sf_dir, "grid", build)


def G(body: str) -> str:
    return with_adapters(S.GRID + ",\n" + body if not body.strip().upper().startswith("SELECT")
                         else S.GRID + "\n" + body)


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


HOUR_BAND_SQL = (f"CASE WHEN hour >= 6 AND hour < 10 THEN {_sql_str(HOUR_BAND_MORNING)} "
                 f"WHEN hour >= 16 AND hour < 20 THEN {_sql_str(HOUR_BAND_EVENING)} "
                 f"ELSE {_sql_str(HOUR_BAND_REST)} END")
LABEL_SQL = "CASE coco " + " ".join(f"WHEN {k} THEN {_sql_str(v)}" for k, v in COCO_LABELS.items()) + " END"
W_ST = "WINDOW w AS (PARTITION BY station_id ORDER BY date_hour)"

# --------------------------------------------------------------------------- spines and joins


@query("hour_spine", G("SELECT date_hour FROM g_hours"))
def q_hour_spine(spark, sf_dir):
    return series.hour_spine(net(spark, sf_dir))


@query("day_hour_spine", G("""SELECT unnest(generate_series(date_trunc('day', min(date_hour)),
  date_trunc('day', max(date_hour)) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS date_hour FROM f_dedup"""))
def q_day_hour_spine(spark, sf_dir):
    return series.day_hour_spine(net(spark, sf_dir))


@query("cross_station_hour", G("SELECT s.station_id, h.date_hour FROM g_st s CROSS JOIN g_hours h"))
def q_cross_station_hour(spark, sf_dir):
    return flow.dense_index(net(spark, sf_dir))


@query("left_grid_fill", G("SELECT * FROM g_bike"))
def q_left_grid_fill(spark, sf_dir):
    n = net(spark, sf_dir)
    return flow.left_grid_fill(flow.dense_index(n), n)


@query("left_weather", G("SELECT * FROM g_merged"))
def q_left_weather(spark, sf_dir):
    n = net(spark, sf_dir)
    return flow.left_weather(flow.left_grid_fill(flow.dense_index(n), n), wfilled(spark, sf_dir))


@query("left_holiday", G("SELECT station_id, date_hour, is_holiday FROM g_grid"))
def q_left_holiday(spark, sf_dir):
    n = net(spark, sf_dir)
    g = flow.left_grid_fill(flow.dense_index(n), n).select("station_id", "date_hour")
    return flow.left_holiday(g, mob(spark, sf_dir)["holidays"])


@query("holiday_calendar", with_adapters("SELECT date, is_holiday FROM a_holidays"))
def q_holiday_calendar(spark, sf_dir):
    return mob(spark, sf_dir)["holidays"]


@query("cross_scalar_stats", G("""SELECT g.station_id, g.date_hour, g.net_flow, s.mean_net_flow
FROM g_grid g, (SELECT avg(net_flow) AS mean_net_flow FROM g_grid) s"""))
def q_cross_scalar_stats(spark, sf_dir):
    g = grid(spark, sf_dir)
    stats = g.agg(F.avg("net_flow").alias("mean_net_flow"))
    return with_scalars(g.select("station_id", "date_hour", "net_flow"), stats)


@query("anti_missing_rows", G("""SELECT g.station_id, g.date_hour FROM g_grid g
WHERE NOT EXISTS (SELECT 1 FROM f_dedup n WHERE n.station_id = g.station_id AND n.date_hour = g.date_hour)"""))
def q_anti_missing_rows(spark, sf_dir):
    """Grid rows that had no observed flow (the gap-filled ones)."""
    return grid(spark, sf_dir).select("station_id", "date_hour").join(
        shuffled(net(spark, sf_dir).select("station_id", "date_hour")), ["station_id", "date_hour"], "left_anti")


# --------------------------------------------------------------------------- windows


@query("lag_features", G("""SELECT station_id, date_hour, net_flow_lag_1, net_flow_lag_2, net_flow_lag_24,
  num_bikes_taken_lag_1, num_bikes_dropped_lag_1 FROM g_grid"""))
def q_lag_features(spark, sf_dir):
    g = grid(spark, sf_dir).select("station_id", "date_hour", "net_flow", "num_bikes_taken", "num_bikes_dropped")
    g = windows.add_lags(g, "net_flow", [1, 2, 24], ["station_id"], ["date_hour"])
    g = windows.add_lags(g, "num_bikes_taken", [1], ["station_id"], ["date_hour"])
    g = windows.add_lags(g, "num_bikes_dropped", [1], ["station_id"], ["date_hour"])
    return g.drop("net_flow", "num_bikes_taken", "num_bikes_dropped")


@query("lag_features_with_history", G("""SELECT station_id, date_hour, net_flow_lag_1, net_flow_lag_24, net_flow_roll_24
FROM g_grid WHERE year = 2024 AND month = 2"""))
def q_lag_features_with_history(spark, sf_dir):
    """February's lags and rolling mean, its first hours from January's tail."""
    g = grid(spark, sf_dir).where("year = 2024").select("station_id", "date_hour", "month", "net_flow")

    def features(d):
        d = windows.add_lags(d, "net_flow", [1, 24], ["station_id"], ["date_hour"])
        return windows.rolling_mean(d, "net_flow", 24, ["station_id"], ["date_hour"])
    out = windows.with_history_tail(g.where("month = 2"), g.where("month = 1"), ["station_id"], ["date_hour"], 24, features)
    return out.drop("net_flow", "month")


@query("rolling_mean", G("SELECT station_id, date_hour, net_flow_roll_3, net_flow_roll_24 FROM g_grid"))
def q_rolling_mean(spark, sf_dir):
    g = grid(spark, sf_dir).select("station_id", "date_hour", "net_flow")
    for n in (3, 24):
        g = windows.rolling_mean(g, "net_flow", n, ["station_id"], ["date_hour"])
    return g.drop("net_flow")


@query("rolling_mean_strict", G(f"""SELECT station_id, date_hour,
  CASE WHEN count(net_flow) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 3
       THEN avg(net_flow) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END AS net_flow_roll_3,
  CASE WHEN count(net_flow) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) = 24
       THEN avg(net_flow) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) END AS net_flow_roll_24
FROM g_grid {W_ST}"""))
def q_rolling_mean_strict(spark, sf_dir):
    g = grid(spark, sf_dir).select("station_id", "date_hour", "net_flow")
    for n in (3, 24):
        g = windows.rolling_mean(g, "net_flow", n, ["station_id"], ["date_hour"], strict=True)
    return g.drop("net_flow")


@query("lead_target", G(f"SELECT station_id, date_hour, lead(net_flow) OVER w AS y FROM g_grid {W_ST}"))
def q_lead_target(spark, sf_dir):
    g = grid(spark, sf_dir).select("station_id", "date_hour", "net_flow")
    return windows.lead_target(g, "net_flow", ["station_id"], ["date_hour"]).drop("net_flow")


# --------------------------------------------------------------------------- column features

@query("weekday_label", G("SELECT jour_semaine, count(*) AS n_hours FROM g_grid GROUP BY 1"))
def q_weekday_label(spark, sf_dir):
    return grid(spark, sf_dir).groupBy("jour_semaine").agg(F.count(F.lit(1)).alias("n_hours"))


@query("fill_defaults", G("""SELECT station_id, date_hour, temp, relative_humidity, precipitation_total,
  average_wind_speed, coco, coco_group, is_holiday FROM g_grid"""))
def q_fill_defaults(spark, sf_dir):
    return grid(spark, sf_dir).select("station_id", "date_hour", "temp", "relative_humidity",
                                      "precipitation_total", "average_wind_speed", "coco", "coco_group",
                                      "is_holiday")


@query("hour_band", G(f"""SELECT {HOUR_BAND_SQL} AS hour_band,
  CAST(sum(num_bikes_taken) AS BIGINT) AS num_bikes_taken, CAST(sum(num_bikes_dropped) AS BIGINT) AS num_bikes_dropped
FROM g_grid GROUP BY 1"""))
def q_hour_band(spark, sf_dir):
    return grid(spark, sf_dir).groupBy(hour_band("hour").alias("hour_band")).agg(
        F.sum("num_bikes_taken").cast("long").alias("num_bikes_taken"),
        F.sum("num_bikes_dropped").cast("long").alias("num_bikes_dropped"))


CAL_SQL = """(round(sin(2 * pi() * hour / 24), 9) + 0.0) AS hour_sin, (round(cos(2 * pi() * hour / 24), 9) + 0.0) AS hour_cos,
  (round(sin(2 * pi() * day / 31), 9) + 0.0) AS day_sin, (round(cos(2 * pi() * day / 31), 9) + 0.0) AS day_cos,
  (round(sin(2 * pi() * month / 12), 9) + 0.0) AS month_sin, (round(cos(2 * pi() * month / 12), 9) + 0.0) AS month_cos,
  CAST(jour_semaine IN ('Samedi', 'Dimanche') AS INTEGER) AS is_weekend,
  CAST((hour >= 6 AND hour < 10) OR (hour >= 16 AND hour < 20) AS INTEGER) AS is_peak"""


def _cal(g: DataFrame) -> dict:
    return {k: (F.round(v, 9) + F.lit(0.0) if k.endswith(("_sin", "_cos")) else v) for k, v in calendar_features().items()}


@query("calendar_features", G(f"SELECT station_id, date_hour, {CAL_SQL} FROM g_grid"))
def q_calendar_features(spark, sf_dir):
    g = grid(spark, sf_dir)
    return g.select("station_id", "date_hour", *[v.alias(k) for k, v in _cal(g).items()])


FLAGS_SQL = """CAST(coalesce(precipitation_total > 0, FALSE) AS INTEGER) AS is_rain,
  CAST(coalesce(temp < 5, FALSE) AS INTEGER) AS cold_weather, CAST(coalesce(temp > 30, FALSE) AS INTEGER) AS hot_weather,
  CAST(coalesce(precipitation_total > 5, FALSE) AS INTEGER) AS heavy_rain"""


@query("weather_flags", G(f"SELECT station_id, date_hour, {FLAGS_SQL} FROM g_grid"))
def q_weather_flags(spark, sf_dir):
    g = grid(spark, sf_dir)
    return g.select("station_id", "date_hour", *[v.alias(k) for k, v in weather_flags().items()])


@query("weather_code_label", with_adapters(S.WEATHER + f"""
SELECT coco, {LABEL_SQL} AS coco_label, count(*) AS n_hours FROM w_clean GROUP BY 1, 2"""))
def q_weather_code_label(spark, sf_dir):
    from flowgrid.plans.q_mobility import weather_hourly
    w = weather_hourly(spark, sf_dir)
    return w.groupBy("coco", weather_code_label("coco").alias("coco_label")).agg(F.count(F.lit(1)).alias("n_hours"))


#: fixed values: the columns of the feature table, in its order
FEATURES = ["station_id", "date_hour", "year", "month", "day", "hour", "temp", "precipitation_total",
            "relative_humidity", "average_wind_speed", "num_bikes_taken_lag_1", "num_bikes_dropped_lag_1",
            "net_flow_lag_1", "net_flow_lag_2", "net_flow_lag_24", "net_flow_roll_3", "net_flow_roll_24",
            "jour_semaine", "coco_group", "is_holiday", "coco", "net_flow"]
FEATURES_SQL = f"""
p_base AS (
  SELECT * EXCLUDE (net_flow_roll_3, net_flow_roll_24),
    CASE WHEN count(net_flow) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 3
         THEN avg(net_flow) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END AS net_flow_roll_3,
    CASE WHEN count(net_flow) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) = 24
         THEN avg(net_flow) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) END AS net_flow_roll_24,
    lead(net_flow) OVER w AS y
  FROM g_grid {W_ST}
),
p_feat AS (
  SELECT {', '.join(FEATURES)}, y, {CAL_SQL},
    CAST(coalesce(temp < 5, FALSE) AS INTEGER) AS cold_weather, CAST(coalesce(temp > 30, FALSE) AS INTEGER) AS hot_weather,
    CAST(coalesce(precipitation_total > 5, FALSE) AS INTEGER) AS heavy_rain
  FROM p_base
  WHERE y IS NOT NULL AND net_flow_lag_1 IS NOT NULL AND net_flow_lag_2 IS NOT NULL AND net_flow_lag_24 IS NOT NULL
    AND net_flow_roll_3 IS NOT NULL AND net_flow_roll_24 IS NOT NULL AND num_bikes_taken_lag_1 IS NOT NULL
    AND num_bikes_dropped_lag_1 IS NOT NULL
)"""
FEATURE_REQUIRED = ["y", "net_flow_lag_1", "net_flow_lag_2", "net_flow_lag_24", "net_flow_roll_3",
                    "net_flow_roll_24", "num_bikes_taken_lag_1", "num_bikes_dropped_lag_1"]


def prepare_features(g: DataFrame) -> DataFrame:
    """Target = next-hour net flow; calendar and weather flags; strict rolls
    (pandas semantics); rows with any missing lag/roll/target removed.  One
    shuffle on station for all windows."""
    d = g.drop("net_flow_roll_3", "net_flow_roll_24")
    for n in (3, 24):
        d = windows.rolling_mean(d, "net_flow", n, ["station_id"], ["date_hour"], strict=True)
    d = windows.lead_target(d, "net_flow", ["station_id"], ["date_hour"])
    flags = weather_flags()
    d = d.select(*FEATURES, "y", *[v.alias(k) for k, v in _cal(d).items()],
                 *[flags[k].alias(k) for k in ("cold_weather", "hot_weather", "heavy_rain")])
    return d.dropna(subset=FEATURE_REQUIRED)


@query("prepare_features", G(FEATURES_SQL + "\nSELECT * FROM p_feat"))
def q_prepare_features(spark, sf_dir):
    return prepare_features(grid(spark, sf_dir))


@query("filter_feature_complete", G(FEATURES_SQL + "\nSELECT station_id, date_hour FROM p_feat"))
def q_filter_feature_complete(spark, sf_dir):
    return prepare_features(grid(spark, sf_dir)).select("station_id", "date_hour")


# --------------------------------------------------------------------------- filters, order, top-k

@query("filter_period", G("""SELECT station_id, date_hour FROM g_grid
WHERE date_hour BETWEEN (SELECT min(date_hour) FROM w_clean) AND (SELECT max(date_hour) FROM w_clean)"""))
def q_filter_period(spark, sf_dir):
    """Grid rows inside the weather-covered range (bounds from a 1-row aggregate)."""
    from flowgrid.plans.q_mobility import weather_hourly
    b = weather_hourly(spark, sf_dir).agg(F.min("date_hour").alias("lo"), F.max("date_hour").alias("hi"))
    g = with_scalars(grid(spark, sf_dir).select("station_id", "date_hour"), b)
    return g.where(F.col("date_hour").between(F.col("lo"), F.col("hi"))).drop("lo", "hi")


TOP_SQL = """
t_take AS (SELECT station_id, CAST(sum(num_bikes_taken) AS BIGINT) AS total_num_bikes_taken FROM g_grid
           GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20),
t_drop AS (SELECT station_id, CAST(sum(num_bikes_dropped) AS BIGINT) AS total_num_bikes_dropped FROM g_grid
           GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20)"""


def top_lists(g: DataFrame):
    return (profile.top_k(g, "station_id", "num_bikes_taken", 20),
            profile.top_k(g, "station_id", "num_bikes_dropped", 20))


@query("top_stations", G(TOP_SQL + "\nSELECT * FROM t_take"))
def q_top_stations(spark, sf_dir):
    return top_lists(grid(spark, sf_dir))[0]


@query("top_stations_daily_mean", G("""SELECT station_id, avg(d) AS mean_daily_num_bikes_taken FROM
  (SELECT station_id, CAST(date_hour AS DATE) AS dt, sum(num_bikes_taken) AS d FROM g_grid GROUP BY 1, 2)
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""))
def q_top_stations_daily_mean(spark, sf_dir):
    g = grid(spark, sf_dir).withColumn("dt", F.to_date("date_hour"))
    return profile.daily_mean_top_k(g, "station_id", "num_bikes_taken", "dt", 20)


@query("bottom_stations", G("""SELECT station_id, CAST(sum(net_flow) AS BIGINT) AS total_net_flow FROM g_grid
GROUP BY 1 ORDER BY 2 ASC, 1 LIMIT 20"""))
def q_bottom_stations(spark, sf_dir):
    return profile.top_k(grid(spark, sf_dir), "station_id", "net_flow", 20, ascending=True)


# fixed values: what stations are ranked by
RANKED = {"pickups": "num_bikes_taken", "drops": "num_bikes_dropped", "net_flow": "net_flow", "net_outflow": "-net_flow"}


@query("station_rankings", G("agg AS (" + "\nUNION ALL\n".join(
    f"SELECT '{form}_{n}' AS ranking, station_id, CAST({f}({c}) AS DOUBLE) AS value FROM g_grid GROUP BY 2"
    for n, c in RANKED.items() for form, f in (("total", "sum"), ("mean", "avg"))) + """)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ranking ORDER BY value DESC, station_id) AS INTEGER) AS rank FROM agg)
WHERE rank <= 20"""))
def q_station_rankings(spark, sf_dir):
    """Top 20 stations by total and by mean pickups, drops, net flow and its
    opposite."""
    return profile.rankings(grid(spark, sf_dir), "station_id", {n: F.expr(c) for n, c in RANKED.items()}, 20)


@query("outer_toplists", G(TOP_SQL + """
SELECT coalesce(a.station_id, b.station_id) AS station_id, a.total_num_bikes_taken, b.total_num_bikes_dropped
FROM t_take a FULL OUTER JOIN t_drop b ON a.station_id = b.station_id"""))
def q_outer_toplists(spark, sf_dir):
    a, b = top_lists(grid(spark, sf_dir))
    return a.join(b, "station_id", "full")


@query("focus_station_set", G(TOP_SQL + """
SELECT station_id FROM t_take UNION SELECT station_id FROM t_drop"""))
def q_focus_station_set(spark, sf_dir):
    a, b = top_lists(grid(spark, sf_dir))
    return a.select("station_id").union(b.select("station_id")).distinct()


def focus(spark, sf_dir) -> DataFrame:
    a, b = top_lists(grid(spark, sf_dir))
    return a.select("station_id").union(b.select("station_id")).distinct()


@query("filter_in_list", G(TOP_SQL + """
SELECT station_id, date_hour, net_flow FROM g_grid
WHERE station_id IN (SELECT station_id FROM t_take UNION SELECT station_id FROM t_drop)"""))
def q_filter_in_list(spark, sf_dir):
    g = grid(spark, sf_dir).select("station_id", "date_hour", "net_flow")
    return g.join(F.broadcast(focus(spark, sf_dir)), "station_id", "left_semi")  # <= 40 keys (two top-20 lists)


@query("export_focus_history", G(TOP_SQL + """
SELECT * FROM g_grid WHERE station_id IN (SELECT station_id FROM t_take UNION SELECT station_id FROM t_drop)
ORDER BY station_id, year, month, day, hour"""))
def q_export_focus_history(spark, sf_dir):
    g = grid(spark, sf_dir).join(F.broadcast(focus(spark, sf_dir)), "station_id", "left_semi")
    return g.orderBy("station_id", "year", "month", "day", "hour")


@query("order_output", G("SELECT station_id, date_hour, net_flow FROM g_grid ORDER BY station_id, date_hour"))
def q_order_output(spark, sf_dir):
    return grid(spark, sf_dir).select("station_id", "date_hour", "net_flow").orderBy("station_id", "date_hour")


@query("page_rows", G("""SELECT station_id, date_hour, net_flow FROM g_grid
ORDER BY station_id, date_hour LIMIT 500 OFFSET 1000"""))
def q_page_rows(spark, sf_dir):
    """One ordered page (OFFSET 1000 LIMIT 500) - the page is the feature."""
    g = grid(spark, sf_dir).select("station_id", "date_hour", "net_flow")
    return g.orderBy("station_id", "date_hour").offset(1000).limit(500)


@query("latest_row", G("""SELECT station_id, max(date_hour) AS date_hour,
  arg_max(net_flow, date_hour) AS net_flow, arg_max(temp, date_hour) AS temp FROM g_grid GROUP BY 1"""))
def q_latest_row(spark, sf_dir):
    g = grid(spark, sf_dir)
    return g.groupBy("station_id").agg(F.max("date_hour").alias("date_hour"),
                                       F.max_by("net_flow", "date_hour").alias("net_flow"),
                                       F.max_by("temp", "date_hour").alias("temp"))


# --------------------------------------------------------------------------- profiles

NUMERIC = ["num_bikes_taken", "num_bikes_dropped", "net_flow", "temp", "relative_humidity",
           "precipitation_total", "average_wind_speed"]


@query("series_alignment", G("""SELECT count(*) AS n_series, count(DISTINCT n_points) AS n_distinct_lengths,
  min(n_points) AS min_points, max(n_points) AS max_points,
  count(DISTINCT n_points) = 1 AND min(n_points) = (SELECT count(DISTINCT date_hour) FROM g_grid) AS same_hour_set
FROM (SELECT station_id, count(DISTINCT date_hour) AS n_points FROM g_grid GROUP BY 1)"""))
def q_series_alignment(spark, sf_dir):
    return profile.series_alignment(grid(spark, sf_dir))


@query("series_hour_sets", G("""SELECT station_id, count(DISTINCT date_hour)::BIGINT AS n_points,
  ((SELECT count(DISTINCT date_hour) FROM g_grid) - count(DISTINCT date_hour))::BIGINT AS n_missing,
  count(DISTINCT date_hour) = (SELECT count(DISTINCT date_hour) FROM g_grid) AS same_set
FROM g_grid WHERE NOT (station_id LIKE '%7' AND day = 5) GROUP BY 1"""))
def q_series_hour_sets(spark, sf_dir):
    """Per station its hours and those it lacks of all stations' hours; the
    stations ending in 7 have a day taken out."""
    g = grid(spark, sf_dir).where(~(F.col("station_id").endswith("7") & (F.col("day") == 5)))
    return sketches.series_overlap(g, "station_id", "date_hour")


@query("distinct_count", with_adapters(S.TRIMMED_TRIPS + """
SELECT count(DISTINCT start_station_id) AS n_start_stations, count(DISTINCT end_station_id) AS n_end_stations
FROM c_final"""))
def q_distinct_count(spark, sf_dir):
    t = final_trips(spark, sf_dir)
    return t.agg(F.count_distinct("start_station_id").alias("n_start_stations"),
                 F.count_distinct("end_station_id").alias("n_end_stations"))


@query("station_daily_mean", G("""SELECT station_id, avg(taken) AS mean_daily_taken, avg(dropped) AS mean_daily_dropped,
  avg(nf) AS mean_daily_net_flow FROM (SELECT station_id, CAST(date_hour AS DATE) AS dt, sum(num_bikes_taken) AS taken,
  sum(num_bikes_dropped) AS dropped, sum(net_flow) AS nf FROM g_grid GROUP BY 1, 2) GROUP BY 1"""))
def q_station_daily_mean(spark, sf_dir):
    g = grid(spark, sf_dir)
    d = g.groupBy("station_id", F.to_date("date_hour").alias("dt")).agg(
        F.sum("num_bikes_taken").alias("taken"), F.sum("num_bikes_dropped").alias("dropped"),
        F.sum("net_flow").alias("nf"))
    return d.groupBy("station_id").agg(F.avg("taken").alias("mean_daily_taken"),
                                       F.avg("dropped").alias("mean_daily_dropped"),
                                       F.avg("nf").alias("mean_daily_net_flow"))


@query("flow_by_calendar", G(f"""SELECT {HOUR_BAND_SQL} AS hour_band, jour_semaine,
  CAST(weekofyear(date_hour) AS INTEGER) AS iso_week, month,
  CAST(sum(num_bikes_taken) AS BIGINT) AS num_bikes_taken, CAST(sum(num_bikes_dropped) AS BIGINT) AS num_bikes_dropped
FROM g_grid GROUP BY GROUPING SETS ((1), (jour_semaine), (3), (month))"""))
def q_flow_by_calendar(spark, sf_dir):
    return profile.flow_by_calendar(grid(spark, sf_dir))


@query("flow_by_holiday", G("""SELECT hour, jour_semaine, is_holiday, avg(num_bikes_taken) AS mean_taken,
  avg(num_bikes_dropped) AS mean_dropped, avg(net_flow) AS mean_net_flow
FROM g_grid GROUP BY GROUPING SETS ((hour, is_holiday), (jour_semaine, is_holiday))"""))
def q_flow_by_holiday(spark, sf_dir):
    return profile.flow_by_holiday(grid(spark, sf_dir))


WEATHER_FLOW_SQL = """SELECT 'coco' AS dimension, CAST(coco AS VARCHAR) AS key, avg(num_bikes_taken) AS mean_taken,
  avg(num_bikes_dropped) AS mean_dropped, CAST(sum(num_bikes_taken) AS BIGINT) AS total_taken,
  CAST(sum(num_bikes_dropped) AS BIGINT) AS total_dropped FROM g_grid GROUP BY 1, 2
UNION ALL
SELECT 'coco_group', coco_group, avg(num_bikes_taken), avg(num_bikes_dropped),
  CAST(sum(num_bikes_taken) AS BIGINT), CAST(sum(num_bikes_dropped) AS BIGINT) FROM g_grid GROUP BY 1, 2"""


@query("flow_by_weather", G(WEATHER_FLOW_SQL))
def q_flow_by_weather(spark, sf_dir):
    return profile.flow_by_weather(grid(spark, sf_dir))


@query("flow_dashboard", G(TOP_SQL + f""",
fg AS (SELECT * FROM g_grid WHERE station_id IN (SELECT station_id FROM t_take UNION SELECT station_id FROM t_drop))
SELECT 'hour_band' AS section, {HOUR_BAND_SQL} AS key, CAST(sum(num_bikes_taken) AS BIGINT) AS num_bikes_taken,
  CAST(sum(num_bikes_dropped) AS BIGINT) AS num_bikes_dropped FROM fg GROUP BY 1, 2
UNION ALL SELECT 'weekday', jour_semaine, CAST(sum(num_bikes_taken) AS BIGINT), CAST(sum(num_bikes_dropped) AS BIGINT) FROM fg GROUP BY 1, 2
UNION ALL SELECT 'iso_week', CAST(weekofyear(date_hour) AS VARCHAR), CAST(sum(num_bikes_taken) AS BIGINT), CAST(sum(num_bikes_dropped) AS BIGINT) FROM fg GROUP BY 1, 2
UNION ALL SELECT 'month', CAST(month AS VARCHAR), CAST(sum(num_bikes_taken) AS BIGINT), CAST(sum(num_bikes_dropped) AS BIGINT) FROM fg GROUP BY 1, 2
UNION ALL SELECT 'holiday', CAST(is_holiday AS VARCHAR), CAST(sum(num_bikes_taken) AS BIGINT), CAST(sum(num_bikes_dropped) AS BIGINT) FROM fg GROUP BY 1, 2
UNION ALL SELECT 'coco_group', coco_group, CAST(sum(num_bikes_taken) AS BIGINT), CAST(sum(num_bikes_dropped) AS BIGINT) FROM fg GROUP BY 1, 2"""))
def q_flow_dashboard(spark, sf_dir):
    """Calendar, holiday and weather totals for the focus stations, long form
    (one Expand + one aggregate over the filtered grid)."""
    g = profile.with_calendar_keys(grid(spark, sf_dir)).join(
        F.broadcast(focus(spark, sf_dir)), "station_id", "left_semi")
    keys = {"hour_band": F.col("hour_band"), "weekday": F.col("jour_semaine"),
            "iso_week": F.col("iso_week").cast("string"), "month": F.col("month").cast("string"),
            "holiday": F.col("is_holiday").cast("string"), "coco_group": F.col("coco_group")}
    arr = F.array(*[F.struct(F.lit(k).alias("section"), v.alias("key")) for k, v in keys.items()])
    e = g.select(F.inline(arr), "num_bikes_taken", "num_bikes_dropped")
    return e.groupBy("section", "key").agg(F.sum("num_bikes_taken").cast("long").alias("num_bikes_taken"),
                                           F.sum("num_bikes_dropped").cast("long").alias("num_bikes_dropped"))


@query("heatmap_pivot", G("SELECT jour_semaine, " + ", ".join(
    f"avg(CASE WHEN hour = {h} THEN net_flow END) AS h{h}" for h in range(24)) + " FROM g_grid GROUP BY 1"))
def q_heatmap_pivot(spark, sf_dir):
    return profile.heatmap_pivot(grid(spark, sf_dir))


@query("heatmap_binned", G("""hb AS (SELECT *, round(temp, 1) AS x FROM g_grid),
hm AS (SELECT min(x) AS mn, max(x) AS mx FROM hb)
SELECT CASE WHEN mx = mn THEN 1 ELSE CAST(greatest(1, least(20, ceil((x - mn) / ((mx - mn) / 20)))) AS INTEGER) END
  AS temp_bin, hour, avg(net_flow) AS mean_net_flow FROM hb, hm GROUP BY 1, 2"""))
def q_heatmap_binned(spark, sf_dir):
    return profile.heatmap_binned(grid(spark, sf_dir), "temp", 20)


@query("correlation_matrix", G("\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS corr FROM g_grid"
    for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:])))
def q_correlation_matrix(spark, sf_dir):
    return profile.correlation_long(grid(spark, sf_dir), NUMERIC)


@query("describe_numeric", G("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
  CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
  quantile_cont({c}, 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM g_grid""" for c in NUMERIC)))
def q_describe_numeric(spark, sf_dir):
    return profile.describe_numeric(grid(spark, sf_dir), NUMERIC)


@query("histogram_box", G("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, CAST(CASE WHEN mx = mn THEN 0 ELSE least(floor((CAST({c} AS DOUBLE) - mn) / (mx - mn) * 30), 29) END AS INTEGER) AS bin,
  count(*) AS n, any_value(mn) AS min, any_value(q1) AS p25, any_value(q2) AS p50, any_value(q3) AS p75, any_value(mx) AS max
  FROM g_grid, (SELECT CAST(min({c}) AS DOUBLE) AS mn, CAST(max({c}) AS DOUBLE) AS mx, quantile_cont({c}, 0.25) AS q1,
    quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM g_grid)
  WHERE {c} IS NOT NULL GROUP BY 1, 2""" for c in NUMERIC)))
def q_histogram_box(spark, sf_dir):
    return profile.histogram_box(grid(spark, sf_dir), NUMERIC, 30)


@query("moments", G("""SELECT count(net_flow) AS n, avg(net_flow) AS mean, stddev_samp(net_flow) AS std_samp,
  stddev_pop(net_flow) AS std_pop FROM g_grid"""))
def q_moments(spark, sf_dir):
    return profile.moments(grid(spark, sf_dir), "net_flow")


@query("having_filter", with_adapters(S.NET_FLOW + "\nSELECT * FROM f_pick WHERE num_bikes_taken > 1"))
def q_having_filter(spark, sf_dir):
    return flow.hourly_pickups(final_trips(spark, sf_dir)).where("num_bikes_taken > 1")


@query("time_ordered_split", G("""SELECT station_id, date_hour,
  CASE WHEN row_number() OVER (ORDER BY date_hour, station_id) - 1 < floor((SELECT count(*) FROM g_grid) * 0.8)
       THEN 'train' ELSE 'test' END AS split FROM g_grid"""))
def q_time_ordered_split(spark, sf_dir):
    g = grid(spark, sf_dir).select("station_id", "date_hour")
    return windows.time_ordered_split(g, ["date_hour", "station_id"], 0.8)


@query("positional_split", """SELECT o_orderkey, CASE WHEN file_row_number < floor((SELECT count(*) FROM orders) * 0.8)
  THEN 'train' ELSE 'test' END AS split FROM (SELECT o_orderkey, row_number() OVER () - 1 AS file_row_number FROM orders)""")
def q_positional_split(spark, sf_dir):
    """80/20 cut by row position in the stored file, whatever the order of its values."""
    return windows.positional_split(spark, f"{sf_dir}/orders.parquet", 0.8).select("o_orderkey", "split")


# --------------------------------------------------------------------------- table profiles (trips / weather)

TRIP_COLUMNS = ["id", "started_at", "ended_at", "start_station_id", "end_station_id", "rideable_type", "member_casual",
                "start_lat", "start_lng", "end_lat", "end_lng"]


@query("missing_pct", with_adapters("SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*) "
    f"AS missing_pct FROM a_trips" for c in TRIP_COLUMNS) + ") WHERE missing_pct > 0"))
def q_missing_pct(spark, sf_dir):
    """Percent null per column (> 0), every column in one aggregate."""
    return profile.missing_pct(mob(spark, sf_dir)["trips"].select(*TRIP_COLUMNS))


@query("categorical_profile", with_adapters("""c AS (SELECT 'rideable_type' AS column_name, rideable_type AS value FROM a_trips
  UNION ALL SELECT 'member_casual', member_casual FROM a_trips),
g AS (SELECT column_name, value, count(*) AS n FROM c GROUP BY 1, 2)
SELECT column_name, value, n, round(n * 100.0 / sum(n) OVER (PARTITION BY column_name), 6) AS pct FROM g"""))
def q_categorical_profile(spark, sf_dir):
    """Frequency and share of every value of the text columns."""
    return profile.categorical_profile(mob(spark, sf_dir)["trips"], ["rideable_type", "member_casual"])


@query("duplicate_rows", with_adapters("""SELECT time, temp, coco FROM a_weather
WHERE date_trunc('hour', time) IN (SELECT date_trunc('hour', time) FROM a_weather GROUP BY 1 HAVING count(*) > 1)"""))
def q_duplicate_rows(spark, sf_dir):
    """All weather observations whose hour holds more than one (keep=False)."""
    from flowgrid.functions.columns import hour_floor
    w = mob(spark, sf_dir)["weather"].select("time", "temp", "coco", hour_floor("time").alias("_h"))
    return profile.duplicate_rows(w, ["_h"]).drop("_h")
