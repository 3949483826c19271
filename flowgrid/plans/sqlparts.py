"""Shared DuckDB SQL fragments for the oracle.

Written from the meaning of the operators with other means than the Spark
plans use, so that an error in one is not repeated in the other: null
propagation instead of lists of null tests, quantiles by rank, moves (+1 / -1)
instead of two counts and an outer join, observations stretched to the next
one instead of an as-of join, lags by time-shifted joins and rolling means by
time ranges instead of row offsets."""

from __future__ import annotations


def norm_sql(x: str) -> str:
    return (f"CASE WHEN position('.' IN {x}) > 0 AND length(split_part({x}, '.', 2)) = 1 "
            f"THEN split_part({x}, '.', 1) || '.' || split_part({x}, '.', 2) || '0' ELSE {x} END")


HAVERSINE_SQL = ("round(6371 * 2 * asin(sqrt(pow(sin(radians(end_lat - start_lat) / 2), 2) + "
                 "cos(radians(start_lat)) * cos(radians(end_lat)) * pow(sin(radians(end_lng - start_lng) / 2), 2))), 2)")

# usable stations (c_st); complete trips between them, ids normalised (c_valid)
VALID_TRIPS = f"""
c_st AS (SELECT * FROM a_stations WHERE (short_name || station_id || name) IS NOT NULL AND (id + capacity + lat) IS NOT NULL),
c_valid AS (
  SELECT t.* REPLACE (x.short_name AS start_station_id, y.short_name AS end_station_id)
  FROM a_trips t JOIN c_st x ON x.short_name = {norm_sql('t.start_station_id')} JOIN c_st y ON y.short_name = {norm_sql('t.end_station_id')}
  WHERE (t.ended_at - t.started_at) IS NOT NULL AND (t.rideable_type || t.member_casual) IS NOT NULL
)"""

# durations of 1 to 80 minutes (c_range), within the 1 % and 99 % ranks (c_qtrim), distances within 3 sigma (c_final)
TRIMMED_TRIPS = VALID_TRIPS + f""",
c_dur AS (SELECT *, date_diff('microsecond', started_at, ended_at) / CAST(6e7 AS DOUBLE) AS duration_minutes FROM c_valid),
c_range AS (FROM c_dur WHERE 1 <= duration_minutes AND duration_minutes <= 80),
c_rank AS (
  SELECT duration_minutes AS d, row_number() OVER (ORDER BY duration_minutes) - 1 AS r, (count(*) OVER () - 1) * CAST(0.01 AS DOUBLE) AS lo,
         (count(*) OVER () - 1) * CAST(0.99 AS DOUBLE) AS hi FROM c_range
),
c_cut AS (
  SELECT max(d) FILTER (r = floor(lo)) + (max(d) FILTER (r = ceil(lo)) - max(d) FILTER (r = floor(lo))) * (max(lo) - floor(max(lo))) AS least,
         max(d) FILTER (r = floor(hi)) + (max(d) FILTER (r = ceil(hi)) - max(d) FILTER (r = floor(hi))) * (max(hi) - floor(max(hi))) AS most
  FROM c_rank
),
c_qtrim AS (FROM c_range WHERE duration_minutes >= (SELECT least FROM c_cut) AND duration_minutes <= (SELECT most FROM c_cut)),
c_dist AS (SELECT *, {HAVERSINE_SQL} AS distance_km_rounded FROM c_qtrim),
c_final AS (
  SELECT * EXCLUDE (middle, spread)
  FROM (SELECT *, avg(distance_km_rounded) OVER () AS middle, stddev_samp(distance_km_rounded) OVER () AS spread FROM c_dist)
  WHERE distance_km_rounded >= middle - 3 * spread AND distance_km_rounded <= middle + 3 * spread
)"""

# every trip takes a bike at one station and hour and drops it at another
NET_FLOW = TRIMMED_TRIPS + """,
f_moves AS (
  SELECT unnest([{'s': start_station_id, 't': started_at, 'taken': 1}, {'s': end_station_id, 't': ended_at, 'taken': 0}], recursive := true)
  FROM c_final
),
f_dedup AS (
  SELECT s AS station_id, date_trunc('hour', t) AS date_hour, CAST(sum(taken) AS BIGINT) AS num_bikes_taken,
         CAST(sum(1 - taken) AS BIGINT) AS num_bikes_dropped, CAST(sum(2 * taken - 1) AS BIGINT) AS net_flow
  FROM f_moves GROUP BY ALL
),
f_net AS (FROM f_dedup),
f_pick AS (SELECT station_id, date_hour, num_bikes_taken FROM f_dedup WHERE num_bikes_taken > 0),
f_drop AS (SELECT station_id, date_hour, num_bikes_dropped FROM f_dedup WHERE num_bikes_dropped > 0)"""

# fixed values: the code ranges and their group names
COCO_GROUP_SQL = """CASE WHEN coco BETWEEN 1 AND 6 THEN 'Pas de pluie' WHEN coco = 17 THEN 'Averse de pluie'
              WHEN coco BETWEEN 8 AND 27 THEN 'Pluie/Neige' ELSE 'Autre' END"""

# hours with every measure (w_clean), stretched over the hours up to the next such hour (w_filled)
WEATHER = f"""
w_base AS (
  SELECT * REPLACE (CASE WHEN coco SIMILAR TO '[0-9]+([.][0-9]+)?' THEN CAST(round(CAST(coco AS DOUBLE)) AS INTEGER) END AS coco),
         date_trunc('hour', time) AS date_hour FROM a_weather
),
w_clean AS (
  SELECT *, {COCO_GROUP_SQL} AS coco_group FROM (
    SELECT date_hour, round(avg(temp), 6) AS temp, round(avg(relative_humidity), 6) AS relative_humidity,
           round(avg(precipitation_total), 6) AS precipitation_total, round(avg(average_wind_speed), 6) AS average_wind_speed,
           max(coco) AS coco
    FROM w_base GROUP BY date_hour
    HAVING least(count(temp), count(relative_humidity), count(precipitation_total), count(average_wind_speed), count(coco)) > 0)
),
w_until AS (SELECT *, coalesce(lead(date_hour) OVER (ORDER BY date_hour), date_hour + INTERVAL 1 HOUR) AS until FROM w_clean),
w_filled AS (
  SELECT unnest(range(date_hour, until, INTERVAL 1 HOUR)) AS date_hour, temp, relative_humidity, precipitation_total,
         average_wind_speed, coco, coco_group FROM w_until
),
w_spine AS (SELECT date_hour FROM w_filled)"""

# fixed values: weekday names from Sunday on
WEEKDAY_SQL = "['Dimanche', 'Lundi', 'Mardi', 'Mercredi', 'Jeudi', 'Vendredi', 'Samedi'][CAST(dayofweek(date_hour) AS INTEGER) + 1]"

GRID = NET_FLOW + "," + WEATHER + f""",
g_hours AS (
  SELECT unnest(range(first, last + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS date_hour
  FROM (SELECT min(date_hour) AS first, max(date_hour) AS last FROM f_dedup)
),
g_st AS (SELECT station_id FROM f_dedup GROUP BY ALL),
g_bike AS (
  SELECT station_id, date_hour, CAST(hour(date_hour) AS INTEGER) AS hour, CAST(sum(num_bikes_taken) AS BIGINT) AS num_bikes_taken,
         CAST(sum(num_bikes_dropped) AS BIGINT) AS num_bikes_dropped, CAST(sum(net_flow) AS BIGINT) AS net_flow
  FROM (FROM f_dedup UNION ALL SELECT station_id, date_hour, 0, 0, 0 FROM g_st, g_hours) GROUP BY station_id, date_hour
),
g_merged AS (
  SELECT g_bike.*, ifnull(temp, 0) AS temp, ifnull(relative_humidity, 0) AS relative_humidity,
         ifnull(precipitation_total, 0) AS precipitation_total, ifnull(average_wind_speed, 0) AS average_wind_speed,
         ifnull(coco, 0) AS coco, ifnull(coco_group, 'Autre') AS coco_group
  FROM g_bike LEFT JOIN w_filled USING (date_hour)
),
g_rolled AS (
  SELECT *, avg(net_flow) OVER (s RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS net_flow_roll_3,
         avg(net_flow) OVER (s RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS net_flow_roll_24
  FROM g_merged WINDOW s AS (PARTITION BY station_id ORDER BY date_hour)
),
g_grid AS (
  SELECT n.station_id, n.date_hour, CAST(year(n.date_hour) AS INTEGER) AS year, CAST(month(n.date_hour) AS INTEGER) AS month,
         CAST(day(n.date_hour) AS INTEGER) AS day, n.hour, n.temp, n.precipitation_total, n.relative_humidity, n.average_wind_speed,
         h1.num_bikes_taken AS num_bikes_taken_lag_1, h1.num_bikes_dropped AS num_bikes_dropped_lag_1, h1.net_flow AS net_flow_lag_1,
         h2.net_flow AS net_flow_lag_2, h24.net_flow AS net_flow_lag_24, n.net_flow_roll_3, n.net_flow_roll_24,
         {WEEKDAY_SQL.replace('date_hour', 'n.date_hour')} AS jour_semaine, n.coco_group,
         CAST(n.date_hour AS DATE) IN (SELECT date FROM a_holidays) AS is_holiday, n.coco, n.net_flow, n.num_bikes_taken, n.num_bikes_dropped
  FROM g_rolled n
  LEFT JOIN g_bike h1 ON h1.station_id = n.station_id AND h1.date_hour + INTERVAL 1 HOUR = n.date_hour
  LEFT JOIN g_bike h2 ON h2.station_id = n.station_id AND h2.date_hour + INTERVAL 2 HOUR = n.date_hour
  LEFT JOIN g_bike h24 ON h24.station_id = n.station_id AND h24.date_hour + INTERVAL 24 HOUR = n.date_hour
)"""
