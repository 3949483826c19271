"""Hourly departures/arrivals, net flow, weather per hour and the dense
station x hour grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgrid.functions.columns import (hour_floor, weather_code_group, weather_code_parse,
                                        weekday_label)
from flowgrid.operators.clean import WEATHER_REQUIRED, filter_complete_rows
from flowgrid.operators.joins import bounded_broadcast
from flowgrid.operators.series import asof_backward, hour_spine
from flowgrid.session import materialize

KEYS = ["station_id", "date_hour"]
SIGNS = ("dropped_minus_taken", "taken_minus_dropped")
WEATHER_MEASURES = ["temp", "relative_humidity", "precipitation_total", "average_wind_speed"]
# hours in the study range bound the weather and spine sides (8 784 per leap year)
MAX_HOURS_BROADCAST = 1_000_000


def _net(taken, dropped, sign: str):
    if sign == "taken_minus_dropped":
        return taken - dropped
    if sign == "dropped_minus_taken":
        return dropped - taken
    raise ValueError(f"sign must be one of {SIGNS}")


def hourly_pickups(trips: DataFrame, station: str = "start_station_id", ts: str = "started_at") -> DataFrame:
    """Trips per (start station, hour of start): partial + final hash aggregate."""
    return (trips.groupBy(F.col(station).alias("station_id"), hour_floor(ts).alias("date_hour"))
            .agg(F.count(F.lit(1)).alias("num_bikes_taken")))


def hourly_drops(trips: DataFrame, station: str = "end_station_id", ts: str = "ended_at") -> DataFrame:
    return (trips.groupBy(F.col(station).alias("station_id"), hour_floor(ts).alias("date_hour"))
            .agg(F.count(F.lit(1)).alias("num_bikes_dropped")))


def reaggregate_flow(df: DataFrame, measure: str) -> DataFrame:
    """Sum counts again after truncating to the hour."""
    return (df.groupBy("station_id", hour_floor("date_hour").alias("date_hour"))
            .agg(F.sum(measure).cast("long").alias(measure)))


def full_outer_flow(pickups: DataFrame, drops: DataFrame, sign: str = "taken_minus_dropped") -> DataFrame:
    """pickups FULL OUTER JOIN drops on (station, hour); keys and counts coalesced."""
    j = pickups.join(drops, KEYS, "full")
    t = F.coalesce("num_bikes_taken", F.lit(0)).cast("long")
    d = F.coalesce("num_bikes_dropped", F.lit(0)).cast("long")
    return j.select(*KEYS, t.alias("num_bikes_taken"), d.alias("num_bikes_dropped"), _net(t, d, sign).alias("net_flow"))


def net_flow_single_pass(trips: DataFrame, sign: str = "taken_minus_dropped") -> DataFrame:
    """Same result as ``full_outer_flow`` with one shuffle: each trip becomes a
    +1 pickup row and a +1 drop row, then a single partial/final aggregate."""
    p = trips.select(F.col("start_station_id").alias("station_id"), hour_floor("started_at").alias("date_hour"),
                     F.lit(1).alias("_t"), F.lit(0).alias("_d"))
    d = trips.select(F.col("end_station_id").alias("station_id"), hour_floor("ended_at").alias("date_hour"),
                     F.lit(0).alias("_t"), F.lit(1).alias("_d"))
    g = p.unionByName(d).groupBy(*KEYS).agg(F.sum("_t").cast("long").alias("num_bikes_taken"),
                                           F.sum("_d").cast("long").alias("num_bikes_dropped"))
    return g.withColumn("net_flow", _net(F.col("num_bikes_taken"), F.col("num_bikes_dropped"), sign))


def dedup_keep_best(df: DataFrame, keys=KEYS, by: str = "net_flow") -> DataFrame:
    """One row per key, highest ``by``; remaining columns (descending) break
    ties.  A hash aggregate of ``max(struct(by, others))``: partial aggregation
    collapses a hot key map-side (a row_number window would sort a whole key
    group in one task), and after an aggregate on the same keys it adds no
    shuffle."""
    others = [c for c in df.columns if c not in keys and c != by]
    g = df.groupBy(*keys).agg(F.max(F.struct(F.col(by), *[F.col(c) for c in others])).alias("_r"))
    return g.select(*[F.col(c) if c in keys else F.col("_r." + c).alias(c) for c in df.columns])


def station_day_summary(net: DataFrame) -> DataFrame:
    return (net.groupBy("station_id", F.to_date("date_hour").alias("date"))
            .agg(F.sum("num_bikes_taken").cast("long").alias("num_bikes_taken"),
                 F.sum("num_bikes_dropped").cast("long").alias("num_bikes_dropped"),
                 F.sum("net_flow").cast("long").alias("net_flow")))


# ---------------------------------------------------------------------------
# Weather
# ---------------------------------------------------------------------------
def weather_hourly_dedup(weather: DataFrame, digits: int | None = None) -> DataFrame:
    """Hour key, mean of the measures and max of the parsed code per hour,
    incomplete hours removed, code group attached."""
    base = weather.select(hour_floor("time").alias("date_hour"), *WEATHER_MEASURES,
                          weather_code_parse("coco").alias("coco"))
    aggs = []
    for m in WEATHER_MEASURES:
        a = F.avg(m)
        aggs.append((F.round(a, digits) if digits is not None else a).alias(m))
    g = base.groupBy("date_hour").agg(*aggs, F.max("coco").alias("coco"))
    g = filter_complete_rows(g, WEATHER_REQUIRED)
    return g.withColumn("coco_group", weather_code_group("coco"))


def weather_hourly_filled(wh: DataFrame) -> DataFrame:
    """Every hour between the first and last weather hour with the latest
    observation at or before it (as-of backward).  The weather series is
    bounded by the hours of the study range, so one ordered window is fine."""
    spine = hour_spine(wh, "date_hour")
    return asof_backward(spine, wh, "date_hour", global_order="window")


# ---------------------------------------------------------------------------
# Grid
# ---------------------------------------------------------------------------
#: fixed values: the columns of the grid table, in its order
GRID_COLUMNS = ["station_id", "date_hour", "year", "month", "day", "hour", "temp", "precipitation_total",
                "relative_humidity", "average_wind_speed", "num_bikes_taken_lag_1", "num_bikes_dropped_lag_1",
                "net_flow_lag_1", "net_flow_lag_2", "net_flow_lag_24", "net_flow_roll_3", "net_flow_roll_24",
                "jour_semaine", "coco_group", "is_holiday", "coco", "net_flow", "num_bikes_taken",
                "num_bikes_dropped"]


def dense_index(net: DataFrame, spine_mode: str = "hour_span") -> DataFrame:
    """stations x hours, as a generator rather than a join: every station row
    explodes the hour range, whose bounds come from one scalar subquery.
    ``hour_span``: first..last observed hour (SQL); ``day_x_24``: whole days x
    24 hours (pandas).  The station list is hash-spread over the shuffle
    partitions first, so the (stations x hours) rows are generated by many
    tasks, not by the one that holds a small distinct result."""
    if spine_mode == "hour_span":
        b = net.agg(F.struct(F.min(hour_floor("date_hour")).alias("lo"),
                             F.max(hour_floor("date_hour")).alias("hi")).alias("b")).scalar()
        lo, hi = b.getField("lo"), b.getField("hi")
    elif spine_mode == "day_x_24":
        b = net.agg(F.struct(F.min(F.to_date("date_hour")).alias("lo"),
                             F.max(F.to_date("date_hour")).alias("hi")).alias("b")).scalar()
        lo = b.getField("lo").cast("timestamp_ntz")
        hi = F.timestamp_add("HOUR", F.lit(23), b.getField("hi").cast("timestamp_ntz"))
    else:
        raise ValueError(spine_mode)
    n = int(net.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    stations = net.select("station_id").distinct().repartition(n, "station_id")
    return stations.select("station_id", F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 HOUR"))).alias("date_hour"))


def left_grid_fill(index: DataFrame, net: DataFrame) -> DataFrame:
    """index LEFT JOIN net (one row per key), counts 0 where net has no row.

    Written as a union + aggregate on station-hash-partitioned inputs instead
    of a join: ``dense_index`` already lays the index out by station, so only
    net flow (<= the grid) is shuffled, by station; the aggregate on (station,
    hour) and the later per-station windows reuse that partitioning (no
    grid-sized shuffle for the join, none for the windows).  Net rows whose
    key is not in the index are dropped, as by the left join."""
    counts = ["num_bikes_taken", "num_bikes_dropped", "net_flow"]
    n = int(net.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    i = index.select(*KEYS, F.lit(1).alias("_i"), *[F.lit(0).cast("long").alias(c) for c in counts])
    m = net.select(*KEYS, F.lit(0).alias("_i"), *[F.col(c).cast("long").alias(c) for c in counts]) \
        .repartition(n, "station_id")
    g = i.unionByName(m).groupBy(*KEYS).agg(F.max("_i").alias("_i"), *[F.sum(c).alias(c) for c in counts])
    return g.where(F.col("_i") == 1).select(*KEYS, F.hour("date_hour").alias("hour"),
                                             *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts])


def left_weather(grid: DataFrame, weather_filled: DataFrame) -> DataFrame:
    w = bounded_broadcast(weather_filled, MAX_HOURS_BROADCAST)
    g = grid.join(w, "date_hour", "left")
    return g.withColumns({
        **{m: F.coalesce(m, F.lit(0.0)) for m in WEATHER_MEASURES},
        "coco": F.coalesce(F.col("coco").cast("int"), F.lit(0)),
        "coco_group": F.coalesce("coco_group", F.lit("Autre")),
    })


def left_holiday(grid: DataFrame, holidays: DataFrame, ts: str = "date_hour") -> DataFrame:
    h = bounded_broadcast(holidays.select(F.col("date").alias("_hd"), F.col("is_holiday").alias("_ih")), 1_000_000)
    g = grid.join(h, F.to_date(grid[ts]) == h["_hd"], "left")
    return g.withColumn("is_holiday", F.coalesce("_ih", F.lit(False))).drop("_hd", "_ih")


def add_lags_and_rolls(grid: DataFrame, min_periods: str = "partial", by: str = "station_id",
                       order: str = "date_hour") -> DataFrame:
    """Lags 1/2/24 of net flow, lag 1 of pickups/drops, rolling means of the
    previous 3 and 24 rows.  ``min_periods='partial'``: mean over the rows that
    exist (SQL); ``'strict'``: null unless the frame is full (pandas).  All
    windows share one partitioning and ordering -> one shuffle, one sort."""
    w = Window.partitionBy(by).orderBy(order)
    cols = {
        "net_flow_lag_1": F.lag("net_flow", 1).over(w),
        "net_flow_lag_2": F.lag("net_flow", 2).over(w),
        "net_flow_lag_24": F.lag("net_flow", 24).over(w),
        "num_bikes_taken_lag_1": F.lag("num_bikes_taken", 1).over(w),
        "num_bikes_dropped_lag_1": F.lag("num_bikes_dropped", 1).over(w),
    }
    for n in (3, 24):
        fr = w.rowsBetween(-n, -1)
        mean = F.avg("net_flow").over(fr)
        if min_periods == "strict":
            mean = F.when(F.count("net_flow").over(fr) == n, mean)
        cols[f"net_flow_roll_{n}"] = mean
    return grid.withColumns(cols)


def build_grid(trips: DataFrame, stations: DataFrame, weather: DataFrame, holidays: DataFrame, *,
               sign: str = "taken_minus_dropped", spine_mode: str = "hour_span", min_periods: str = "partial",
               weather_digits: int | None = None, trims: bool = True, clean_kwargs: dict | None = None) -> DataFrame:
    """Raw trips/stations/weather/holidays -> the 24-column station x hour grid."""
    from flowgrid.operators.clean import clean_trips

    t = clean_trips(trips, stations, trims=trims, **(clean_kwargs or {}))
    # net flow (<= stations x hours rows) and the filled weather (<= hours rows)
    # are small and reused by the spine, the size checks and the joins: write
    # them once as Parquet in the shared checkpoint folder (one job each, unlike
    # an RDD checkpoint that computes the lineage twice) and read them back.
    net = materialize(dedup_keep_best(net_flow_single_pass(t, sign)), "net-flow")
    wf = materialize(weather_hourly_filled(weather_hourly_dedup(weather, weather_digits)), "weather-filled")
    g = left_grid_fill(dense_index(net, spine_mode), net)
    g = left_weather(g, wf)
    g = g.withColumns({"year": F.year("date_hour"), "month": F.month("date_hour"),
                       "day": F.dayofmonth("date_hour"), "jour_semaine": weekday_label("date_hour")})
    g = left_holiday(g, holidays)
    g = add_lags_and_rolls(g, min_periods)
    return g.select(*GRID_COLUMNS)
