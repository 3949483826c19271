"""Registered source/sink queries.  Each writes data derived from the driver
tables into the shared scratch folder (under ``spark.checkpoint.dir``) with
the engine's writer and returns it read back with the engine's reader."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgrid.functions.columns import hour_floor, normalize_station_id
from flowgrid.functions.dates import ntz_lit
from flowgrid.operators import clean, flow
from flowgrid.operators.joins import bounded_broadcast, shuffled
from flowgrid.plans import sqlparts as S
from flowgrid.plans.adapters import n_stations, sql_station_index, station_index
from flowgrid.plans.q_drift import PERIOD_SQL, predictions
from flowgrid.plans.q_grid import G, grid
from flowgrid.plans.q_mobility import mob, weather_hourly
from flowgrid.plans.q_star import T as TBL
from flowgrid.plans.registry import query, with_adapters
from flowgrid.session import scratch_path
from flowgrid.sources import readers, sinks

TRIP10_SQL = with_adapters("""SELECT started_at, ended_at, start_station_id, end_station_id, rideable_type,
  member_casual, start_lat, start_lng, end_lat, end_lng FROM a_trips""")


def _trip_csv_frame(spark, sf_dir) -> DataFrame:
    t = mob(spark, sf_dir)["trips"]
    ts = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return t.select(F.col("id").cast("string").alias("ride_id"), "rideable_type", ts("started_at").alias("started_at"),
                    ts("ended_at").alias("ended_at"), F.concat(F.lit("Station "), "start_station_id").alias("start_station_name"),
                    "start_station_id", F.concat(F.lit("Station "), "end_station_id").alias("end_station_name"),
                    "end_station_id", "start_lat", "start_lng", "end_lat", "end_lng", "member_casual")


@query("src_trips_csv", TRIP10_SQL)
def q_src_trips_csv(spark, sf_dir):
    """Trips written as a monthly CSV export plus a decoy file that does not
    match the name pattern (same rows: any leak would duplicate them)."""
    base = scratch_path(spark, "trip-csv")
    frame = _trip_csv_frame(spark, sf_dir)
    frame.write.option("header", True).csv(f"{base}/202401-bike-tripdata_1.csv")
    frame.write.option("header", True).csv(f"{base}/notes_export.csv")
    return readers.read_trips(spark, base)


@query("src_trips_zip", TRIP10_SQL)
def q_src_trips_zip(spark, sf_dir):
    """Trips zipped per partition by the executors (archives of several
    members), then read member by member through the archives' directories."""
    base = scratch_path(spark, "trip-zip")
    frame = _trip_csv_frame(spark, sf_dir).withColumn("_pid", F.spark_partition_id())

    def zip_parts(it):
        from pyarrow import fs as pafs
        filesystem, root = pafs.FileSystem.from_uri(base)  # local, HDFS or object store
        filesystem.create_dir(root, recursive=True)
        for batch_no, pdf in enumerate(it):
            if len(pdf) == 0:
                continue
            pid = int(pdf["_pid"].iloc[0])
            # deterministic name: a retried task overwrites its own archive instead of adding one
            name = f"{root}/2024{pid:04d}-{batch_no:05d}-bike-tripdata.zip"
            blob = io.BytesIO()
            with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("readme.txt", "not a table")
                for part, rows in enumerate(range(0, len(pdf), 4000)):
                    z.writestr(f"202401-bike-tripdata_{part}.csv", pdf.iloc[rows:rows + 4000].drop(columns=["_pid"]).to_csv(index=False))
            with filesystem.open_output_stream(name) as out:
                out.write(blob.getvalue())
            yield pd.DataFrame({"n": [len(pdf)]})

    frame.mapInPandas(zip_parts, "n long").agg(F.sum("n")).collect()  # one action: write the archives
    return readers.read_trip_archives(spark, base)


FEED_DOC_STATIONS = 10_000  # stations per feed document (part)
WEATHER_DOC_ROWS = 10_000  # observations per weather document


def feed_documents(st: DataFrame, item, key: str = "station_id") -> DataFrame:
    """``{"data": {"stations": [...]}}`` documents, one per hash bucket of
    ``key`` with about FEED_DOC_STATIONS items each, so no task or group ever
    holds the whole dimension.  Written one document per line."""
    n = max(1, -(-st.count() // FEED_DOC_STATIONS))
    b = F.pmod(F.xxhash64(key), F.lit(n)).alias("_part")
    return st.groupBy(b).agg(F.collect_list(item).alias("stations")).select(F.struct("stations").alias("data"))


def _stations_complete(spark, sf_dir) -> DataFrame:
    return mob(spark, sf_dir)["stations"]


@query("src_stations_json", with_adapters("SELECT short_name, station_id, name, capacity, lat, lon FROM a_stations"))
def q_src_stations_json(spark, sf_dir):
    """Station dimension as nested feed documents (one per bucket of
    stations), read back line-delimited."""
    path = scratch_path(spark, "station-feed")
    st = _stations_complete(spark, sf_dir)
    feed_documents(st, F.struct(*readers.STATION_FIELDS)).write.json(path)
    return readers.read_stations(spark, path, multi_line=False)


STATUS_SQL = with_adapters("""SELECT station_id, CAST(id % 7 AS INTEGER) AS num_bikes_available,
  CAST(capacity - id % 7 AS INTEGER) AS num_docks_available FROM a_stations""")


def status(spark, sf_dir) -> DataFrame:
    st = _stations_complete(spark, sf_dir)
    return st.select("station_id", (F.col("id") % 7).cast("int").alias("num_bikes_available"),
                     (F.col("capacity") - F.col("id") % 7).cast("int").alias("num_docks_available"),
                     "short_name")


@query("src_station_status_json", STATUS_SQL)
def q_src_station_status_json(spark, sf_dir):
    path = scratch_path(spark, "status-feed")
    feed_documents(status(spark, sf_dir),
                   F.struct("station_id", "num_bikes_available", "num_docks_available")).write.json(path)
    return readers.read_station_status(spark, path, multi_line=False)


@query("src_weather_json", with_adapters("""SELECT time, temp, relative_humidity, precipitation_total,
  average_wind_speed, coco FROM a_weather"""))
def q_src_weather_json(spark, sf_dir):
    """Payload documents of at most about WEATHER_DOC_ROWS observations of a day
    (``data`` array of hourly objects with extra fields that the reader drops)."""
    path = scratch_path(spark, "weather-json")
    w = mob(spark, sf_dir)["weather"]
    obj = F.struct(F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"), "temp",
                   F.col("relative_humidity").alias("rhum"), F.col("precipitation_total").alias("prcp"),
                   F.col("average_wind_speed").alias("wspd"), "coco", (F.col("temp") - 3).alias("dwpt"))
    n = max(1, -(-w.count() // WEATHER_DOC_ROWS))
    part = F.pmod(F.xxhash64("time", "temp", "coco"), F.lit(n))
    docs = w.groupBy(F.to_date("time").alias("d"), part.alias("p")).agg(F.collect_list(obj).alias("data")).select("data")
    docs.write.json(path)
    return readers.read_weather_json(spark, path)


@query("src_parquet_projected", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45")
def q_src_parquet_projected(spark, sf_dir):
    return readers.read_parquet_projected(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity"],
                                          F.col("l_quantity") > 45)


ENFORCE_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                               T.StructField("o_totalprice", T.DoubleType()),
                               T.StructField("o_orderdate", T.TimestampNTZType()),
                               T.StructField("o_comment", T.StringType())])


@query("schema_enforce", """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END
  AS o_totalprice, o_orderdate, CAST(NULL AS VARCHAR) AS o_comment FROM orders""")
def q_schema_enforce(spark, sf_dir):
    """Raw text columns (one unparseable price in 97, an extra column, a
    missing one) coerced back to the declared schema."""
    o = TBL(spark, sf_dir, "orders")
    raw = o.select(F.col("o_orderkey").cast("string").alias("O_ORDERKEY"), F.col("o_custkey").cast("string"),
                   F.when(F.col("o_orderkey") % 97 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
                   .alias("o_totalprice"), F.col("o_orderdate").cast("string"), F.lit("x").alias("junk"))
    out, _missing, _extra = readers.enforce(raw, ENFORCE_SCHEMA)
    return out


@query("schema_downcast", """SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey,
  CAST(l_quantity AS FLOAT) AS l_quantity, CAST(l_extendedprice AS FLOAT) AS l_extendedprice, l_returnflag FROM lineitem""")
def q_schema_downcast(spark, sf_dir):
    li = TBL(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
                                               "l_returnflag")
    return readers.downcast(li)


@query("sink_parquet", G("SELECT * FROM g_grid"))
def q_sink_parquet(spark, sf_dir):
    return sinks.write_parquet(grid(spark, sf_dir), scratch_path(spark, "grid-export"),
                               sort_by=["station_id", "date_hour"], max_records_per_file=100_000)


@query("sink_month_partition", G("SELECT * FROM g_grid"))
def q_sink_month_partition(spark, sf_dir):
    g = grid(spark, sf_dir)
    back = sinks.write_month_partitions(g, scratch_path(spark, "grid-months"), "date_hour")
    return back.select(*flow.GRID_COLUMNS)


@query("sink_csv", with_adapters(S.WEATHER + "\nSELECT * FROM w_clean"))
def q_sink_csv(spark, sf_dir):
    return sinks.write_csv(weather_hourly(spark, sf_dir), scratch_path(spark, "weather-csv"))


@query("table_full_refresh", with_adapters(S.VALID_TRIPS + "\nSELECT * FROM c_st"))
def q_table_full_refresh(spark, sf_dir):
    st = clean.filter_complete_rows(_stations_complete(spark, sf_dir), clean.STATION_REQUIRED)
    path = scratch_path(spark, "dim-stations")
    sinks.full_refresh(st.limit(0), "fg_dim_stations", path)  # first load
    return sinks.full_refresh(st, "fg_dim_stations", path)      # refresh replaces it


HISTORY_SCHEMA = T.StructType([
    T.StructField("station_id", T.StringType()), T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()), T.StructField("day", T.IntegerType()),
    T.StructField("hour", T.LongType()), T.StructField("temp", T.FloatType()),
    T.StructField("precipitation_total", T.FloatType()), T.StructField("relative_humidity", T.FloatType()),
    T.StructField("average_wind_speed", T.FloatType()),
    *[T.StructField(c, T.DoubleType()) for c in ["num_bikes_taken_lag_1", "num_bikes_dropped_lag_1",
                                                 "net_flow_lag_1", "net_flow_lag_2", "net_flow_lag_24",
                                                 "net_flow_roll_3", "net_flow_roll_24"]],
    T.StructField("jour_semaine", T.StringType()), T.StructField("coco_group", T.StringType()),
    T.StructField("is_holiday", T.BooleanType()), T.StructField("coco", T.LongType()),
    T.StructField("net_flow", T.LongType())])
HISTORY_SQL = """SELECT station_id, year, month, day, CAST(hour AS BIGINT) AS hour, CAST(temp AS FLOAT) AS temp,
  CAST(precipitation_total AS FLOAT) AS precipitation_total, CAST(relative_humidity AS FLOAT) AS relative_humidity,
  CAST(average_wind_speed AS FLOAT) AS average_wind_speed, CAST(num_bikes_taken_lag_1 AS DOUBLE) AS num_bikes_taken_lag_1,
  CAST(num_bikes_dropped_lag_1 AS DOUBLE) AS num_bikes_dropped_lag_1, CAST(net_flow_lag_1 AS DOUBLE) AS net_flow_lag_1,
  CAST(net_flow_lag_2 AS DOUBLE) AS net_flow_lag_2, CAST(net_flow_lag_24 AS DOUBLE) AS net_flow_lag_24,
  net_flow_roll_3, net_flow_roll_24, jour_semaine, coco_group, is_holiday, CAST(coco AS BIGINT) AS coco, net_flow
FROM g_grid"""


def history(spark, sf_dir) -> DataFrame:
    g = grid(spark, sf_dir)
    out, _, _ = readers.enforce(g, HISTORY_SCHEMA)
    return out


@query("import_history", G(HISTORY_SQL))
def q_import_history(spark, sf_dir):
    """Prepared history file (Parquet with looser types and an extra column)
    -> declared columns and types -> table refresh."""
    path = scratch_path(spark, "history-file")
    grid(spark, sf_dir).withColumn("extra_col", F.lit(1)).write.parquet(path)
    typed, _missing, _extra = readers.enforce(spark.read.parquet(path), HISTORY_SCHEMA)
    return sinks.full_refresh(typed, "fg_historical_data", scratch_path(spark, "history-table"))


HKEYS = ["station_id", "year", "month", "day", "hour"]


@query("insert_ignore", G(f"""h AS ({HISTORY_SQL}),
tgt AS (SELECT * FROM h WHERE day <= 12),
bat AS (SELECT * FROM h WHERE day >= 10
        UNION ALL SELECT * REPLACE (CAST(temp + 1 AS FLOAT) AS temp) FROM h WHERE day >= 10),
bd AS (SELECT * FROM bat QUALIFY row_number() OVER (PARTITION BY station_id, year, month, day, hour ORDER BY temp) = 1)
SELECT * FROM tgt UNION ALL
SELECT * FROM bd WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.station_id = bd.station_id AND tgt.year = bd.year
  AND tgt.month = bd.month AND tgt.day = bd.day AND tgt.hour = bd.hour)"""))
def q_insert_ignore(spark, sf_dir):
    """History rows of days <= 12 exist; a batch of the days from 10 on (each
    key twice, the copy with a higher temperature) is inserted: existing keys
    win, inside the batch the smallest row wins."""
    h = history(spark, sf_dir)
    tgt_path = scratch_path(spark, "history-target")
    h.where("day <= 12").write.parquet(tgt_path)
    b = h.where("day >= 10")
    batch = b.unionByName(b.withColumn("temp", (F.col("temp") + 1).cast("float")))
    return sinks.insert_ignore(tgt_path, batch, HKEYS)


BY_PERIOD_SQL = """WITH o AS (SELECT o_orderkey, o_orderdate, o_totalprice,
  datediff('month', TIMESTAMP '1995-02-20 00:00:00', o_orderdate) AS n FROM orders
  WHERE o_orderdate > TIMESTAMP '1995-02-20 00:00:00' AND o_orderdate < TIMESTAMP '2001-01-01 00:00:00')
SELECT o_orderkey, o_orderdate, o_totalprice, strftime(TIMESTAMP '1995-02-20 00:00:00' + to_months(CAST(
  CASE WHEN day(o_orderdate) < 20 THEN n - 1 ELSE n END AS INTEGER)), '%Y-%m-%d') AS period FROM o"""


@query("insert_by_period", BY_PERIOD_SQL)
def q_insert_by_period(spark, sf_dir):
    """Months counted from 1995-02-20: one load up to 1998, then the backfill
    resumes after its newest timestamp and appends every further month up to
    the stop date in one pass."""
    o = TBL(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    path, start = scratch_path(spark, "orders-by-period"), "1995-02-20 00:00:00"
    sinks.backfill_by_period(o, path, "o_orderdate", "1998-01-01 00:00:00", "month", start=start)
    sinks.backfill_by_period(o, path, "o_orderdate", "2001-01-01 00:00:00", "month", start=start)
    schema = "o_orderkey long, o_orderdate timestamp_ntz, o_totalprice double, period string"
    return spark.read.schema(schema).parquet(path)


@query("insert_by_period_rewrite", BY_PERIOD_SQL)
def q_insert_by_period_rewrite(spark, sf_dir):
    """The same months after a load that stopped in the middle of one and a
    repeated load: every touched month is replaced as a whole."""
    o = TBL(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    path, start = scratch_path(spark, "orders-rewritten"), "1995-02-20 00:00:00"
    sinks.rewrite_periods(o.where(F.col("o_orderkey") % 2 == 0), path, "o_orderdate", "1995-03-05 00:00:00", "month", start=start)
    sinks.rewrite_periods(o, path, "o_orderdate", "1998-01-01 00:00:00", "month", start=start)
    return sinks.rewrite_periods(o, path, "o_orderdate", "2001-01-01 00:00:00", "month", start=start)


@query("append_evolving", G("""r AS (SELECT md5(station_id || '|' || strftime(date_hour, '%Y-%m-%d %H:%M:%S')) AS run_id,
  station_id, date_hour AS request_datetime, hour, coalesce(net_flow_roll_24, 0) AS prediction, month,
  """ + PERIOD_SQL + """ AS period FROM g_grid)
SELECT run_id, station_id, request_datetime, hour, prediction, month, CAST(NULL AS INTEGER) AS model_version
FROM r WHERE period = 'reference'
UNION ALL SELECT run_id, station_id, request_datetime, hour, prediction, CAST(NULL AS INTEGER), 2 FROM r
WHERE period = 'current'"""))
def q_append_evolving(spark, sf_dir):
    """The log gains a column (model_version) and the new batch lacks one
    (month): additive evolution, read back with mergeSchema."""
    p = predictions(spark, sf_dir)
    path = scratch_path(spark, "prediction-log")
    p.where("period = 'reference'").select("run_id", "station_id", "request_datetime", "hour", "prediction",
                                           "month").write.parquet(path)
    batch = p.where("period = 'current'").select("run_id", "station_id", "request_datetime", "hour", "prediction",
                                                 F.lit(2).alias("model_version"))
    out, _missing, _extra = sinks.append_evolving(path, batch)
    return out.select("run_id", "station_id", "request_datetime", "hour", "prediction", "month", "model_version")


@query("slice_previous_month", G("SELECT * FROM g_grid WHERE year = 2024 AND month = 1 ORDER BY station_id, date_hour"))
def q_slice_previous_month(spark, sf_dir):
    """The (year, month) before ``as_of`` = 2024-02-01 (year and month, not
    month alone), written sorted as the drift reference."""
    as_of_year, as_of_month = 2024, 2
    y, m = (as_of_year, as_of_month - 1) if as_of_month > 1 else (as_of_year - 1, 12)
    g = grid(spark, sf_dir).where((F.col("year") == y) & (F.col("month") == m))
    return sinks.write_parquet(g, scratch_path(spark, "reference-month"), sort_by=["station_id", "date_hour"]) \
        .orderBy("station_id", "date_hour")


PRED_IMPORT_SQL = """p AS (SELECT md5(station_id || '|' || strftime(date_hour, '%Y-%m-%d %H:%M:%S')) AS run_id, station_id,
  date_hour AS request_datetime, hour, coalesce(net_flow_roll_24, 0) AS prediction,
  CASE WHEN hour % 2 = 0 THEN 2 ELSE 1 END AS model_version FROM g_grid),
cut AS (SELECT max(request_datetime) AS t FROM p),
tgt AS (SELECT p.* FROM p, cut WHERE request_datetime <= t - INTERVAL 12 HOUR),
win AS (SELECT p.* FROM p, cut WHERE request_datetime > t - INTERVAL 24 HOUR AND request_datetime <= t),
newest AS (SELECT * FROM win WHERE model_version = (SELECT max(model_version) FROM win)),
typed AS (SELECT run_id, station_id, request_datetime, hour, prediction, model_version,
  CAST(month(request_datetime) AS INTEGER) AS month,
  CASE dayofweek(request_datetime) WHEN 0 THEN 'Dimanche' WHEN 1 THEN 'Lundi' WHEN 2 THEN 'Mardi' WHEN 3 THEN 'Mercredi'
       WHEN 4 THEN 'Jeudi' WHEN 5 THEN 'Vendredi' WHEN 6 THEN 'Samedi' END AS jour_semaine FROM newest),
tgt_typed AS (SELECT run_id, station_id, request_datetime, hour, prediction, model_version,
  CAST(month(request_datetime) AS INTEGER) AS month,
  CASE dayofweek(request_datetime) WHEN 0 THEN 'Dimanche' WHEN 1 THEN 'Lundi' WHEN 2 THEN 'Mardi' WHEN 3 THEN 'Mercredi'
       WHEN 4 THEN 'Jeudi' WHEN 5 THEN 'Vendredi' WHEN 6 THEN 'Samedi' END AS jour_semaine FROM tgt)
SELECT * FROM tgt_typed UNION ALL
SELECT * FROM typed WHERE run_id NOT IN (SELECT run_id FROM tgt_typed)"""


@query("predictions_import", G(PRED_IMPORT_SQL))
def q_predictions_import(spark, sf_dir):
    """Keep the newest model version's predictions of the 24 h before
    ``as_of`` (= newest logged request), derive month and weekday name, and
    insert-ignore them by run id into the prediction table."""
    from flowgrid.functions.columns import weekday_label
    p = predictions(spark, sf_dir).select(
        "run_id", "station_id", "request_datetime", "hour", "prediction",
        F.when(F.col("hour") % 2 == 0, 2).otherwise(1).alias("model_version"))
    t = p.agg(F.max("request_datetime").alias("t")).first()["t"]
    lit_t = ntz_lit(t)
    typed = lambda d: d.withColumns({"month": F.month("request_datetime"),
                                     "jour_semaine": weekday_label("request_datetime")})
    tgt = typed(p.where(F.col("request_datetime") <= F.timestamp_add("HOUR", F.lit(-12), lit_t)))
    win = p.where((F.col("request_datetime") > F.timestamp_add("HOUR", F.lit(-24), lit_t))
                  & (F.col("request_datetime") <= lit_t))
    top = win.agg(F.max("model_version")).first()[0]
    batch = typed(win.where(F.col("model_version") == top))
    tgt_path = scratch_path(spark, "predictions-table")
    tgt.write.parquet(tgt_path)
    return sinks.insert_ignore(tgt_path, batch.select(*tgt.columns), ["run_id"])


# --------------------------------------------------------------------------- request-side joins

REQ_SQL = f"""rq AS (SELECT event_id AS request_id, {S.norm_sql("CAST(100 + " + sql_station_index("event_id") + " AS VARCHAR) || '.1'")} AS station_id,
  date_trunc('hour', ts) AS date_hour, CASE WHEN event_id % 2 = 0 THEN 'take' ELSE 'drop' END AS action
  FROM events),
st AS (SELECT short_name, station_id AS feed_station_id, capacity, CAST(id % 7 AS INTEGER) AS num_bikes_available,
  CAST(capacity - id % 7 AS INTEGER) AS num_docks_available FROM a_stations)"""


def requests(spark, sf_dir) -> DataFrame:
    """Every event is a forecast request for its station and hour (even ids
    ask to take a bike, odd ids to drop one)."""
    e = TBL(spark, sf_dir, "events")
    sid = normalize_station_id(F.concat((F.lit(100) + station_index(F.col("event_id"), n_stations(e))).cast("string"), F.lit(".1")))
    return e.select(F.col("event_id").alias("request_id"), sid.alias("station_id"), hour_floor("ts").alias("date_hour"),
                    F.when(F.col("event_id") % 2 == 0, F.lit("take")).otherwise(F.lit("drop")).alias("action"))


def availability(spark, sf_dir) -> DataFrame:
    st = status(spark, sf_dir).select(F.col("short_name").alias("station_id"),
                                      F.col("station_id").alias("feed_station_id"),
                                      "num_bikes_available", "num_docks_available")
    return requests(spark, sf_dir).join(bounded_broadcast(st), "station_id", "left")  # one row per station


@query("lookup_availability", with_adapters(REQ_SQL + """
SELECT rq.request_id, rq.station_id, st.feed_station_id, st.num_bikes_available, st.num_docks_available
FROM rq LEFT JOIN st ON rq.station_id = st.short_name"""))
def q_lookup_availability(spark, sf_dir):
    return availability(spark, sf_dir).select("request_id", "station_id", "feed_station_id", "num_bikes_available",
                                              "num_docks_available")


def decision(action, bikes, docks, pred):
    """Batch form of the take/drop advice table (3 outcomes per action)."""
    take = (F.when(bikes.isNull() | (bikes == 0), F.lit("no_bikes"))
            .when(pred < 0, F.lit("bikes_leaving_hurry")).otherwise(F.lit("bikes_arriving")))
    drop = (F.when(docks.isNull() | (docks == 0), F.lit("no_docks"))
            .when(pred > 0, F.lit("bikes_arriving_hurry")).otherwise(F.lit("good_time_to_drop")))
    return F.when(action == "take", take).otherwise(drop)


@query("recommend_action", G(REQ_SQL + """
SELECT rq.request_id, rq.action, coalesce(g.net_flow_roll_24, 0) AS predicted_flow,
  CASE WHEN rq.action = 'take' THEN
         CASE WHEN st.num_bikes_available IS NULL OR st.num_bikes_available = 0 THEN 'no_bikes'
              WHEN coalesce(g.net_flow_roll_24, 0) < 0 THEN 'bikes_leaving_hurry' ELSE 'bikes_arriving' END
       ELSE CASE WHEN st.num_docks_available IS NULL OR st.num_docks_available = 0 THEN 'no_docks'
              WHEN coalesce(g.net_flow_roll_24, 0) > 0 THEN 'bikes_arriving_hurry' ELSE 'good_time_to_drop' END END
  AS recommendation
FROM rq LEFT JOIN st ON rq.station_id = st.short_name
LEFT JOIN g_grid g ON g.station_id = rq.station_id AND g.date_hour = rq.date_hour"""))
def q_recommend_action(spark, sf_dir):
    a = availability(spark, sf_dir)
    g = grid(spark, sf_dir).select("station_id", "date_hour", F.coalesce("net_flow_roll_24", F.lit(0.0)).alias("pf"))
    j = a.join(shuffled(g), ["station_id", "date_hour"], "left")
    pred = F.coalesce(F.col("pf"), F.lit(0.0))
    return j.select("request_id", "action", pred.alias("predicted_flow"),
                    decision(F.col("action"), F.col("num_bikes_available"), F.col("num_docks_available"), pred)
                    .alias("recommendation"))
