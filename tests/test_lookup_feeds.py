"""Analog-row table, aggregate dedup and split feed documents (hand-made frames)."""

import datetime as dt

from pyspark.sql import functions as F

from flowgrid.operators import flow
from flowgrid.plans import q_io, q_learn
from flowgrid.sources import readers

LAGS = q_learn.ANALOG_LAGS


def _grid(spark, rows):
    data = [(s, wd, m, t, t.hour, *([float(v)] * len(LAGS))) for s, wd, m, t, v in rows]
    cols = "station_id string, jour_semaine string, month int, date_hour timestamp_ntz, hour int, " + \
        ", ".join(f"{c} double" for c in LAGS)
    return spark.createDataFrame(data, cols)


def test_analog_table_nearest_earlier_hour_then_latest(spark):
    t = dt.datetime
    g = _grid(spark, [
        ("A", "Lundi", 1, t(2024, 1, 1, 8), 1), ("A", "Lundi", 1, t(2024, 1, 8, 8), 2),   # hour 8, two days
        ("A", "Lundi", 1, t(2024, 1, 1, 12), 3),                                         # hour 12
        ("A", "Lundi", 1, t(2024, 1, 15, 5), 4),                                         # hour 5, latest day
    ])
    got = {r["hour"]: (r["_b"]["analog_time"], r["_b"]["net_flow_lag_1"])
           for r in q_learn.analog_table(g).collect()}
    assert sorted(got) == list(range(24))
    assert got[4] == (t(2024, 1, 15, 5), 4.0)    # nothing <= 4: latest row of the key
    assert got[5] == (t(2024, 1, 15, 5), 4.0)
    assert got[7] == (t(2024, 1, 15, 5), 4.0)
    assert got[8] == (t(2024, 1, 8, 8), 2.0)     # nearest hour 8, latest such day
    assert got[11] == (t(2024, 1, 8, 8), 2.0)
    assert got[12] == (t(2024, 1, 1, 12), 3.0)
    assert got[23] == (t(2024, 1, 1, 12), 3.0)
    par = {r["hour"]: r["_b"]["analog_time"] for r in q_learn.analog_table(g, parity=True).collect()}
    assert set(par.values()) == {t(2024, 1, 15, 5)}


def test_dedup_keep_best_matches_row_number_rule(spark):
    rows = [("s", 1, 5, 1, 4), ("s", 1, 5, 2, 3), ("s", 1, 2, 9, 7), ("s", 2, None, 1, 1), ("s", 2, 0, 0, 0)]
    rows += [("hot", 3, i % 7, i, i % 5) for i in range(3000)]  # one key with many rows
    df = spark.createDataFrame(rows, "station_id string, date_hour int, net_flow int, num_bikes_taken int, "
                                     "num_bikes_dropped int")
    got = {(r[0], r[1]): tuple(r) for r in flow.dedup_keep_best(df).collect()}
    assert got[("s", 1)] == ("s", 1, 5, 2, 3)        # highest net_flow, then highest other columns
    assert got[("s", 2)] == ("s", 2, 0, 0, 0)        # null net_flow loses
    assert got[("hot", 3)] == ("hot", 3, 6, 2995, 0)
    assert flow.dedup_keep_best(df).columns == df.columns


def test_feed_documents_split_and_read_back(spark, tmp_path):
    n = 25_000
    st = spark.range(n).select(F.format_string("st-%d", "id").alias("station_id"),
                               F.col("id").cast("string").alias("short_name"), F.lit("x").alias("name"),
                               F.lit(10).alias("capacity"), F.lit(40.7).alias("lat"), F.lit(-74.0).alias("lon"))
    docs = q_io.feed_documents(st, F.struct(*readers.STATION_FIELDS))
    sizes = [r[0] for r in docs.select(F.size("data.stations")).collect()]
    assert len(sizes) == 3 and sum(sizes) == n and max(sizes) < n  # no document holds the whole dimension
    path = str(tmp_path / "feed")
    docs.write.json(path)
    back = readers.read_stations(spark, path, multi_line=False)
    assert back.count() == n and back.select("station_id").distinct().count() == n


def test_dense_index_modes(spark):
    t = dt.datetime
    net = spark.createDataFrame([("A", t(2024, 3, 1, 5)), ("B", t(2024, 3, 2, 7)), ("A", t(2024, 3, 2, 1))],
                                "station_id string, date_hour timestamp_ntz")
    span = flow.dense_index(net, "hour_span")
    assert span.count() == 2 * 27  # 03-01 05:00 .. 03-02 07:00
    assert {r.date_hour for r in span.where("station_id = 'B'").collect()} == \
        {t(2024, 3, 1, 5) + dt.timedelta(hours=i) for i in range(27)}
    days = flow.dense_index(net, "day_x_24")
    assert days.count() == 2 * 48 and days.agg(F.max("date_hour")).first()[0] == t(2024, 3, 2, 23)
    assert flow.dense_index(net.where("false"), "hour_span").count() == 0


def test_left_grid_fill_edges(spark):
    t = dt.datetime
    index = spark.createDataFrame([("A", t(2024, 1, 1, h)) for h in range(3)], "station_id string, date_hour timestamp_ntz")
    net = spark.createDataFrame([("A", t(2024, 1, 1, 1), 3, 1, 2), ("A", t(2024, 1, 1, 2), None, 2, None),
                                 ("Z", t(2024, 1, 1, 1), 9, 9, 0)],
                                "station_id string, date_hour timestamp_ntz, num_bikes_taken long, "
                                "num_bikes_dropped long, net_flow long")
    got = sorted(tuple(r) for r in flow.left_grid_fill(index, net).collect())
    assert got == [("A", t(2024, 1, 1, 0), 0, 0, 0, 0), ("A", t(2024, 1, 1, 1), 1, 3, 1, 2),
                   ("A", t(2024, 1, 1, 2), 2, 0, 2, 0)]
