"""The skew-safe ordered helpers must equal their single-partition forms,
also when one key holds a third of all rows."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowgrid.operators import scan, series, windows


def _skewed(spark, n=3000):
    rnd = random.Random(7)
    data = [(i, 0 if i % 3 == 0 else rnd.randint(1, 40), rnd.random() * 100) for i in range(n)]
    return spark.createDataFrame(data, "id long, k long, v double")


def test_lead_in_order_matches_window_with_hot_key(spark):
    df = _skewed(spark)
    fast = scan.lead_in_order(df, by=["k"], order=["v", "id"], cols={"id": "nid", "v": "nv"}, n=8)
    w = Window.partitionBy("k").orderBy("v", "id")
    ref = df.withColumns({"nid": F.lead("id").over(w), "nv": F.lead("v").over(w)})
    a = fast.toPandas().sort_values("id").reset_index(drop=True)
    b = ref.toPandas().sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(a[["id", "nid", "nv"]], b[["id", "nid", "nv"]], check_dtype=False)


def test_lead_in_order_null_keys(spark):
    rows = [(i, None if i % 3 == 0 else i % 5, None if i % 7 == 0 else f"t{i % 4}") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, k long, t string")
    w = Window.partitionBy("k", "t").orderBy("id")
    want = {r.id: r.nid for r in df.withColumn("nid", F.lead("id").over(w)).collect()}
    got = {r.id: r.nid for r in scan.lead_in_order(df, by=["k", "t"], order=["id"], cols={"id": "nid"}, n=9).collect()}
    assert got == want


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, k long, v double")
    assert scan.lead_in_order(df, ["k"], ["id"], {"v": "nv"}).count() == 0
    assert scan.prefix_scan(df, ["id"], "v").count() == 0
    assert scan.exact_quantiles(df, "v", [0.5]) == [None]


def test_lead_in_order_global(spark):
    df = spark.range(0, 500).select((F.col("id") * 3).alias("x"))
    out = scan.lead_in_order(df, by=[], order=["x"], cols={"x": "nx"}, n=7).toPandas().sort_values("x")
    assert (out["nx"].iloc[:-1].to_numpy() == out["x"].iloc[1:].to_numpy()).all()
    assert pd.isna(out["nx"].iloc[-1])


def test_exact_quantiles_match_numpy_with_duplicates_over_partitions(spark):
    rnd = np.random.default_rng(3)
    vals = np.concatenate([rnd.normal(size=4000), np.zeros(2000)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.01, 0.25, 0.5, 0.99]
    got = scan.exact_quantiles(df, "x", probs, n=16)
    want = np.quantile(vals, probs)  # linear interpolation = percentile_cont
    assert np.allclose(got, want, rtol=0, atol=1e-12)


def test_prefix_scan_matches_cumsum(spark):
    rnd = np.random.default_rng(5)
    vals = rnd.normal(size=2000)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i long, v double")
    out = scan.prefix_scan(df, ["i"], "v", n=8).toPandas().sort_values("i")
    cum = np.cumsum(vals)
    assert np.allclose(out["_cum"], cum)
    assert np.allclose(out["_cummin"], np.minimum.accumulate(cum))
    assert (out["_idx"].to_numpy() == np.arange(2000)).all()


def test_forward_fill_global_matches_pandas(spark):
    vals = [None if i % 4 else float(i) for i in range(400)]
    vals[0] = None
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, v double")
    out = windows.forward_fill_global(df, ["i"], ["v"]).toPandas().sort_values("i")
    want = pd.Series(vals, dtype="float64").ffill()
    assert np.allclose(out["v"].fillna(-1), want.fillna(-1))


def test_page_hinkley_matches_loop(spark):
    rnd = np.random.default_rng(11)
    r = np.concatenate([rnd.normal(0, 1, 300), rnd.normal(2, 1, 300)])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(r)], "i long, r double")
    got = windows.first_alarm(windows.page_hinkley(df, "r", ["i"], 0.0, 0.5, 10.0)).first()
    s, m, alarm = 0.0, 0.0, -1
    for i, x in enumerate(r):
        s += x - 0.0 - 0.5
        m = min(m, s)
        if s - m > 10.0:
            alarm = i
            break
    assert got.first_alarm_idx == alarm


def test_date_spine_excludes_exact_end(spark):
    out = series.date_spine(spark, "day", "2018-01-01", "2018-01-10", out="d")
    ds = sorted(r.d for r in out.collect())
    assert len(ds) == 9 and ds[-1] == dt.datetime(2018, 1, 9)


def test_generate_series(spark):
    assert [r[0] for r in series.generate_series(spark, 10).orderBy("generated_number").collect()] == list(range(1, 11))


def test_holiday_calendar_rules(spark):
    yrs = spark.createDataFrame([(2021,), (2024,)], "year int")
    got = {r.date for r in series.holiday_calendar(yrs).collect()}
    for d in [dt.date(2024, 1, 1), dt.date(2024, 1, 15), dt.date(2024, 2, 19), dt.date(2024, 5, 27),
              dt.date(2024, 6, 19), dt.date(2024, 7, 4), dt.date(2024, 9, 2), dt.date(2024, 10, 14),
              dt.date(2024, 11, 11), dt.date(2024, 11, 28), dt.date(2024, 12, 25),
              dt.date(2021, 7, 5), dt.date(2021, 12, 24), dt.date(2021, 6, 18)]:
        assert d in got, d


def test_asof_backward_takes_latest_at_or_before(spark):
    left = spark.createDataFrame([(dt.datetime(2024, 1, 1, h),) for h in range(5)], "t timestamp_ntz")
    right = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0), 1.0), (dt.datetime(2024, 1, 1, 2), 2.0)],
                                  "t timestamp_ntz, x double")
    got = sorted((r.t.hour, r.x) for r in series.asof_backward(left, right, "t").collect())
    assert got == [(0, 1.0), (1, 1.0), (2, 2.0), (3, 2.0), (4, 2.0)]


def test_asof_scan_equals_window(spark):
    rnd = random.Random(3)
    left = spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i), i) for i in range(300)],
                                 "t timestamp_ntz, li long")
    right = spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 2100)), float(i))
                                   for i in range(80)], "t timestamp_ntz, x double").dropDuplicates(["t"])
    a = series.asof_backward(left, right, "t", global_order="scan").toPandas().sort_values("li").reset_index(drop=True)
    b = series.asof_backward(left, right, "t", global_order="window").toPandas().sort_values("li").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)


def test_grouped_percentiles_hot_group(spark):
    rnd = np.random.default_rng(9)
    g = np.where(np.arange(3000) % 3 == 0, 0, rnd.integers(1, 6, 3000))
    v = np.round(rnd.normal(size=3000), 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, v)], "g long, v double")
    out = {r.g: r for r in scan.grouped_percentiles(df, ["g"], "v", [0.1, 0.5, 0.9], ["a", "b", "c"]).collect()}
    for key in np.unique(g):
        want = np.quantile(v[g == key], [0.1, 0.5, 0.9])
        got = [out[int(key)].a, out[int(key)].b, out[int(key)].c]
        assert np.allclose(got, want, atol=1e-12), key


def test_forward_fill_by_matches_window_with_hot_key(spark):
    from pyspark.sql import Window
    from flowgrid.operators.windows import forward_fill_by
    rows = []
    for i in range(6000):  # key "hot" holds about a third of the rows
        k = "hot" if i % 3 == 0 else f"k{i % 37}"
        v = None if (i % 5 and i % 7) else float(i)  # long runs of nulls
        rows.append((k, i, v, None if i % 11 else i))
    rows.append((None, 1, None, 4))
    rows.append((None, 2, 5.0, None))
    df = spark.createDataFrame(rows, "k string, t int, v double, w int").repartition(7)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    def nk(t):
        return tuple((x is None, x) for x in t)
    want = sorted((tuple(r) for r in df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in ["v", "w"]})
                   .collect()), key=nk)
    got = forward_fill_by(df, ["k"], ["t"], ["v", "w"])
    assert got.columns == df.columns
    assert sorted((tuple(r) for r in got.collect()), key=nk) == want


def test_asof_backward_by_key_matches_window(spark):
    from flowgrid.operators.series import asof_backward
    left = spark.createDataFrame([(k, t) for k in ["a", "b", "hot"] for t in range(0, 600, 3)], "k string, t int")
    right = spark.createDataFrame([("hot", t, float(t)) for t in range(1, 600, 2)] + [("a", 10, 1.0), ("a", 99, 2.0)],
                                  "k string, t int, x double")
    scan = asof_backward(left, right, "t", by=["k"])
    win = asof_backward(left, right, "t", by=["k"], global_order="window")
    assert sorted(tuple(r) for r in scan.collect()) == sorted(tuple(r) for r in win.collect())
    got = {(r.k, r.t): r.x for r in scan.collect()}
    assert got[("a", 9)] is None and got[("a", 12)] == 1.0 and got[("a", 99)] == 2.0 and got[("hot", 6)] == 5.0
