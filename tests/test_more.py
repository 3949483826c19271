"""Drift over many columns, rankings, history tail, limited listagg, failure counts."""

import random

import numpy as np
from pyspark.sql import functions as F

from flowgrid.operators import drift, learn, profile, quality, reshape, windows


def test_column_drift_matches_single_tests(spark):
    rnd = random.Random(4)
    rows = [("a" if i % 3 else "b", rnd.gauss(0, 1) + (0 if i % 3 else 0.3), float(rnd.randrange(4)), rnd.choice("xyz") if i % 3 else rnd.choice("xxz"),
             None if i % 11 == 0 else rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "s string, v double, w double, c string, u double")
    got = {r.column_name: r for r in drift.column_drift(df, ["v", "w", "u"], ["c"], "s", "a", "b").collect()}
    for c in ("v", "w", "u"):
        one = drift.ks_two_sample(df, c, "s", "a", "b").first()
        assert abs(got[c].stat - one.d_stat) < 1e-8 and abs(got[c].p_value - one.p_value) < 1e-5 and got[c].drift == one.drift
    assert got["v"].drift
    share = {s: np.array([sum(r[0] == s and r[3] == k for r in rows) for k in "xyz"], float) for s in "ab"}
    p, q = (x / x.sum() for x in share.values())
    m = (p + q) / 2
    js = np.sqrt(sum(x * np.log(x / y) for a in (p, q) for x, y in zip(a, m) if x > 0) / 2)
    assert abs(got["c"].stat - js) < 1e-12 and got["c"].drift == (js >= drift.JS_THRESHOLD)
    assert drift.column_drift(df.where("s = 'a'"), ["v"], ["c"], "s", "a", "b").count() == 0


def test_decisions_use_exact_values(spark):
    df = spark.createDataFrame([(1e9 + i, 1e9 + i + 1e-3) for i in range(50)], "y double, p double")
    a, p = df.select(F.lit(1).alias("k"), "y"), df.select(F.lit(1).alias("k"), "p")
    pairs = a.join(p, "k")
    want, got = drift.regression_metrics(pairs, "y", "p").first(), drift.fanout_metrics(a, p, ["k"], "y", "p").first()
    assert abs(got.rmse - want.rmse) < 1e-6 * want.rmse and abs(got.mae - want.mae) < 1e-6 * want.mae


def test_rankings(spark):
    df = spark.createDataFrame([("a", 5), ("a", 1), ("b", 4), ("c", 6), ("c", 0), ("d", None)], "k string, n int")
    got = {(r.ranking, r.rank): r.k for r in profile.rankings(df, "k", {"n": F.col("n"), "minus": -F.col("n")}, 2).collect()}
    assert got[("total_n", 1)] == "a" and got[("total_n", 2)] == "c" and got[("mean_n", 1)] == "b" and got[("mean_n", 2)] == "a"
    assert got[("total_minus", 1)] == "b" and len(got) == 8


def test_history_tail_gives_the_first_rows_their_past(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("s"), F.col("id").alias("t"), (F.col("id") * 3).alias("x"))

    def lagged(d):
        return windows.add_lags(d, "x", [1, 5], ["s"], ["t"])
    whole = lagged(df).where("t >= 60")
    got = windows.with_history_tail(df.where("t >= 60"), df.where("t < 60"), ["s"], ["t"], 5, lagged)
    assert got.count() == 40 and got.exceptAll(whole.select(*got.columns)).count() == 0


def test_listagg_limit_collects_the_first_only(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (1, None, 0), (1, "c", 3), (None, "x", 1), (2, None, 1)], "g int, v string, o int")
    got = {r.g: r.l for r in reshape.listagg(df, ["g"], "v", "-", ["o"], limit_num=2, out="l").collect()}
    assert got == {1: "a-b", None: "x", 2: ""}


def test_equality_failures(spark):
    a, b = spark.range(0, 10), spark.range(4, 11)
    assert tuple(quality.equality_failures(a, b).first()) == (4, 1, 8)


def test_most_frequent_value_and_median_in_one_pass(spark):
    df = spark.createDataFrame([(1.0, "b", True), (2.0, "a", False), (None, "b", False), (9.0, "a", None)], "x double, c string, f boolean")
    assert learn.impute_values(df, ["x"], ["c", "f"]) == {"x": 2.0, "c": "a", "f": False}


def test_histogram_box(spark):
    df = spark.range(1, 102).select(F.col("id").cast("double").alias("v"))
    rows = profile.histogram_box(df, ["v"], 10).collect()
    assert sum(r.n for r in rows) == 101
    assert {(r["min"], r.p25, r.p50, r.p75, r["max"]) for r in rows} == {(1.0, 26.0, 51.0, 76.0, 101.0)}
