"""Data-quality semantics, sink semantics and monitoring statistics."""

import datetime as dt
import math
import tempfile

import numpy as np
from pyspark.sql import functions as F

from flowgrid.operators import drift
from flowgrid.operators import quality as Q
from flowgrid.operators import windows
from flowgrid.sources import sinks


def _ranges(spark, rows):
    return spark.createDataFrame(rows, "p string, lo int, hi int")


def test_mutually_exclusive_ranges_gap_modes(spark):
    df = _ranges(spark, [("a", 0, 5), ("a", 5, 10), ("a", 12, 20), ("b", 0, 5), ("b", 3, 8), ("c", 4, 4), ("c", 6, None)])
    allowed = windows.range_violations(df, "lo", "hi", ["p"], gaps="allowed")
    assert sorted((r.p, r.lo) for r in allowed.collect()) == [("b", 0), ("c", 4), ("c", 6)]
    not_allowed = windows.range_violations(df, "lo", "hi", ["p"], gaps="not_allowed")
    assert ("a", 5) in {(r.p, r.lo) for r in not_allowed.collect()}  # gap 10 -> 12
    required = windows.range_violations(df, "lo", "hi", ["p"], gaps="required")
    assert ("a", 0) in {(r.p, r.lo) for r in required.collect()}  # 5 touches 5, no gap
    zero_ok = windows.range_violations(df, "lo", "hi", ["p"], gaps="allowed", zero_length_allowed=True)
    assert ("c", 4) not in {(r.p, r.lo) for r in zero_ok.collect()}
    # a null upper bound is a violation
    assert ("c", 6) in {(r.p, r.lo) for r in zero_ok.collect()}


def test_accepted_range_and_null_semantics(spark):
    df = spark.createDataFrame([(i,) for i in range(-1, 12)] + [(None,)], "id int")
    assert Q.accepted_range(df, "id", -1, 11).count() == 0
    assert Q.accepted_range(df, "id", -1, 11, inclusive=False).count() == 2
    assert Q.accepted_range(df, "id", min_value=0, where="id <> -1").count() == 0
    assert Q.accepted_values(df, "id", list(range(0, 12))).count() == 1  # -1; null passes


def test_not_null_proportion_and_at_least_one(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert Q.not_null_proportion(df, "x", 0.5).count() == 0
    assert Q.not_null_proportion(df, "x", 0.9).count() == 1
    assert Q.at_least_one(spark.createDataFrame([(None,)], "x int"), "x").count() == 1


def test_relationships_equality_rowcounts(spark):
    child = spark.createDataFrame([(1,), (2,), (4,), (None,)], "id int")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert [r[0] for r in Q.relationships_where(child, "id", parent, "id").collect()] == [4]
    assert Q.relationships_where(child, "id", parent, "id", from_condition="id <> 4").count() == 0
    eq = Q.equality(child.where("id is not null"), parent)
    assert sorted((r.id, r.which_diff) for r in eq.collect()) == [(3, "b_minus_a"), (4, "a_minus_b")]
    assert Q.equal_rowcount(child, parent).first().diff_count == 1
    assert Q.fewer_rows_than(parent, parent).first().row_count_delta == 1


def test_sequential_values_with_datepart(spark):
    ts = [dt.datetime(2024, 1, 1, h) for h in (0, 1, 2, 4)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    bad = Q.sequential_values(df, "t", 1, "hour").collect()
    assert [r.t.hour for r in bad] == [4]


def test_insert_ignore_existing_wins_batch_min_wins_null_keys_kept(spark):
    tgt = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a"), (None, "x"), (None, "y")], "k int, v string")
    path = tempfile.mkdtemp(prefix="fg-ii-") + "/t"
    tgt.write.parquet(path)
    out = sinks.insert_ignore(path, batch, ["k"])
    got = sorted(((r.k if r.k is not None else -1), r.v) for r in out.collect())
    assert got == [(-1, "x"), (-1, "y"), (1, "old"), (2, "a")]


def test_regression_metric_properties(spark):
    y = [1.0, 2.0, 3.0, 4.0]
    df = spark.createDataFrame([(a, a, 2.5, 5.0 - a) for a in y], "y double, perfect double, mean double, rev double")
    p = drift.regression_metrics(df, "y", "perfect").first()
    assert p.rmse == 0 and p.r2 == 1
    assert drift.regression_metrics(df, "y", "mean").first().r2 == 0
    r = drift.regression_metrics(df, "y", "rev").first()
    assert r.r2 < 0 and r.rmse >= r.mae


def test_student_t_p_values_against_tables():
    # two-sided p for t = 2.228, df = 10 is 0.05; t = 1.96, df = 1e6 is 0.05
    assert abs(drift.t_two_sided_p(2.228, 10) - 0.05) < 1e-3
    assert abs(drift.t_two_sided_p(1.959964, 1e6) - 0.05) < 1e-4
    assert abs(drift.t_two_sided_p(0.0, 5) - 1.0) < 1e-12


def test_ks_two_sample_against_direct(spark):
    rnd = np.random.default_rng(1)
    a, b = rnd.normal(0, 1, 400), rnd.normal(0.3, 1, 300)
    df = spark.createDataFrame([(float(x), "a") for x in a] + [(float(x), "b") for x in b], "v double, s string")
    got = drift.ks_two_sample(df, "v", "s", "a", "b").first()
    grid = np.sort(np.concatenate([a, b]))
    d = np.max(np.abs(np.searchsorted(np.sort(a), grid, "right") / 400 - np.searchsorted(np.sort(b), grid, "right") / 300))
    assert abs(got.d_stat - d) < 1e-9
    lam = d * math.sqrt(400 * 300 / 700)
    p = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert abs(got.p_value - min(1, max(0, p))) < 1e-6
    assert got.drift == (p < 0.05)


def test_welch_matches_formula(spark):
    rnd = np.random.default_rng(2)
    a, b = rnd.normal(0, 1, 50), rnd.normal(0.5, 2, 70)
    df = spark.createDataFrame([(float(x), "a") for x in a] + [(float(x), "b") for x in b], "v double, s string")
    got = drift.welch_t_test(df, "v", "s", "a", "b").first()
    va, vb = a.var(ddof=1) / 50, b.var(ddof=1) / 70
    t = (a.mean() - b.mean()) / math.sqrt(va + vb)
    assert abs(got.t_stat - t) < 1e-5
    assert 0 <= got.p_value <= 1


def test_dedup_by_agg_matches_row_number(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 5, "y"), (2, 1, "z"), (1, 5, "a")], "k int, o int, v string")
    got = sorted(tuple(r) for r in windows.deduplicate_by_agg(df, ["k"], ["o", "v"], descending=True).collect())
    assert got == [(1, 5, "y"), (2, 1, "z")]
    _ = F


def test_fanout_metrics_equal_pair_join(spark):
    import random
    from flowgrid.operators import drift as DR
    rnd = random.Random(3)
    act = [(f"k{rnd.randrange(12)}", rnd.randrange(-5, 6)) for _ in range(300)]
    pre = [(f"k{rnd.randrange(14)}", None if rnd.random() < 0.1 else rnd.choice([rnd.randrange(-5, 6) * 1.0,
                                                                               rnd.uniform(-5, 5)]))
           for _ in range(250)]
    a = spark.createDataFrame(act, "k string, y int")
    p = spark.createDataFrame(pre, "k string, p double")

    def both(a, p):
        pairs = a.join(p, "k").where("p IS NOT NULL")
        want = DR.regression_metrics(pairs, "y", "p").first()
        got = DR.fanout_metrics(a, p, ["k"], "y", "p").first()
        return want, got
    want, got = both(a, p)
    assert got.n == want.n > 0
    for c in ("rmse", "mae", "r2"):
        assert abs(got[c] - want[c]) < 1e-6, c
    want, got = both(a.withColumn("y", F.lit(2)), p)           # constant target: r2 is null
    assert got.r2 is None and want.r2 is None and abs(got.rmse - want.rmse) < 1e-6
    want, got = both(a.where("false"), p)                       # no pairs
    assert got.n == 0 and got.rmse is None and want.rmse is None


def test_deduplicate_uniform_order_uses_aggregate_and_matches_window(spark):
    from pyspark.sql import Window
    rows = [(1, 1, "a"), (1, 3, "b"), (1, None, "c"), (2, 2, "d"), (2, 2, "e"), (None, 5, "f"), (None, 4, "g")]
    rows += [(7, i, f"h{i}") for i in range(2000)]  # hot key
    df = spark.createDataFrame(rows, "user_id int, version int, tag string")
    for d in ("asc", "desc"):
        got = windows.deduplicate(df, ["user_id"], [f"version {d}", f"tag {d}"])
        assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
        o = [F.col("version").asc(), F.col("tag").asc()] if d == "asc" else [F.col("version").desc(), F.col("tag").desc()]
        w = Window.partitionBy("user_id").orderBy(*o)
        want = df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
        assert got.columns == df.columns
        key = lambda t: tuple((x is None, x) for x in t)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    mixed = windows.deduplicate(df, ["user_id"], ["version desc", "tag asc"])
    assert {r.user_id: r.tag for r in mixed.collect()}[2] == "d"
