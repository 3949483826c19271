"""Sketch-based forms against the exact ones, fused checks, positions, periods, exact KS."""

import bisect
import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from flowgrid.operators import clean, drift, quality, scan, sketches, windows
from flowgrid.sources import sinks
from tests.conftest import SF_SMALL, rows

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]


def column(spark, kind, n=30_000):
    rng = random.Random(kind)
    value = {"spread": lambda: rng.gauss(0, 100), "hot": lambda: 5.0 if rng.random() < 0.4 else rng.random() * 10,
             "few": lambda: float(rng.randrange(7)), "one": lambda: 3.0}[kind]
    data = [(None if rng.random() < 0.02 else float("nan") if rng.random() < 0.01 else value(),) for _ in range(n)]
    return spark.createDataFrame(data, "x double"), sorted(v for v, in data if v is not None and v == v)


@pytest.mark.parametrize("kind", ["spread", "hot", "few", "one"])
def test_quantiles_by_rank_bounds_are_exact(spark, kind):
    df, _ = column(spark, kind)
    want = scan.exact_quantiles(df, "x", PROBS)
    assert sketches.quantiles_by_rank_bounds(df, "x", PROBS) == want
    # a sketch too coarse for its bounds changes the way, not the answer
    assert sketches.quantiles_by_rank_bounds(df, "x", PROBS, k=8) == want


def test_bounds_that_miss_fall_back(spark, monkeypatch):
    df, _ = column(spark, "spread", 5000)
    monkeypatch.setattr(sketches, "rank_error", lambda k=0: 0.0)
    assert sketches.quantiles_by_rank_bounds(df, "x", PROBS, k=8) == scan.exact_quantiles(df, "x", PROBS)


@pytest.mark.parametrize("kind", ["spread", "hot", "few"])
@pytest.mark.parametrize("k", [200, 2048])
def test_approximate_quantiles_within_rank_error(spark, kind, k):
    df, values = column(spark, kind)
    for p, v in zip(PROBS, sketches.approx_quantiles(df, "x", PROBS, k)):
        lo, hi = bisect.bisect_left(values, v) / len(values), bisect.bisect_right(values, v) / len(values)
        assert lo - 2 * sketches.rank_error(k) <= p <= hi + 2 * sketches.rank_error(k)


def test_no_values(spark):
    none = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert sketches.approx_quantiles(none, "x", [0.5]) == sketches.quantiles_by_rank_bounds(none, "x", [0.5]) == [None]
    for how in ("ordered", "bounds", "approximate"):
        assert clean.trim_quantiles(none, "x", method=how).count() == 0


def test_trims_agree(spark):
    df, values = column(spark, "spread")
    exact = rows(clean.trim_quantiles(df, "x").orderBy("x"))
    assert rows(clean.trim_quantiles(df, "x", method="bounds").orderBy("x")) == exact
    near = clean.trim_quantiles(df, "x", method="approximate").count()
    assert abs(near - len(exact)) <= 4 * sketches.rank_error() * len(values)


def test_distinct_and_overlap_estimates(spark):
    small = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("s"), F.lit(None).cast("long").alias("n"))
    assert rows(sketches.distinct_estimates(small, ["k", "s", "n"])) == [(5000, 7, 0)]
    large = spark.range(300_000).select(F.col("id").alias("k"))
    assert abs(sketches.distinct_estimates(large, ["k"]).first().k / 300_000 - 1) < 0.04
    a, b = spark.range(100, 4000).select(F.col("id").alias("k")), spark.range(3000, 6000).select(F.col("id").alias("k"))
    assert rows(sketches.set_overlap(a, b, "k")) == [(3900, 3000, 1000, 5900, 2900, 2000)]


def test_series_overlap(spark):
    start = dt.datetime(2024, 1, 1)
    data = [(s, start + dt.timedelta(hours=h)) for s, lack in (("a", ()), ("b", (3, 4)), ("c", ()), ("d", range(50))) for h in range(60) if h not in lack]
    # as many hours as the others, not the same ones
    data += [("e", start + dt.timedelta(hours=h + (h == 7) * 93)) for h in range(60)] + [("a", start), ("a", None)]
    df = spark.createDataFrame(data, "s string, t timestamp_ntz")
    got = {r.s: (r.n_points, r.n_missing, r.same_set) for r in sketches.series_overlap(df, "s", "t").collect()}
    assert got == {"a": (60, 1, False), "b": (58, 3, False), "c": (60, 1, False), "d": (10, 51, False), "e": (60, 1, False)}
    same = {r.s: (r.n_missing, r.same_set) for r in sketches.series_overlap(df.where("s in ('a', 'b', 'c')"), "s", "t").collect()}
    assert same == {"a": (0, True), "b": (2, False), "c": (0, True)}


def scans(df, column):
    """File scans of the plan that read ``column``."""
    plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    return sum("FileScan" in line and f"{column}#" in line for line in plan.splitlines())


def test_fused_checks_scan_once(spark, tmp_path):
    path = str(tmp_path / "fused_rows")
    data = [(i, None if i % 10 == 0 else "ab"[i % 2], float(i % 60), None if i == 3 else i % 5) for i in range(200)] + [(3, "z", -1.0, 9)]
    spark.createDataFrame(data, "id long, kind string, q double, p int").write.parquet(path)
    df = spark.read.parquet(path)
    parent = spark.createDataFrame([(0,), (1,), (2,), (3,), (None,)], "p int")
    tied = quality.with_relation(df, "p", parent, "p", "orphan")
    got = quality.row_check_report(tied, {
        "null": quality.failing(F.col("kind").isNull()), "values": quality.failing_values("kind", ["a", "b"]),
        "range": quality.failing(~F.col("q").between(0, 45)), "share": quality.failing_proportion("kind", 0.95),
        "relation": quality.failing(F.col("orphan"))})
    want = {"null": quality.not_null(df, "kind"), "values": quality.accepted_values(df, "kind", ["a", "b"]),
            "range": quality.accepted_range(df, "q", 0, 45), "share": quality.not_null_proportion(df, "kind", 0.95),
            "relation": df.where("p is not null and p not in (0, 1, 2, 3)")}
    assert dict(rows(got)) == {k: v.count() for k, v in want.items()}
    assert scans(got, "kind") == 1
    keys = quality.unique_check_report(df, {"id": ["id"], "pair": ["kind", "p"], "p": ["p"], "all": ["id", "q"]})
    assert dict(rows(keys)) == {"id": quality.unique(df, "id").count(), "pair": quality.unique_combination(df, ["kind", "p"]).count(),
                                "p": quality.unique(df, "p").count(), "all": 0}
    assert scans(keys, "kind") == 1
    assert dict(rows(quality.unique_check_report(df.limit(0), {"id": ["id"], "p": ["p"]}))) == {"id": 0, "p": 0}
    report = quality.fused_report([got, keys.where("check_name = 'all'")])
    assert {r.check_name: r.passed for r in report.collect()}["all"] is True


def test_positional_split(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000, 0, -1).select(F.col("id").alias("v")).repartition(1).write.option("maxRecordsPerFile", 170).parquet(path)
    files = sorted(r.f for r in spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f")).distinct().collect())
    stored = [r.v for f in files for r in spark.read.parquet(f).coalesce(1).collect()]
    got = {r.v: r.split for r in windows.positional_split(spark, path, 0.8).collect()}
    assert len(files) == 6 and got == {v: "train" if i < 800 else "test" for i, v in enumerate(stored)}
    assert windows.positional_split(spark, path, 0.33).where("split = 'train'").count() == 330
    assert "SortMergeJoin" not in windows.positional_split(spark, path)._jdf.queryExecution().executedPlan().toString()


def test_rewrite_puts_half_a_period_right(spark, tmp_path):
    import os
    import shutil
    path = str(tmp_path / "t")
    base = dt.datetime(2024, 1, 3)
    src = spark.createDataFrame([(i, base + dt.timedelta(hours=7 * i)) for i in range(600)], "id long, ts timestamp_ntz")
    sinks.rewrite_periods(src, path, "ts", "2024-03-10 00:00:00")
    first = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("period=")}
    assert sorted(first) == ["period=2024-01-01", "period=2024-02-01", "period=2024-03-01"]
    # a load that was interrupted: part of the newest month is there, twice over
    newest = f"{path}/period=2024-03-01"
    part = next(f for f in os.listdir(newest) if f.endswith(".parquet"))
    shutil.copy(f"{newest}/{part}", f"{newest}/copy.parquet")
    for _ in range(2):
        out = sinks.rewrite_periods(src, path, "ts", "2024-05-01 00:00:00")
        want = [r.id for r in src.where("ts < timestamp_ntz '2024-04-30 23:59:59.999'").orderBy("id").collect()]
        assert [r.id for r in out.orderBy("id").collect()] == want
    # earlier months were not written again
    assert all(sorted(os.listdir(f"{path}/{d}")) == first[d] for d in ("period=2024-01-01", "period=2024-02-01"))


def plain_ks(n, m, d):
    """Share of all orders of n + m values whose statistic is at least d."""
    hit = total = 0
    for at in itertools.combinations(range(n + m), n):
        here, i, top = set(at), 0, 0.0
        for k in range(n + m):
            i += k in here
            top = max(top, abs(i / n - (k + 1 - i) / m))
        hit += top >= d - 1e-12
        total += 1
    return hit / total


def test_exact_ks_against_enumeration():
    for n in range(1, 9):
        for m in range(1, 9):
            if n + m > 13:
                continue
            seen = sorted({abs(i / n - j / m) for i in range(n + 1) for j in range(m + 1)})
            for d in seen[:: max(1, len(seen) // 5)]:
                assert drift.ks_exact_p(n, m, d) == pytest.approx(plain_ks(n, m, d), abs=1e-9), (n, m, d)


def test_exact_ks_against_asymptotic(spark):
    rng = random.Random(3)
    data = [("a", rng.gauss(0, 1)) for _ in range(900)] + [("b", rng.gauss(0.06, 1)) for _ in range(1100)]
    df = spark.createDataFrame(data, "side string, v double")
    exact, plain = drift.ks_two_sample(df, "v", "side", "a", "b", exact=True).first(), drift.ks_two_sample(df, "v", "side", "a", "b").first()
    assert exact.d_stat == plain.d_stat and abs(exact.p_value - plain.p_value) < 0.02
    few = df.limit(0).unionByName(spark.createDataFrame(data[:6] + data[900:905], "side string, v double"))
    r = drift.ks_two_sample(few, "v", "side", "a", "b", exact=True).first()
    assert r.p_value == pytest.approx(plain_ks(6, 5, r.d_stat), abs=1e-6)


def test_report_query_scans_tables_once(spark):
    from flowgrid.plans import catalog
    df = catalog.queries()["dq_report"](spark, SF_SMALL)
    assert scans(df, "l_quantity") == 1 and scans(df, "o_orderstatus") == 1
    assert df.count() == 7
