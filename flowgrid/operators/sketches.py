"""Opt-in sketches: KLL for ranks, theta for sets.

Sketches are aggregates of bounded size that merge map-side, so a column or a
set of any size costs one scan and no shuffle of its values.  Answers that are
estimates say so and carry their error; ``quantiles_by_rank_bounds`` uses the
sketch only to find where to look and is exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgrid.operators.scan import exact_quantiles, prefix_scan

KLL_K = 2048
THETA_LG_NOM = 14


def rank_error(k: int = KLL_K) -> float:
    """Rank error of one KLL query that is exceeded with a probability of about
    1 %: 0.14 % of the rows at the default ``k``, 1.3 % at 200."""
    return 2.296 / k ** 0.9723


def _values(df: DataFrame, col: str) -> DataFrame:
    v = df.select(F.col(col).cast("double").alias("v"))
    return v.where(F.col("v").isNotNull() & ~F.isnan("v"))


def approx_quantiles(df: DataFrame, col: str, probs: Sequence[float], k: int = KLL_K) -> list[float | None]:
    """Estimated quantiles (actual values of ``col``) from one KLL sketch,
    merged from the tasks' sketches; nulls and NaN are left out.  The rank of
    each is within ``rank_error(k)`` of the wanted one."""
    sketch = _values(df, col).agg(F.kll_sketch_agg_double("v", F.lit(k)).alias("s"))
    out = sketch.select(*[F.kll_sketch_get_quantile_double("s", F.lit(float(p))).alias(f"q{i}") for i, p in enumerate(probs)],
                        F.kll_sketch_get_n_double("s").alias("n")).where("n > 0").first()
    return [None] * len(probs) if out is None else list(out)[:-1]


def quantiles_by_rank_bounds(df: DataFrame, col: str, probs: Sequence[float], k: int = KLL_K) -> list[float | None]:
    """Exact interpolated quantiles (``percentile_cont``), two scans of ``df``
    and a shuffle of a few thousandths of its values.

    One KLL sketch gives for each probability two values between which its
    ranks lie; one pass counts the values below each of them, and only those in
    between are ordered.  Where the sketch was off, which the counts show, the
    ordered scan of all values decides; the answer is exact either way."""
    v = _values(df, col)
    probs = list(probs)
    slack = 3 * rank_error(k)
    ends = [(max(0.0, p - slack), min(1.0, p + slack)) for p in probs]
    found = v.agg(F.kll_sketch_agg_double("v", F.lit(k)).alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n"))
    got = found.select("n", "lo", "hi", *[F.kll_sketch_get_quantile_double("s", F.lit(x)).alias(f"e{i}{j}")
                                          for i, e in enumerate(ends) for j, x in enumerate(e)]).where("n > 0").first()
    if got is None:
        return [None] * len(probs)
    n = got["n"]
    spans = [(got["lo"] if ends[i][0] == 0 else got[f"e{i}0"], got["hi"] if ends[i][1] == 1 else got[f"e{i}1"]) for i in range(len(probs))]
    inside = F.lit(False)
    for lo, hi in spans:
        inside = inside | F.col("v").between(lo, hi)
    below = v.agg(*[F.count(F.when(F.col("v") < lo, 1)).alias(f"b{i}") for i, (lo, _) in enumerate(spans)]).first()
    between = prefix_scan(v.where(inside).groupBy("v").agg(F.count(F.lit(1)).cast("double").alias("n")), ["v"], "n")
    offsets = between.agg(*[F.coalesce(F.min(F.when(F.col("v") >= lo, F.col("_cum") - F.col("n"))), F.lit(0.0)).alias(f"o{i}")
                            for i, (lo, _) in enumerate(spans)]).first()
    wanted = []
    for i, p in enumerate(probs):
        spot = (n - 1) * p
        wanted += [(i, r) for r in (math.floor(spot), math.ceil(spot))]
    # the value at rank r of all is the one at rank r - below + offset of those in between
    at = {(i, r): float(r - below[f"b{i}"] + offsets[f"o{i}"]) for i, r in wanted}
    hits = [F.max(F.when((F.col("_cum") - F.col("n") <= x) & (x < F.col("_cum")) & F.col("v").between(*spans[i]), F.col("v"))).alias(f"h{j}")
            for j, ((i, _), x) in enumerate(at.items())]
    values = between.agg(*hits).first()
    known = {key: values[f"h{j}"] if x >= offsets[f"o{key[0]}"] else None for j, (key, x) in enumerate(at.items())}
    if None in known.values():
        return exact_quantiles(df, col, probs)
    out = []
    for i, p in enumerate(probs):
        spot = (n - 1) * p
        a, b = known[i, math.floor(spot)], known[i, math.ceil(spot)]
        out.append(a + (b - a) * (spot - math.floor(spot)))
    return out


def distinct_estimates(df: DataFrame, cols: Sequence[str], lg_nom: int = THETA_LG_NOM) -> DataFrame:
    """One row: the estimated distinct non-null values of each column, by theta
    sketches of 2 ** ``lg_nom`` hashes (relative standard error 2 ** (-lg_nom / 2),
    0.8 % at the default; exact while there are fewer values than hashes)."""
    return df.agg(*[F.theta_sketch_estimate(F.theta_sketch_agg(c, F.lit(lg_nom))).alias(c) for c in cols])


def set_overlap(a: DataFrame, b: DataFrame, col: str, lg_nom: int = THETA_LG_NOM) -> DataFrame:
    """One row: estimated sizes of the distinct values of ``col`` in ``a``, in
    ``b``, in both, in either, in ``a`` alone and in ``b`` alone, from one
    sketch of each; the tables are never joined."""
    one = [t.agg(F.theta_sketch_agg(col, F.lit(lg_nom)).alias(n)) for t, n in ((a, "_a"), (b, "_b"))]
    both = one[0].select("_a", one[1].scalar().alias("_b"))  # one value each
    size = F.theta_sketch_estimate
    return both.select(size("_a").alias("n_a"), size("_b").alias("n_b"), size(F.theta_intersection("_a", "_b")).alias("n_both"),
                       size(F.theta_union("_a", "_b", F.lit(lg_nom))).alias("n_either"), size(F.theta_difference("_a", "_b")).alias("n_only_a"),
                       size(F.theta_difference("_b", "_a")).alias("n_only_b"))


def series_overlap(df: DataFrame, key: str, ts: str, lg_nom: int = THETA_LG_NOM) -> DataFrame:
    """Per series: ``n_points`` it has and ``n_missing`` of the points that any
    series has (estimates; exact below 2 ** ``lg_nom`` points), from one sketch
    for each series and their union.  ``same_set`` is exact also beyond that: a
    series' points are compared by an order-free digest, the sum of two hashes
    of its distinct points, which a set has in common with no other but by a
    chance of about 2 ** -100."""
    def lane(i):
        return F.sum(F.xxhash64(ts, F.lit(i)).cast("decimal(20,0)"))

    points = df.where(F.col(ts).isNotNull()).select(key, ts).distinct()  # map-side combined
    per = points.groupBy(key).agg(F.theta_sketch_agg(F.col(ts).cast("string"), F.lit(lg_nom)).alias("_s"),
                                  F.count(F.lit(1)).alias("_n"), lane(0).alias("_x"), lane(1).alias("_y"))
    every = points.select(ts).distinct().agg(F.count(F.lit(1)).alias("n"), lane(0).alias("x"), lane(1).alias("y"))
    union = per.agg(F.theta_union_agg("_s", F.lit(lg_nom)).alias("u")).scalar()
    whole = every.select(F.struct("n", "x", "y").alias("e")).scalar()
    return per.select(key, F.theta_sketch_estimate("_s").alias("n_points"), F.theta_sketch_estimate(F.theta_difference(union, "_s")).alias("n_missing"),
                      ((F.col("_n") == whole["n"]) & (F.col("_x") == whole["x"]) & (F.col("_y") == whole["y"])).alias("same_set"))
