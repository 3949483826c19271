"""Model monitoring: regression metrics, residual statistics and the three
concept-drift tests (two-sample Kolmogorov-Smirnov, Welch's t, Page-Hinkley)
plus the majority vote.  Statistics are aggregates; only 1-row results reach
the driver (for the p-values that need special functions)."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowgrid.operators.scan import prefix_scan
from flowgrid.operators.windows import first_alarm, page_hinkley
from flowgrid.operators.joins import with_scalars

# Fixed thresholds of the monitoring job.
RMSE_THRESHOLD = 15.0
P_THRESHOLD = 0.05
PH_DELTA = 0.5
PH_LAMBDA = 10.0
MIN_VOTES = 2


def regression_metrics(df: DataFrame, y: str, yhat: str, digits: int | None = None) -> DataFrame:
    """n, RMSE, MAE, R^2 (null when y is constant) in one aggregate pass plus
    one pass for the centred sum of squares (mean as a scalar subquery)."""
    e = F.col(y) - F.col(yhat)
    m = df.agg(F.avg(y).alias("_ybar"))
    j = with_scalars(df, m)
    a = j.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
              F.sum(e * e).alias("_sse"), F.sum((F.col(y) - F.col("_ybar")) ** 2).alias("_sst"))
    r2 = F.when(F.col("_sst") != 0, 1 - F.col("_sse") / F.col("_sst"))
    out = a.select("n", "rmse", "mae", r2.alias("r2"))
    if digits is not None:
        out = out.select("n", *[F.round(c, digits).alias(c) for c in ("rmse", "mae", "r2")])
    return out


def fanout_metrics(actuals: DataFrame, preds: DataFrame, keys: Sequence[str], y: str, yhat: str,
                   digits: int | None = None) -> DataFrame:
    """``regression_metrics`` over ``actuals JOIN preds ON keys`` (every match
    kept, null predictions dropped) without emitting the pairs.  Both sides
    are dealt by key once.  Per key: counts, sums and sums of squares of both
    sides give n, SSE, the mean and SST; the sum of |a - p| over a key's pairs
    comes from a running count and sum of the actuals in value order (for each
    prediction p: p*c - s + (S - s) - p*(N - c)), a window over one key's rows
    only."""
    keys = list(keys)
    # both sides relative to the mean actual: differences stay, squares stay small
    centre = F.coalesce(actuals.agg(F.avg(F.col(y).cast("double"))).scalar(), F.lit(0.0))
    a = actuals.select(*keys, (F.col(y).cast("double") - centre).alias("_v"), F.lit(1).alias("_isa"))
    p = preds.where(F.col(yhat).isNotNull()).select(*keys, (F.col(yhat).cast("double") - centre).alias("_v"),
                                                   F.lit(0).alias("_isa"))
    w = Window.partitionBy(*keys).orderBy(F.col("_v"), F.col("_isa").desc())
    upto, whole = w.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*keys)
    isa, pv = F.col("_isa") == 1, F.col("_v")
    act, pred = F.when(isa, pv), F.when(~isa, pv)
    u = a.unionByName(p).dropna(subset=keys).withColumns({  # a null key meets nothing
        "_c": F.sum("_isa").over(upto), "_s": F.coalesce(F.sum(act).over(upto), F.lit(0.0)),
        "_na": F.sum("_isa").over(whole), "_sa": F.sum(act).over(whole)})
    na, sa = F.col("_na"), F.col("_sa")
    absum = F.when(~isa, pv * F.col("_c") - F.col("_s") + (sa - F.col("_s")) - pv * (na - F.col("_c")))
    k = u.groupBy(*keys).agg(F.sum("_isa").alias("_na"), F.sum(act).alias("_sa"), F.sum(act * act).alias("_sa2"),
                             F.count(act).alias("_nv"), F.var_pop(act).alias("_var"), F.min(act).alias("_lo"), F.max(act).alias("_hi"),
                             F.count(pred).alias("_np"), F.sum(pred).alias("_sp"), F.sum(pred * pred).alias("_sp2"), F.sum(absum).alias("_abs"))
    k = k.where((F.col("_na") > 0) & (F.col("_np") > 0))  # keys present on both sides only
    np_, sp = F.col("_np"), F.col("_sp")
    # SST about the mean of all pairs, within keys and between their means
    # (exactly 0 for a constant target): each actual weighs as many pairs as
    # its key has predictions
    nv = F.col("_nv")
    t = k.agg(F.coalesce(F.sum(na * np_), F.lit(0)).alias("n"),
              F.sum(np_ * F.col("_sa2") - 2 * sa * sp + na * F.col("_sp2")).alias("_sse"), F.sum("_abs").alias("_abs"),
              F.sum(np_ * nv * F.col("_var")).alias("_within"), F.sum(F.try_divide(np_ * sa * sa, nv)).alias("_means"),
              F.sum(np_ * sa).alias("_sum"), F.sum(np_ * nv).alias("_w"), (F.min("_lo") == F.max("_hi")).alias("_one"))
    ybar = F.try_divide(F.col("_sum"), F.col("n").cast("double"))
    between = F.greatest(F.col("_means") - 2 * ybar * F.col("_sum") + ybar * ybar * F.col("_w"), F.lit(0.0))
    t = t.withColumn("_sst", F.when(F.col("_one") & (F.col("_within") == 0), F.lit(0.0)).otherwise(F.col("_within") + between))
    n = F.col("n").cast("double")
    sst = F.col("_sst")
    sse = F.greatest(F.col("_sse"), F.lit(0.0))
    out = t.select("n", F.sqrt(F.try_divide(sse, n)).alias("rmse"), F.try_divide(F.col("_abs"), n).alias("mae"),
                   F.when(sst != 0, 1 - sse / sst).alias("r2"))
    if digits is not None:
        out = out.select("n", *[F.round(c, digits).alias(c) for c in ("rmse", "mae", "r2")])
    return out


def residual_stats(df: DataFrame, residual: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(residual).alias("n"), F.round(F.avg(residual), 6).alias("mean"),
                               F.round(F.stddev_pop(residual), 6).alias("std_pop"))


#: n_a * n_b up to which the exact p-value is counted on request
KS_EXACT = 10_000_000


def ks_exact_p(n: int, m: int, d: float) -> float:
    """P(D >= d) of the two-sample statistic without ties, by counting lattice
    paths: an order of the pooled values is a path of n steps right and m steps
    up, and D < d if it stays where |i / n - j / m| < d.  Paths inside are
    counted column by column as shares of all paths, so nothing overflows."""
    reach = round(d * n * m)  # D is a whole multiple of 1 / (n m)
    if reach <= 0:
        return 1.0
    # share[j]: paths to (i, j) inside, over all paths to (i, j)
    share = [1.0 if j * n < reach else 0.0 for j in range(m + 1)]
    for j in range(1, m + 1):
        if not share[j - 1]:
            share[j] = 0.0
    for i in range(1, n + 1):
        share[0] = share[0] if i * m < reach else 0.0
        for j in range(1, m + 1):
            inside = abs(i * m - j * n) < reach
            share[j] = (share[j] * i + share[j - 1] * j) / (i + j) if inside else 0.0
    return min(1.0, max(0.0, 1.0 - share[m]))


def ks_two_sample(df: DataFrame, value: str, side: str, a, b, exact: bool = False) -> DataFrame:
    """D = sup |F_a - F_b| over the pooled values (ties aggregated first),
    asymptotic p-value (``exact``: counted, for samples with n_a * n_b up to
    ``KS_EXACT``), drift flag.  The running difference of the two ECDFs
    is a prefix sum over distinct values computed with the range-partition
    scan (no single-partition window)."""
    c = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(
        F.sum(F.when(F.col(side) == a, 1).otherwise(0)).alias("na"),
        F.sum(F.when(F.col(side) == b, 1).otherwise(0)).alias("nb"))
    tot = c.agg(F.sum("na").alias("NA"), F.sum("nb").alias("NB")).first()
    n_a, n_b = int(tot["NA"] or 0), int(tot["NB"] or 0)
    spark = df.sparkSession
    if n_a == 0 or n_b == 0:
        return spark.createDataFrame([(None, n_a, n_b, None, False)],
                                     "d_stat double, n_a long, n_b long, p_value double, drift boolean")
    x = c.withColumn("_x", F.col("na") / F.lit(float(n_a)) - F.col("nb") / F.lit(float(n_b)))
    s = prefix_scan(x, ["v"], "_x")
    d = s.agg(F.max(F.abs("_cum")).alias("d_stat"))
    lam = F.col("d_stat") * F.lit(math.sqrt(n_a * n_b / (n_a + n_b)))
    p = F.lit(ks_exact_p(n_a, n_b, d.first()["d_stat"])) if exact and n_a * n_b <= KS_EXACT else _ks_p(lam)
    return d.select(F.round("d_stat", 9).alias("d_stat"), F.lit(n_a).cast("long").alias("n_a"),
                    F.lit(n_b).cast("long").alias("n_b"), F.round(p, 6).alias("p_value"),
                    (p < P_THRESHOLD).alias("drift"))


JS_THRESHOLD = 0.1


def column_drift(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], side: str, a, b) -> DataFrame:
    """Drift of every column between sides ``a`` and ``b``: two-sample KS for
    numeric columns, Jensen-Shannon distance of the category shares for the
    others (null is a category), in one pass over the rows.

    Columns become (column, value) rows counted by side; one ordered scan over
    (column, value) gives the running difference of the two distributions of
    all numeric columns at once, because a column's differences add up to 0.
    Returns column_name, kind, stat, p_value (KS only) and drift."""
    sides = df.where(F.col(side).isin(a, b))
    is_a = (F.col(side) == a).cast("int").alias("_a")
    num = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in numeric])).alias("x")
    cat = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in categorical])).alias("x")

    def counted(values, drop_null):
        x = sides.select(is_a, values).select("_a", "x.c", "x.v")
        x = x.where(F.col("v").isNotNull()) if drop_null else x
        n = x.groupBy("c", "v").agg(F.sum("_a").alias("na"), F.sum(1 - F.col("_a")).alias("nb"))
        total = n.groupBy("c").agg(F.sum("na").alias("all_a"), F.sum("nb").alias("all_b"))  # one row per column
        return n.join(F.broadcast(total), "c").where((F.col("all_a") > 0) & (F.col("all_b") > 0))

    out = []
    if numeric:
        n = counted(num, True).withColumn("_x", F.col("na") / F.col("all_a") - F.col("nb") / F.col("all_b"))
        d = prefix_scan(n, ["c", "v"], "_x").groupBy("c").agg(
            F.max(F.abs("_cum")).alias("d"), F.first("all_a").alias("na"), F.first("all_b").alias("nb"))
        lam = F.col("d") * F.sqrt(F.col("na").cast("double") * F.col("nb") / (F.col("na") + F.col("nb")))
        p = _ks_p(lam)
        out.append(d.select(F.col("c").alias("column_name"), F.lit("numeric").alias("kind"), F.col("d").alias("stat"),
                            p.alias("p_value"), (p < P_THRESHOLD).alias("drift")))
    if categorical:
        p, q = F.col("na") / F.col("all_a"), F.col("nb") / F.col("all_b")
        part = F.when(p > 0, p * F.log(2 * p / (p + q))).otherwise(0.0) + F.when(q > 0, q * F.log(2 * q / (p + q))).otherwise(0.0)
        js = counted(cat, False).groupBy("c").agg(F.sqrt(F.greatest(F.lit(0.0), F.sum(part) / 2)).alias("d"))
        out.append(js.select(F.col("c").alias("column_name"), F.lit("categorical").alias("kind"), F.col("d").alias("stat"),
                             F.lit(None).cast("double").alias("p_value"), (F.col("d") >= JS_THRESHOLD).alias("drift")))
    return functools.reduce(DataFrame.unionByName, out)


def _ks_p(lam):
    """Asymptotic two-sided Kolmogorov p-value of ``lam``."""
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
                         lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(F.lit(-2.0) * k * k * lam * lam))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(2.0) * series))


def welch_stats(df: DataFrame, value: str, side: str, a, b) -> DataFrame:
    """Welch's t statistic and Welch-Satterthwaite degrees of freedom."""
    g = df.agg(*[f for s, tag in ((a, "a"), (b, "b")) for f in (
        F.count(F.when(F.col(side) == s, F.col(value))).alias(f"n_{tag}"),
        F.avg(F.when(F.col(side) == s, F.col(value))).alias(f"mean_{tag}"),
        F.var_samp(F.when(F.col(side) == s, F.col(value))).alias(f"var_{tag}"))])
    va, vb = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    t = (F.col("mean_a") - F.col("mean_b")) / F.sqrt(va + vb)
    dof = (va + vb) ** 2 / (va ** 2 / (F.col("n_a") - 1) + vb ** 2 / (F.col("n_b") - 1))
    return g.select("n_a", "n_b", "mean_a", "mean_b", t.alias("t_stat"), dof.alias("dof"))


# -- Student t p-value (regularised incomplete beta, continued fraction) ----------
def _betacf(a: float, b: float, x: float, itmax: int = 300, eps: float = 3e-16) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
    h = d
    for m in range(1, itmax + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > 1e-300 else 1e-300
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > 1e-300 else 1e-300
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            break
    return h


def betainc_reg(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def t_two_sided_p(t: float, dof: float) -> float:
    if t is None or dof is None or math.isnan(t) or math.isnan(dof):
        return float("nan")
    return betainc_reg(dof / 2.0, 0.5, dof / (dof + t * t))


def welch_t_test(df: DataFrame, value: str, side: str, a, b) -> DataFrame:
    """Welch statistics plus the two-sided p-value (computed from the 1-row
    statistics) and the drift flag."""
    row = welch_stats(df, value, side, a, b).first()
    p = t_two_sided_p(row["t_stat"], row["dof"]) if row["t_stat"] is not None else None
    spark: SparkSession = df.sparkSession
    return spark.createDataFrame(
        [(row["n_a"], row["n_b"], row["mean_a"], row["mean_b"], row["t_stat"], row["dof"], p,
          bool(p is not None and p < P_THRESHOLD))],
        "n_a long, n_b long, mean_a double, mean_b double, t_stat double, dof double, p_value double, drift boolean")


def page_hinkley_test(cur: DataFrame, value: str, order: Sequence[str], ref_mean: float,
                      delta: float = PH_DELTA, lam: float = PH_LAMBDA) -> DataFrame:
    fa = first_alarm(page_hinkley(cur, value, order, ref_mean, delta, lam))
    return fa.select("first_alarm_idx", F.round("max_ph_stat", 6).alias("max_ph_stat"),
                     (F.col("first_alarm_idx") >= 0).alias("drift"))


def concept_drift_vote(res: DataFrame, residual: str, period: str, ref, cur, order: Sequence[str]) -> DataFrame:
    """KS + Welch + Page-Hinkley on reference vs current residuals; drift
    when at least two agree; an empty side gives no drift."""
    ks = ks_two_sample(res, residual, period, ref, cur).first()
    wt = welch_t_test(res, residual, period, ref, cur).first()
    ref_mean = res.where(F.col(period) == ref).agg(F.avg(residual)).first()[0]
    cur_df = res.where(F.col(period) == cur)
    if ref_mean is None or ks["n_a"] == 0 or ks["n_b"] == 0:
        ph = {"first_alarm_idx": -1, "max_ph_stat": None, "drift": False}
    else:
        ph = page_hinkley_test(cur_df, residual, order, ref_mean).first().asDict()
    votes = int(bool(ks["drift"])) + int(bool(wt["drift"])) + int(bool(ph["drift"]))
    spark = res.sparkSession
    return spark.createDataFrame(
        [(ks["d_stat"], ks["p_value"], bool(ks["drift"]), wt["t_stat"], wt["p_value"], bool(wt["drift"]),
          int(ph["first_alarm_idx"]), bool(ph["drift"]), votes, votes >= MIN_VOTES)],
        "ks_stat double, ks_p double, ks_drift boolean, t_stat double, t_p double, t_drift boolean, "
        "ph_alarm_idx long, ph_drift boolean, votes int, concept_drift boolean")
