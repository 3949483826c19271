"""Registered monitoring queries: metrics, performance gate, residuals,
KS / Welch / Page-Hinkley, votes, data drift and the retrain decision.

Stand-ins: the prediction of an hour is the grid's 24-hour rolling mean
(0 when missing); days 1-15 are the reference period, later days the current
period (two "months")."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgrid.operators import drift
from flowgrid.plans.q_grid import G, grid
from flowgrid.plans.registry import query
from flowgrid.operators.joins import shuffled, with_scalars

PERIOD_SQL = "CASE WHEN year = 2024 AND month = 1 THEN 'reference' WHEN year = 2024 AND month = 2 THEN 'current' END"
RES_SQL = f"""r_res AS (SELECT station_id, date_hour, hour, month, jour_semaine, {PERIOD_SQL} AS period,
  net_flow AS actual, coalesce(net_flow_roll_24, 0) AS prediction,
  net_flow - coalesce(net_flow_roll_24, 0) AS residual FROM g_grid)"""
# fixed values: the monitored columns
DRIFT_COLS = ["month", "day", "hour", "temp", "precipitation_total", "relative_humidity", "average_wind_speed",
              "num_bikes_taken_lag_1", "num_bikes_dropped_lag_1", "net_flow_lag_1", "net_flow_lag_2", "net_flow_lag_24",
              "net_flow_roll_3", "net_flow_roll_24", "coco", "net_flow"]
DRIFT_CATEGORIES = ["station_id", "jour_semaine", "coco_group", "is_holiday"]


def period():
    """Reference month and current month, by year and month."""
    first = F.col("year") == 2024
    return F.when(first & (F.col("month") == 1), F.lit("reference")).when(first & (F.col("month") == 2), F.lit("current"))


def residuals(spark, sf_dir) -> DataFrame:
    g = grid(spark, sf_dir)
    pred = F.coalesce(F.col("net_flow_roll_24"), F.lit(0.0))
    return g.select("station_id", "date_hour", "hour", "month", "jour_semaine",
                    period().alias("period"),
                    F.col("net_flow").alias("actual"), pred.alias("prediction"),
                    (F.col("net_flow") - pred).alias("residual"))


def predictions(spark, sf_dir) -> DataFrame:
    """Stand-in prediction log: one row per grid hour."""
    r = residuals(spark, sf_dir)
    return r.select(F.md5(F.concat_ws("|", "station_id", F.col("date_hour").cast("string"))).alias("run_id"),
                    "station_id", F.col("date_hour").alias("request_datetime"), "hour", "prediction",
                    F.col("date_hour").alias("timestamp"), "month", "jour_semaine", "period")


JOIN_SQL = RES_SQL + """,
j_act AS (SELECT * FROM r_res WHERE period = 'current'),
j_pred AS (SELECT station_id, hour, month, jour_semaine, date_hour AS request_datetime, prediction
           FROM r_res WHERE period = 'current'),
j_join AS (SELECT a.station_id, a.date_hour, p.request_datetime, a.actual, p.prediction
  FROM j_act a JOIN j_pred p ON a.station_id = p.station_id AND a.hour = p.hour AND a.month = p.month
   AND a.jour_semaine = p.jour_semaine WHERE p.prediction IS NOT NULL)"""


def joined(spark, sf_dir) -> DataFrame:
    """actuals x predictions on (station, hour, month, weekday) for the
    current period; the keys are not unique on either side, so every match is
    kept (the metric is defined over the fan-out).  The fan-out per key is
    bounded by the number of same-weekday days in a month (<= 5 x 5)."""
    r = residuals(spark, sf_dir).where("period = 'current'")
    a = r.select("station_id", "date_hour", "hour", "month", "jour_semaine", "actual")
    p = r.select("station_id", "hour", "month", "jour_semaine", F.col("date_hour").alias("request_datetime"),
                 "prediction")
    return a.join(shuffled(p), ["station_id", "hour", "month", "jour_semaine"]).where(F.col("prediction").isNotNull()) \
        .select("station_id", "date_hour", "request_datetime", "actual", "prediction")


@query("join_actuals_predictions", G(JOIN_SQL + "\nSELECT * FROM j_join"))
def q_join_actuals_predictions(spark, sf_dir):
    return joined(spark, sf_dir)


@query("join_actuals_predictions_exact", G(RES_SQL + """
SELECT a.station_id, a.date_hour, a.actual, p.prediction FROM r_res a JOIN r_res p
  ON a.station_id = p.station_id AND a.date_hour = p.date_hour WHERE a.period = 'current' AND p.prediction IS NOT NULL"""))
def q_join_actuals_predictions_exact(spark, sf_dir):
    """Each actual with the prediction for its very hour (unique key)."""
    a = residuals(spark, sf_dir).where("period = 'current'").select("station_id", "date_hour", "actual")
    p = predictions(spark, sf_dir).select("station_id", F.col("request_datetime").alias("date_hour"), "prediction")
    return a.join(shuffled(p.where(F.col("prediction").isNotNull())), ["station_id", "date_hour"])


def _metrics_sql(src: str, y: str, yhat: str) -> str:
    return f"""SELECT count(*) AS n, round(sqrt(avg(({y} - {yhat}) * ({y} - {yhat}))), 6) AS rmse,
  round(avg(abs({y} - {yhat})), 6) AS mae,
  round(CASE WHEN sum(({y} - ybar) * ({y} - ybar)) <> 0
        THEN 1 - sum(({y} - {yhat}) * ({y} - {yhat})) / sum(({y} - ybar) * ({y} - ybar)) END, 6) AS r2
FROM {src}, (SELECT avg({y}) AS ybar FROM {src})"""


@query("regression_metrics", G(RES_SQL + "\n" + _metrics_sql("r_res", "actual", "prediction")))
def q_regression_metrics(spark, sf_dir):
    return drift.regression_metrics(residuals(spark, sf_dir), "actual", "prediction", digits=6)


@query("performance_gate", G(JOIN_SQL + f"""
SELECT *, coalesce(rmse > {drift.RMSE_THRESHOLD}, FALSE) AS retrain FROM ({_metrics_sql('j_join', 'actual', 'prediction')})"""))
def q_performance_gate(spark, sf_dir):
    """Metrics of the fan-out join and the retrain flag (RMSE > 15; empty
    input gives false).  Computed from per-key statistics of both sides, so
    the pairs of the fan-out are never emitted."""
    r = residuals(spark, sf_dir).where("period = 'current'")
    keys = ["station_id", "hour", "month", "jour_semaine"]
    m = drift.fanout_metrics(r.select(*keys, "actual"), r.select(*keys, "prediction"), keys, "actual", "prediction")
    flag = F.coalesce(F.col("rmse") > drift.RMSE_THRESHOLD, F.lit(False))  # decided on the exact value
    return m.select("n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")], flag.alias("retrain"))


@query("naive_baseline", G("""nb AS (SELECT net_flow, CAST(net_flow_lag_1 AS DOUBLE) AS naive FROM g_grid
  WHERE net_flow_lag_1 IS NOT NULL)
""" + _metrics_sql("nb", "net_flow", "naive")))
def q_naive_baseline(spark, sf_dir):
    """Previous-hour baseline (the target scored against its own lag 1)."""
    g = grid(spark, sf_dir).where(F.col("net_flow_lag_1").isNotNull()).select(
        "net_flow", F.col("net_flow_lag_1").cast("double").alias("naive"))
    return drift.regression_metrics(g, "net_flow", "naive", digits=6)


@query("residual_stats", G(RES_SQL + """
SELECT period, count(residual) AS n, round(avg(residual), 6) AS mean, round(stddev_pop(residual), 6) AS std_pop
FROM r_res GROUP BY 1"""))
def q_residual_stats(spark, sf_dir):
    return drift.residual_stats(residuals(spark, sf_dir), "residual", ["period"])


def _ks_sql(src: str, value: str, side: str, a: str, b: str, where: str = "TRUE") -> str:
    return f"""(WITH c AS (SELECT {value} AS v, sum(CASE WHEN {side} = '{a}' THEN 1 ELSE 0 END) AS na,
       sum(CASE WHEN {side} = '{b}' THEN 1 ELSE 0 END) AS nb FROM {src} WHERE {value} IS NOT NULL AND {where} GROUP BY 1),
  t AS (SELECT sum(na) AS NA, sum(nb) AS NB FROM c),
  cum AS (SELECT sum(na) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ca,
                 sum(nb) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cb FROM c),
  d AS (SELECT max(abs(ca / NA - cb / NB)) AS d_stat, any_value(NA) AS n_a, any_value(NB) AS n_b FROM cum, t),
  l AS (SELECT d_stat, n_a, n_b, d_stat * sqrt(CAST(n_a AS DOUBLE) * n_b / (n_a + n_b)) AS lam FROM d),
  p AS (SELECT d_stat, n_a, n_b, least(1.0, greatest(0.0, 2.0 * (SELECT sum(power(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam))
        FROM range(1, 101) r(k)))) AS p FROM l)
  SELECT round(d_stat, 9) AS d_stat, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b,
         round(p, 6) AS p_value, p < {drift.P_THRESHOLD} AS drift FROM p)"""


@query("ks_two_sample", G(RES_SQL + "\nSELECT * FROM " + _ks_sql("r_res", "residual", "period", "reference", "current")))
def q_ks_two_sample(spark, sf_dir):
    return drift.ks_two_sample(residuals(spark, sf_dir), "residual", "period", "reference", "current")


# two-sided p-value: the t density integrated by Simpson's rule from 0 to |t|
WELCH_SQL = f"""s AS (SELECT count(residual) FILTER (period = 'reference') AS n_a, avg(residual) FILTER (period = 'reference') AS mean_a,
  var_samp(residual) FILTER (period = 'reference') AS var_a, count(residual) FILTER (period = 'current') AS n_b,
  avg(residual) FILTER (period = 'current') AS mean_b, var_samp(residual) FILTER (period = 'current') AS var_b FROM r_res),
t AS (SELECT n_a, n_b, mean_a, mean_b, (mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) AS t_stat,
  power(var_a / n_a + var_b / n_b, 2) / (power(var_a / n_a, 2) / (n_a - 1) + power(var_b / n_b, 2) / (n_b - 1)) AS dof FROM s),
area AS (SELECT sum(CASE WHEN k IN (0, 4000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
  * exp(-(dof + 1) / 2 * ln(1 + power(t_stat * k / 4000, 2) / dof))) * any_value(abs(t_stat)) / 12000 AS a FROM t, range(0, 4001) r(k)),
welch AS (SELECT t.*, greatest(0, 1 - 2 * a * exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(dof * pi())) AS p FROM t, area)"""


@query("welch_t_test", G(RES_SQL + f""",
{WELCH_SQL}
SELECT n_a, n_b, round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b, round(t_stat, 6) AS t_stat, round(dof, 4) AS dof,
  round(p, 6) AS p_value, p < {drift.P_THRESHOLD} AS drift FROM welch"""))
def q_welch_t_test(spark, sf_dir):
    """t, Welch-Satterthwaite df, two-sided p-value and drift flag."""
    w = drift.welch_t_test(residuals(spark, sf_dir), "residual", "period", "reference", "current")
    return w.select("n_a", "n_b", *[F.round(c, 6).alias(c) for c in ("mean_a", "mean_b", "t_stat")], F.round("dof", 4).alias("dof"),
                    F.round("p_value", 6).alias("p_value"), "drift")


PH_SQL = f"""ref AS (SELECT avg(residual) AS mu FROM r_res WHERE period = 'reference'),
cur AS (SELECT row_number() OVER (ORDER BY date_hour, station_id) - 1 AS idx,
  sum(residual - mu - {drift.PH_DELTA}) OVER (ORDER BY date_hour, station_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s
  FROM r_res, ref WHERE period = 'current'),
ph AS (SELECT idx, s - least(0.0, min(s) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS ph_stat FROM cur),
alarm AS (SELECT coalesce(min(idx) FILTER (ph_stat > {drift.PH_LAMBDA}), -1) AS first_alarm_idx, round(max(ph_stat), 6) AS max_ph_stat FROM ph)"""


@query("page_hinkley", G(RES_SQL + f""",
{PH_SQL}
SELECT *, first_alarm_idx >= 0 AS drift FROM alarm"""))
def q_page_hinkley(spark, sf_dir):
    """Sequential change detection over the current residuals in time order
    (ties broken by station), reference mean from the reference period."""
    r = residuals(spark, sf_dir)
    mu = r.where("period = 'reference'").agg(F.avg("residual")).first()[0]
    return drift.page_hinkley_test(r.where("period = 'current'").select("date_hour", "station_id", "residual"),
                                   "residual", ["date_hour", "station_id"], mu)


VOTE_SQL = f"""ks AS (SELECT * FROM {_ks_sql("r_res", "residual", "period", "reference", "current")}),
{WELCH_SQL},
{PH_SQL},
vote AS (SELECT d_stat AS ks_stat, p_value AS ks_p, drift AS ks_drift, round(t_stat, 6) AS t_stat, round(p, 6) AS t_p,
  p < {drift.P_THRESHOLD} AS t_drift, first_alarm_idx AS ph_alarm_idx, first_alarm_idx >= 0 AS ph_drift,
  CAST(drift AS INTEGER) + CAST(p < {drift.P_THRESHOLD} AS INTEGER) + CAST(first_alarm_idx >= 0 AS INTEGER) AS votes
  FROM ks, welch, alarm)"""


@query("concept_drift_vote", G(RES_SQL + f""",
{VOTE_SQL}
SELECT *, votes >= {drift.MIN_VOTES} AS concept_drift FROM vote"""))
def q_concept_drift_vote(spark, sf_dir):
    v = drift.concept_drift_vote(residuals(spark, sf_dir), "residual", "period", "reference", "current", ["date_hour", "station_id"])
    return v.withColumns({"t_stat": F.round("t_stat", 6), "t_p": F.round("t_p", 6)})


def data_drift(spark, sf_dir) -> DataFrame:
    g = grid(spark, sf_dir).withColumn("period", period())
    return drift.column_drift(g, DRIFT_COLS, DRIFT_CATEGORIES, "period", "reference", "current")


def _js_sql(column: str) -> str:
    return f"""(WITH c AS (SELECT CAST({column} AS VARCHAR) AS v, count(*) FILTER (period = 'reference') AS a,
       count(*) FILTER (period = 'current') AS b FROM dd WHERE period IS NOT NULL GROUP BY 1),
  s AS (SELECT a / sum(a) OVER () AS p, b / sum(b) OVER () AS q FROM c)
  SELECT sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) / 2)) AS d FROM s)"""


DATA_DRIFT_SQL = f"dd AS (SELECT *, {PERIOD_SQL} AS period FROM g_grid),\ndrifts AS (" + "\nUNION ALL\n".join(
    [f"SELECT '{c}' AS column_name, 'numeric' AS kind, d_stat AS stat, p_value, drift FROM "
     + _ks_sql(f"(SELECT CAST({c} AS DOUBLE) AS v, period FROM dd WHERE period IS NOT NULL)", "v", "period", "reference", "current") for c in DRIFT_COLS]
    + [f"SELECT '{c}', 'categorical', round(d, 9), NULL, d >= {drift.JS_THRESHOLD} FROM " + _js_sql(c) for c in DRIFT_CATEGORIES]) + ")"


@query("data_drift", G(DATA_DRIFT_SQL + "\nSELECT * FROM drifts"))
def q_data_drift(spark, sf_dir):
    """Every monitored column between the reference and the current month."""
    d = data_drift(spark, sf_dir)
    return d.withColumns({"stat": F.round("stat", 9), "p_value": F.round("p_value", 6)})


@query("retrain_decision", G(RES_SQL + f""",
{VOTE_SQL},
{DATA_DRIFT_SQL},
{JOIN_SQL[len(RES_SQL):].lstrip(", ").strip()},
gate AS (SELECT coalesce(sqrt(avg(power(actual - prediction, 2))) > {drift.RMSE_THRESHOLD}, FALSE) AS performance_drift FROM j_join)
SELECT data_drift, concept_drift, performance_drift, data_drift OR concept_drift OR performance_drift AS retrain
FROM (SELECT coalesce(bool_or(drift), FALSE) AS data_drift FROM drifts), (SELECT votes >= {drift.MIN_VOTES} AS concept_drift FROM vote), gate"""))
def q_retrain_decision(spark, sf_dir):
    """OR of data drift (any feature), concept drift (vote) and performance."""
    dd = data_drift(spark, sf_dir).agg(F.coalesce(F.bool_or("drift"), F.lit(False)).alias("data_drift"))
    cd = q_concept_drift_vote(spark, sf_dir).select("concept_drift")
    pg = q_performance_gate(spark, sf_dir).select(F.col("retrain").alias("performance_drift"))
    j = with_scalars(with_scalars(dd, cd), pg)  # three 1-row frames
    return j.withColumn("retrain", F.col("data_drift") | F.col("concept_drift") | F.col("performance_drift"))
