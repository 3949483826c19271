"""Registered data-quality checks, ordered/range operators and series
generators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgrid.operators import quality as Q
from flowgrid.operators import series, windows
from flowgrid.operators.scan import lead_in_order
from flowgrid.plans import sqlparts as S
from flowgrid.plans.q_grid import G, grid, net
from flowgrid.plans.q_mobility import mob, valid_trips, weather_hourly
from flowgrid.plans.q_star import T
from flowgrid.plans.registry import query, with_adapters

# --------------------------------------------------------------------------- single-table checks


@query("dq_not_null", with_adapters("SELECT id, rideable_type FROM a_trips WHERE member_casual IS NULL"))
def q_dq_not_null(spark, sf_dir):
    return Q.not_null(mob(spark, sf_dir)["trips"], "member_casual").select("id", "rideable_type")


@query("dq_unique", with_adapters(S.WEATHER + """
SELECT date_hour AS unique_field, count(*) AS n_records FROM w_base WHERE date_hour IS NOT NULL
GROUP BY 1 HAVING count(*) > 1"""))
def q_dq_unique(spark, sf_dir):
    from flowgrid.functions.columns import hour_floor
    w = mob(spark, sf_dir)["weather"].select(hour_floor("time").alias("date_hour"))
    return Q.unique(w, "date_hour")


@query("dq_unique_combination", """SELECT o_custkey, o_orderstatus, count(*) AS n_records FROM orders
GROUP BY 1, 2 HAVING count(*) > 1""")
def q_dq_unique_combination(spark, sf_dir):
    return Q.unique_combination(T(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus"])


@query("dq_unique_date_hour", with_adapters(S.VALID_TRIPS + """
SELECT start_station_id, CAST(started_at AS DATE) AS date, CAST(hour(started_at) AS INTEGER) AS hour,
  count(*) AS n_records FROM c_valid GROUP BY 1, 2, 3 HAVING count(*) > 1"""))
def q_dq_unique_date_hour(spark, sf_dir):
    t = valid_trips(spark, sf_dir).select("start_station_id", F.to_date("started_at").alias("date"),
                                          F.hour("started_at").alias("hour"))
    return Q.unique_combination(t, ["start_station_id", "date", "hour"])


@query("dq_accepted_values", with_adapters("""SELECT rideable_type AS value_field, count(*) AS n_records FROM a_trips
GROUP BY 1 HAVING rideable_type NOT IN ('view', 'click', 'purchase')"""))
def q_dq_accepted_values(spark, sf_dir):
    return Q.accepted_values(mob(spark, sf_dir)["trips"], "rideable_type", ["view", "click", "purchase"])


@query("dq_not_accepted_values", "SELECT DISTINCT event_type AS value_field FROM events WHERE event_type IN ('error')")
def q_dq_not_accepted_values(spark, sf_dir):
    return Q.not_accepted_values(T(spark, sf_dir, "events"), "event_type", ["error"])


@query("dq_expression_is_true", """SELECT l_orderkey, l_linenumber, l_discount FROM lineitem
WHERE l_returnflag <> 'N' AND NOT (l_discount <= 0.08)""")
def q_dq_expression_is_true(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem")
    return Q.expression_is_true(li, "<= 0.08", column="l_discount", where="l_returnflag <> 'N'").select(
        "l_orderkey", "l_linenumber", "l_discount")


@query("dq_accepted_range", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE NOT (l_quantity >= 1) OR NOT (l_quantity <= 45)""")
def q_dq_accepted_range(spark, sf_dir):
    return Q.accepted_range(T(spark, sf_dir, "lineitem"), "l_quantity", 1, 45).select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query("dq_at_least_one", """SELECT c_nationkey, c_mktsegment, count(CASE WHEN c_acctbal < 0 THEN 1 END) AS filler_column
FROM customer GROUP BY 1, 2 HAVING count(CASE WHEN c_acctbal < 0 THEN 1 END) = 0""")
def q_dq_at_least_one(spark, sf_dir):
    """Nation and segment pairs without any overdrawn account."""
    c = T(spark, sf_dir, "customer").withColumn("overdrawn", F.when(F.col("c_acctbal") < 0, F.col("c_acctbal")))
    return Q.at_least_one(c, "overdrawn", ["c_nationkey", "c_mktsegment"])


@query("dq_not_constant", """SELECT o_custkey, count(DISTINCT o_orderstatus) AS filler_column FROM orders
GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 1""")
def q_dq_not_constant(spark, sf_dir):
    """Customers whose orders all have one status."""
    return Q.not_constant(T(spark, sf_dir, "orders"), "o_orderstatus", ["o_custkey"])


@query("dq_not_null_proportion", with_adapters("""SELECT * FROM (
  SELECT CAST(sum(CASE WHEN end_station_id IS NOT NULL THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS not_null_proportion
  FROM a_trips) WHERE not_null_proportion < 0.999 OR not_null_proportion > 1"""))
def q_dq_not_null_proportion(spark, sf_dir):
    return Q.not_null_proportion(mob(spark, sf_dir)["trips"], "end_station_id", 0.999)


@query("dq_recency", """SELECT * FROM (SELECT max(o_orderdate) AS most_recent,
  TIMESTAMP '2010-01-01 00:00:00' - INTERVAL 30 DAY AS threshold FROM orders)
WHERE most_recent IS NULL OR most_recent < threshold""")
def q_dq_recency(spark, sf_dir):
    return Q.recency(T(spark, sf_dir, "orders"), "o_orderdate", "day", 30, "2010-01-01 00:00:00")


@query("dq_no_empty_string", """SELECT conv_id, turn FROM conversations
WHERE regexp_extract(text, '[0-9]+') = ''""")
def q_dq_no_empty_string(spark, sf_dir):
    """Turns whose first number (as text) is empty."""
    c = T(spark, sf_dir, "conversations").withColumn("number", F.regexp_extract("text", "[0-9]+", 0))
    return Q.no_empty_string(c, "number").select("conv_id", "turn")


@query("dq_assert_equal", G("""SELECT station_id, date_hour FROM g_grid
WHERE NOT (net_flow = num_bikes_taken)"""))
def q_dq_assert_equal(spark, sf_dir):
    """Hours in which the net flow is not the pickups alone."""
    g = grid(spark, sf_dir).withColumn("_exp", F.col("num_bikes_taken"))
    return Q.assert_equal(g, "net_flow", "_exp").select("station_id", "date_hour")


# --------------------------------------------------------------------------- two-table checks

@query("dq_equal_rowcount", """SELECT * FROM (SELECT a.count_a, b.count_b, abs(a.count_a - b.count_b) AS diff_count
FROM (SELECT count(*) AS count_a FROM customer) a, (SELECT count(*) AS count_b FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 250000)) b)
WHERE diff_count > 0""")
def q_dq_equal_rowcount(spark, sf_dir):
    """All customers against those with a large order."""
    large = T(spark, sf_dir, "orders").where("o_totalprice > 250000")
    return Q.equal_rowcount(T(spark, sf_dir, "customer"), large.select("o_custkey").distinct())


@query("dq_fewer_rows_than", """SELECT * FROM (SELECT a.count_our_model, b.count_comparison_model,
  CASE WHEN a.count_our_model >= b.count_comparison_model THEN a.count_our_model - b.count_comparison_model + 1 ELSE 0 END
  AS row_count_delta FROM (SELECT count(*) AS count_our_model FROM customer) a,
  (SELECT count(*) AS count_comparison_model FROM supplier) b) WHERE row_count_delta > 0""")
def q_dq_fewer_rows_than(spark, sf_dir):
    return Q.fewer_rows_than(T(spark, sf_dir, "customer"), T(spark, sf_dir, "supplier"))


@query("dq_equality", """SELECT c_custkey, 'a_minus_b' AS which_diff FROM (
  SELECT c_custkey FROM customer WHERE c_nationkey < 12 EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0)
UNION ALL SELECT c_custkey, 'b_minus_a' FROM (
  SELECT c_custkey FROM customer WHERE c_acctbal > 0 EXCEPT SELECT c_custkey FROM customer WHERE c_nationkey < 12)""")
def q_dq_equality(spark, sf_dir):
    c = T(spark, sf_dir, "customer")
    return Q.equality(c.where("c_nationkey < 12"), c.where("c_acctbal > 0"), ["c_custkey"])


@query("dq_equality_failures", """WITH a AS (SELECT c_custkey FROM customer WHERE c_nationkey < 12),
b AS (SELECT c_custkey FROM customer WHERE c_acctbal > 0),
n AS (SELECT (SELECT count(*) FROM (FROM a EXCEPT FROM b)) AS n_a, (SELECT count(*) FROM (FROM b EXCEPT FROM a)) AS n_b)
SELECT n_a, n_b, n_a + n_b + abs(n_a - n_b) AS failures FROM n""")
def q_dq_equality_failures(spark, sf_dir):
    c = T(spark, sf_dir, "customer")
    return Q.equality_failures(c.where("c_nationkey < 12"), c.where("c_acctbal > 0"), ["c_custkey"])


@query("dq_cardinality_equality", """WITH a AS (SELECT o_custkey AS value_field, count(*) AS n_records FROM orders GROUP BY 1),
b AS (SELECT c_custkey AS value_field, count(*) AS n_records FROM customer GROUP BY 1)
(SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def q_dq_cardinality_equality(spark, sf_dir):
    return Q.cardinality_equality(T(spark, sf_dir, "orders"), "o_custkey", T(spark, sf_dir, "customer"), "c_custkey")


@query("dq_relationships_where", """SELECT l_partkey AS from_field FROM lineitem
WHERE l_quantity > 10 AND l_partkey IS NOT NULL
  AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10 AND p_partkey IS NOT NULL)""")
def q_dq_relationships_where(spark, sf_dir):
    return Q.relationships_where(T(spark, sf_dir, "lineitem"), "l_partkey", T(spark, sf_dir, "part"), "p_partkey",
                                 "l_quantity > 10", "p_size > 10")


@query("dq_flow_consistency", G("""
n_nz AS (SELECT station_id, date_hour, num_bikes_taken, num_bikes_dropped, net_flow FROM f_dedup WHERE net_flow <> 0),
g_nz AS (SELECT station_id, date_hour, num_bikes_taken, num_bikes_dropped, net_flow FROM g_grid WHERE net_flow <> 0 AND day > 1)
SELECT *, 'missing_in_grid' AS issue FROM (SELECT * FROM n_nz EXCEPT SELECT * FROM g_nz)
UNION ALL SELECT *, 'extra_in_grid' FROM (SELECT * FROM g_nz EXCEPT SELECT * FROM n_nz)"""))
def q_dq_flow_consistency(spark, sf_dir):
    """Flows against a grid that lacks the first day of each month."""
    cols = ["station_id", "date_hour", "num_bikes_taken", "num_bikes_dropped", "net_flow"]
    n = net(spark, sf_dir).select(*cols).where("net_flow <> 0")
    g = grid(spark, sf_dir).where("net_flow <> 0 and day > 1").select(*cols)
    return n.subtract(g).withColumn("issue", F.lit("missing_in_grid")).unionByName(
        g.subtract(n).withColumn("issue", F.lit("extra_in_grid")))


@query("dq_sequential_values", G(f"""SELECT station_id, date_hour, previous_date_hour FROM (
  SELECT station_id, date_hour, lag(date_hour) OVER (PARTITION BY station_id ORDER BY date_hour) AS previous_date_hour
  FROM f_dedup) WHERE NOT (date_hour = previous_date_hour + INTERVAL 1 HOUR)"""))
def q_dq_sequential_values(spark, sf_dir):
    """Observed hours of a station that do not follow on each other."""
    n = net(spark, sf_dir).select("station_id", "date_hour")
    return Q.sequential_values(n, "date_hour", 1, "hour", ["station_id"]).select("station_id", "date_hour", "previous_date_hour")


# --------------------------------------------------------------------------- ranges and sequences

SESSIONS_SQL = """sess AS (SELECT user_id, ts AS lower_bound,
  ts + to_minutes(CAST(floor(value) AS INTEGER)) AS upper_bound, event_id FROM events),
ranked AS (SELECT user_id, lower_bound, upper_bound,
  lead(lower_bound) OVER (PARTITION BY user_id ORDER BY lower_bound, upper_bound, event_id) AS next_lower_bound
  FROM sess),
flags AS (SELECT *, coalesce(lower_bound < upper_bound, FALSE) AS lower_bound_within_upper_bound,
  coalesce(next_lower_bound IS NULL OR upper_bound <= next_lower_bound, FALSE) AS upper_bound_fits_next FROM ranked)"""


def sessions(spark, sf_dir) -> DataFrame:
    e = T(spark, sf_dir, "events")
    return e.select("user_id", F.col("ts").alias("lower_bound"),
                    F.timestamp_add("MINUTE", F.floor("value").cast("int"), F.col("ts")).alias("upper_bound"),
                    "event_id")


def range_flags(spark, sf_dir) -> DataFrame:
    """next lower bound per user via the skew-safe ordered lead (a hot user is
    split across range partitions)."""
    s = lead_in_order(sessions(spark, sf_dir), by=["user_id"], order=["lower_bound", "upper_bound", "event_id"],
                      cols={"lower_bound": "next_lower_bound"})
    lo, up, nl = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    return s.select("user_id", "lower_bound", "upper_bound", "next_lower_bound",
                    F.coalesce(lo < up, F.lit(False)).alias("lower_bound_within_upper_bound"),
                    F.coalesce(nl.isNull() | (up <= nl), F.lit(False)).alias("upper_bound_fits_next"))


@query("range_overlap", "WITH " + SESSIONS_SQL + "\nSELECT * FROM flags")
def q_range_overlap(spark, sf_dir):
    return range_flags(spark, sf_dir)


@query("dq_mutually_exclusive_ranges", "WITH " + SESSIONS_SQL + """
SELECT * FROM flags WHERE NOT lower_bound_within_upper_bound OR NOT upper_bound_fits_next""")
def q_dq_mutually_exclusive_ranges(spark, sf_dir):
    f = range_flags(spark, sf_dir)
    return f.where(~F.col("lower_bound_within_upper_bound") | ~F.col("upper_bound_fits_next"))


@query("sequence_gaps", """SELECT o_orderkey, previous_o_orderkey FROM (
  SELECT o_orderkey, lag(o_orderkey) OVER (ORDER BY o_orderkey) AS previous_o_orderkey FROM orders WHERE o_orderstatus = 'O')
WHERE previous_o_orderkey IS NOT NULL AND o_orderkey <> previous_o_orderkey + 1""")
def q_sequence_gaps(spark, sf_dir):
    """Global order without a partition key: successor pairs come from the
    range-partitioned lead, so no single task sees the whole table."""
    o = T(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select("o_orderkey")
    pairs = lead_in_order(o, by=[], order=["o_orderkey"], cols={"o_orderkey": "_next"})
    return pairs.where(F.col("_next").isNotNull() & (F.col("_next") != F.col("o_orderkey") + 1)).select(
        F.col("_next").alias("o_orderkey"), F.col("o_orderkey").alias("previous_o_orderkey"))


@query("forward_fill", with_adapters(S.WEATHER + """,
ff_base AS (SELECT s.date_hour, w.temp, w.coco FROM w_spine s LEFT JOIN w_clean w ON s.date_hour = w.date_hour)
SELECT date_hour,
  last_value(temp IGNORE NULLS) OVER (ORDER BY date_hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS temp,
  last_value(coco IGNORE NULLS) OVER (ORDER BY date_hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS coco
FROM ff_base"""))
def q_forward_fill(spark, sf_dir):
    """Complete hourly timeline with the last known value carried forward
    (global order, range-partitioned scan with a per-partition carry)."""
    wh = weather_hourly(spark, sf_dir)
    base = series.hour_spine(wh).join(wh.select("date_hour", "temp", "coco"), "date_hour", "left")
    return windows.forward_fill_global(base, ["date_hour"], ["temp", "coco"])


@query("date_spine", """WITH b AS (SELECT min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders),
n AS (SELECT s, e, date_diff('month', s, e) AS n FROM b WHERE date_diff('month', s, e) >= 1),
i AS (SELECT s, e, unnest(generate_series(0, n - 1)) AS i FROM n)
SELECT s + to_months(CAST(i AS INTEGER)) AS date_month FROM i WHERE s + to_months(CAST(i AS INTEGER)) <= e""")
def q_date_spine(spark, sf_dir):
    b = T(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e"))
    return series.date_spine(spark, "month", "s", "e", out="date_month", bounds=b)


@query("generate_series", """SELECT generate_series AS generated_number
FROM generate_series(1, (SELECT count(*) FROM orders))""")
def q_generate_series(spark, sf_dir):
    """1..n with n = rows of ``orders`` (grows with the data); ``range`` is
    generated in parallel splits, nothing but n passes through the driver."""
    n = T(spark, sf_dir, "orders").count()
    return series.generate_series(spark, n)


# --------------------------------------------------------------------------- report


@query("dq_report", with_adapters(S.WEATHER + """
SELECT 'dq_not_null' AS check_name, (SELECT count(*) FROM a_trips WHERE member_casual IS NULL) AS failures
UNION ALL SELECT 'dq_unique', (SELECT count(*) FROM (SELECT date_hour FROM w_base WHERE date_hour IS NOT NULL
  GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'dq_accepted_values', (SELECT count(*) FROM (SELECT rideable_type FROM a_trips GROUP BY 1
  HAVING rideable_type NOT IN ('view', 'click', 'purchase')))
UNION ALL SELECT 'dq_accepted_range', (SELECT count(*) FROM lineitem WHERE NOT (l_quantity >= 1) OR NOT (l_quantity <= 45))
UNION ALL SELECT 'dq_not_null_proportion', (SELECT count(*) FROM (SELECT CAST(sum(CASE WHEN end_station_id IS NOT NULL
  THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS p FROM a_trips) WHERE p < 0.999 OR p > 1)
UNION ALL SELECT 'dq_relationships_where', (SELECT count(*) FROM lineitem WHERE l_quantity > 10 AND l_partkey IS NOT NULL
  AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10 AND p_partkey IS NOT NULL))
UNION ALL SELECT 'dq_unique_combination', (SELECT count(*) FROM (SELECT o_custkey, o_orderstatus FROM orders
  GROUP BY 1, 2 HAVING count(*) > 1))""").replace(
    "SELECT 'dq_not_null' AS check_name,", "SELECT *, failures = 0 AS passed FROM (SELECT 'dq_not_null' AS check_name,")
    + ")")
def q_dq_report(spark, sf_dir):
    """One row per check (name, failures, passed): the row checks of a table are
    one aggregate over one scan of it, uniqueness checks one grouped scan."""
    from flowgrid.functions.columns import hour_floor
    trips = Q.row_check_report(mob(spark, sf_dir)["trips"], {
        "dq_not_null": Q.failing(F.col("member_casual").isNull()),
        "dq_accepted_values": Q.failing_values("rideable_type", ["view", "click", "purchase"]),
        "dq_not_null_proportion": Q.failing_proportion("end_station_id", 0.999)})
    li = Q.with_relation(T(spark, sf_dir, "lineitem"), "l_partkey", T(spark, sf_dir, "part").where("p_size > 10"), "p_partkey", "orphan")
    items = Q.row_check_report(li, {
        "dq_accepted_range": Q.failing(~F.col("l_quantity").between(1, 45)),
        "dq_relationships_where": Q.failing((F.col("l_quantity") > 10) & F.col("orphan"))})
    hours = Q.unique_check_report(mob(spark, sf_dir)["weather"].select(hour_floor("time").alias("date_hour")), {"dq_unique": ["date_hour"]})
    orders = Q.unique_check_report(T(spark, sf_dir, "orders"), {"dq_unique_combination": ["o_custkey", "o_orderstatus"]})
    return Q.fused_report([trips, items, hours, orders])
