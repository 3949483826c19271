"""Registered queries on the star-schema driver tables and on pages /
documents / events: reshaping, set operations, scalar-function jobs, URL
jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgrid.functions import urls
from flowgrid.functions.columns import array_to_text, haversine_distance, right_chars, safe_add, surrogate_key, width_bucket
from flowgrid.functions.dates import datediff_boundaries, date_trunc_ntz, dateadd, last_day_of, weekday_sunday0
from flowgrid.operators import reshape, windows
from flowgrid.plans.adapters import table
from flowgrid.plans.q_mobility import mob
from flowgrid.plans.registry import query, with_adapters
from flowgrid.operators.joins import with_scalars


def T(spark, sf_dir, name) -> DataFrame:
    return table(spark, sf_dir, name)


# --------------------------------------------------------------------------- projections

@query("select_star_except", """SELECT c_custkey AS cust_c_custkey, c_nationkey AS cust_c_nationkey,
  c_acctbal AS cust_c_acctbal, c_mktsegment AS cust_c_mktsegment FROM customer""")
def q_select_star_except(spark, sf_dir):
    return reshape.star(T(spark, sf_dir, "customer"), except_=["C_NAME"], prefix="cust_")


@query("nullcheck", """SELECT p_partkey, nullif(p_name, '') AS p_name, nullif(p_brand, '') AS p_brand,
  nullif(p_type, '') AS p_type, p_size, p_retailprice FROM part""")
def q_nullcheck(spark, sf_dir):
    return reshape.nullcheck(T(spark, sf_dir, "part"))


@query("safe_add", with_adapters("""SELECT id, 0 + coalesce(start_lat, 0) + coalesce(end_lat, 0) AS lat_sum,
  0 + coalesce(start_lng, 0) + coalesce(end_lng, 0) AS lng_sum FROM a_trips"""))
def q_safe_add(spark, sf_dir):
    t = mob(spark, sf_dir)["trips"]
    return t.select("id", safe_add("start_lat", "end_lat").alias("lat_sum"),
                    safe_add("start_lng", "end_lng").alias("lng_sum"))


@query("surrogate_key", """SELECT o_orderkey, md5(concat_ws('-', coalesce(CAST(o_orderkey AS VARCHAR), ''),
  coalesce(CAST(o_custkey AS VARCHAR), ''), coalesce(CAST(o_orderstatus AS VARCHAR), ''))) AS order_sk FROM orders""")
def q_surrogate_key(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    return o.select("o_orderkey", surrogate_key("o_orderkey", "o_custkey", "o_orderstatus").alias("order_sk"))


@query("width_bucket", """WITH s AS (SELECT min(l_extendedprice) AS mn, max(l_extendedprice) AS mx FROM lineitem),
b AS (SELECT CAST(least(ceil((l_extendedprice - mn) / ((mx - mn) / 10)), 11)
             + CASE WHEN (l_extendedprice % ((mx - mn) / 10)) = 0 THEN 1 ELSE 0 END AS INTEGER) AS bucket
      FROM lineitem, s)
SELECT bucket, count(*) AS n FROM b GROUP BY 1""")
def q_width_bucket(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem")
    s = li.agg(F.min("l_extendedprice").alias("mn"), F.max("l_extendedprice").alias("mx"))
    j = with_scalars(li.select("l_extendedprice"), s)  # 1-row statistics
    return j.groupBy(width_bucket("l_extendedprice", "mn", "mx", 10, "edge_mod").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"))


@query("haversine_distance", with_adapters("""SELECT id,
  round(2 * 3961 * asin(sqrt(pow(sin((radians(end_lat) - radians(start_lat)) / 2), 2)
    + cos(radians(start_lat)) * cos(radians(end_lat)) * pow(sin((radians(end_lng) - radians(start_lng)) / 2), 2))), 6) AS dist_mi,
  round(2 * 3961 * asin(sqrt(pow(sin((radians(end_lat) - radians(start_lat)) / 2), 2)
    + cos(radians(start_lat)) * cos(radians(end_lat)) * pow(sin((radians(end_lng) - radians(start_lng)) / 2), 2)))
    * CAST(1.60934 AS DOUBLE), 6) AS dist_km
FROM a_trips WHERE end_lat IS NOT NULL"""))
def q_haversine_distance(spark, sf_dir):
    t = mob(spark, sf_dir)["trips"].where(F.col("end_lat").isNotNull())
    return t.select("id", F.round(haversine_distance("start_lat", "start_lng", "end_lat", "end_lng", "mi"), 6).alias("dist_mi"),
                    F.round(haversine_distance("start_lat", "start_lng", "end_lat", "end_lng", "km"), 6).alias("dist_km"))


# --------------------------------------------------------------------------- reshaping

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("pivot_values", "SELECT o_orderstatus, " + ", ".join(
    f"CAST(sum(CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END) AS BIGINT) AS prio_{p.replace('-', '_').replace(' ', '_')}"
    for p in PRIORITIES) + " FROM orders GROUP BY 1")
def q_pivot_values(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    vals = reshape.distinct_values(o, "o_orderpriority")  # size-checked, data-derived pivot values
    return reshape.pivot_values(o, ["o_orderstatus"], "o_orderpriority", vals, "sum", prefix="prio_")


@query("unpivot_columns", """SELECT c_custkey, field_name, value FROM (
  SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
         CAST(c_mktsegment AS VARCHAR) AS c_mktsegment FROM customer)
UNPIVOT INCLUDE NULLS (value FOR field_name IN (c_nationkey, c_acctbal, c_mktsegment))""")
def q_unpivot_columns(spark, sf_dir):
    return reshape.unpivot(T(spark, sf_dir, "customer"), "string", exclude=["c_custkey"], remove=["c_name"])


@query("column_values", """SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1
ORDER BY n DESC, value LIMIT 3""")
def q_column_values(spark, sf_dir):
    """Top 3 values by frequency (max_records is the feature)."""
    return reshape.column_values(T(spark, sf_dir, "orders"), "o_orderpriority", max_records=3)


@query("listagg", """SELECT o_custkey, string_agg(o_orderstatus, ',' ORDER BY o_orderkey) AS statuses,
  array_to_string(list(o_orderstatus ORDER BY o_orderkey)[1:2], ',') AS first_two,
  array_to_string(list_sort(list(DISTINCT o_orderpriority)), '|') AS priorities
FROM orders GROUP BY 1""")
def q_listagg(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    return o.groupBy("o_custkey").agg(
        reshape.listagg_column("o_orderstatus", ",", ["o_orderkey"]).alias("statuses"),
        reshape.listagg_column("o_orderstatus", ",", ["o_orderkey"], limit_num=2).alias("first_two"),
        reshape.listagg_column("o_orderpriority", "|", distinct=True).alias("priorities"))


@query("bool_or", """SELECT o_custkey, bool_or(o_totalprice > 300000) AS has_big_order FROM orders GROUP BY 1""")
def q_bool_or(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    return o.groupBy("o_custkey").agg(F.bool_or(F.col("o_totalprice") > 300000).alias("has_big_order"))


@query("any_value", """SELECT o.o_custkey, any_value(c.c_nationkey) AS c_nationkey, count(*) AS n_orders
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1""")
def q_any_value(spark, sf_dir):
    """any_value on a column constant within the group (customer nation)."""
    o, c = T(spark, sf_dir, "orders"), T(spark, sf_dir, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    return j.groupBy("o_custkey").agg(F.any_value("c_nationkey").alias("c_nationkey"),
                                      F.count(F.lit(1)).alias("n_orders"))


@query("deduplicate", """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def q_deduplicate(spark, sf_dir):
    """Newest order per customer, as a max_by aggregate (skew-safe)."""
    o = T(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return windows.deduplicate_by_agg(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], descending=True)


# --------------------------------------------------------------------------- set operations

@query("union_all", """SELECT c_custkey AS custkey, 'customer_without_orders' AS side FROM customer
  WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)
UNION ALL SELECT o_custkey, 'order_without_customer' FROM orders WHERE o_totalprice > 200000
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def q_union_all(spark, sf_dir):
    """Customers without a large order, and large orders of customers in debt."""
    c, o = T(spark, sf_dir, "customer"), T(spark, sf_dir, "orders").where("o_totalprice > 200000")
    a = c.join(o, c["c_custkey"] == o["o_custkey"], "left_anti").select(F.col("c_custkey").alias("custkey"),
                                                                           F.lit("customer_without_orders").alias("side"))
    paid = c.where("c_acctbal > 0")
    b = o.join(paid, o["o_custkey"] == paid["c_custkey"], "left_anti").select(F.col("o_custkey").alias("custkey"),
                                                                                 F.lit("order_without_customer").alias("side"))
    return a.unionByName(b)


@query("except_distinct", """SELECT o_custkey AS custkey FROM orders
EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0""")
def q_except_distinct(spark, sf_dir):
    a = T(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"))
    b = T(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("custkey"))
    return reshape.except_distinct(a, b)


@query("intersect_distinct", """SELECT o_custkey AS custkey FROM orders
INTERSECT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'""")
def q_intersect_distinct(spark, sf_dir):
    a = T(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"))
    b = T(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("custkey"))
    return reshape.intersect_distinct(a, b)


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def q_distinct_rows(spark, sf_dir):
    return T(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()


UNION_REL_SQL = """SELECT 'orders' AS _source_relation, o_orderkey AS order_key, o_totalprice AS amount,
  o_orderdate AS event_date, CAST(NULL AS DOUBLE) AS quantity FROM orders
UNION ALL SELECT 'lineitem', l_orderkey, l_extendedprice, l_shipdate, l_quantity FROM lineitem"""


def _rel_orders(spark, sf_dir):
    return T(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("amount"),
                                            F.col("o_orderdate").alias("event_date"))


def _rel_lineitem(spark, sf_dir):
    return T(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"),
                                              F.col("l_extendedprice").alias("amount"),
                                              F.col("l_shipdate").alias("event_date"),
                                              F.col("l_quantity").alias("quantity"))


@query("union_relations", UNION_REL_SQL)
def q_union_relations(spark, sf_dir):
    return reshape.union_relations({"orders": _rel_orders(spark, sf_dir), "lineitem": _rel_lineitem(spark, sf_dir)})


@query("union_by_pattern", UNION_REL_SQL)
def q_union_by_pattern(spark, sf_dir):
    """Registers the relations as temp views fgrel_<name>, then unions every
    catalog view matching ``fgrel_%`` except ``fgrel_customer``."""
    _rel_orders(spark, sf_dir).createOrReplaceTempView("fgrel_orders")
    _rel_lineitem(spark, sf_dir).createOrReplaceTempView("fgrel_lineitem")
    T(spark, sf_dir, "customer").createOrReplaceTempView("fgrel_customer")
    rels = reshape.relations_by_pattern(spark, "fgrel_%", exclude="fgrel_customer")
    named = {k.replace("fgrel_", ""): v for k, v in sorted(rels.items(), key=lambda kv: kv[0] != "fgrel_orders")}
    return reshape.union_relations(named)


@query("concat_files", "SELECT event_id, event_type, value FROM events")
def q_concat_files(spark, sf_dir):
    """Stack many files: events are written as one CSV folder per event type
    (into the shared scratch folder) and read back with one multi-file scan."""
    from flowgrid.session import scratch_path
    path = scratch_path(spark, "events-csv")
    T(spark, sf_dir, "events").select("event_id", "event_type", "value").write.partitionBy("event_type") \
        .option("header", True).csv(path)
    return spark.read.schema("event_id LONG, value DOUBLE, event_type STRING").option("header", True) \
        .csv(path).select("event_id", "event_type", "value")


# --------------------------------------------------------------------------- scalar function jobs

@query("fn_datediff", """SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS order_month, count(*) AS n_lines,
  CAST(sum(date_diff('day', o.o_orderdate, l.l_shipdate)) AS BIGINT) AS sum_days,
  CAST(sum((CAST(date_trunc('week', l.l_shipdate) AS DATE) - CAST(date_trunc('week', o.o_orderdate) AS DATE)) // 7) AS BIGINT) AS sum_weeks,
  CAST(sum(date_diff('month', o.o_orderdate, l.l_shipdate)) AS BIGINT) AS sum_months
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY 1""")
def q_fn_datediff(spark, sf_dir):
    o, li = T(spark, sf_dir, "orders"), T(spark, sf_dir, "lineitem")
    j = o.join(li, o["o_orderkey"] == li["l_orderkey"])
    return j.groupBy(F.to_date(date_trunc_ntz("month", "o_orderdate")).alias("order_month")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(datediff_boundaries("o_orderdate", "l_shipdate", "day")).cast("long").alias("sum_days"),
        F.sum(datediff_boundaries("o_orderdate", "l_shipdate", "week")).cast("long").alias("sum_weeks"),
        F.sum(datediff_boundaries("o_orderdate", "l_shipdate", "month")).cast("long").alias("sum_months"))


@query("fn_dateadd", """SELECT o.o_orderpriority, count(*) AS n_late FROM orders o JOIN lineitem l
  ON o.o_orderkey = l.l_orderkey WHERE l.l_shipdate > o.o_orderdate + INTERVAL 2 MONTH GROUP BY 1""")
def q_fn_dateadd(spark, sf_dir):
    o, li = T(spark, sf_dir, "orders"), T(spark, sf_dir, "lineitem")
    j = o.join(li, o["o_orderkey"] == li["l_orderkey"])
    return j.where(F.col("l_shipdate") > dateadd("month", 2, "o_orderdate")).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_late"))


@query("fn_date_trunc", """SELECT date_trunc('month', o_orderdate) AS month_start, count(*) AS n_orders,
  round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1""")
def q_fn_date_trunc(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    return o.groupBy(date_trunc_ntz("month", "o_orderdate").alias("month_start")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))


@query("fn_last_day", """SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start,
  last_day(CAST(date_trunc('quarter', o_orderdate) AS DATE) + INTERVAL 2 MONTH) AS quarter_last_day,
  CAST(date_trunc('year', o_orderdate) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_last_day,
  count(*) AS n_orders FROM orders GROUP BY 1, 2, 3""")
def q_fn_last_day(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    return o.groupBy(F.to_date(date_trunc_ntz("quarter", "o_orderdate")).alias("quarter_start"),
                     last_day_of("quarter", "o_orderdate").alias("quarter_last_day"),
                     last_day_of("year", "o_orderdate").alias("year_last_day")).agg(
        F.count(F.lit(1)).alias("n_orders"))


@query("fn_extract", """SELECT CAST(weekofyear(o_orderdate) AS INTEGER) AS iso_week,
  CAST(dayofweek(o_orderdate) AS INTEGER) AS dow, CAST(hour(o_orderdate) AS INTEGER) AS hour,
  CAST(extract(epoch FROM o_orderdate) AS BIGINT) // 86400 % 7 AS epoch_day_mod7, count(*) AS n_orders
FROM orders GROUP BY 1, 2, 3, 4""")
def q_fn_extract(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    epoch_days = F.unix_date(F.to_date("o_orderdate")).cast("long")
    return o.groupBy(F.weekofyear("o_orderdate").alias("iso_week"), weekday_sunday0("o_orderdate").alias("dow"),
                     F.hour("o_orderdate").alias("hour"), F.pmod(epoch_days, F.lit(7)).alias("epoch_day_mod7")).agg(
        F.count(F.lit(1)).alias("n_orders"))


@query("fn_split_part", """SELECT split_part(p_type, ' ', 1) AS type_1, split_part(p_type, ' ', 2) AS type_2,
  split_part(p_type, ' ', -1) AS type_last, split_part(p_brand, '#', 2) AS brand_no, count(*) AS n_parts
FROM part GROUP BY 1, 2, 3, 4""")
def q_fn_split_part(spark, sf_dir):
    p = T(spark, sf_dir, "part")
    sp = lambda c, d, i: F.split_part(F.col(c), F.lit(d), F.lit(i))
    return p.groupBy(sp("p_type", " ", 1).alias("type_1"), sp("p_type", " ", 2).alias("type_2"),
                     sp("p_type", " ", -1).alias("type_last"), sp("p_brand", "#", 2).alias("brand_no")).agg(
        F.count(F.lit(1)).alias("n_parts"))


@query("fn_right", """SELECT right(p_brand, 2) AS brand_suffix, right(p_brand, -6) AS brand_tail, count(*) AS n_parts
FROM part GROUP BY 1, 2""")
def q_fn_right(spark, sf_dir):
    p = T(spark, sf_dir, "part")
    return p.groupBy(right_chars("p_brand", 2).alias("brand_suffix"), right_chars("p_brand", -6).alias("brand_tail")).agg(
        F.count(F.lit(1)).alias("n_parts"))


@query("fn_position_length_replace_concat", """SELECT lang, upper(lang) || ':' || replace(source, 'src', 'source-') AS label,
  count(*) AS n_docs, avg(length(text)) AS mean_length,
  avg(CASE WHEN position('the' IN text) > 0 THEN 1 ELSE 0 END) AS share_with_the
FROM documents GROUP BY 1, 2""")
def q_fn_position_length_replace_concat(spark, sf_dir):
    d = T(spark, sf_dir, "documents")
    label = F.concat(F.upper("lang"), F.lit(":"), F.replace("source", F.lit("src"), F.lit("source-")))
    return d.groupBy("lang", label.alias("label")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.avg(F.length("text")).alias("mean_length"),
        F.avg(F.when(F.position(F.lit("the"), F.col("text")) > 0, 1).otherwise(0)).alias("share_with_the"))


@query("fn_hash", """SELECT substr(md5(CAST(c_custkey AS VARCHAR)), 1, 1) AS bucket, count(*) AS n_customers
FROM customer GROUP BY 1""")
def q_fn_hash(spark, sf_dir):
    c = T(spark, sf_dir, "customer")
    return c.groupBy(F.substring(F.md5(F.col("c_custkey").cast("string")), 1, 1).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_customers"))


@query("fn_safe_cast", """SELECT event_type, count(*) AS n,
  count(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)) AS n_int,
  count(TRY_CAST(event_type AS INTEGER)) AS n_type_int FROM events GROUP BY 1""")
def q_fn_safe_cast(spark, sf_dir):
    e = T(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.get_json_object("props", "$.k").try_cast("int")).alias("n_int"),
        F.count(F.col("event_type").try_cast("int")).alias("n_type_int"))


@query("fn_bool_text", """SELECT CAST(value > 50 AS VARCHAR) AS flag_text, count(*) AS n FROM events GROUP BY 1""")
def q_fn_bool_text(spark, sf_dir):
    e = T(spark, sf_dir, "events")
    return e.groupBy((F.col("value") > 50).cast("string").alias("flag_text")).agg(F.count(F.lit(1)).alias("n"))




@query("fn_array", """SELECT line_text, count(*) AS n_orders FROM (
  SELECT '[' || array_to_string(list_concat(list_append(list_sort(list(l_linenumber)), 0), [99]), ',') || ']' AS line_text
  FROM lineitem GROUP BY l_orderkey) GROUP BY 1""")
def q_fn_array(spark, sf_dir):
    """Per order: sorted line numbers, appended 0, concatenated [99], as text;
    orders counted per text (arrays are bounded by lines per order)."""
    li = T(spark, sf_dir, "lineitem")
    arr = F.concat(F.array_append(F.array_sort(F.collect_list("l_linenumber")), F.lit(0)), F.array(F.lit(99)))
    per = li.groupBy("l_orderkey").agg(array_to_text(arr).alias("line_text"))
    return per.groupBy("line_text").agg(F.count(F.lit(1)).alias("n_orders"))


@query("fn_math", """SELECT l_returnflag, round(sum(l_extendedprice * (1 - l_discount)), 2) AS disc_price,
  round(avg(power(l_quantity, 2)), 6) AS mean_sq_qty, round(avg(sqrt(l_quantity)), 6) AS mean_sqrt_qty,
  max(abs(l_tax - 0.04)) AS max_tax_dev, CAST(sum(ceil(l_quantity / 7)) AS BIGINT) AS sum_ceil_weeks,
  CAST(sum(CAST(l_quantity AS BIGINT) % 5) AS BIGINT) AS sum_mod5, max(greatest(l_tax, l_discount)) AS max_rate
FROM lineitem GROUP BY 1""")
def q_fn_math(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag").agg(
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("disc_price"),
        F.round(F.avg(F.pow("l_quantity", 2)), 6).alias("mean_sq_qty"),
        F.round(F.avg(F.sqrt("l_quantity")), 6).alias("mean_sqrt_qty"),
        F.max(F.abs(F.col("l_tax") - 0.04)).alias("max_tax_dev"),
        F.sum(F.ceil(F.col("l_quantity") / 7)).cast("long").alias("sum_ceil_weeks"),
        F.sum(F.col("l_quantity").cast("long") % 5).cast("long").alias("sum_mod5"),
        F.max(F.greatest("l_tax", "l_discount")).alias("max_rate"))


# --------------------------------------------------------------------------- URL jobs

HOST_SQL = ("split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), "
            "'/', 1), '?', 1)")
STRIP_SQL = "replace(replace(url, 'http://', ''), 'https://', '')"
PATH_SQL = (f"split_part(right({STRIP_SQL}, CAST(length({STRIP_SQL}) - coalesce(nullif(position('/' IN {STRIP_SQL}), 0), "
            f"position('?' IN {STRIP_SQL}) - 1) AS INTEGER)), '?', 1)")


@query("url_host_profile", f"""SELECT {HOST_SQL} AS host, count(*) AS n_pages,
  round(count(*) * 100.0 / (SELECT count(*) FROM pages), 6) AS pct_pages FROM pages GROUP BY 1""")
def q_url_host_profile(spark, sf_dir):
    p = T(spark, sf_dir, "pages")
    g = p.groupBy(urls.url_host("url").alias("host")).agg(F.count(F.lit(1)).alias("n_pages"))
    total = p.agg(F.count(F.lit(1)).alias("_t"))
    return with_scalars(g, total).select(
        "host", "n_pages", F.round(F.col("n_pages") * 100.0 / F.col("_t"), 6).alias("pct_pages"))


@query("url_path_profile", f"SELECT {PATH_SQL} AS path, count(*) AS n_pages FROM pages GROUP BY 1")
def q_url_path_profile(spark, sf_dir):
    p = T(spark, sf_dir, "pages")
    return p.groupBy(urls.url_path("url").alias("path")).agg(F.count(F.lit(1)).alias("n_pages"))


@query("url_parameter_profile", """SELECT nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page,
  nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS utm_source, count(*) AS n_pages
FROM pages GROUP BY 1, 2""")
def q_url_parameter_profile(spark, sf_dir):
    p = T(spark, sf_dir, "pages")
    return p.groupBy(urls.url_parameter("url", "page").alias("page"),
                     urls.url_parameter("url", "utm_source").alias("utm_source")).agg(F.count(F.lit(1)).alias("n_pages"))
