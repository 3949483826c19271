"""Literal cases of the reference's macro tests (hand-made frames)."""

import datetime as dt

from pyspark.sql import functions as F

from flowgrid.functions import columns as C
from flowgrid.functions import dates as D
from flowgrid.operators import quality as Q
from flowgrid.operators import reshape as R
from flowgrid.sources import sinks


def test_insert_by_period_first_load_and_resume(spark, tmp_path):
    t = dt.datetime
    rows = [(1, t(2018, 1, 1)), (2, t(2018, 1, 1, 0, 0, 1)), (3, t(2018, 2, 14)), (4, t(2018, 3, 31, 23)),
            (5, t(2018, 4, 1)), (6, t(2018, 5, 31, 23, 59, 59)), (7, t(2018, 6, 1))]
    src = spark.createDataFrame(rows, "id int, created_at timestamp_ntz")
    path = str(tmp_path / "target")
    out = sinks.backfill_by_period(src.where("id <= 3"), path, "created_at", "2018-06-01", "month",
                                   start="2018-01-01")
    assert sorted(r.id for r in out.collect()) == [2, 3]      # a row exactly at the start is not loaded
    out = sinks.backfill_by_period(src, path, "created_at", "2018-06-01", "month", start="2018-01-01")
    assert sorted(r.id for r in out.collect()) == [2, 3, 4, 5, 6]  # resumes after the newest row; stop excluded
    again = sinks.backfill_by_period(src, path, "created_at", "2018-06-01", "month", start="2018-01-01")
    assert again.count() == 5                                     # a rerun loads nothing twice
    assert {str(r.period) for r in again.collect()} == {"2018-01-01", "2018-02-01", "2018-03-01", "2018-04-01",
                                                    "2018-05-01"}


def test_any_value_constant_per_group(spark):
    rows = [(1, "abc", "dbt"), (2, "abc", "dbt"), (3, "jkl", "dbt"), (4, "jkl", "dbt"), (5, "jkl", "dbt"),
            (6, "xyz", "test")]
    df = spark.createDataFrame(rows, "id int, key_name string, static_col string")
    got = sorted(tuple(r) for r in df.groupBy("key_name").agg(F.any_value("static_col"), F.count("id")).collect())
    assert got == [("abc", "dbt", 2), ("jkl", "dbt", 3), ("xyz", "test", 1)]


def test_listagg_variants(spark):
    rows = [(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "1", 3), (2, "2", 2), (2, "3", 1),
            (3, "g", 1), (3, "g", 2), (3, "g", 3)]
    df = spark.createDataFrame(rows, "group_col int, string_text string, order_col int")

    def agg(**kw):
        return {r[0]: r[1] for r in R.listagg(df, ["group_col"], "string_text", **kw).collect()}
    assert agg(delim="_|_", order_by=["order_col"]) == {1: "a_|_b_|_c", 2: "3_|_2_|_1", 3: "g_|_g_|_g"}
    assert agg(delim="_|_", order_by=["order_col"], limit_num=2) == {1: "a_|_b", 2: "3_|_2", 3: "g_|_g"}
    assert agg(distinct=True)[3] == "g"
    assert agg(delim=", ")[3] == "g, g, g"
    assert agg()[3] == "g,g,g"


def test_expression_is_true_forms(spark):
    df = spark.createDataFrame([(0.5, 0.5), (0.0, 1.0), (0.25, 0.5)], "col_a double, col_b double")
    assert Q.expression_is_true(df, "col_a + col_b = 1").count() == 1               # 0.25 + 0.5
    assert Q.expression_is_true(df, "+ col_b = 1", column="col_a").count() == 1
    assert Q.expression_is_true(df, "col_a = 0.5", where="col_b = 0.5").count() == 1  # 0.25 row
    assert Q.expression_is_true(df, "= 0.5", column="col_b", where="col_a = 0.5").count() == 0


def test_bool_text_array_text_split_part(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, my_bool boolean")
    assert [r[0] for r in df.orderBy("id").select(C.bool_text("my_bool")).collect()] == ["true", "false", None]
    arr = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert arr.select(C.array_to_text(F.array("a", "b", "c"))).first()[0] == "[1,2,3]"
    assert arr.select(C.array_to_text(F.array().cast("array<int>"))).first()[0] == "[]"
    s = spark.createDataFrame([("a,b,c", ",")], "parts string, split_on string")
    got = s.select(*[F.split_part("parts", "split_on", F.lit(i)) for i in (1, 2, 3, -1)]).first()
    assert tuple(got) == ("a", "b", "c", "c")


def test_unpivot_keeps_and_removes_and_texts_booleans(spark):
    df = spark.createDataFrame([(1, "2017-01-01", "name", 5, True)],
                               "customer_id int, created_at string, name string, status int, active boolean")
    out = R.unpivot(df, exclude=["customer_id", "created_at"], remove=["name"])
    got = sorted((r.field_name, r.value) for r in out.collect())
    assert got == [("active", "true"), ("status", "5")]
    assert out.columns == ["customer_id", "created_at", "field_name", "value"]


def test_date_trunc_day_and_month(spark):
    df = spark.createDataFrame([("2018-01-05 12:00:00",)], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("updated_at"))
    r = df.select(F.to_date(D.date_trunc_ntz("day", "updated_at")).alias("d"),
                  F.to_date(D.date_trunc_ntz("month", "updated_at")).alias("m")).first()
    assert (r.d, r.m) == (dt.date(2018, 1, 5), dt.date(2018, 1, 1))


def test_sorted_export_splits_a_hot_sort_value(spark, tmp_path):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 50).alias("k"),
                                  F.col("id").alias("v"))
    out = sinks.write_parquet(df, str(tmp_path / "export"), sort_by=["k"], n_partitions=6)
    assert out.count() == 9000
    f = out.select("k", F.input_file_name().alias("f"))
    assert f.where("k = 5").select("f").distinct().count() > 1      # the hot value is spread over files
    ranges = {r.f: (r.lo, r.hi) for r in f.groupBy("f").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect()}
    spans = sorted(ranges.values())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))      # files hold contiguous, ordered key ranges


def test_bounded_broadcast_checks_rows_and_bytes(spark):
    from flowgrid.operators import joins as J

    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    df = spark.range(1000).selectExpr("id", "cast(id as string) AS s")
    assert J.row_width(df.schema) == 28
    assert hinted(J.bounded_broadcast(df, max_rows=1000, max_bytes=28_000))
    assert not hinted(J.bounded_broadcast(df, max_rows=999, max_bytes=10**9))     # too many rows
    assert not hinted(J.bounded_broadcast(df, max_rows=10**6, max_bytes=27_999))   # too many bytes
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")                # broadcasting disabled
        assert not hinted(J.bounded_broadcast(df))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_with_scalars_attaches_statistics_without_a_join(spark):
    from flowgrid.operators import joins as J
    df = spark.range(100).select((F.col("id") % 10).alias("x"))
    stats = df.agg(F.avg("x").alias("mean_x"), F.max("x").alias("max_x"))
    out = J.with_scalars(df, stats)
    assert out.columns == ["x", "mean_x", "max_x"]
    assert {(r.mean_x, r.max_x) for r in out.collect()} == {(4.5, 9)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan
