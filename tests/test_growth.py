"""Steps that must grow no faster than their input: joins of tables that are
small on disk, categories by the thousand, sums over frames, the dense grid."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowgrid.functions.columns import normalize_station_id
from flowgrid.operators import clean, drift, learn, scan
from flowgrid.plans import adapters, q_drift, q_grid, q_io, q_learn


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """A folder with a few events in January and February 2024, a quarter of an hour apart."""
    d = str(tmp_path_factory.mktemp("feed"))
    t0 = dt.datetime(2024, 1, 3)
    rows = [(i, t0 + dt.timedelta(minutes=15 * (i // 8)), i % 8, "click", float(i % 30), "{}") for i in range(1600)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .coalesce(1).write.parquet(f"{d}/events.parquet")
    return d


def broadcasts(df) -> int:
    return df._jdf.queryExecution().sparkPlan().toString().count("BroadcastHashJoin")


def test_requests_meet_the_grid_without_a_broadcast_of_it(spark, feed):
    df = q_io.q_recommend_action(spark, feed)
    assert broadcasts(df) == 1  # the stations, counted before
    assert df.count() == 1600


def test_joins_of_grid_rows_do_not_trust_the_file_size(spark, feed):
    for q in (q_drift.q_join_actuals_predictions_exact, q_drift.q_join_actuals_predictions, q_grid.q_anti_missing_rows):
        df = q(spark, feed)
        assert broadcasts(df) == 0
        assert df.count() > 0


def test_vectors_are_read_as_stored(spark):
    from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
    from pyspark.sql import types as T
    rows = [(0, SparseVector(4, {1: 1.0, 3: 2.5})), (1, DenseVector([0.0, 7.0, -1.0])), (2, SparseVector(5, [], [])),
            (3, SparseVector(4, [0, 2], [0.0, 3.0])), (4, SparseVector(10 ** 9, {999_999_999: 1.0}))]  # the last fits nowhere densely
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("x", VectorUDT())])
    df = spark.createDataFrame(rows, schema)
    got = df.select("k", learn.vector_width("x"), learn.vector_slots("x")).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(0, 4, "1:1.0,3:2.5"), (1, 3, "1:7.0,2:-1.0"), (2, 5, ""), (3, 4, "2:3.0"),
                                       (4, 10 ** 9, "999999999:1.0")]


def test_features_are_never_made_dense(spark, feed):
    df = q_learn.q_feature_pipeline(spark, feed)
    assert "vector_to_array" not in df._jdf.queryExecution().analyzed().toString()
    assert df.where("n_nonzero > n_features").count() == 0 and df.count() > 0


def test_fanout_metrics_deal_each_side_once(spark):
    rows = [(k, float((i * 7 + k) % 5), float(i % 3)) for k in range(6) for i in range(4)]
    df = spark.createDataFrame(rows + [(None, 3.0, 1.0), (9, None, 2.0), (9, 4.0, None)], "k int, y double, p double")
    a, p = df.where("k is null or k <> 2").select("k", "y"), df.where("k is null or k <> 3").select("k", "p")
    got = drift.fanout_metrics(a, p, ["k"], "y", "p", digits=6)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and plan.count("LocalTableScan") + plan.count("Scan ExistingRDD") == 2
    pairs = a.join(p.where("p is not null"), "k")
    want = drift.regression_metrics(pairs.where("y is not null"), "y", "p", digits=6).first()
    same = drift.fanout_metrics(a.where("y is not null"), p, ["k"], "y", "p", digits=6).first()
    assert tuple(same) == tuple(want)
    assert got.first().n == pairs.count()
    # one actual in every pair, others without a prediction: no spread to explain
    one = spark.createDataFrame([(k, 0.1) for k in (1, 2, 3) for _ in range(k)] + [(7, 50.0)], "k int, y double")
    pr = spark.createDataFrame([(1, 1.0), (2, 2.0), (2, 3.0), (3, 0.5)], "k int, p double")
    assert drift.fanout_metrics(one, pr, ["k"], "y", "p").first().r2 is None


def test_saved_and_kept_predictions_meet_without_a_broadcast(spark, feed, monkeypatch):
    rows = learn.as_training_frame(q_grid.grid(spark, feed))
    fill = learn.impute_values(rows)
    model = learn.fit_pipeline(learn.impute(rows, fill), "linear", maxIter=1)
    monkeypatch.setattr(q_learn, "final_model", lambda *_: (model, fill))
    df = q_learn.q_final_model_save_load(spark, feed)
    assert df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 0
    assert df.first().max_abs_diff == 0.0
    scored = q_learn.q_batch_forecast(spark, feed)
    assert "SortMergeJoin" in scored._jdf.queryExecution().sparkPlan().toString() and scored.count() == 1600


def test_trips_are_ordered_with_one_shuffle(spark, feed, monkeypatch):
    written = []
    monkeypatch.setattr(scan, "materialize", lambda df, name, keep=scan.materialize: written.append(name) or keep(df, name))
    t = adapters.trips(adapters.table(spark, feed, "events"))
    assert written == ["large-groups"]  # no user has many events, so no ordered copy of them is written
    assert t._jdf.queryExecution().sparkPlan().toString().count("Exchange") == 1 and t.count() == 1600


def test_large_groups_are_split_and_others_are_not(spark, monkeypatch):
    rows = [(None if k == 2 else k, (i * 37) % 101, i) for k, n in ((0, 90), (1, 7), (2, 60), (3, 1), (4, 20)) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, v int, id int")
    split = []
    monkeypatch.setattr(scan, "_lead_by_range", lambda d, *a, f=scan._lead_by_range: split.append(d.count()) or f(d, *a))
    want = sorted(map(tuple, scan.lead_in_order(df, ["k"], ["v", "id"], {"id": "nid"}, skew_safe=False).collect()), key=str)
    for most, large in ((20, 150), (89, 90), (90, None)):
        split.clear()
        got = scan.lead_in_order(df, ["k"], ["v", "id"], {"id": "nid"}, n=5, group_rows=most)
        assert sorted(map(tuple, got.collect()), key=str) == want
        assert split == ([large] if large else [])


def test_trips_out_of_range_are_not_looked_up(spark, feed):
    trips = adapters.trips(adapters.table(spark, feed, "events"))
    plan = clean.clean_trips(trips, adapters.stations(adapters.table(spark, feed, "events")), trims=False) \
        ._jdf.queryExecution().analyzed().toString()
    assert plan.index("LeftSemi") < plan.index("substring_index") < plan.index("duration_minutes#", plan.index("substring_index"))


def test_station_ids_are_padded_as_before(spark):
    ids = {"5980.1": "5980.10", "5980.10": "5980.10", "5980": "5980", ".5": ".50", "5980.": "5980.", "a..b": "a..b",
           "1.2.3": "1.20", "1.23.4": "1.23.4", "": "", ".": ".", None: None}
    df = spark.createDataFrame([(k, v) for k, v in ids.items()], "k string, v string")
    assert df.where(~normalize_station_id("k").eqNullSafe(F.col("v"))).count() == 0
