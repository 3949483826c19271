"""Readers and sinks on small files written here."""

import datetime as dt
import os

from pyspark.sql import functions as F

from flowgrid.sources import readers, sinks

HEAD = "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id," \
       "start_lat,start_lng,end_lat,end_lng,member_casual"
ROW = "r1,classic,2024-01-05 10:00:00,2024-01-05 10:20:00,S,101.10,E,102.1,40.7,-74.0,40.8,-74.1,member"


def test_trips_are_read_by_header_name(spark, tmp_path):
    head, row = HEAD.split(","), ROW.split(",")
    turned = [head[-1], *head[:-1], "extra"], [row[-1], *row[:-1], "junk"]
    fewer = [c for c in head if c != "end_lat"], [v for c, v in zip(head, row) if c != "end_lat"]
    for i, (h, r) in enumerate([(head, row), turned, fewer, (head, row)]):
        (tmp_path / f"20240{i + 1}-bike-tripdata_{i}.csv").write_text(",".join(h) + "\n" + ",".join(r) + "\n")
    (tmp_path / "other.csv").write_text("a\n1\n")
    (tmp_path / "202409-bike-tripdata_9.csv").write_text("")
    got = readers.read_trips(spark, str(tmp_path)).collect()
    assert len(got) == 4
    for r in got:
        assert (r.started_at, r.start_station_id, r.member_casual, r.rideable_type, r.end_lng) == \
            (dt.datetime(2024, 1, 5, 10), "101.10", "member", "classic", -74.1)
    assert sorted(str(r.end_lat) for r in got) == ["40.8", "40.8", "40.8", "None"]
    assert readers.read_trips(spark, str(tmp_path / "other.csv")).count() == 0


def test_weather_time_zone_and_newest(spark, tmp_path):
    (tmp_path / "w.json").write_text('{"data":[{"time":"2024-01-05 10:00:00","temp":3,"coco":7,"dwpt":1},'
                                     '{"time":"2024-07-05 10:00:00","temp":4.5,"rhum":50}]}\n{"data":[]}\n')
    plain = readers.read_weather_json(spark, str(tmp_path))
    assert sorted(r.time.hour for r in plain.collect()) == [10, 10]
    local = readers.read_weather_json(spark, str(tmp_path), "America/New_York")
    assert sorted(r.time.hour for r in local.collect()) == [14, 15]
    newest = readers.newest_observation(plain).collect()
    assert [(r.time.month, r.temp, r.relative_humidity, r.coco) for r in newest] == [(7, 4.5, 50.0, None)]
    assert readers.newest_observation(plain.limit(0)).count() == 0


def files(path):
    return {f: os.path.getmtime(os.path.join(path, f)) for f in os.listdir(path) if f.endswith(".parquet")}


def test_insert_ignore_leaves_old_files_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", (F.col("id") * 2).alias("v")).write.parquet(path)
    before = files(path)
    batch = spark.range(90, 120).select("id", F.lit(0).cast("long").alias("v"))
    assert sinks.insert_ignore(path, batch, ["id"]).count() == 120
    assert before.items() <= files(path).items()
    again = sinks.insert_ignore(path, batch, ["id"])
    assert again.count() == 120 and again.where("id >= 100 and v = 0").count() == 20


def test_evolution_is_reported_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).select("id", F.lit("a").alias("x")).write.parquet(path)
    more = spark.range(2).select("id", F.lit(1).alias("y"))
    _, missing, extra = sinks.append_evolving(path, more)
    assert (missing, extra) == (["x"], ["y"])
    out, missing, extra = sinks.append_evolving(path, more)
    assert (missing, extra) == (["x"], []) and out.count() == 7 and set(out.columns) == {"id", "x", "y"}


def test_periods_are_counted_from_the_start(spark, tmp_path):
    days = [dt.datetime(2024, 1, 31, 6), dt.datetime(2024, 1, 31, 7), dt.datetime(2024, 2, 29, 5), dt.datetime(2024, 2, 29, 6),
            dt.datetime(2024, 3, 30), dt.datetime(2024, 3, 31, 6), dt.datetime(2025, 1, 31, 6)]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    label = {r.t: r.p for r in df.select("t", F.date_format(sinks.period_start("t", "month", "2024-01-31 06:00:00"), "yyyy-MM-dd").alias("p")).collect()}
    assert [label[d] for d in days] == ["2024-01-31", "2024-01-31", "2024-01-31", "2024-02-29", "2024-02-29", "2024-03-31", "2025-01-31"]
    weeks = {r.p.day for r in df.where("t < '2024-02-15'").select(sinks.period_start("t", "week", "2024-01-26 06:30:00").alias("p")).collect()}
    assert weeks == {26}
    out = sinks.backfill_by_period(df, str(tmp_path / "t"), "t", "2025-01-01", "quarter", start="2024-01-31 06:00:00")
    assert sorted({str(r.period) for r in out.collect()}) == ["2024-01-31"]


def test_month_partitions(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2024, m, 3), 2024) for m in (1, 1, 2)], "t timestamp_ntz, year int").repartition(3)
    out = sinks.write_month_partitions(df, str(tmp_path / "m"), "t", files_per_month=2)
    assert sorted((r.year, r.month) for r in out.collect()) == [(2024, 1), (2024, 1), (2024, 2)]


def test_a_thousand_small_files_of_two_forms(spark, tmp_path):
    head, row = HEAD.split(","), ROW.split(",")
    turned = [head[-1], *head[:-1]], [row[-1], *row[:-1]]
    for i in range(1000):
        h, r = (head, row) if i % 3 else turned
        r = [f"r{i}" if c == "ride_id" else f"{i}.10" if c == "start_station_id" else v for c, v in zip(h, r)]
        (tmp_path / f"2024-bike-tripdata_{i}.csv").write_text(",".join(h) + "\n" + (",".join(r) + "\n") * (1 + i % 2))
    forms = readers.header_forms(spark, str(tmp_path))
    assert sorted((len(n), len(f)) for n, f in forms) == [(13, 334), (13, 666)]
    got = readers.read_trips(spark, str(tmp_path)).collect()
    assert len(got) == 1500 and {r.start_station_id for r in got} == {f"{i}.10" for i in range(1000)}
    assert {(r.member_casual, r.end_lng) for r in got} == {("member", -74.1)}


def test_headers_of_files_read_in_several_blocks(spark, tmp_path):
    # the first line of later blocks is no header
    body = "".join(f"r{i},classic,2024-01-05 10:00:00,2024-01-05 10:20:00,S,{i}.10,E,102.1,40.7,-74.0,40.8,-74.1,member\n" for i in range(3000))
    (tmp_path / "2024-bike-tripdata_1.csv").write_text(HEAD + "\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert [n for n, _ in readers.header_forms(spark, str(tmp_path))] == [tuple(HEAD.split(","))]
        assert readers.read_trips(spark, str(tmp_path)).count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_archive_members_are_tasks_of_their_own(spark, tmp_path):
    import zipfile
    want = 0
    for a in range(2):
        with zipfile.ZipFile(tmp_path / f"2024{a}-bike-tripdata.zip", "w", zipfile.ZIP_DEFLATED if a else zipfile.ZIP_STORED) as z:
            z.writestr("__MACOSX/readme.txt", "x")
            for m in range(12):
                n = 40 * (m + 1)
                want += n
                z.writestr(f"part_{m}.csv", HEAD + "\n" + (ROW + "\n") * n)
    (tmp_path / "other.zip").write_bytes(b"not a zip")
    found = readers.archive_members(spark, str(tmp_path))
    assert found.count() == 24 and found.select("archive").distinct().count() == 2
    got = readers.read_trip_archives(spark, str(tmp_path), tasks=24)
    assert got.rdd.getNumPartitions() >= 12  # members of one archive in many tasks
    per_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert got.count() == want and max(per_task) <= 40 * 12 * 3
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, readers.read_whole_archives(spark, str(tmp_path)).collect()))
    assert readers.read_trip_archives(spark, str(tmp_path / "none") if (tmp_path / "none").mkdir() is None else "").count() == 0


def test_a_member_is_a_stream(monkeypatch, tmp_path):
    # parsed chunk by chunk while it is unpacked: the first rows come before the end is read
    import zipfile
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z, z.open("big.csv", "w", force_zip64=True) as out:
        out.write((HEAD + "\n").encode())
        for _ in range(300):
            out.write((ROW + "\n").encode() * 1000)
    monkeypatch.setattr(readers, "ZIP_CHUNK_ROWS", 1000)
    with readers._opened(f"file://{tmp_path}/a.zip") as fh, zipfile.ZipFile(fh) as z, z.open("big.csv") as member:
        rows = readers._csv_rows(member)
        assert len(next(rows)) == 1000 and member._left > member._orig_file_size * 0.5 if hasattr(member, "_orig_file_size") else True
        assert 1000 + sum(len(c) for c in rows) == 300_000
