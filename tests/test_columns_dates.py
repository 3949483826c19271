"""Edge rules of the column expressions and date wrappers (hand-made frames)."""

import datetime as dt

from pyspark.sql import functions as F

from flowgrid.functions import columns as C
from flowgrid.functions import dates as D
from flowgrid.functions import urls as U


def test_normalize_station_id(spark):
    df = spark.createDataFrame([("5980.1",), ("5980.10",), ("6140.05",), ("72",), (None,)], "s string")
    got = [r[0] for r in df.select(C.normalize_station_id("s")).collect()]
    assert got == ["5980.10", "5980.10", "6140.05", "72", None]


def test_weather_code_parse_rounds_and_groups(spark):
    df = spark.createDataFrame([("3",), ("12.0",), ("12.7",), ("7",), ("17",), ("n/a",), (None,)], "c string")
    out = df.select(C.weather_code_parse("c").alias("v")).select(
        "v", C.weather_code_group("v").alias("g"), C.weather_code_group("v", unmapped=None).alias("g2")).collect()
    assert [r.v for r in out] == [3, 12, 13, 7, 17, None, None]
    assert [r.g for r in out] == ["Pas de pluie", "Pluie/Neige", "Pluie/Neige", "Autre", "Averse de pluie",
                                  "Autre", "Autre"]
    assert out[3].g2 is None  # code 7 is in no group


def test_surrogate_key_null_equals_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    k = [r[0] for r in df.select(C.surrogate_key("x", "y")).collect()]
    assert k[0] == k[1]


def test_right_negative_and_array_text(spark):
    df = spark.createDataFrame([("Brand#13", [3, 1, 2])], "b string, a array<int>")
    r = df.select(C.right_chars("b", 2).alias("r2"), C.right_chars("b", -6).alias("rn"),
                  C.array_to_text(F.array_sort("a")).alias("t"), C.array_to_text(F.array().cast("array<int>")).alias("e")).first()
    assert (r.r2, r.rn, r.t, r.e) == ("13", "13", "[1,2,3]", "[]")


def test_width_bucket_edge_mod_vs_native(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (20.0,), (25.0,)], "x double")
    got = [r[0] for r in df.select(C.width_bucket("x", F.lit(0.0), F.lit(20.0), 4, "edge_mod")).collect()]
    # macro arithmetic: least(ceil(x/5), 5), +1 when x is a multiple of the bin width;
    # x = max + bin (25) gives N + 2
    assert got == [1, 2, 3, 5, 6]
    nat = [r[0] for r in df.select(C.width_bucket("x", F.lit(0.0), F.lit(20.0), 4, "native")).collect()]
    assert nat == [1, 2, 3, 5, 5]


def test_haversine_zero_and_known(spark):
    df = spark.createDataFrame([(40.7, -74.0, 40.7, -74.0), (40.7, -74.0, 40.8, -74.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(C.haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] == 0.0 and abs(got[1] - 11.12) < 0.01


def test_hour_floor_stays_ntz(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59, 59),)], "t timestamp_ntz")
    out = df.select(C.hour_floor("t").alias("h"))
    assert out.schema["h"].dataType.simpleString() == "timestamp_ntz"
    assert out.first().h == dt.datetime(2024, 1, 1, 23, 0)


def test_datediff_counts_boundaries(spark):
    a = dt.datetime(1999, 12, 31, 23, 59, 59, 999999)
    df = spark.createDataFrame([(a, dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 3))], "a timestamp_ntz, b timestamp_ntz, c timestamp_ntz")
    for part in ["microsecond", "millisecond", "second", "minute", "hour", "day", "month", "quarter", "year"]:
        assert df.select(D.datediff_boundaries("a", "b", part)).first()[0] == 1, part
    assert df.select(D.datediff_boundaries("a", "c", "week")).first()[0] == 1


def test_dateadd_and_last_day(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31),)], "t timestamp_ntz")
    r = df.select(D.dateadd("month", 1, "t").alias("m"), D.last_day_of("month", "t").alias("lm"),
                  D.last_day_of("quarter", "t").alias("lq"), D.last_day_of("year", "t").alias("ly")).first()
    assert r.m == dt.datetime(2024, 2, 29)
    assert (r.lm, r.lq, r.ly) == (dt.date(2024, 1, 31), dt.date(2024, 3, 31), dt.date(2024, 12, 31))


def test_url_parts(spark):
    df = spark.createDataFrame([("https://www.example.com/a/b?x=1&page=2",), ("example.com",), ("http://h.io?page=",),
                                ("android-app://com.app/path",)], "u string")
    r = df.select(U.url_host("u"), U.url_path("u"), U.url_parameter("u", "page")).collect()
    assert [x[0] for x in r] == ["www.example.com", "example.com", "h.io", "com.app"]
    assert [x[1] for x in r] == ["a/b", "example.com", "", "/com.app/path"]
    assert [x[2] for x in r] == ["2", None, None, None]


def _py_boundaries(a: dt.datetime, b: dt.datetime, part: str) -> int:
    """Boundary count from truncated values (plain Python reference)."""
    def micros(x):
        return (x - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    unit = {"microsecond": 1, "millisecond": 1_000, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6}
    if part in unit:
        return micros(b) // unit[part] - micros(a) // unit[part]
    if part == "day":
        return (b.date() - a.date()).days
    if part == "week":
        ma = a.date() - dt.timedelta(days=a.weekday())
        mb = b.date() - dt.timedelta(days=b.weekday())
        return (mb - ma).days // 7
    if part == "month":
        return (b.year - a.year) * 12 + b.month - a.month
    if part == "quarter":
        return (b.year - a.year) * 4 + (b.month - 1) // 3 - (a.month - 1) // 3
    return b.year - a.year


def test_datediff_boundaries_matches_truncation_rule(spark):
    import random
    rnd = random.Random(7)
    base = dt.datetime(1965, 3, 1)
    pairs = []
    for _ in range(300):
        a = base + dt.timedelta(microseconds=rnd.randrange(0, 70 * 365 * 86400 * 10**6))
        b = a + dt.timedelta(microseconds=rnd.randrange(-3 * 365 * 86400 * 10**6, 3 * 365 * 86400 * 10**6))
        pairs.append((a.isoformat(sep=" "), b.isoformat(sep=" ")))
    df = spark.createDataFrame(pairs, "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    parts = ["microsecond", "millisecond", "second", "minute", "hour", "day", "week", "month", "quarter", "year"]
    got = df.select("a", "b", *[D.datediff_boundaries("a", "b", p).alias(p) for p in parts]).collect()
    for r in got:
        for p in parts:
            assert r[p] == _py_boundaries(r["a"], r["b"], p), (r["a"], r["b"], p)
