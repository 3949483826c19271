"""Profiling aggregates: top-k, describe, histograms, missing shares,
categorical frequencies, correlation, calendar/holiday/weather groupings,
heatmaps.  All are one or two aggregations; nothing is collected except the
documented small statistics (min/max for binning)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgrid.functions.columns import hour_band
from flowgrid.operators.joins import with_scalars


def top_k(df: DataFrame, key: str, measure: str, k: int = 20, ascending: bool = False,
          out: str | None = None) -> DataFrame:
    """Sum of ``measure`` per ``key``, top ``k`` (TakeOrdered: each task keeps
    k rows, the driver merges k x tasks)."""
    g = df.groupBy(key).agg(F.sum(measure).cast("long").alias(out or f"total_{measure}"))
    o = F.col(out or f"total_{measure}")
    return g.orderBy(o.asc() if ascending else o.desc(), F.col(key).asc()).limit(k)


def daily_mean_top_k(df: DataFrame, key: str, measure: str, day_col: str, k: int = 20) -> DataFrame:
    daily = df.groupBy(key, day_col).agg(F.sum(measure).alias("_d"))
    g = daily.groupBy(key).agg(F.avg("_d").alias(f"mean_daily_{measure}"))
    return g.orderBy(F.col(f"mean_daily_{measure}").desc(), F.col(key).asc()).limit(k)


def missing_pct(df: DataFrame) -> DataFrame:
    """Percent null per column (> 0), all columns in one aggregate."""
    aggs = [(F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("double") * 100 / F.count(F.lit(1))).alias(c)
            for c in df.columns]
    wide = df.agg(*aggs)
    long = wide.unpivot([], df.columns, "column_name", "missing_pct")
    return long.where("missing_pct > 0")


def categorical_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Frequency and percentage of every value of each text column (shares
    from a per-column total: one row per column, broadcast)."""
    d = df.select(*[F.col(c).cast("string") for c in cols]).unpivot([], list(cols), "column_name", "value")
    g = d.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    tot = g.groupBy("column_name").agg(F.sum("n").alias("_t"))
    return g.join(F.broadcast(tot), "column_name").select(
        "column_name", "value", "n", F.round(F.col("n") * 100.0 / F.col("_t"), 6).alias("pct"))


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles (exact, interpolated), max per column:
    one aggregate for the moments and one skew-safe grouped-percentile pass
    after an unpivot."""
    from flowgrid.operators.scan import grouped_percentiles
    d = df.select(*[F.col(c).cast("double") for c in cols]).unpivot([], list(cols), "column_name", "v")
    m = d.groupBy("column_name").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    q = grouped_percentiles(d, ["column_name"], "v", [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return m.join(q, "column_name", "left").select("column_name", "count", "mean", "std", "min", "p25", "p50",
                                                  "p75", "max")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width bins between each column's min and max (last bin closed)."""
    d = df.select(*[F.col(c).cast("double") for c in cols]).unpivot([], list(cols), "column_name", "v") \
        .where(F.col("v").isNotNull())
    mm = d.groupBy("column_name").agg(F.min("v").alias("mn"), F.max("v").alias("mx"))
    j = d.join(F.broadcast(mm), "column_name")  # one row per column
    b = F.least(F.floor((F.col("v") - F.col("mn")) / (F.col("mx") - F.col("mn")) * bins), F.lit(bins - 1))
    b = F.when(F.col("mx") == F.col("mn"), F.lit(0)).otherwise(b).cast("int")
    return j.groupBy("column_name", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def histogram_box(df: DataFrame, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """Histogram bins with the column's five-number summary on every bin."""
    box = describe_numeric(df, cols).select("column_name", "min", "p25", "p50", "p75", "max")  # one row per column
    return histogram(df, cols, bins).join(F.broadcast(box), "column_name")


def rankings(df: DataFrame, key: str, measures: dict[str, Column], k: int = 20) -> DataFrame:
    """For every measure (name -> column) the ``k`` keys with the largest total
    and the largest mean: (ranking, rank, key, value), ties by key.  One
    aggregate over the rows; the ranking windows see one row per key."""
    agg = df.groupBy(key).agg(*[f(c).cast("double").alias(f"{form}_{n}") for n, c in measures.items()
                                for form, f in (("total", F.sum), ("mean", F.avg))])
    long = agg.unpivot([key], [c for c in agg.columns if c != key], "ranking", "value")
    rank = F.row_number().over(Window.partitionBy("ranking").orderBy(F.col("value").desc(), F.col(key)))
    return long.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)


def correlation_long(df: DataFrame, cols: Sequence[str], digits: int = 9) -> DataFrame:
    """Pearson correlation of every column pair in one aggregate, long form."""
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[F.round(F.corr(a, b), digits).alias(f"{a}|{b}") for a, b in pairs])
    long = wide.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "corr")
    return long.select(F.split_part("pair", F.lit("|"), F.lit(1)).alias("col_a"),
                       F.split_part("pair", F.lit("|"), F.lit(2)).alias("col_b"), "corr")


def series_alignment(df: DataFrame, key: str = "station_id", ts: str = "date_hour") -> DataFrame:
    """Do all series have the same number of points, and the same set?"""
    per = df.groupBy(key).agg(F.count_distinct(ts).alias("n_points"))
    total = df.agg(F.count_distinct(ts).alias("n_all"))
    s = per.agg(F.count(F.lit(1)).alias("n_series"), F.count_distinct("n_points").alias("n_distinct_lengths"),
                F.min("n_points").alias("min_points"), F.max("n_points").alias("max_points"))
    return with_scalars(s, total).select(
        "n_series", "n_distinct_lengths", "min_points", "max_points",
        ((F.col("n_distinct_lengths") == 1) & (F.col("min_points") == F.col("n_all"))).alias("same_hour_set"))


def with_calendar_keys(grid: DataFrame) -> DataFrame:
    return grid.withColumns({"hour_band": hour_band("hour"), "iso_week": F.weekofyear("date_hour")})


def flow_by_calendar(grid: DataFrame) -> DataFrame:
    """Totals by hour band, weekday, ISO week and month in one pass
    (GROUPING SETS -> one Expand + one aggregate)."""
    g = with_calendar_keys(grid)
    return g.groupingSets([["hour_band"], ["jour_semaine"], ["iso_week"], ["month"]],
                          "hour_band", "jour_semaine", "iso_week", "month").agg(
        F.sum("num_bikes_taken").cast("long").alias("num_bikes_taken"),
        F.sum("num_bikes_dropped").cast("long").alias("num_bikes_dropped"))


def flow_by_holiday(grid: DataFrame) -> DataFrame:
    return grid.groupingSets([["hour", "is_holiday"], ["jour_semaine", "is_holiday"]],
                             "hour", "jour_semaine", "is_holiday").agg(
        F.avg("num_bikes_taken").alias("mean_taken"), F.avg("num_bikes_dropped").alias("mean_dropped"),
        F.avg("net_flow").alias("mean_net_flow"))


def flow_by_weather(grid: DataFrame) -> DataFrame:
    aggs = [F.avg("num_bikes_taken").alias("mean_taken"), F.avg("num_bikes_dropped").alias("mean_dropped"),
            F.sum("num_bikes_taken").cast("long").alias("total_taken"),
            F.sum("num_bikes_dropped").cast("long").alias("total_dropped")]
    by_code = grid.groupBy(F.lit("coco").alias("dimension"), F.col("coco").cast("string").alias("key")).agg(*aggs)
    by_group = grid.groupBy(F.lit("coco_group").alias("dimension"), F.col("coco_group").alias("key")).agg(*aggs)
    return by_code.unionByName(by_group)


def heatmap_pivot(grid: DataFrame, row: str = "jour_semaine", value: str = "net_flow") -> DataFrame:
    """Mean ``value`` for ``row`` x hour 0..23 (fixed pivot values: no
    distinct-values job)."""
    p = grid.groupBy(row).pivot("hour", list(range(24))).agg(F.avg(value))
    return p.select(row, *[F.col(str(h)).alias(f"h{h}") for h in range(24)])


def pd_cut_bins(df: DataFrame, col: str, bins: int = 20, out: str = "bin", round_to: int | None = 1) -> DataFrame:
    """Equal-width, right-closed bins between min and max (lowest edge
    lowered so the minimum lands in bin 1), as a bin number 1..bins."""
    c = F.round(col, round_to) if round_to is not None else F.col(col)
    d = df.withColumn("_x", c)
    mm = d.agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
    j = with_scalars(d, mm)  # 1-row statistics
    step = (F.col("_mx") - F.col("_mn")) / bins
    b = F.greatest(F.lit(1), F.least(F.lit(bins), F.ceil((F.col("_x") - F.col("_mn")) / step))).cast("int")
    b = F.when(F.col("_mx") == F.col("_mn"), F.lit(1)).otherwise(b)
    return j.withColumn(out, b).drop("_x", "_mn", "_mx")


def heatmap_binned(grid: DataFrame, col: str, bins: int = 20, value: str = "net_flow") -> DataFrame:
    b = pd_cut_bins(grid, col, bins, f"{col}_bin")
    return b.groupBy(f"{col}_bin", "hour").agg(F.avg(value).alias(f"mean_{value}"))


def moments(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count(col).alias("n"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std_samp"),
                  F.stddev_pop(col).alias("std_pop"))


def duplicate_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once (pandas keep=False).

    Counting is a partial+final aggregate (a hot key collapses map-side); the
    duplicated keys are then semi-joined back, which AQE can split when one
    key is skewed.  No window holds a whole key group in one task."""
    dup = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return df.join(dup, list(key), "left_semi")
