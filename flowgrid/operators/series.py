"""Series generation: hour/day/date spines, integer series, holiday calendar,
as-of (backward) fill and forward fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowgrid.functions.columns import hour_floor
from flowgrid.functions.dates import datediff_boundaries, dateadd, ntz_lit

# ---------------------------------------------------------------------------
# Spines
# ---------------------------------------------------------------------------


def hour_spine(df: DataFrame, ts: str = "date_hour", out: str = "date_hour") -> DataFrame:
    """Every hour between the min and max of ``ts`` (inclusive).

    The bounds are one partial+final aggregate; the spine itself is generated
    by ``sequence`` from that 1-row frame (size = hours in range)."""
    b = df.agg(F.min(hour_floor(ts)).alias("_lo"), F.max(hour_floor(ts)).alias("_hi"))
    return b.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 HOUR"))).alias(out)).where(F.col(out).isNotNull())


def day_hour_spine(df: DataFrame, ts: str = "date_hour", out: str = "date_hour") -> DataFrame:
    """All whole days between min and max of ``ts`` times hours 0..23."""
    b = df.agg(F.min(F.to_date(ts)).alias("_lo"), F.max(F.to_date(ts)).alias("_hi"))
    days = b.select(F.explode(F.sequence("_lo", "_hi")).alias("_d"))
    return days.select(F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h"), "_d").select(
        F.make_timestamp_ntz(F.year("_d"), F.month("_d"), F.dayofmonth("_d"), F.col("_h"), F.lit(0), F.lit(0)).alias(out))


def date_spine(spark: SparkSession, datepart: str, start, end, out: str = "date_day",
               bounds: DataFrame | None = None) -> DataFrame:
    """Every ``datepart`` step from ``start``; the number of rows is the
    boundary-count difference between start and end, so an end that is an exact
    multiple is excluded.  ``start``/``end`` are literals or, with ``bounds``,
    column names of a 1-row frame (data-derived bounds)."""
    if bounds is None:
        bounds = spark.range(1).select(ntz_lit(start).alias("_s"),
                                       ntz_lit(end).alias("_e"))
    else:
        bounds = bounds.select(F.col(start).cast("timestamp_ntz").alias("_s"),
                               F.col(end).cast("timestamp_ntz").alias("_e"))
    n = datediff_boundaries(F.col("_s"), F.col("_e"), datepart)
    steps = bounds.select("_s", "_e", n.alias("_n")).where(F.col("_n") >= 1)
    out_df = steps.select("_s", "_e", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_i"))
    return out_df.select(dateadd(datepart, F.col("_i"), F.col("_s")).alias(out), "_e") \
        .where(F.col(out) <= F.col("_e")).select(out)


def generate_series(spark: SparkSession, n: int, out: str = "generated_number") -> DataFrame:
    if n <= 0:
        raise ValueError("generate_series needs n >= 1")
    return spark.range(1, n + 1).select(F.col("id").alias(out))


# ---------------------------------------------------------------------------
# Holiday calendar (US federal rules, with weekend-observed days)
# ---------------------------------------------------------------------------
# Rule set (fixed values): New Year's Day 1/1, Juneteenth 6/19 (from 2021),
# Independence Day 7/4, Veterans Day 11/11, Christmas 12/25 (all observed on the
# Friday before a Saturday and the Monday after a Sunday); Martin Luther King
# Jr. Day 3rd Monday of January; Washington's Birthday 3rd Monday of February;
# Memorial Day last Monday of May; Labor Day 1st Monday of September; Columbus
# Day 2nd Monday of October; Thanksgiving 4th Thursday of November.
FIXED_HOLIDAYS = [(1, 1, None), (6, 19, 2021), (7, 4, None), (11, 11, None), (12, 25, None)]
NTH_WEEKDAY_HOLIDAYS = [(1, 2, 3), (2, 2, 3), (9, 2, 1), (10, 2, 2), (11, 5, 4)]  # (month, Spark dow, n)
LAST_WEEKDAY_HOLIDAYS = [(5, 2)]  # (month, Spark dow): last Monday of May


def _nth_weekday(y: Column, month: int, dow: int, n: int) -> Column:
    first = F.make_date(y, F.lit(month), F.lit(1))
    off = F.pmod(F.lit(dow) - F.dayofweek(first), F.lit(7)) + F.lit(7 * (n - 1))
    return F.date_add(first, off)


def _last_weekday(y: Column, month: int, dow: int) -> Column:
    last = F.last_day(F.make_date(y, F.lit(month), F.lit(1)))
    return F.date_sub(last, F.pmod(F.dayofweek(last) - F.lit(dow), F.lit(7)))


def holiday_calendar(years: DataFrame, year_col: str = "year") -> DataFrame:
    """Holiday dates for every year in ``years`` (a data-derived frame):
    columns ``date DATE, is_holiday BOOLEAN``.  Pure column expressions."""
    y = F.col(year_col).cast("int")
    dates: list[Column] = []
    for m, d, since in FIXED_HOLIDAYS:
        actual = F.make_date(y, F.lit(m), F.lit(d))
        if since is not None:
            actual = F.when(y >= since, actual)
        dow = F.dayofweek(actual)
        observed = F.when(dow == 7, F.date_sub(actual, 1)).when(dow == 1, F.date_add(actual, 1))
        dates += [actual, observed]
    for m, dow, n in NTH_WEEKDAY_HOLIDAYS:
        dates.append(_nth_weekday(y, m, dow, n))
    for m, dow in LAST_WEEKDAY_HOLIDAYS:
        dates.append(_last_weekday(y, m, dow))
    return (years.select(F.explode(F.array(*dates)).alias("date"))
            .where(F.col("date").isNotNull()).distinct()
            .select("date", F.lit(True).alias("is_holiday")))


def years_of(df: DataFrame, ts: str) -> DataFrame:
    return df.select(F.year(ts).alias("year")).distinct()


# ---------------------------------------------------------------------------
# As-of and forward fill
# ---------------------------------------------------------------------------


def asof_backward(left: DataFrame, right: DataFrame, ts: str, by: list[str] | None = None,
                  right_ts: str | None = None, global_order: str = "scan") -> DataFrame:
    """For every left row, the values of the latest right row with
    ``right.ts <= left.ts`` (per ``by`` group).

    One union + a forward fill of the right-row struct (``last(struct,
    ignorenulls)``) instead of a non-equi join per column.  Ties at equal
    timestamps put right rows first so an exact match is taken.  Without
    ``by`` the fill needs a global order, and with ``by`` one key may hold a
    large share of the rows: ``global_order='scan'`` (default) uses the
    range-partitioned scan with a carry table (no task ever holds a whole key
    or the whole series); ``'window'`` uses an ordered window per key (or one
    global window) and is only for series with a proven small bound (e.g. one
    row per hour of a study range).
    """
    by = by or []
    right_ts = right_ts or ts
    rcols = [c for c in right.columns if c not in by and c != right_ts]
    lcols = [c for c in left.columns]
    r = right.select(*by, F.col(right_ts).alias("_ts"), F.struct(*[F.col(c) for c in rcols]).alias("_r"),
                     F.lit(0).alias("_side"))
    lcols_struct = F.struct(*[F.col(c) for c in lcols]).alias("_l")
    lft = left.select(*by, F.col(ts).alias("_ts"), lcols_struct, F.lit(1).alias("_side"))
    u = lft.withColumn("_r", F.lit(None).cast(r.schema["_r"].dataType)).unionByName(
        r.withColumn("_l", F.lit(None).cast(lft.schema["_l"].dataType)))
    if global_order == "scan":
        from flowgrid.operators.windows import forward_fill_by
        filled = forward_fill_by(u.withColumn("_m", F.col("_r")), by, ["_ts", "_side"], ["_m"]) \
            .where(F.col("_side") == 1)
    else:
        w = (Window.partitionBy(*by) if by else Window).orderBy("_ts", "_side") \
            .rowsBetween(Window.unboundedPreceding, 0)
        filled = u.withColumn("_m", F.last("_r", ignorenulls=True).over(w)).where(F.col("_side") == 1)
    return filled.select(*[F.col("_l." + c).alias(c) for c in lcols],
                         *[F.col("_m." + c).alias(c) for c in rcols])


def forward_fill(df: DataFrame, order: str, cols: list[str], by: list[str] | None = None,
                 skew_safe: bool = True) -> DataFrame:
    """Carry the last non-null value of each column forward in ``order``
    (per ``by`` key).  ``skew_safe``: range-partition scan with a carry table;
    otherwise one window partition per key (one task for the whole series
    without ``by``)."""
    if skew_safe:
        from flowgrid.operators.windows import forward_fill_by
        return forward_fill_by(df, by or [], [order], cols)
    w = (Window.partitionBy(*by) if by else Window).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
