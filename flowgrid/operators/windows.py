"""Window operators: lags, leads, rolling means, dedup, range checks,
sequence gaps, time-ordered split and Page-Hinkley."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowgrid.functions.dates import dateadd
from flowgrid.operators.scan import prefix_scan, range_partitioned


def add_lags(df: DataFrame, col: str, lags: Sequence[int], by: Sequence[str], order: Sequence[str],
             prefix: str | None = None) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    p = prefix or col
    return df.withColumns({f"{p}_lag_{k}": F.lag(col, k).over(w) for k in lags})


def rolling_mean(df: DataFrame, col: str, n: int, by: Sequence[str], order: Sequence[str],
                 out: str | None = None, strict: bool = False) -> DataFrame:
    """Mean of the previous ``n`` rows (current excluded).  ``strict``: null
    unless all ``n`` rows exist (pandas ``rolling(n)`` after ``shift(1)``)."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-n, -1)
    m = F.avg(col).over(w)
    if strict:
        m = F.when(F.count(col).over(w) == n, m)
    return df.withColumn(out or f"{col}_roll_{n}", m)


def lead_target(df: DataFrame, col: str, by: Sequence[str], order: Sequence[str], out: str = "y",
                k: int = 1) -> DataFrame:
    return df.withColumn(out, F.lead(col, k).over(Window.partitionBy(*by).orderBy(*order)))


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row per key by ``order_by`` (add a unique tie-break for
    determinism).  Rows with null keys are kept (grouped together).

    ``order_by`` entries are column names, optionally suffixed ``asc`` /
    ``desc`` (``"version desc"``).  When all share one direction the skew-safe
    aggregate form (``deduplicate_by_agg``) is used; only mixed directions or
    Column expressions fall back to a ``row_number`` window."""
    parsed = []
    for o in order_by:
        if not isinstance(o, str):
            break
        parts = o.split()
        if len(parts) == 1 or (len(parts) == 2 and parts[1].lower() in ("asc", "desc")):
            parsed.append((parts[0], len(parts) == 2 and parts[1].lower() == "desc"))
        else:
            break
    else:
        # struct comparison puts null fields first, so min_by / max_by pick
        # the same row as ORDER BY ... ASC NULLS FIRST / DESC NULLS LAST
        if parsed and len({d for _, d in parsed}) == 1:
            return deduplicate_by_agg(df, partition_by, [c for c, _ in parsed], descending=parsed[0][1])
    w = Window.partitionBy(*partition_by).orderBy(*[F.expr(o) if isinstance(o, str) else o for o in order_by])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def with_history_tail(df: DataFrame, history: DataFrame, by: Sequence[str], order: Sequence[str], n: int, fn) -> DataFrame:
    """Apply ``fn`` (lags, rolling means) to ``df`` preceded by the last ``n``
    history rows of each group, and return only the rows of ``df``: its first
    rows keep their past.  Per group only ``n`` history rows are kept."""
    w = Window.partitionBy(*by).orderBy(*[F.col(o).desc() for o in order])
    tail = history.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
    both = tail.select(*df.columns).withColumn("_old", F.lit(True)).unionByName(df.withColumn("_old", F.lit(False)))
    return fn(both).where(~F.col("_old")).drop("_old")


def range_violations(df: DataFrame, lower: str, upper: str, partition_by: Sequence[str] = (),
                     gaps: str = "allowed", zero_length_allowed: bool = False,
                     tiebreak: str | None = None) -> DataFrame:
    """Rows breaking bound order or overlapping the next range (mutually
    exclusive ranges).  ``gaps``: allowed / not_allowed / required.  Null bounds
    are violations.  The next lower bound per partition comes from the
    skew-safe ordered lead; the last row of a partition has none and passes
    the second test."""
    from flowgrid.operators.scan import lead_in_order
    tb = tiebreak or "_tb"
    d = df if tiebreak else df.withColumn("_tb", F.monotonically_increasing_id())
    d = lead_in_order(d, by=list(partition_by), order=[lower, upper, tb], cols={lower: "next_lower_bound"})
    lo, up, nl = F.col(lower), F.col(upper), F.col("next_lower_bound")
    order_ok = (lo <= up) if zero_length_allowed else (lo < up)
    cmp = {"allowed": up <= nl, "not_allowed": up == nl, "required": up < nl}[gaps]
    d = d.withColumns({"lower_bound_within_upper_bound": F.coalesce(order_ok, F.lit(False)),
                       "upper_bound_fits_next": F.coalesce(nl.isNull() | cmp, F.lit(False))})
    out = d.where(~F.col("lower_bound_within_upper_bound") | ~F.col("upper_bound_fits_next"))
    return out if tiebreak else out.drop("_tb")


def sequence_gaps(df: DataFrame, col: str, step=1, datepart: str | None = None,
                  partition_by: Sequence[str] = ()) -> DataFrame:
    """Rows whose predecessor (by ``col``) plus ``step`` differs from the row's
    value; the first row passes (same rule as the sequential-values check)."""
    from flowgrid.operators.quality import sequential_values
    return sequential_values(df, col, step, datepart, partition_by)


def time_ordered_split(df: DataFrame, order: Sequence[str], ratio: float = 0.8) -> DataFrame:
    """Adds ``split`` = train for the first ``ratio`` share of rows in
    ``order`` and test for the rest (exact: global row number from the
    range-partition scan, no single-partition window)."""
    n = df.count()
    cut = int(n * ratio)
    s = prefix_scan(df.withColumn("_one", F.lit(1.0)), order, "_one")
    return s.withColumn("split", F.when(F.col("_idx") < cut, F.lit("train")).otherwise(F.lit("test"))) \
        .drop("_one", "_cum", "_cummin", "_idx")


def positional_split(spark: SparkSession, path: str, ratio: float = 0.8) -> DataFrame:
    """The table at ``path`` (Parquet) with ``split`` = train for the first
    ``ratio`` share of its rows as they are stored: files in name order, rows
    in file order.  A row's position is its index in its file, which the reader
    gives, plus the rows of the files before; no row is ordered or shuffled.
    The counts of the files (one row each) meet their rows by broadcast."""
    meta = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    sizes = meta.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("_file", before.alias("_before"), F.sum("_n").over(Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"))
    cut = F.floor(F.col("_all") * F.lit(ratio))
    return (meta.join(F.broadcast(sizes), "_file")
            .withColumn("split", F.when(F.col("_before") + F.col("_at") < cut, F.lit("train")).otherwise(F.lit("test")))
            .drop("_file", "_at", "_before", "_all"))


def page_hinkley(df: DataFrame, value: str, order: Sequence[str], ref_mean: float, delta: float = 0.5,
                 lam: float = 10.0) -> DataFrame:
    """Page-Hinkley statistic per row: S_i = sum_{j<=i}(x_j - ref_mean - delta),
    M_i = min(0, min_{j<=i} S_j), PH_i = S_i - M_i, alarm when PH_i > lambda.
    Computed with the two-level range-partition prefix scan."""
    d = df.withColumn("_dev", F.col(value).cast("double") - F.lit(ref_mean) - F.lit(delta))
    s = prefix_scan(d, order, "_dev")
    return (s.withColumn("ph_stat", F.col("_cum") - F.least(F.lit(0.0), F.col("_cummin")))
            .withColumn("alarm", F.col("ph_stat") > F.lit(lam))
            .withColumnRenamed("_idx", "idx").withColumnRenamed("_cum", "cum_dev")
            .drop("_dev", "_cummin"))


def first_alarm(ph: DataFrame) -> DataFrame:
    """1-row frame: first 0-based index with an alarm, -1 if none."""
    return ph.agg(F.coalesce(F.min(F.when(F.col("alarm"), F.col("idx"))), F.lit(-1)).alias("first_alarm_idx"),
                  F.max("ph_stat").alias("max_ph_stat"))


def forward_fill_global(df: DataFrame, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Forward fill without a partition key, without funnelling the table
    into one task: range-partition on ``order``, fill inside each partition
    with a window over the stamped partition id, then fill each partition's
    leading nulls from the last non-null value of earlier partitions (a carry
    table with one row per partition, broadcast)."""
    r = range_partitioned(df, list(order))
    w_in = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = r.withColumns({c: F.last(c, ignorenulls=True).over(w_in) for c in cols})
    last_per = r.groupBy("_pid").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c)
                                       for c in cols])
    wc = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = last_per.select("_pid", *[F.last(c, ignorenulls=True).over(wc).alias("_carry_" + c) for c in cols])
    out = filled.join(F.broadcast(carry), "_pid", "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.col("_carry_" + c)) for c in cols}) \
        .drop("_pid", *["_carry_" + c for c in cols])


def forward_fill_by(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``last(c, ignorenulls) over (partition by by order by order)`` for each
    column, without one task per key: range-partition on ``by + order`` (a hot
    key is spread over many partitions), fill inside each (partition, key)
    slice, then carry the last non-null value of a key from earlier partitions
    into the first key of each partition.  The carry table has one row per
    partition (only a partition's first key can continue from before it)."""
    by, order = list(by), list(order)
    if not by:
        return forward_fill_global(df, order, cols)
    r = range_partitioned(df, by + order)
    key = F.struct(*[F.col(b) for b in by])
    w_in = Window.partitionBy("_pid", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = r.withColumns({c: F.last(c, ignorenulls=True).over(w_in) for c in cols})
    per = r.groupBy("_pid").agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    # last non-null value of each column among the rows of the partition's last key
    tails = r.join(F.broadcast(per.select("_pid", "_last")), "_pid").where(key.eqNullSafe(F.col("_last"))) \
        .groupBy("_pid").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias("_t_" + c) for c in cols])
    per = per.join(tails, "_pid", "left")
    # cumulative per last key over the partitions (the carry table is one row per partition)
    wk = Window.partitionBy("_last").orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumns({"_cum_" + c: F.last("_t_" + c, ignorenulls=True).over(wk) for c in cols})
    wp = Window.orderBy("_pid")
    carry = per.select("_pid", "_first", F.lag("_last").over(wp).alias("_prev_last"),
                       *[F.lag("_cum_" + c).over(wp).alias("_carry_" + c) for c in cols])
    carry = carry.where(F.col("_prev_last").eqNullSafe(F.col("_first"))).drop("_prev_last")
    out = filled.join(F.broadcast(carry), "_pid", "left")  # one row per partition
    first_group = key.eqNullSafe(F.col("_first"))
    return out.withColumns({c: F.when(first_group, F.coalesce(F.col(c), F.col("_carry_" + c)))
                            .otherwise(F.col(c)) for c in cols}) \
        .drop("_pid", "_first", *["_carry_" + c for c in cols])


def deduplicate_by_agg(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                       descending: bool = False) -> DataFrame:
    """First row per key by ``order_by`` (all ascending or all descending),
    as a hash aggregate: ``min_by``/``max_by`` of the row struct.  Partial
    aggregation collapses a hot key map-side, so no task ever holds a whole
    key group (unlike a row_number window)."""
    others = [c for c in df.columns if c not in partition_by]
    pick = F.max_by if descending else F.min_by
    g = df.groupBy(*partition_by).agg(pick(F.struct(*others), F.struct(*order_by)).alias("_r"))
    return g.select(*[F.col(c) if c in partition_by else F.col("_r." + c).alias(c) for c in df.columns])
