"""Order-dependent operators that must not funnel a hot key (or the whole
table) into one task.

Pattern used throughout: range-partition the rows on the full ordering key
(``repartitionByRange`` splits a hot group across many partitions, because the
order columns are part of the key), stamp each row with its partition id, run
the ordered function as a window *inside* each partition, write the result as
Parquet into the shared checkpoint folder (stable ids, survives executor loss,
later passes prune columns), build a *carry table* with one row per partition
(its size is bounded by the partition count, never by the data) and apply the
carries through a broadcast of that table.  Built-in functions only; no global
window over data rows, no collect of data rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgrid.operators.joins import bounded_broadcast, with_scalars
from flowgrid.session import materialize


def _n_parts(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _dealt(df: DataFrame, keys: Sequence[str], n: int | None = None) -> DataFrame:
    """Rows range-partitioned on ``keys``, each stamped with its partition id
    (``_pid``).  Ids only mean something once written (``materialize``): later
    passes read them from the data, never from the task context."""
    return df.repartitionByRange(_n_parts(df, n), *keys).withColumn("_pid", F.spark_partition_id())


def range_partitioned(df: DataFrame, keys: Sequence[str], n: int | None = None) -> DataFrame:
    """Range-partitioned, sorted and stamped rows, written to the shared folder."""
    return materialize(_dealt(df, keys, n).sortWithinPartitions(*keys), "ranges")


def _next_partition(r: DataFrame, value: Column) -> DataFrame:
    """(``_pid``, ``_nf``): the smallest ``value`` of the next non-empty partition.
    The ordered window runs over one row per partition."""
    firsts = r.groupBy("_pid").agg(F.min(value).alias("_f"))
    return firsts.select("_pid", F.lead("_f").over(Window.orderBy("_pid")).alias("_nf"))


#: rows of one ``by`` group that a task orders in a plain window; a larger group is split over range partitions
GROUP_ROWS = 200_000


def lead_in_order(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: dict[str, str],
                  n: int | None = None, skew_safe: bool = True, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``lead(c, 1) over (partition by by order by order)`` for each
    ``c -> alias`` in ``cols`` (nulls first, null keys are a group).  ``by +
    order`` must identify a row.

    ``skew_safe=False`` uses the plain window (one task per ``by`` group).  The
    default counts the groups first: those of at most ``group_rows`` rows take
    the plain window (one shuffle), larger ones, and the whole table without
    ``by``, are split across range partitions, the row after a partition's last
    one coming from the carry table.
    """
    if not skew_safe:
        return _lead_by_group(df, by, order, cols)
    if not by:
        return _lead_by_range(df, by, order, cols, n)
    # at most rows / group_rows of them
    large = materialize(df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > group_rows)
                        .select(*[F.col(b).alias(f"_l{i}") for i, b in enumerate(by)]).coalesce(1), "large-groups")
    if large.isEmpty():
        return _lead_by_group(df.repartition(_n_parts(df, n), *by), by, order, cols)
    large, same = F.broadcast(large), F.lit(True)
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_l{i}"))
    rest = df.join(large, same, "left_anti").repartition(_n_parts(df, n), *by)
    return _lead_by_group(rest, by, order, cols).unionByName(
        _lead_by_range(df.join(large, same, "left_semi"), by, order, cols, n))


def _lead_by_group(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: dict[str, str]) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumns({a: F.lead(c).over(w) for c, a in cols.items()})


def _lead_by_range(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: dict[str, str],
                   n: int | None = None) -> DataFrame:
    keys = list(by) + [o for o in order if o not in by]
    row = F.struct(*keys, *[c for c in cols if c not in keys])
    w = Window.partitionBy("_pid").orderBy(*keys)
    r = materialize(_dealt(df, keys, n).withColumn("_nx", F.lead(row).over(w)), "ordered")
    # a partition's last row is the only one without a successor inside it
    x = r.join(F.broadcast(_next_partition(r, row)), "_pid", "left").withColumn("_nx", F.coalesce("_nx", "_nf"))
    same = F.col("_nx").isNotNull()
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_nx.{b}"))
    return x.select(*df.columns, *[F.when(same, F.col(f"_nx.{c}")).alias(a) for c, a in cols.items()])


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], n: int | None = None) -> list[float | None]:
    """Exact interpolated quantiles (``percentile_cont``) without funnelling
    the column into one task, one way at every size.

    Values are first collapsed to (value, count) - partial aggregation turns a
    hot value into one row -, the counts get a running sum over the ordered
    values from the range-partition scan, and the values that hold a wanted
    rank are picked out.  Returned to the driver: at most two values per
    probability."""
    v = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    s = prefix_scan(v.groupBy("v").agg(F.count(F.lit(1)).cast("double").alias("n")), ["v"], "n", n)
    total = int(s.agg(F.max("_cum")).first()[0] or 0)
    if total == 0:
        return [None for _ in probs]
    spots = [(total - 1) * p for p in probs]
    ranks = sorted({f(x) for x in spots for f in (math.floor, math.ceil)})
    first = F.col("_cum") - F.col("n")
    held = F.exists(F.array(*[F.lit(float(r)) for r in ranks]), lambda r: (first <= r) & (r < F.col("_cum")))
    rows = s.where(held).select("v", first.alias("a"), F.col("_cum").alias("z")).collect()
    at = {r: next(x["v"] for x in rows if x["a"] <= r < x["z"]) for r in ranks}
    return [at[math.floor(x)] + (at[math.ceil(x)] - at[math.floor(x)]) * (x - math.floor(x)) for x in spots]


def prefix_scan(df: DataFrame, order: Sequence[str], value: str, n: int | None = None) -> DataFrame:
    """Adds ``_idx`` (0-based global row number), ``_cum`` (running sum of
    ``value``, null and NaN as 0) and ``_cummin`` (running minimum of ``_cum``)
    in ``order``.  ``order`` must identify a row.  Windows run inside range
    partitions; what came before a partition is one carry row, computed over
    one row per partition."""
    w = Window.partitionBy("_pid").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    x = F.coalesce(F.nanvl(F.col(value).cast("double"), F.lit(0.0)), F.lit(0.0))
    d = _dealt(df, order, n).withColumns({"_idx": F.row_number().over(w).cast("long") - 1, "_cum": F.sum(x).over(upto)})
    r = materialize(d.withColumn("_cummin", F.min("_cum").over(upto)), "ordered")
    per = r.groupBy("_pid").agg(F.count(F.lit(1)).alias("_k"), F.max_by("_cum", "_idx").alias("_s"), F.min("_cum").alias("_m"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    per = per.withColumns({"_k0": F.coalesce(F.sum("_k").over(before), F.lit(0)), "_s0": F.coalesce(F.sum("_s").over(before), F.lit(0.0))})
    per = per.withColumn("_m0", F.coalesce(F.min(F.col("_s0") + F.col("_m")).over(before), F.lit(math.inf)))
    return r.join(F.broadcast(per.select("_pid", "_k0", "_s0", "_m0")), "_pid").select(
        *df.columns, (F.col("_idx") + F.col("_k0")).alias("_idx"), (F.col("_cum") + F.col("_s0")).alias("_cum"),
        F.least(F.col("_cummin") + F.col("_s0"), F.col("_m0")).alias("_cummin"))


def grouped_percentiles(df: DataFrame, by: Sequence[str], col: str, probs: Sequence[float],
                        names: Sequence[str] | None = None, max_broadcast_groups: int = 1_000_000) -> DataFrame:
    """Exact interpolated percentiles (``percentile_cont``) per group, without
    funnelling a group into one task (the ordered counts are written once, at
    the call; the rest is lazy).

    Values collapse to (group, value, count) by a partial aggregate; a prefix
    sum of the counts in (group, value) order comes from the range-partition
    scan (a hot group is spread over many partitions); subtracting each
    group's starting offset gives in-group ranks; the values at the wanted
    ranks are picked by one more aggregate.  Output: ``by`` + one column per
    probability."""
    by = list(by)
    names = list(names or [f"p{int(round(p * 100)):02d}" for p in probs])
    v = df.select(*by, F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    vc = v.groupBy(*by, "_v").agg(F.count(F.lit(1)).cast("double").alias("_n"))
    s = prefix_scan(vc, by + ["_v"], "_n").drop("_idx", "_cummin")
    off = s.groupBy(*by).agg(F.min(F.col("_cum") - F.col("_n")).alias("_off"), F.sum("_n").alias("_tot"))
    tgt = off.select(*by, "_off", "_tot", *[x for i, p in enumerate(probs) for x in (
        F.floor((F.col("_tot") - 1) * F.lit(p)).alias(f"_rlo{i}"), F.ceil((F.col("_tot") - 1) * F.lit(p)).alias(f"_rhi{i}"),
        ((F.col("_tot") - 1) * F.lit(p) - F.floor((F.col("_tot") - 1) * F.lit(p))).alias(f"_fr{i}"))])
    if by:
        side = bounded_broadcast(tgt, max_broadcast_groups)  # rows and bytes checked
        j = s.join(side, by)
    else:
        j = with_scalars(s, tgt)  # one row
    hi_c = F.col("_cum") - F.col("_off")
    lo_c = hi_c - F.col("_n")
    aggs = []
    for i in range(len(probs)):
        for tag in ("rlo", "rhi"):
            r = F.col(f"_{tag}{i}")
            aggs.append(F.max(F.when((lo_c <= r) & (r < hi_c), F.col("_v"))).alias(f"_{tag}v{i}"))
        aggs.append(F.first(f"_fr{i}").alias(f"_fr{i}"))
    g = j.groupBy(*by).agg(*aggs)
    return g.select(*by, *[(F.col(f"_rlov{i}") + (F.col(f"_rhiv{i}") - F.col(f"_rlov{i}")) * F.col(f"_fr{i}"))
                           .alias(names[i]) for i in range(len(probs))])
