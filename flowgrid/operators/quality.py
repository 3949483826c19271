"""Data-quality checks.  Every check returns a DataFrame of violations and
passes when it is empty.  A null condition is not a violation unless stated
(three-valued logic, as in SQL)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgrid.functions.dates import dateadd, ntz_lit
from flowgrid.operators.joins import with_scalars


def _where(df: DataFrame, cond: str | Column | None) -> DataFrame:
    return df.where(cond) if cond is not None else df


def not_null(df: DataFrame, column: str, where=None) -> DataFrame:
    return _where(df, where).where(F.col(column).isNull())


def unique(df: DataFrame, column: str, where=None) -> DataFrame:
    d = _where(df, where).where(F.col(column).isNotNull())
    return d.groupBy(F.col(column).alias("unique_field")).agg(F.count(F.lit(1)).alias("n_records")) \
        .where("n_records > 1")


def unique_combination(df: DataFrame, columns: Sequence[str], where=None) -> DataFrame:
    return _where(df, where).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence, where=None) -> DataFrame:
    d = _where(df, where)
    g = d.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return g.where(~F.col("value_field").isin(*values))  # null value -> null predicate -> passes


def not_accepted_values(df: DataFrame, column: str, values: Sequence, where=None) -> DataFrame:
    return _where(df, where).select(F.col(column).alias("value_field")).distinct() \
        .where(F.col("value_field").isin(*values))


def expression_is_true(df: DataFrame, expression: str, column: str | None = None, where=None) -> DataFrame:
    """Rows where NOT(expression); with ``column`` the expression is
    ``column <expression>`` (e.g. ``= a + b``)."""
    e = F.expr(f"{column} {expression}") if column else F.expr(expression)
    return _where(df, where).where(~e)


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True,
                   where=None) -> DataFrame:
    c = F.col(column)
    conds = []
    if min_value is not None:
        conds.append(~(c >= F.lit(min_value)) if inclusive else ~(c > F.lit(min_value)))
    if max_value is not None:
        conds.append(~(c <= F.lit(max_value)) if inclusive else ~(c < F.lit(max_value)))
    if not conds:
        raise ValueError("give min_value and/or max_value")
    cond = conds[0]
    for x in conds[1:]:
        cond = cond | x
    return _where(df, where).where(cond)


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group_by).agg(F.count(column).alias("filler_column")).where("filler_column = 0")


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group_by).agg(F.count_distinct(column).alias("filler_column")).where("filler_column = 1")


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0,
                        group_by: Sequence[str] = ()) -> DataFrame:
    g = df.groupBy(*group_by).agg(
        (F.sum(F.when(F.col(column).isNotNull(), 1).otherwise(0)) / F.count(F.lit(1))).alias("not_null_proportion"))
    return g.where((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def equal_rowcount(a: DataFrame, b: DataFrame) -> DataFrame:
    ca = a.agg(F.count(F.lit(1)).alias("count_a"))
    cb = b.agg(F.count(F.lit(1)).alias("count_b"))
    j = with_scalars(ca, cb)  # two 1-row frames
    return j.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b"))).where("diff_count > 0")


def fewer_rows_than(a: DataFrame, b: DataFrame) -> DataFrame:
    """Fails when a has at least as many rows as b (equal counts give 1)."""
    j = with_scalars(a.agg(F.count(F.lit(1)).alias("count_our_model")),
                     b.agg(F.count(F.lit(1)).alias("count_comparison_model")))
    return j.withColumn("row_count_delta",
                        F.when(F.col("count_our_model") >= F.col("count_comparison_model"),
                               F.col("count_our_model") - F.col("count_comparison_model") + 1).otherwise(0)) \
        .where("row_count_delta > 0")


def equality(a: DataFrame, b: DataFrame, compare_columns: Sequence[str] | None = None) -> DataFrame:
    """Rows in A-B and B-A (EXCEPT DISTINCT) with a side label."""
    cols = list(compare_columns or a.columns)
    x, y = a.select(*cols), b.select(*cols)
    return x.subtract(y).withColumn("which_diff", F.lit("a_minus_b")).unionByName(
        y.subtract(x).withColumn("which_diff", F.lit("b_minus_a")))


def equality_failures(a: DataFrame, b: DataFrame, compare_columns: Sequence[str] | None = None) -> DataFrame:
    """1-row failure count of ``equality``: differing rows plus the difference
    of the two sides' numbers."""
    side = lambda s: F.count(F.when(F.col("which_diff") == s, 1))
    d = equality(a, b, compare_columns).agg(side("a_minus_b").alias("n_a"), side("b_minus_a").alias("n_b"))
    return d.select("n_a", "n_b", (F.col("n_a") + F.col("n_b") + F.abs(F.col("n_a") - F.col("n_b"))).alias("failures"))


def cardinality_equality(a: DataFrame, col_a: str, b: DataFrame, col_b: str) -> DataFrame:
    ta = a.groupBy(F.col(col_a).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    tb = b.groupBy(F.col(col_b).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return ta.subtract(tb).unionByName(tb.subtract(ta))


def relationships_where(child: DataFrame, column: str, parent: DataFrame, field: str,
                        from_condition=None, to_condition=None) -> DataFrame:
    c = _where(child, from_condition).select(F.col(column).alias("from_field")).where("from_field is not null")
    p = _where(parent, to_condition).select(F.col(field).alias("to_field"))
    return c.join(p, c["from_field"] == p["to_field"], "left_anti")


def sequential_values(df: DataFrame, column: str, interval=1, datepart: str | None = None,
                      group_by: Sequence[str] = ()) -> DataFrame:
    """Rows whose predecessor (by ``column``, per group) plus the step differs;
    the first row passes.  Successor pairs come from the skew-safe ordered
    lead (a hot group, or no group at all, is split over range partitions):
    for every pair (x, y), y violates when y != x + step."""
    from flowgrid.operators.scan import lead_in_order
    g = list(group_by)
    base = df.select(*g, column).withColumn("_tb", F.monotonically_increasing_id())
    pairs = lead_in_order(base, by=g, order=[column, "_tb"], cols={column: "_next"})
    exp = dateadd(datepart, interval, F.col(column)) if datepart else F.col(column) + F.lit(interval)
    return pairs.where(F.col("_next").isNotNull() & ~(F.col("_next") == exp)).select(
        *g, F.col("_next").alias(column), F.col(column).alias("previous_" + column))


def recency(df: DataFrame, field: str, datepart: str, interval: int, as_of) -> DataFrame:
    """One row when max(field) is older than ``interval`` dateparts before
    ``as_of`` (explicit, never the wall clock)."""
    g = df.agg(F.max(field).alias("most_recent"))
    thr = dateadd(datepart, -interval, ntz_lit(as_of))
    return g.withColumn("threshold", thr).where(
        F.col("most_recent").isNull() | (F.col("most_recent") < F.col("threshold")))


def no_empty_string(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) == "")


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    return df.where(~(F.col(actual) == F.col(expected)))


def report(checks: dict[str, DataFrame]) -> DataFrame:
    """One row per check: name, failures, passed.  Each check is counted by a
    partial+final aggregate; the union is one job."""
    out = None
    for name, v in checks.items():
        r = v.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")
        out = r if out is None else out.unionByName(r)
    return out.withColumn("passed", F.col("failures") == 0)


def failing(condition) -> Column:
    """Rows for which a check's failure ``condition`` holds, as an aggregate."""
    return F.count_if(condition)


def failing_values(column: str, values: Sequence) -> Column:
    """Distinct values outside ``values`` (null passes), as an aggregate."""
    return F.count_distinct(F.when(~F.col(column).isin(*values), F.col(column)))


def failing_proportion(column: str, at_least: float, at_most: float = 1.0) -> Column:
    """1 if the share of non-null values is outside the bounds, as an aggregate."""
    share = F.count(F.col(column)) / F.count(F.lit(1))
    return F.when((share < at_least) | (share > at_most), 1).otherwise(0).cast("long")


def with_relation(df: DataFrame, column: str, parent: DataFrame, parent_column: str, flag: str) -> DataFrame:
    """``df`` with ``flag``: its non-null ``column`` is not in ``parent`` - a row
    condition that goes with the other checks of the table's one scan."""
    keys = parent.where(F.col(parent_column).isNotNull()).select(F.col(parent_column).alias("_parent")).distinct()
    return (df.join(keys, F.col(column) == F.col("_parent"), "left")
            .withColumn(flag, F.col(column).isNotNull() & F.col("_parent").isNull()).drop("_parent"))


def row_check_report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check_name, failures) of all ``checks`` of one table, aggregates of the
    forms above, compiled into a single aggregate: one scan of the columns that
    any of them needs, whatever their number."""
    one = df.agg(*[c.cast("long").alias(name) for name, c in checks.items()])
    return one.unpivot([], list(checks), "check_name", "failures")


def unique_check_report(df: DataFrame, checks: dict[str, Sequence[str]]) -> DataFrame:
    """(check_name, failures) of several uniqueness checks of one table in one
    scan: grouping sets, one for each check's columns; nulls are left out by a
    single column, as in ``unique``, and a value like others in combinations."""
    cols = list(dict.fromkeys(c for by in checks.values() for c in by))
    names, sets = list(checks), [list(by) for by in checks.values()]
    bit = {c: 1 << (len(cols) - 1 - i) for i, c in enumerate(cols)}
    ids = [sum(bit[c] for c in cols if c not in by) for by in sets]
    if len(set(ids)) < len(ids):
        raise ValueError("two checks have the same columns")
    groups = df.groupingSets(sets, *cols).agg(F.count(F.lit(1)).alias("n_records"), F.grouping_id().alias("_set"))
    said = F.create_map(*[x for i, name in zip(ids, names) for x in (F.lit(i).cast("long"), F.lit(name))])
    complete = F.lit(False)
    for i, by in zip(ids, sets):
        here = F.col("_set") == i
        complete = complete | (here & F.col(by[0]).isNotNull() if len(by) == 1 else here)
    # every check has its row, also without a failure
    found = groups.where(complete).groupBy(F.element_at(said, F.col("_set").cast("long")).alias("check_name")).agg(
        F.count_if(F.col("n_records") > 1).alias("failures"))
    every = df.sparkSession.createDataFrame([(n,) for n in names], "check_name string")
    return F.broadcast(every).join(found, "check_name", "left").select("check_name", F.coalesce("failures", F.lit(0).cast("long")).alias("failures"))


def fused_report(parts: Sequence[DataFrame]) -> DataFrame:
    """One row per check (name, failures, passed) from the tables' reports."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failures") == 0)
