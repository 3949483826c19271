"""Table reshaping and set operations: star/except, pivot, unpivot, unions
of relations, column values, listagg, set differences."""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def star(df: DataFrame, except_: Sequence[str] = (), prefix: str = "", suffix: str = "",
         relation_alias: str | None = None) -> DataFrame:
    """All columns but ``except_`` (case-insensitive), renamed prefix+c+suffix."""
    ex = {c.lower() for c in except_}
    cols = [c for c in df.columns if c.lower() not in ex]
    src = df.alias(relation_alias) if relation_alias else df
    return src.select(*[F.col(c).alias(f"{prefix}{c}{suffix}") for c in cols])


def nullcheck(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Empty string -> null in every string column (or ``cols``)."""
    strs = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in strs})


def column_values(df: DataFrame, column: str, order_by: str = "count desc", max_records: int | None = None,
                  where: Column | str | None = None) -> DataFrame:
    """Distinct values ordered by frequency (value as tie-break), optional
    filter and limit; returns (value, n)."""
    d = df.where(where) if where is not None else df
    g = d.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    if order_by == "count desc":
        g = g.orderBy(F.col("n").desc(), F.col("value").asc_nulls_last())
    else:
        g = g.orderBy(F.col("value").asc_nulls_last())
    return g.limit(max_records) if max_records else g


def pivot_values(df: DataFrame, group: Sequence[str], column: str, values: Sequence, agg: str = "sum",
                 cmp: str = "=", then_value=1, else_value=0, prefix: str = "", suffix: str = "",
                 quote_identifiers: bool = False, distinct: bool = False) -> DataFrame:
    """One output column per value: agg(case when column <cmp> value then
    then_value else else_value end)."""
    ops = {"=": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b,
           ">": lambda a, b: a > b, "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b}
    fn = {"sum": F.sum, "count": F.count, "avg": F.avg, "max": F.max, "min": F.min}[agg]
    exprs = []
    for v in values:
        e = F.when(ops[cmp](F.col(column), F.lit(v)), F.lit(then_value)).otherwise(F.lit(else_value))
        if distinct:
            e = F.count_distinct(e) if agg == "count" else fn(e)
        else:
            e = fn(e)
        name = f"{prefix}{v}{suffix}" if quote_identifiers else re.sub(r"\W", "_", f"{prefix}{v}{suffix}")
        exprs.append(e.alias(name))
    return df.groupBy(*group).agg(*exprs)


def distinct_values(df: DataFrame, column: str) -> list:
    """Sorted distinct values of a column, for a pivot (each becomes an output
    column, so the caller has few of them)."""
    return sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().toLocalIterator())


def unpivot(df: DataFrame, cast_to: str = "string", exclude: Sequence[str] = (), remove: Sequence[str] = (),
            field_name: str = "field_name", value_name: str = "value") -> DataFrame:
    """Columns -> rows with one Expand (one scan); booleans become text."""
    keep = list(exclude)
    cols = [c for c in df.columns if c not in keep and c not in remove]
    d = df.select(*keep, *[F.col(c).cast(cast_to).alias(c) for c in cols])
    return d.unpivot(keep, cols, field_name, value_name)


def union_relations(relations: dict[str, DataFrame], include: Sequence[str] | None = None,
                    exclude: Sequence[str] | None = None, column_override: dict[str, str] | None = None,
                    source_column_name: str | None = "_source_relation", where: str | None = None) -> DataFrame:
    """Union relations with different columns: superset of columns (first
    seen order), missing -> null, type overrides, optional include/exclude
    (not both) and a source-name column."""
    if include and exclude:
        raise ValueError("include and exclude are mutually exclusive")
    types: dict[str, T.DataType] = {}
    for df in relations.values():
        for f in df.schema.fields:
            if f.name not in types:
                types[f.name] = f.dataType
    names = list(types)
    if include:
        names = [c for c in names if c.lower() in {i.lower() for i in include}]
    if exclude:
        names = [c for c in names if c.lower() not in {e.lower() for e in exclude}]
    over = column_override or {}
    out = None
    for rel, df in relations.items():
        sel = [F.lit(rel).alias(source_column_name)] if source_column_name else []
        for c in names:
            t = over.get(c) or types[c].simpleString()
            sel.append((F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c))
        part = df.select(*sel)
        if where:
            part = part.where(where)
        out = part if out is None else out.unionByName(part)
    return out


def relations_by_pattern(spark: SparkSession, pattern: str, exclude: str | None = None) -> dict[str, DataFrame]:
    """Catalog tables/views whose name matches a SQL LIKE pattern."""
    rx = re.compile("^" + re.escape(pattern).replace("%", ".*").replace("_", ".") + "$", re.I)
    ex = re.compile("^" + re.escape(exclude).replace("%", ".*").replace("_", ".") + "$", re.I) if exclude else None
    names = sorted(t.name for t in spark.catalog.listTables() if rx.match(t.name) and not (ex and ex.match(t.name)))
    return {n: spark.table(n) for n in names}


def listagg_column(measure: str, delim: str = ",", order_by: Sequence[str] | None = None, limit_num: int | None = None,
                   distinct: bool = False) -> Column:
    """Ordered / distinct / limited string aggregation as an aggregate column,
    so several of them share one ``groupBy``."""
    m = F.col(measure).cast("string")
    if distinct:
        arr = F.array_sort(F.collect_set(m))
    elif order_by:
        arr = F.transform(F.array_sort(F.collect_list(F.struct(*[F.col(o) for o in order_by], m.alias("_v")))),
                          lambda s: s["_v"])
    else:
        arr = F.collect_list(m)
    return F.array_join(F.slice(arr, 1, limit_num) if limit_num else arr, delim)


def listagg(df: DataFrame, group: Sequence[str], measure: str, delim: str = ",",
            order_by: Sequence[str] | None = None, limit_num: int | None = None, distinct: bool = False,
            out: str = "agg") -> DataFrame:
    """Ordered / distinct / limited string aggregation per group.  With an
    order and a limit only the first ``limit_num`` rows of a group are
    collected (a rank filter that each task applies before the shuffle)."""
    if limit_num and order_by and not distinct:
        m = F.col(measure).cast("string")
        keep = df.where(m.isNotNull()).withColumn("_rn", F.row_number().over(Window.partitionBy(*group).orderBy(*order_by, m)))
        first = keep.where(F.col("_rn") <= limit_num)
        groups = df.select(*group).distinct()
        got = first.groupBy(*group).agg(listagg_column(measure, delim, ["_rn"]).alias(out))
        same = functools.reduce(lambda x, y: x & y, [groups[g].eqNullSafe(got[g]) for g in group])
        return groups.join(got, same, "left").select(*[groups[g] for g in group], F.coalesce(out, F.lit("")).alias(out))
    return df.groupBy(*group).agg(listagg_column(measure, delim, order_by, limit_num, distinct).alias(out))


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)
