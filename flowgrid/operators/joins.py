"""Join helpers: size-checked broadcast, shuffled sides, full-outer flow merge, as-of."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BROADCAST_ROWS = 5_000_000


_FIXED_WIDTH = {"boolean": 1, "tinyint": 1, "byte": 1, "smallint": 2, "short": 2, "int": 4, "integer": 4,
                "date": 4, "float": 4, "bigint": 8, "long": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}


def row_width(dtype: T.DataType) -> int:
    """Estimated bytes per value (Spark's default sizes: 20 per string, 8 per
    wide number; nested types add up; decimals 16)."""
    if isinstance(dtype, T.StructType):
        return sum(row_width(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return 4 * row_width(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return 4 * (row_width(dtype.keyType) + row_width(dtype.valueType))
    if isinstance(dtype, T.DecimalType):
        return 16
    return _FIXED_WIDTH.get(dtype.simpleString(), 20)


def broadcast_limit_bytes(spark) -> int:
    """The session's broadcast threshold (the limit Spark applies to its own
    estimates); 0 when broadcasting is disabled."""
    v = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    m = re.fullmatch(r"\s*(-?\d+)\s*([kmgt]?)b?\s*", str(v).lower())
    if not m:
        return 10 * 1024 * 1024
    n = int(m.group(1)) * 1024 ** " kmgt".index(m.group(2) or " ")
    return max(n, 0)


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      max_bytes: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when its exact row count is at most ``max_rows``
    and rows x estimated row width is within ``max_bytes`` (default: the
    session's broadcast threshold); otherwise return it unhinted so the
    planner (and AQE at run time) shuffles instead.  The count is an action on
    a small dimension."""
    n = df.count()
    limit = broadcast_limit_bytes(df.sparkSession) if max_bytes is None else max_bytes
    fits = n <= max_rows and n * max(row_width(df.schema), 1) <= limit
    return F.broadcast(df) if fits else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` marked for a sort-merge join: for a side that grows with the
    data.  The planner takes a file's size for its rows' size, and a written
    table of repeated values is hundreds of times smaller than its rows, so
    without the mark it would be collected and broadcast at any row count."""
    return df.hint("merge")


def with_scalars(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach every column of a 1-row frame (a global aggregate) to each row
    of ``df`` as scalar subqueries: evaluated once (the struct subquery is
    reused for every field), inlined as values, no join and no shuffle."""
    s = stats.select(F.struct(*[F.col(c) for c in stats.columns]).alias("_s")).scalar()
    return df.select("*", *[s.getField(c).alias(c) for c in stats.columns])


def semi_join(df: DataFrame, keys: DataFrame, on: str | list[str], max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    return df.join(bounded_broadcast(keys, max_rows), on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(keys, on, "left_anti")
