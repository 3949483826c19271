"""Joins and ordered scans that don't gather a hot key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgrid.session import materialize

#: the most frequent keys that are joined by broadcast, where they hold more than LEAST rows;
#: a key with more than 1 / HOT_KEYS of the rows is always among them
HOT_KEYS = 1000
LEAST = 1000


def hot_keys(rows: DataFrame, on: Sequence[str]) -> list:
    """The hot keys of ``rows`` (counted map-side; at most HOT_KEYS)."""
    on = list(on)
    return rows.groupBy(*on).count().orderBy(F.desc("count")).limit(HOT_KEYS).filter(F.col("count") > LEAST).select(*on).collect()


def attach(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left", hot: list | None = None) -> DataFrame:
    """``rows`` joined (``left``, ``inner`` or ``left_semi``) with ``table``,
    which has at most one row for each ``on``; no key column is null.

    Hot keys (found in ``rows`` where not given) meet their table rows, which
    are as few, by broadcast; in the shuffle join for the others their rows have
    the hash of the whole row as a key, which matches nothing, so they are spread
    (and lie where they lay if a lost task is run again).
    """
    on = list(on)
    hot = hot_keys(rows, on) if hot is None else hot
    if not hot:
        return rows.join(table, on, how)
    new = [c for c in table.columns if c not in on]
    keys = rows.sparkSession.createDataFrame([tuple(h) for h in hot], rows.select(*on).schema)
    few = table.join(F.broadcast(keys), on, "left_semi").withColumnsRenamed({c: f"_h_{c}" for c in new}).withColumn("_there", F.lit(True))
    few = F.broadcast(keys.withColumn("_hot", F.lit(True)).join(few, on, "left"))
    side = table.withColumnsRenamed({c: f"_k_{c}" for c in on} | {c: f"_t_{c}" for c in new}).withColumn("_met", F.lit(True))
    # hot rows: an impossible flag in the key and their hash
    both = rows.join(few, on, "left").withColumns({"_hot": F.coalesce("_hot", F.lit(False)), "_spread": F.when(F.col("_hot"), F.xxhash64(*rows.columns)).otherwise(0)})
    side = side.withColumns({"_cold": F.lit(False), "_zero": F.lit(0).cast("long")})
    match = (F.col("_hot") == F.col("_cold")) & (F.col("_spread") == F.col("_zero"))
    for c in on:
        match = match & (F.col(c) == F.col(f"_k_{c}"))
    out = both.join(side, match, "left")
    if how != "left":
        out = out.filter(F.coalesce("_there", "_met", F.lit(False)))
    added = [] if how == "left_semi" else [F.when(F.col("_hot"), F.col(f"_h_{c}")).otherwise(F.col(f"_t_{c}")).alias(c) for c in new]
    return out.select(*rows.columns, *added)


def running(rows: DataFrame, by: str, order: Sequence[str], xors: Sequence[str] = (), sums: Sequence[str] = ()) -> DataFrame:
    """Adds ``place`` (from 1, in ``order`` within ``by``, nulls first) and turns
    ``xors`` and ``sums`` into running values, this row included.

    Rows are range-partitioned on ``by`` and ``order``, so a long group is split
    over tasks; what a group had in earlier partitions is a table with one row
    for each partition, which is broadcast.  ``by`` and ``order`` identify a
    row, or its repeats are equal in all columns; ``by`` is not null.
    """
    keys = [by, *order]
    xors, sums = list(xors), list(sums)
    window = Window.partitionBy("_pid", by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = rows.repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id())
    done = {"place": F.row_number().over(window).cast("long"), **{c: F.bit_xor(c).over(window) for c in xors},
            **{c: F.sum(c).over(window) for c in sums}}
    local = materialize(dealt.withColumns(done), "running")
    last = local.groupBy("_pid").agg(F.max(F.struct(by, "place", *xors, *sums)).alias("_t"))
    through = Window.partitionBy("_t." + by).orderBy("_pid")  # one row for each partition
    carry = last.select(F.lead("_pid").over(Window.orderBy("_pid")).alias("_pid"), F.col("_t." + by).alias(by),
                        F.sum("_t.place").over(through).alias("_place"),
                        *[F.bit_xor("_t." + c).over(through).alias("_x" + c) for c in xors],
                        *[F.sum("_t." + c).over(through).alias("_s" + c) for c in sums])
    out = local.join(F.broadcast(carry), ["_pid", by], "left")
    return out.select(*[c for c in rows.columns if c not in (*xors, *sums)], (F.col("place") + F.coalesce("_place", F.lit(0))).alias("place"),
                      *[F.col(c).bitwiseXOR(F.coalesce("_x" + c, F.lit(0))).alias(c) for c in xors],
                      *[(F.col(c) + F.coalesce("_s" + c, F.lit(0))).alias(c) for c in sums])
