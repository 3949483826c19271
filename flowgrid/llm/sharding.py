"""Sharding through a permutation-filled lookup table (DataFrame functions only).

Each shard walks its own permutation of the slots of a prime-sized table; the
shards take turns claiming their next free slot until the table is full.
Placement is then one lookup: ``table[hash(key) % slots]``.  The table has
``slots`` rows whatever the corpus holds, so it is broadcast (its size is the
bound).  Shares differ by at most a few slots, and removing one shard moves
few keys of the others.

Edge cases: rows with a null key are placed by their text (null: empty), so
they do not all meet in one shard.  Repeated rows go to the same shard.  An
empty table stays empty.  Input columns are kept; ``slot``/``shard`` of the
input, if any, are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65537
SHARDS = [f"shard-{i:03d}" for i in range(64)]
MAX_SLOTS = 2_000_003


def fill_table(shards: list[str], slots: int = SLOTS, weights: dict[str, int] | None = None) -> list[str]:
    """The slot -> shard table.  ``weights`` gives a shard several turns a round."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct and not empty")
    if slots > MAX_SLOTS or slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError(f"slots must be a prime from {len(shards)} to {MAX_SLOTS}")
    turns = {s: max(1, int((weights or {}).get(s, 1))) for s in shards}
    walk = {}
    for s in shards:
        d = hashlib.sha256(s.encode()).digest()
        walk[s] = (int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:16], "big") % (slots - 1) + 1)
    step = dict.fromkeys(shards, 0)
    table: list[str | None] = [None] * slots
    free = slots
    while free:
        for s in shards:
            for _ in range(turns[s]):
                if not free:
                    break
                offset, skip = walk[s]
                while table[at := (offset + step[s] * skip) % slots] is not None:
                    step[s] += 1
                table[at] = s
                step[s] += 1
                free -= 1
    return table  # type: ignore[return-value]


def slot_of(key: Column, fallback: Column, slots: int) -> Column:
    """Stable slot of a key: 60 bits of its MD5, modulo the table size."""
    text = F.coalesce(key.cast("string"), F.concat(F.lit("null:"), F.coalesce(fallback.cast("string"), F.lit(""))))
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint") % slots).cast("int")


def assign_shards(docs: DataFrame, shards: list[str] = SHARDS, slots: int = SLOTS, key: str = "doc_id",
                  fallback: str = "text", weights: dict[str, int] | None = None) -> DataFrame:
    """``docs`` with ``slot`` and ``shard``."""
    spark: SparkSession = docs.sparkSession
    table = fill_table(shards, slots, weights)
    names = [c for c in docs.columns if c not in ("slot", "shard")]
    # columns by position: no input name, dotted or not, meets one of ours
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {c: F.col(f"c{i}") for i, c in enumerate(docs.columns)}
    placed = numbered.select(*[at[c] for c in names], slot_of(at[key], at.get(fallback, F.lit("")), slots).alias("slot"))
    place = spark.createDataFrame([(i, s) for i, s in enumerate(table)], "slot int, shard string")
    out = placed.join(F.broadcast(place), "slot", "left").select(*placed.columns, "shard")
    return out.toDF(*names, "slot", "shard")
