"""Insert-ignore by the key index: only files that may hold a key are read."""

import os
import random

import pytest
from pyspark.sql import functions as F

from flowgrid.sources import key_index, sinks


def parts(path):
    return sorted(f for f in os.listdir(path) if f.endswith(".parquet"))


def wreck(path, names):
    """Overwrites files in place, length and time kept: whoever reads one fails."""
    for n in names:
        f = os.path.join(path, n)
        at = os.stat(f)
        with open(f, "wb") as out:
            out.write(b"x" * at.st_size)
        os.utime(f, ns=(at.st_atime_ns, at.st_mtime_ns))
        crc = os.path.join(path, f".{n}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def monthly(spark, path, months=6, per=200):
    for m in range(months):
        df = spark.range(m * per, (m + 1) * per).select(F.lit(m).alias("month"), F.concat(F.lit("k"), F.hash("id")).alias("key"), (F.col("id") * 2).alias("v"))
        df.coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("keys", [["month", "key"], ["key"]])
def test_untouched_files_are_not_read(spark, tmp_path, keys):
    path = str(tmp_path / "t")
    monthly(spark, path)
    target = spark.read.parquet(path)
    batch = target.where("month = 3").limit(20).withColumn("v", F.lit(-1).cast("long"))
    new = spark.range(5).select(F.lit(3).alias("month"), F.concat(F.lit("new"), "id").alias("key"), F.col("id").alias("v"))
    batch = spark.createDataFrame(batch.unionByName(new).collect(), target.schema)
    touched = key_index.files_with(spark, path, target, batch, keys)
    with_month = {r.f for r in target.where("month = 3").select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    assert set(touched) >= with_month and len(touched) < 6
    names = {os.path.basename(f) for f in touched}
    wreck(path, [p for p in parts(path) if p not in names])
    before = set(parts(path))
    sinks.insert_ignore(path, batch, keys, target.schema)
    added = [os.path.join(path, p) for p in parts(path) if p not in before]
    assert sorted(r.key for r in spark.read.parquet(*added).collect()) == [f"new{i}" for i in range(5)]
    # a second call indexes the added files alone and appends nothing
    again = set(parts(path))
    sinks.insert_ignore(path, batch, keys, target.schema)
    assert sum(spark.read.parquet(os.path.join(path, p)).count() for p in set(parts(path)) - again) == 0


def test_equal_to_the_full_anti_join(spark, tmp_path):
    rng = random.Random(1)
    path = str(tmp_path / "t")
    rows = [(rng.choice([None, "a", "b", "c"]), rng.randrange(300), float(i)) for i in range(900)]
    schema = "g string, k long, v double"
    seen = []
    for i in range(0, 900, 150):
        batch = spark.createDataFrame(rows[i:i + 150], schema)
        if not i:
            batch.write.parquet(path)
            seen += rows[:150]
            continue
        taken = {r[:2] for r in seen if r[0] is not None}
        seen += [r for r in rows[i:i + 150] if r[0] is None]
        best = {}
        for r in rows[i:i + 150]:
            if r[0] is not None and r[:2] not in taken:
                best[r[:2]] = min(best.get(r[:2], r[2]), r[2])
        seen += [(*k, v) for k, v in best.items()]
        sinks.insert_ignore(path, batch, ["g", "k"])
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=repr) == sorted(seen, key=repr)


def test_changed_and_removed_files_and_large_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    monthly(spark, path, 3)
    target = spark.read.parquet(path)
    batch = target.where("month = 1")
    first = key_index.files_with(spark, path, target, batch, ["month", "key"])
    # beyond max_probed the bounds alone decide: never fewer files
    assert set(first) <= set(key_index.files_with(spark, path, target, batch, ["month", "key"], max_probed=1))
    assert len(first) == 1
    gone = first[0].removeprefix("file:")
    os.remove(gone.replace("//", "/"))
    target = spark.read.parquet(path)
    assert key_index.files_with(spark, path, target, spark.createDataFrame(batch.limit(0).collect(), target.schema), ["month", "key"]) == []
    left = spark.createDataFrame([(1, "k0", 1)], target.schema)
    assert key_index.files_with(spark, path, target, left, ["month", "key"]) == []
    empty = str(tmp_path / "e")
    target.limit(0).write.parquet(empty)
    assert sinks.insert_ignore(empty, left, ["month", "key"]).count() == 1
