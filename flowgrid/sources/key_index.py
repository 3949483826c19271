"""Key index of a Parquet table: which data files may hold a key.

Beside the data lies ``_key_index`` (Spark's readers skip names with an
underscore): one row for each data file with its rows, smallest and largest
key and a Bloom filter of its keys.  A batch of keys is held against these rows
alone, so a file without any of them is never opened.  The index follows the
table: files that it doesn't know, by path, length and time, are indexed on the
next use, and rows of files that are gone are ignored; it can be deleted at any
time.

Filters have ``BITS`` bits for each key and ``PROBES`` probes, so a file without
a key is read for it with a probability of about 0.24 %.  They are built with
built-in aggregates: bits are or-ed together word by word, map-side first.  A
filter is as large as its file has rows (``maxRecordsPerFile`` bounds it).
Probing sends the batch's 64-bit key hashes to the tasks that hold the filters;
a batch of more than ``MAX_PROBED`` keys goes by smallest and largest key alone.
Keys with a null conflict with nothing and are not indexed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 16
PROBES = 4
MAX_PROBED = 1_000_000
_ROW = "file string, length long, time timestamp, n long, words int, lo {key}, hi {key}, word array<int>, bits array<long>"


def _path(table: str) -> str:
    return f"{table.rstrip('/')}/_key_index"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def data_files(spark: SparkSession, table: str) -> DataFrame:
    """(file, length, time) of the table's data files: a listing, nothing is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(table)
    meta = [F.col(f"_metadata.{c}").alias(a) for c, a in (("file_path", "file"), ("file_size", "length"), ("file_modification_time", "time"))]
    return listed.select(*meta).where(~F.substring_index("file", "/", -2).contains("_key_index"))


def _only(df: DataFrame, files: Sequence[str]) -> DataFrame:
    """The rows of some data files: the condition is applied to the file listing."""
    return df.where(F.col("_metadata.file_path").isin(list(files)))


def key_hash(keys: Sequence[str]):
    return F.xxhash64(*keys)


def _complete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna("any", subset=list(keys))


def _rows(spark: SparkSession, table: str, target: DataFrame, keys: Sequence[str], files: DataFrame) -> DataFrame:
    """Index rows of ``files``; their key columns are read, nothing else."""
    names = [r["file"] for r in files.select("file").collect()]  # names of data files, as the planner has them too
    keyed = _complete(_only(target, names), keys).select(F.col("_metadata.file_path").alias("file"), F.struct(*keys).alias("k"), key_hash(keys).alias("h"))
    size = F.greatest(F.lit(16), F.ceil(F.col("n") * BITS / 64)).cast("int")
    bounds = keyed.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).withColumn("words", size)
    # one row for each file: the sizes meet the keys by broadcast
    probes = keyed.join(F.broadcast(bounds.select("file", "words")), "file").select(
        "file", F.explode(F.array(*[F.pmod(F.xxhash64("h", F.lit(i)), F.col("words").cast("long") * 64) for i in range(PROBES)])).alias("bit"))
    words = probes.groupBy("file", F.shiftright("bit", 6).cast("int").alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("b"))
    filters = words.groupBy("file").agg(F.collect_list(F.struct("w", "b")).alias("f"))
    out = files.join(bounds, "file", "left").join(filters, "file", "left")
    return out.select("file", "length", "time", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("words", F.lit(0)).alias("words"), "lo", "hi",
                      F.coalesce(F.col("f.w"), F.array().cast("array<int>")).alias("word"), F.coalesce(F.col("f.b"), F.array().cast("array<long>")).alias("bits"))


def index(spark: SparkSession, table: str, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The index rows of the data files that are there now; files not yet
    indexed are indexed first."""
    key = target.select(F.struct(*keys).alias("k")).schema["k"].dataType.simpleString()
    schema, path = _ROW.format(key=key), _path(table)
    here = data_files(spark, table)
    match = ["file", "length", "time"]
    if _exists(spark, path):
        new = here.join(spark.read.schema(schema).parquet(path).select(*match), match, "left_anti")
    else:
        new = here
    if not new.isEmpty():
        _rows(spark, table, target, keys, new).coalesce(8).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path).join(here, match, "left_semi").dropDuplicates(["file"])


def _probe(shared):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        for batch in batches:
            held = []
            for i in range(batch.num_rows):
                n = batch.column("words")[i].as_py()
                bits = np.zeros(n, np.uint64)
                bits[batch.column("word")[i].values.to_numpy()] = batch.column("bits")[i].values.to_numpy().view(np.uint64)
                open_ = np.arange(asked.shape[1])
                for k in range(PROBES):
                    at = np.mod(asked[k, open_], n * 64) if n else asked[k, :0]
                    open_ = open_[:len(at)]
                    open_ = open_[(bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1]
                held.append(len(open_) > 0)
            yield pa.RecordBatch.from_arrays([batch.column("file").filter(pa.array(held))], names=["file"])
    return probe


def files_with(spark: SparkSession, table: str, target: DataFrame, batch: DataFrame, keys: Sequence[str],
               max_probed: int = MAX_PROBED) -> list[str]:
    """Data files that may hold a key of ``batch``: all that do, and few others."""
    keyed = _complete(batch.select(*keys), keys).select(F.struct(*keys).alias("k"), key_hash(keys).alias("h"))
    span = keyed.agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count_distinct("h").alias("n")).first()
    rows = index(spark, table, target, keys)
    if not span["n"]:
        return []
    bound = keyed.agg(F.struct(F.min("k").alias("lo"), F.max("k").alias("hi")).alias("_s")).scalar()
    rows = rows.where((F.col("lo") <= bound.getField("hi")) & (F.col("hi") >= bound.getField("lo")))
    if span["n"] > max_probed:
        return sorted(r["file"] for r in rows.select("file").collect())
    # at most max_probed hashes
    found = keyed.select("h").distinct().select(*[F.xxhash64("h", F.lit(i)).alias(f"h{i}") for i in range(PROBES)]).toArrow()
    shared = spark.sparkContext.broadcast(np.stack([c.to_numpy() for c in found.columns]))
    return sorted(r["file"] for r in rows.select("file", "words", "word", "bits").mapInArrow(_probe(shared), "file string").collect())


def rows_with(spark: SparkSession, table: str, target: DataFrame, batch: DataFrame, keys: Sequence[str], max_probed: int = MAX_PROBED) -> DataFrame:
    """The target's rows in files that may hold a key of ``batch``."""
    return _only(target, files_with(spark, table, target, batch, keys, max_probed))
