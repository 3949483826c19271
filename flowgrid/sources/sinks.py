"""Writers: sized/sorted Parquet, month partitions, CSV, table refresh,
insert-ignore, period backfill and additive-schema append.  Each writer
returns the table read back, so callers keep working lazily on the stored
copy.  Targets are paths in shared storage; concurrent writers to one target
are not supported (no transactional table format is assumed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgrid.functions.dates import date_trunc_ntz, datediff_boundaries, ntz_lit
from flowgrid.sources import key_index


def write_parquet(df: DataFrame, path: str, sort_by: Sequence[str] = (), partition_by: Sequence[str] = (),
                  max_records_per_file: int = 5_000_000, n_partitions: int | None = None) -> DataFrame:
    """Parallel export: range-partition on ``sort_by`` (each output file
    holds one contiguous key range, sorted), cap rows per file.  A hash of
    the whole row is appended to the range key as a tie-breaker, so a sort
    value shared by a large share of the rows is split over many tasks (the
    hash is deterministic, so a retried task writes the same rows)."""
    out = df
    if sort_by:
        n = n_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        out = (out.withColumn("_tb", F.xxhash64(*[F.col(c) for c in df.columns]))
               .repartitionByRange(n, *sort_by, "_tb").sortWithinPartitions(*sort_by, "_tb").drop("_tb"))
    w = out.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_month_partitions(df: DataFrame, path: str, ts: str, files_per_month: int = 8) -> DataFrame:
    """``year=/month=`` partitions (derived from ``ts`` where the columns are
    missing).  Rows are dealt by month and a row hash, so a month is at most
    ``files_per_month`` files, however many tasks produced it."""
    new = {c: f(ts) for c, f in (("year", F.year), ("month", F.month)) if c not in df.columns}
    d = df.withColumns(new) if new else df
    d = d.repartition("year", "month", F.pmod(F.xxhash64(*df.columns), F.lit(files_per_month)))
    d.write.mode("overwrite").partitionBy("year", "month").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("header", True).csv(path)
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)


def full_refresh(df: DataFrame, name: str, path: str) -> DataFrame:
    """Drop + create + load as an external table at ``path``."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return spark.table(name)


def insert_ignore(path: str, batch: DataFrame, keys: Sequence[str], schema=None) -> DataFrame:
    """Append the batch rows whose key is not yet in the table at ``path``
    (existing row wins); files already there are not touched.  Equal keys
    inside the batch keep the smallest row (by all columns); null keys never
    conflict, as in Postgres.  The batch is deduplicated by an aggregate
    (skew-safe) and anti-joined with the keys of those target files that may
    hold one of them, by the table's ``key_index``; other files are not opened.
    A repeated call appends nothing, except rows with null keys.  Without the
    table's ``schema`` one file's footer is read for it."""
    spark = batch.sparkSession
    target = spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)
    keys = list(keys)
    others = [c for c in batch.columns if c not in keys]
    nn = F.lit(True)
    for k in keys:
        nn = nn & F.col(k).isNotNull()
    keyed, nullkey = batch.where(nn), batch.where(~nn)
    dedup = keyed.distinct() if not others else keyed.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_r")).select(
        *keys, *[F.col("_r." + c).alias(c) for c in others])
    held = key_index.rows_with(spark, path, target, keyed, keys)
    fresh = dedup.join(held.select(*keys), keys, "left_anti")
    out = fresh.select(*target.columns).unionByName(nullkey.select(*target.columns))
    out.write.mode("append").parquet(path)
    return spark.read.schema(target.schema).parquet(path)


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def period_start(ts, period: str, anchor=None):
    """Start of the period that holds ``ts``: periods are counted from
    ``anchor`` (whole months keep its day, clamped at month ends), or follow the
    calendar without one."""
    if anchor is None:
        return date_trunc_ntz(period, ts)
    a, t = ntz_lit(anchor), F.col(ts) if isinstance(ts, str) else ts
    if period in _MONTHS:
        step = _MONTHS[period]
        n = F.floor(datediff_boundaries(a, t, "month") / F.lit(step)).cast("int")
        n = F.when(F.timestamp_add("MONTH", n * step, a) > t, n - 1).otherwise(n)
        return F.timestamp_add("MONTH", n * step, a)
    n = F.floor(F.timestamp_diff("SECOND", a, t) / F.lit({"hour": 3600, "day": 86400, "week": 604800}[period])).cast("int")
    return F.timestamp_add(period.upper(), n, a)


def backfill_by_period(source: DataFrame, target_path: str, ts: str, stop, period: str = "month",
                       start=None) -> DataFrame:
    """Insert-by-period in one pass: load the rows after the newest loaded
    timestamp (``start`` when the target is empty or absent; a row exactly at
    it is not loaded) and before ``stop`` minus one millisecond, stamped with
    the start of their ``period`` - counted from ``start``, or by the calendar
    without one - and appended as partitions of the target.  The union of the
    per-period statements is this one range, so no driver loop is needed; a
    rerun resumes after the new maximum, so it never loads a row twice, and a
    failed job leaves no committed files."""
    spark: SparkSession = source.sparkSession
    hi = None
    if _path_exists(spark, target_path):
        hi = spark.read.schema(source.select(ts).schema).parquet(target_path).agg(F.max(ts)).first()[0]
    lower = ntz_lit(hi) if hi is not None else (ntz_lit(start) if start is not None else None)
    cond = F.col(ts) < F.timestamp_add("MILLISECOND", F.lit(-1), ntz_lit(stop))
    if lower is not None:
        cond = cond & (F.col(ts) > lower)
    label = F.date_format(period_start(ts, period, start), "yyyy-MM-dd HH" if period == "hour" else "yyyy-MM-dd")
    batch = source.where(cond).withColumn("period", label)
    batch.write.mode("append").partitionBy("period").parquet(target_path)
    return spark.read.schema(batch.schema).parquet(target_path)  # declared: the table may still be empty


def rewrite_periods(source: DataFrame, target_path: str, ts: str, stop, period: str = "month", start=None) -> DataFrame:
    """Insert-by-period that replaces whole periods: from the start of the
    newest loaded one up to ``stop`` minus one millisecond, every period that is
    touched is written anew from ``source`` and takes the place of its old
    partition when the job commits (dynamic partition overwrite); periods
    before it stay untouched.  A load that failed, ran twice or came with half
    of a period's rows is put right by the next one, and late rows of the newest
    period come in.  ``start`` as in ``backfill_by_period``."""
    spark: SparkSession = source.sparkSession
    hi = None
    if _path_exists(spark, target_path):
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(target_path)  # names only, no file is opened
        hi = listed.agg(F.max(F.url_decode(F.regexp_extract("path", "/period=([^/]+)/", 1)))).first()[0] or None
    name = F.date_format(period_start(ts, period, start), "yyyy-MM-dd HH" if period == "hour" else "yyyy-MM-dd")
    cond = F.col(ts) < F.timestamp_add("MILLISECOND", F.lit(-1), ntz_lit(stop))
    if start is not None:
        cond = cond & (F.col(ts) > ntz_lit(start))
    if hi is not None:
        cond = cond & (F.col("period") >= hi)
    batch = source.withColumn("period", name).where(cond)
    batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(target_path)
    return spark.read.schema(batch.schema).parquet(target_path)


def append_evolving(target_path: str, batch: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """Append with additive schema evolution: columns the batch lacks are null,
    new batch columns are added (reported once: the table's schema is that of
    all its files)."""
    spark = batch.sparkSession
    old = spark.read.option("mergeSchema", True).parquet(target_path)
    missing = [c for c in old.columns if c not in batch.columns]
    extra = [c for c in batch.columns if c not in old.columns]
    batch.write.mode("append").parquet(target_path)
    return spark.read.option("mergeSchema", True).parquet(target_path), missing, extra
