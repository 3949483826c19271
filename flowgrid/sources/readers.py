"""Readers: trip CSVs and zip archives, nested JSON feeds, projected Parquet,
schema enforcement and downcasting."""

from __future__ import annotations

import csv
import functools
import io
import zipfile
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgrid.session import materialize

# Trip files carry 13 columns; 10 are kept (ids as text).
TRIP_CSV_COLUMNS = ["ride_id", "rideable_type", "started_at", "ended_at", "start_station_name", "start_station_id",
                    "end_station_name", "end_station_id", "start_lat", "start_lng", "end_lat", "end_lng",
                    "member_casual"]
TRIP_KEEP = ["started_at", "ended_at", "start_station_id", "end_station_id", "rideable_type", "member_casual",
             "start_lat", "start_lng", "end_lat", "end_lng"]
TRIP_FILE_PATTERN = r"-tripdata_[^/]*\.csv(/part-[^/]*)?$"  # a file, or a folder of part files
TRIP_ZIP_PATTERN = r"-tripdata[^/]*\.zip$"


def _typed_trips(raw: DataFrame) -> DataFrame:
    return raw.select(
        *[F.col(c).try_cast("timestamp_ntz").alias(c) if c in ("started_at", "ended_at")
          else F.col(c).try_cast("double").alias(c) if c.endswith(("_lat", "_lng"))
          else F.col(c).cast("string").alias(c) for c in TRIP_KEEP])


def header_forms(spark: SparkSession, path: str, pattern: str = TRIP_FILE_PATTERN) -> list[tuple[tuple[str, ...], list[str]]]:
    """(column names, files) of every header form among the text files below
    ``path`` that match ``pattern``.  A file's header is the first line of the
    task that reads its first block; the lines meet their file names through
    the scan's metadata, so no file is opened on the driver.  The driver gets
    one row for each form, with the file names that the planner lists anyway;
    empty files have no form."""
    first = F.col("_metadata.file_block_start") == 0
    lines = (spark.read.option("recursiveFileLookup", True).text(path)
             .where(F.col("_metadata.file_path").rlike(pattern) & first)
             .select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n")))
    headers = lines.groupBy("file").agg(F.min_by("value", "n").alias("header"))
    forms = headers.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header")
    return [(tuple(c.strip().strip("\ufeff") for c in next(csv.reader([r["header"]]))), r["files"]) for r in forms.collect() if r["header"].strip()]


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """All trip CSVs below ``path`` whose file name matches
    ``*-tripdata_*.csv``, columns taken by header name: files are grouped by
    their header (``header_forms``), each group is one scan under its own
    column order, missing columns are null, others are dropped.  Every column
    is read as text, then typed with ``try_cast`` (bad timestamps -> null).
    Unused columns are pruned by the CSV scan."""
    parts = []
    for names, files in header_forms(spark, path):
        raw = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).option("header", True).csv(files)
        parts.append(raw.select(*[F.col(c) if c in names else F.lit(None).cast("string").alias(c) for c in TRIP_KEEP]))
    if not parts:
        parts = [spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in TRIP_KEEP]))]
    return _typed_trips(functools.reduce(DataFrame.unionByName, parts))


ZIP_CHUNK_ROWS = 100_000
_MEMBER = "archive string, member string, offset long, packed long, size long"


def archive_members(spark: SparkSession, path: str, pattern: str = TRIP_ZIP_PATTERN) -> DataFrame:
    """(archive, member, offset, packed, size) of every CSV in the zip archives
    below ``path``: tasks read the central directories at the archives' ends
    (ranged reads), never their contents."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
              .select(F.col("path").alias("archive")).where(F.col("archive").rlike(pattern)))
    n = max(1, listed.count())

    def members(it):
        for pdf in it:
            for archive in pdf["archive"]:
                with _opened(archive) as fh, zipfile.ZipFile(fh) as z:
                    rows = [(archive, i.filename, i.header_offset, i.compress_size, i.file_size) for i in z.infolist()
                            if i.filename.endswith(".csv") and not i.is_dir()]
                yield pd.DataFrame(rows, columns=["archive", "member", "offset", "packed", "size"])

    return listed.repartitionByRange(min(n, 10_000), "archive").mapInPandas(members, _MEMBER)


def _opened(uri: str):
    """A seekable file of any store that Arrow reaches (local, HDFS, object stores)."""
    from pyarrow import fs as pafs
    filesystem, at = pafs.FileSystem.from_uri(uri)
    return filesystem.open_input_file(at)


def _reachable(uri: str) -> bool:
    from pyarrow import ArrowInvalid
    from pyarrow import fs as pafs
    try:
        pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    except (ArrowInvalid, NotImplementedError):
        return False
    return True


def _csv_rows(fh):
    for chunk in pd.read_csv(fh, dtype=str, keep_default_na=False, na_values=[""], chunksize=ZIP_CHUNK_ROWS):
        yield chunk.reindex(columns=TRIP_CSV_COLUMNS).astype(object).where(chunk.notna(), None)


def read_trip_archives(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """Monthly zip archives -> CSV rows, columns by header name.

    The archives' central directories are the index: each member is found by
    its offset, so an archive's members are dealt to many tasks, the large ones
    apart (by running packed size; ``tasks`` is at most one for each member).
    A task seeks to a member and unpacks it as a stream, parsed in chunks, so
    neither an archive nor a member, of whatever size, is ever held whole.
    Stores that only Spark's readers reach have their archives read as one
    binary row each (``read_whole_archives``)."""
    if not _reachable(path):
        return read_whole_archives(spark, path)
    found = materialize(archive_members(spark, path), "archive-members")
    count, packed = found.agg(F.count(F.lit(1)), F.sum("packed")).first()
    schema = T.StructType([T.StructField(c, T.StringType()) for c in TRIP_CSV_COLUMNS])
    if not count:
        return _typed_trips(spark.createDataFrame([], schema))

    def unpack(it):
        for pdf in it:
            for archive, names in pdf.groupby("archive", sort=False)["member"]:
                with _opened(archive) as fh, zipfile.ZipFile(fh) as z:
                    for name in names:
                        with z.open(name) as member:
                            yield from _csv_rows(member)

    n = tasks or int(min(count, max(spark.sparkContext.defaultParallelism, packed // ZIP_TASK_BYTES)))
    return _typed_trips(found.repartitionByRange(n, F.desc("packed"), "archive", "offset").mapInPandas(unpack, schema))


#: packed bytes for each task, beyond one task for each core
ZIP_TASK_BYTES = 32 << 20


def read_whole_archives(spark: SparkSession, path: str) -> DataFrame:
    """Zip archives through Spark's own reader: one binary row of at most 2 GB,
    thus one task, for each archive."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .where(F.col("path").rlike(TRIP_ZIP_PATTERN)).select("content"))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in TRIP_CSV_COLUMNS])

    def unzip(it):
        for pdf in it:
            for blob in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(blob)) as z:
                    for name in z.namelist():
                        if name.endswith(".csv"):
                            with z.open(name) as fh:
                                yield from _csv_rows(fh)

    return _typed_trips(files.mapInPandas(unzip, schema))


STATION_FIELDS = ["short_name", "station_id", "name", "capacity", "lat", "lon"]
_STATION_FEED = "data struct<stations: array<struct<short_name: string, station_id: string, name: string, capacity: int, lat: double, lon: double>>>"
_STATUS_FEED = "data struct<stations: array<struct<station_id: string, num_bikes_available: int, num_docks_available: int>>>"
_WEATHER_FEED = "data array<struct<time: string, temp: double, rhum: double, prcp: double, wspd: double, coco: string>>"


def read_stations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Nested station feed ``{"data": {"stations": [...]}}`` -> 6 columns
    (declared schema: no inference pass).  ``multi_line``: one (pretty-printed)
    document per file, as served; otherwise one document per line (several feed
    parts per file)."""
    return spark.read.schema(_STATION_FEED).option("multiLine", multi_line).json(path).select(F.inline("data.stations"))


def read_station_status(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return spark.read.schema(_STATUS_FEED).option("multiLine", multi_line).json(path).select(F.inline("data.stations"))


def read_weather_json(spark: SparkSession, path: str, source_tz: str | None = None, target_tz: str = "UTC") -> DataFrame:
    """Hourly weather payloads ``{"data": [{time, temp, rhum, prcp, wspd, coco,
    ...}]}`` (one document per line): parse time (local to ``source_tz``, if
    given, then shown in ``target_tz``), rename, keep 6 columns."""
    rows = spark.read.schema(_WEATHER_FEED).json(path).select(F.inline("data"))
    time = F.col("time").try_cast("timestamp_ntz")
    if source_tz:
        time = F.convert_timezone(F.lit(source_tz), F.lit(target_tz), time)
    return rows.select(time.alias("time"), "temp", F.col("rhum").alias("relative_humidity"),
                       F.col("prcp").alias("precipitation_total"), F.col("wspd").alias("average_wind_speed"), "coco")


def newest_observation(weather: DataFrame) -> DataFrame:
    """The latest weather row (ties by all columns), as a 1-row frame."""
    others = [c for c in weather.columns if c != "time"]
    return (weather.where(F.col("time").isNotNull()).agg(F.max(F.struct("time", *others)).alias("_r"))
            .where(F.col("_r").isNotNull()).select("_r.*").select(*weather.columns))


def read_parquet_projected(spark: SparkSession, path: str, cols: Sequence[str], where=None) -> DataFrame:
    """Named columns only (pruned at the scan), optional pushed predicate."""
    df = spark.read.parquet(path).select(*cols)
    return df.where(where) if where is not None else df


def enforce(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, list[str], list[str]]:
    """Coerce every declared column with ``try_cast`` (unparseable -> null),
    add missing ones as null, drop extra ones, fix the order.  Returns the
    frame and the missing / extra column names (schema metadata only)."""
    have = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in have]
    extra = [c for c in df.columns if c.lower() not in {f.name.lower() for f in schema.fields}]
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        cols.append((F.col(src).try_cast(f.dataType) if src else F.lit(None).cast(f.dataType)).alias(f.name))
    return df.select(*cols), missing, extra


def downcast(df: DataFrame) -> DataFrame:
    """double -> float, bigint -> int (training-set footprint)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            out.append(F.col(f.name).cast("float").alias(f.name))
        elif isinstance(f.dataType, T.LongType):
            out.append(F.col(f.name).cast("int").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
