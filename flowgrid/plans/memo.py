"""Per-session materialisation of derived tables (Parquet in the shared
checkpoint folder).  Derived stand-in tables and the grid are computed once
per session and input folder, like tables loaded into a warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowgrid.session import materialize

_MEMO: dict = {}


def _state(spark, folder: str) -> tuple:
    """(bytes, files, newest change) of the tables the stand-ins come from."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out = []
    for name in ("events", "orders"):
        p = fs_path(f"{folder.rstrip('/')}/{name}.parquet")
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(p):
            s = fs.getContentSummary(p)
            out.append((s.getLength(), s.getFileCount(), fs.getFileStatus(p).getModificationTime()))
    return tuple(out)


def memo(spark, sf_dir: str, name: str, build) -> DataFrame:
    """``build()`` written once per session, folder and state of the folder's
    tables (a changed table is a new entry)."""
    key = (spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir), name)
    if key not in _MEMO:
        _MEMO[key] = materialize(build(), name)
    return _MEMO[key]


def memo_value(spark, sf_dir: str, name: str, build):
    """``build()`` once per session, folder and state of the folder's tables (for
    values that are no table, such as a fitted model)."""
    key = (spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir), name)
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def clear_memo() -> None:
    _MEMO.clear()
