"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "flowgrid", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    On a cluster the master and most sizing come from spark-submit; locally
    ``master`` defaults to ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master or not os.environ.get("SPARK_MASTER"):
        b = b.master(master or "local[*]")
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    share_code(spark)
    return spark


def share_code(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package wherever the
    driver was started from (on a cluster it is installed or sent along)."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in paths:
        env["PYTHONPATH"] = os.pathsep.join([here, *paths])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only in a local session
    (tests) an unset folder falls back to a fresh scratch folder."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if sc_dir.isDefined():
        return sc_dir.get()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="flowgrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediate tables."""
    return ensure_checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never machine-local
    on a cluster, because the checkpoint folder is the cluster's)."""
    import uuid
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def arrow_batches(spark: SparkSession, max_bytes: int):
    """Arrow batches of at most about ``max_bytes`` for the Python passes that
    run inside the block, as rows of a pass may be long (texts, whole sets) and
    10 000 of them make a batch by default.  A smaller bound of the session
    stays; its own value is restored afterwards."""
    before = spark.conf.get(_BATCH_BYTES, None)
    own = int(before) if str(before or "").isdigit() else None
    spark.conf.set(_BATCH_BYTES, str(min(max_bytes, own or max_bytes)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_BYTES)
        else:
            spark.conf.set(_BATCH_BYTES, before)


def materialize(df, name: str = "stage", compression: str | None = None):
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: cuts the lineage (a lost executor re-reads files instead of
    recomputing upstream Python passes) and later scans get column pruning
    and predicate pushdown."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)  # known schema: no footer-inference job
