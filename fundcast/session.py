"""Session helpers.

The library never creates a session: every entry point takes the caller's
``SparkSession``. These helpers only pin the settings whose absence changes
results (the session time zone) and locate a shared scratch folder.
"""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

UTC = "UTC"


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC.

    ``from_unixtime`` and ``datediff`` depend on it, and the zone is captured
    when a plan is built, so call this before building the plan.
    """
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)
    return spark


def share_code(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, wherever
    the driver was started. On a cluster whose machines do not share that folder,
    submit the package with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    In order: the folder already set on the context, the one named by
    ``spark.checkpoint.dir``, else a unique folder below the user's home on
    Hadoop's default file system (which every executor can reach; in local
    mode that is the local disk). Never a machine-local temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        fs = sc._jvm.org.apache.hadoop.fs.FileSystem.get(sc._jsc.hadoopConfiguration())
        home = fs.getHomeDirectory().toString().rstrip("/")
        configured = f"{home}/.fundcast/{sc.applicationId}-{uuid.uuid4().hex[:8]}"
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


_CREATED: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder, remembered
    for ``release_scratch``."""
    path = f"{checkpoint_dir(spark)}/fundcast-{name}-{uuid.uuid4().hex[:12]}"
    _CREATED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_paths(spark: SparkSession) -> list[str]:
    """Scratch paths handed out in this application so far."""
    return list(_CREATED.get(spark.sparkContext.applicationId, []))


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch paths this application created (lineage cuts,
    intermediate tables, saved test models) through the Hadoop FileSystem
    API, so it works on any shared file system. Call it only when no
    DataFrame built on them is used any more. Returns how many existed."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for p in _CREATED.pop(spark.sparkContext.applicationId, []):
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            fs.delete(path, True)
            removed += 1
    return removed


def cut_lineage(df, name: str = "stage", compression: str | None = None):
    """Write ``df`` as Parquet below the shared checkpoint folder and return
    the reloaded frame.

    Frames read by several passes (fit, then transform) are computed once;
    a lost executor afterwards costs a re-read of this table, not a
    recomputation from the sources. Parquet keeps it columnar and compressed
    (vector columns included); ``compression`` names another codec than the
    session's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.parquet(path)
