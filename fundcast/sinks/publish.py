"""Replacing a table so that a reader sees the old version or the new one, never a half.

A published table is a folder of versions and a marker that names the current one. A
version is written beside the others; only when it is whole does the marker move to it,
by an atomic rename. Whatever ends a write before that leaves the old version current.
Everything goes through Hadoop's file system interface, so it works wherever Spark
writes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

MARKER = "_CURRENT"
_PREFIX = "version-"


def _place(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, where, where.getFileSystem(conf)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Path of the version that readers follow, or None before the first."""
    jvm, _, where, fs = _place(spark, path)
    marker = jvm.org.apache.hadoop.fs.Path(where, MARKER)
    if not fs.exists(marker):
        return None
    stream = fs.open(marker)
    try:
        name = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    return f"{path.rstrip('/')}/{name}"


def _point(spark: SparkSession, path: str, name: str) -> None:
    jvm, conf, where, fs = _place(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(where, f"{MARKER}.{uuid.uuid4().hex[:8]}")
    out = fs.create(beside)
    try:
        out.write(bytearray(name.encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
        fs.makeQualified(beside), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(where, MARKER)), how
    )


def publish_parquet(df: DataFrame, path: str, keep: int = 1) -> str:
    """Write ``df`` as the new version of the table at ``path`` and make it current.
    ``df`` may read the table itself. The version before it stays for readers that
    still hold it, ``keep`` of them; older ones are removed. Returns the version's path."""
    spark = df.sparkSession
    before = current_version(spark, path)
    name = f"{_PREFIX}{uuid.uuid4().hex}"
    new = f"{path.rstrip('/')}/{name}"
    df.write.parquet(new)
    _point(spark, path, name)
    _retire(spark, path, {new, before}, keep)
    return new


def _retire(spark: SparkSession, path: str, current: set, keep: int) -> None:
    _, _, where, fs = _place(spark, path)
    names = {v.rsplit("/", 1)[1] for v in current if v}
    found = [s for s in fs.listStatus(where) if s.isDirectory() and s.getPath().getName().startswith(_PREFIX)]
    old = sorted((s for s in found if s.getPath().getName() not in names), key=lambda s: -s.getModificationTime())
    for status in old[max(keep - 1, 0) :]:
        fs.delete(status.getPath(), True)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published table."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no published version at {path}")
    return spark.read.parquet(version)
