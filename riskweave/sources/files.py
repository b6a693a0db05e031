"""Folders of a store through the Hadoop file system, so that any store Spark writes to can be
listed, measured and cleaned."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(where) if f.isDirectory())


def measure(spark: SparkSession, path: str) -> tuple[int, int, datetime | None]:
    """Bytes, data files, and when the newest file was written (UTC; null without files)."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return 0, 0, None
    size = count = newest = 0
    found = fs.listFiles(where, True)
    while found.hasNext():
        file = found.next()
        newest = max(newest, file.getModificationTime())
        if not file.getPath().getName().startswith(("_", ".")):
            size, count = size + file.getLen(), count + 1
    at = datetime.fromtimestamp(newest / 1000, timezone.utc).replace(tzinfo=None)
    return size, count, at if newest else None


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    fs.delete(where, True)
