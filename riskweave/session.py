"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What the jobs rely on; the cluster's own settings win for sizes and resources.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}
ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(app_name: str = "riskweave", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session time zone, on which every time expression depends."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # Every batch uploads its changes, not whole snapshots.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state off the JVM heap; needed once state outgrows memory."""
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """The same for the queries that start inside the block."""
    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    use_rocksdb_state(spark)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


_local_roots: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named by ``spark.checkpoint.dir``.

    Without that setting a local session gets a temporary folder of its own; on a
    cluster there is no safe default, so the call fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="riskweave-")
    return _local_roots[context.applicationId]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"
