"""State of a stopped stream as tables, read from its checkpoint by Spark's state sources.

Nothing is replayed: the newest committed state is read, one partition per state partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """operator_id, operator, store, partitions, first_batch, last_batch of every stateful
    operator; what a restart would find."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        F.col("operatorId").alias("operator_id"), F.col("operatorName").alias("operator"),
        F.col("stateStoreName").alias("store"), F.col("numPartitions").alias("partitions"),
        F.col("minBatchId").alias("first_batch"), F.col("maxBatchId").alias("last_batch"))


def _state(spark: SparkSession, checkpoint: str, operator: int):
    return spark.read.format("statestore").option("operatorId", operator).option(
        "path", checkpoint)


def dedup_keys(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """Keys that a deduplication still remembers; ``expires_at`` where it stores one."""
    state = _state(spark, checkpoint, operator).load()
    expires = [F.timestamp_micros("value.expiresAtMicros").alias("expires_at")] if (
        "expiresAtMicros" in state.select("value.*").columns) else []
    return state.select("key.*", *expires)


def window_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """Keys and buffers of windows that a watermark has not closed yet."""
    return _state(spark, checkpoint, operator).load().select("key.*", "value.*")


def user_records(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """user_id, risk_score, scored_at of every user that ``user_state`` holds."""
    state = _state(spark, checkpoint, operator).option("stateVarName", "record").load()
    return state.select("key.user_id", "value.risk_score",
                        F.timestamp_micros("value.scored_us").alias("scored_at"))
