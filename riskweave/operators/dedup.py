"""Duplicate removal for bounded and unbounded inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_arrivals(txns: DataFrame, key: str = "transaction_id",
                   arrived: str = "processing_timestamp") -> DataFrame:
    """Keep the earliest arrival of every id, and every row without an id.

    ``row_number() = 1`` lets Spark cut each map task's rows to one per id before the
    shuffle, so an id with very many copies sends one row per map task. Rows that tie
    on arrival are ordered by their content, which keeps reruns identical.
    """
    tie = F.xxhash64(*[c for c in txns.columns if c != key])
    # Rows without an id are no copies of each other and must not meet in one task.
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    w = Window.partitionBy(key, "_alone").orderBy(F.col(arrived).asc_nulls_last(), tie)
    return (
        txns.withColumn("_alone", alone).withColumn("_arrival", F.row_number().over(w))
        .filter(F.col("_arrival") == 1)
        .drop("_arrival", "_alone")
    )


def stream_first_seen(stream: DataFrame, watermark: str,
                      event_time: str = "event_timestamp") -> DataFrame:
    """Stateful removal of repeated (id, event time) pairs; state ages out by watermark."""
    return (
        stream.withWatermark(event_time, watermark)
        .dropDuplicates(["transaction_id", event_time])
    )


def stream_first_seen_by_id(stream: DataFrame, window: str,
                            event_time: str = "event_timestamp") -> DataFrame:
    """For sources whose copies carry a new event time: one row per id and window."""
    return (
        stream.withWatermark(event_time, window)
        .dropDuplicatesWithinWatermark(["transaction_id"])
    )
