"""Progress of streaming queries as a table, for the metric queries."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from riskweave.operators.metrics import source_lag, trigger_seconds
from riskweave.sources.stores import append_row

PROGRESS = T.StructType([
    T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("at", T.StringType()), T.StructField("input_rows", T.LongType()),
    T.StructField("trigger_seconds", T.DoubleType()), T.StructField("lag", T.LongType()),
    T.StructField("lag_by_partition", T.MapType(T.StringType(), T.LongType())),
])


def progress_row(report: dict) -> dict[str, object]:
    """One row of the table from a query's progress report; ``lag`` sums the records that
    still wait in the source partitions."""
    lag = source_lag(report)
    return {
        "query_id": str(report["id"]), "batch_id": int(report["batchId"]),
        "at": str(report["timestamp"]), "input_rows": int(report.get("numInputRows", 0)),
        "trigger_seconds": float(trigger_seconds(report)),
        "lag": sum(lag.values()), "lag_by_partition": lag,
    }


def append(spark: SparkSession, root: str, report: dict) -> None:
    row = progress_row(report)
    lag = F.from_json(F.lit(json.dumps(row.pop("lag_by_partition"))), "map<string,bigint>")
    append_row(spark, f"{root}/stream_progress", {
        f.name: F.lit(row[f.name]).cast(f.dataType) if f.name in row else lag
        for f in PROGRESS})


class ProgressTable(StreamingQueryListener):
    """Appends a row per finished micro-batch to ``root``/stream_progress."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        append(self.spark, self.root, json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(PROGRESS).parquet(f"{root}/stream_progress")


def lag_by_partition(progress: DataFrame) -> DataFrame:
    """query_id, partition, lag at each query's newest batch: the gauge per partition."""
    newest = progress.groupBy("query_id").agg(
        F.max_by("lag_by_partition", "batch_id").alias("lag"))
    return newest.select("query_id", F.explode("lag").alias("partition", "lag"))
