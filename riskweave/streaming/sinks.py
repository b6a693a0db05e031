"""Replayable outputs: every micro-batch owns the folder of its batch id."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskweave.operators.views import period_stats
from riskweave.schema import ALERT_COLUMNS
from riskweave.settings import DEFAULTS, Settings
from riskweave.sources import microbatches
from riskweave.times import moment


def write_batch(df: DataFrame, root: str, table: str, batch_id: int) -> str:
    """A replayed batch overwrites its own earlier output."""
    path = f"{root}/{table}/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def microbatch_country_stats(rows: DataFrame, batch_id: int, at: datetime | None) -> DataFrame:
    stamp = F.current_timestamp() if at is None else moment(at)
    return period_stats(rows, F.col("country")).select(
        "country", F.col("total_transactions").alias("transaction_count"), "total_amount",
        "fraud_count", "avg_fraud_score", stamp.alias("timestamp"),
        F.lit(batch_id).cast("bigint").alias("batch_no"),
    )


def fan_out(root: str, at: datetime | None = None,
            prepare: Callable[[DataFrame], DataFrame] | None = None
            ) -> Callable[[DataFrame, int], None]:
    """All outputs of the speed layer from one evaluation of the micro-batch.

    ``prepare`` is applied to the batch first, for what must be looked up anew every time.

    Scored rows are written first; alerts and statistics are read back from those files.
    The stateful plan thus runs once per batch and nothing is cached, so a lost executor
    costs no recomputation. Errors propagate and stop the query.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch if prepare is None else prepare(batch)
        path = write_batch(batch, root, "realtime_views", batch_id)
        rows = batch.sparkSession.read.schema(batch.schema).parquet(path)
        write_batch(rows.filter("is_fraud_predicted").select(*ALERT_COLUMNS),
                    root, "fraud_alerts", batch_id)
        write_batch(microbatch_country_stats(rows, batch_id, at),
                    root, "dashboard_stats", batch_id)

    return write


def append_batches(root: str, table: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, root, table, batch_id)

    return write


def start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
          mode: str = "append", s: Settings = DEFAULTS,
          available_now: bool = False) -> StreamingQuery:
    writer = (
        stream.writeStream.outputMode(mode).foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=s.trigger_interval).start()


def drain(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
          mode: str = "append") -> StreamingQuery:
    """Process everything there is and stop."""
    query = start(stream, write, checkpoint, mode, available_now=True)
    query.awaitTermination()
    return query


def start_landing(messages: DataFrame, root: str, checkpoint: str,
                  s: Settings = DEFAULTS) -> StreamingQuery:
    """Append the stream to the date-partitioned landing folder."""
    from riskweave.sources.stores import with_landing_date

    return (
        with_landing_date(messages).writeStream.format("json")
        .partitionBy("year", "month", "day")
        .option("path", root).option("checkpointLocation", checkpoint)
        .trigger(processingTime=s.trigger_interval).start()
    )


def start_console(scored: DataFrame, checkpoint: str, s: Settings = DEFAULTS) -> StreamingQuery:
    """Print scored rows, for debugging."""
    return (
        scored.select("transaction_id", "user_id", "amount", "country", "fraud_score",
                      "is_fraud_predicted", "processing_time")
        .writeStream.outputMode("append").format("console").option("truncate", False)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=s.trigger_interval).start()
    )


def read_batches(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All micro-batches of a table, with their ``batch_id``, packed or not."""
    return microbatches.read(spark, root, table)


def newest_per_user(updates: DataFrame) -> DataFrame:
    """Current state out of update-mode batches: the last batch of a user wins."""
    state = [c for c in updates.columns if c not in ("user_id", "batch_id")]
    return (
        updates.groupBy("user_id")
        .agg(F.max_by(F.struct(*state), "batch_id").alias("s"))
        .select("user_id", "s.*")
    )
