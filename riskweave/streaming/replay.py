"""Bounded reprocessing of a range of micro-batches, from a stream's own checkpoint.

The checkpoint tells for every batch which records it took in, when it ran and what its
watermark was. That is enough to compute the batches of a range again as one bounded job, with
the rows of their time: arrival is the batch's own time, rows that the watermark had passed
are left out, and copies of rows in earlier batches are. The result replaces the batches in all
tables with one commit, while the stream goes on behind them.

Spark keeps the log of the last ``spark.sql.streaming.minBatchesToRetain`` batches (100);
raise it where longer ranges must be replayed. Older rows are the batch layer's.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.functions.scoring import profile, score
from riskweave.operators.quality import accepted, parse_messages, validate
from riskweave.operators.views import period_stats, tag_windows
from riskweave.schema import ALERT_COLUMNS
from riskweave.settings import DEFAULTS, Settings
from riskweave.sources import microbatches
from riskweave.sources.stores import kafka_source_options
from riskweave.times import naive_utc


@dataclass(frozen=True)
class Batch:
    """What the checkpoint says of a micro-batch; times in milliseconds."""

    id: int
    at: int
    watermark: int
    offset: dict


def batches(spark: SparkSession, checkpoint: str) -> dict[int, Batch]:
    """The offset log: one small file per batch."""
    rows = spark.read.text(f"{checkpoint}/offsets", wholetext=True).select(
        F.col("_metadata.file_name").alias("name"), "value").collect()
    found = {}
    for r in rows:
        lines = r.value.splitlines()
        told, offset = json.loads(lines[1]), lines[2] if len(lines) > 2 else "-"
        found[int(r.name)] = Batch(int(r.name), told["batchTimestampMs"],
                                   told["batchWatermarkMs"],
                                   {} if offset == "-" else json.loads(offset))
    return found


def between(log: dict[int, Batch], start: datetime, end: datetime) -> tuple[int, int]:
    """First and last batch that ran from ``start`` to before ``end``; times are UTC."""
    epoch = datetime(1970, 1, 1)
    lower, upper = ((naive_utc(t) - epoch).total_seconds() * 1000 for t in (start, end))
    chosen = [b.id for b in log.values() if lower <= b.at < upper]
    if not chosen:
        raise LookupError("no batch ran in that time, or the checkpoint has forgotten it")
    return min(chosen), max(chosen)


def _log_of(log: dict[int, Batch], batch: int) -> int:
    """Position of the file source's log that a batch reached; -1 before the first."""
    return log[batch].offset["logOffset"] if batch in log else -1


def file_records(spark: SparkSession, checkpoint: str, log: dict[int, Batch], first: int,
                 last: int) -> DataFrame:
    """``value`` and ``batch_id`` of a file stream's records. The plan holds the names of the
    range's files."""
    entry = F.from_json("value", "path string, batchId bigint")
    begin, end = _log_of(log, first - 1), _log_of(log, last)
    taken = spark.read.text(f"{checkpoint}/sources/0").where("value LIKE '{%'").select(
        entry.alias("e")).select("e.*").where(
        (F.col("batchId") > begin) & (F.col("batchId") <= end)).distinct().collect()
    reached = [(b, _log_of(log, b)) for b in range(first, last + 1)]
    rows = [(r.path, next(b for b, at in reached if r.batchId <= at)) for r in taken]
    if not rows:
        return spark.createDataFrame([], "value string, batch_id bigint")

    def plain(path):
        return F.regexp_replace(path, "^file:/+", "file:/")

    names = spark.createDataFrame(rows, "path string, batch_id bigint").select(
        plain(F.col("path")).alias("_path"), "batch_id")
    lines = spark.read.text([path for path, _ in rows])
    return lines.withColumn("_path", plain(F.col("_metadata.file_path"))).join(
        names, "_path").select("value", "batch_id")


def kafka_records(spark: SparkSession, log: dict[int, Batch], first: int, last: int,
                  s: Settings = DEFAULTS) -> DataFrame:
    """The same of a topic, between the offsets of the range; needs the connector."""
    start = log[first - 1].offset if first - 1 in log else None
    options = kafka_source_options(s, json.dumps(start) if start else "earliest")
    options.pop("maxOffsetsPerTrigger")
    rows = spark.read.format("kafka").options(
        **options, endingOffsets=json.dumps(log[last].offset)).load()
    reached = [(topic, int(part), offset, b) for b in range(first, last + 1)
               for topic, parts in log[b].offset.items() for part, offset in parts.items()]
    ends = spark.createDataFrame(reached, "topic string, partition int, upto bigint, b bigint")
    return rows.join(ends, ["topic", "partition"]).where(F.col("offset") < F.col("upto")).groupBy(
        "topic", "partition", "offset").agg(
        F.first("value").alias("value"), F.min("b").alias("batch_id")).select(
        "value", "batch_id")


def rescored(records: DataFrame, log: dict[int, Batch], earlier: DataFrame,
             s: Settings = DEFAULTS,
             scoring: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Scored rows of the records, as the batches of their time made them. ``earlier`` are
    the rows of the batches before."""
    times = records.sparkSession.createDataFrame(
        [(b.id, b.at, log[b.id - 1].watermark if b.id - 1 in log else 0) for b in log.values()],
        "batch_id bigint, _at bigint, _passed bigint")
    key = ["transaction_id", "event_timestamp"]
    rows = accepted(validate(parse_messages(records, keep=("batch_id",)))).join(
        times, "batch_id").where(F.unix_millis("event_timestamp") > F.col("_passed")).withColumn(
        "processing_time", F.timestamp_millis("_at")).drop("_at", "_passed")
    first = Window.partitionBy(*key).orderBy("batch_id", F.xxhash64(*rows.columns))
    unique = rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n").join(
        earlier.select(*key), key, "left_anti")
    tagged = tag_windows(unique, s.window_duration)
    return scoring(tagged) if scoring else score(
        tagged, profile("stream", s.fraud_threshold), high_amount=s.high_amount)


def replay(spark: SparkSession, checkpoint: str, root: str, first: int, last: int, at: datetime,
           s: Settings = DEFAULTS, records: DataFrame | None = None,
           scoring: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Compute the batches from ``first`` to ``last`` again and switch all tables to the
    result; returns the version of the manifest. The newest batch may still be written and
    cannot be replayed. ``scoring`` may be other rules than those of the first run."""
    log = batches(spark, checkpoint)
    missing = [b for b in range(first, last + 1) if b not in log]
    newest = max(microbatches.batch_ids(spark, root, "realtime_views"), default=-1)
    if missing or last >= newest:
        raise ValueError(f"batches {missing or last} cannot be replayed")
    if records is None:
        records = file_records(spark, checkpoint, log, first, last)
    view = microbatches.read(spark, root, "realtime_views")
    rows = rescored(records, log, view.where(F.col("batch_id") < first), s, scoring).select(
        *view.columns)
    # The three tables come from the rows that are written once, as in the stream.
    path = f"{root}/replays/{at:%Y%m%d_%H%M%S}_{first}_{last}"
    rows.write.parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    stats = period_stats(stored, F.col("batch_id"), F.col("country"), F.col("processing_time"))
    return microbatches.replace(spark, root, {
        "realtime_views": stored,
        "fraud_alerts": stored.where("is_fraud_predicted").select(*ALERT_COLUMNS, "batch_id"),
        "dashboard_stats": stats.select(
            "country", F.col("total_transactions").alias("transaction_count"), "total_amount",
            "fraud_count", "avg_fraud_score", F.col("processing_time").alias("timestamp"),
            F.col("batch_id").alias("batch_no"), "batch_id"),
    }, first, last, at)
