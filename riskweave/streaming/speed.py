"""Speed layer: the batch expressions on an unbounded input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.scoring import Profile, profile, score
from riskweave.operators.history import amount_zscore
from riskweave.operators.profiles import unusual_countries
from riskweave.operators.dedup import stream_first_seen
from riskweave.operators.quality import accepted, parse_messages, validate
from riskweave.operators.views import flagged_count, tag_windows
from riskweave.settings import DEFAULTS, Settings
from riskweave.sources.stores import kafka_source_options


def read_records(spark: SparkSession, s: Settings = DEFAULTS,
                 starting_offsets: str = "latest") -> DataFrame:
    """Records of the transactions topic. ``starting_offsets`` together with a fresh
    checkpoint replays older records."""
    return (
        spark.readStream.format("kafka")
        .options(**kafka_source_options(s, starting_offsets)).load()
    )


def read_landing_stream(spark: SparkSession, root: str, max_files: int = 100) -> DataFrame:
    """Landed JSON lines as records, one text line per ``value``."""
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", True).text(root)
    )


def to_transactions(records: DataFrame, arrival: Column | None = None) -> DataFrame:
    """Valid records as transactions. Their processing time is the clock of the job, not of
    the sender; replays of recorded input pass another ``arrival``."""
    return accepted(validate(parse_messages(records))).withColumn(
        "processing_time", F.current_timestamp() if arrival is None else arrival
    )


def score_stream(stream: DataFrame, rules: Profile | str = "stream",
                 s: Settings = DEFAULTS) -> DataFrame:
    """Watermark, stateful dedup, lookup joins, window tag, rule score."""
    unique = stream_first_seen(stream, s.watermark_delay)
    if isinstance(rules, str):
        rules = profile(rules, s.fraud_threshold)
    return score(tag_windows(unique, s.window_duration), rules, high_amount=s.high_amount)


def unique_stream(stream: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """The stateful part of ``score_stream`` alone."""
    return tag_windows(stream_first_seen(stream, s.watermark_delay), s.window_duration)


def score_batch(batch: DataFrame, versions: DataFrame, user_profiles: DataFrame | None = None,
                s: Settings = DEFAULTS) -> DataFrame:
    """The rest of it for one micro-batch, with lookups that were read for this batch: risks
    by the version of a row's event time and, with profiles, the user's averages, z-score and
    whether the country is new for the user."""
    scored = score(batch, profile("stream", s.fraud_threshold), high_amount=s.high_amount,
                   versions=versions)
    if user_profiles is None:
        return scored
    return unusual_countries(amount_zscore(scored, user_profiles), user_profiles)


def window_stats(stream: DataFrame, s: Settings = DEFAULTS, duration: str | None = None,
                 slide: str | None = None, *keys: str, watermarked: bool = False) -> DataFrame:
    """Counts and amounts per event-time window, emitted once a window is closed. A stream
    that has been deduplicated is ``watermarked`` already."""
    duration = duration or s.window_duration
    window = F.window("event_timestamp", duration, slide or duration)
    measures = {"n": F.count(F.lit(1)), "total_amount": F.sum("amount")}
    if "is_fraud_predicted" in stream.columns:
        measures["fraud_count"] = flagged_count()
    if not watermarked:
        stream = stream.withWatermark("event_timestamp", s.watermark_delay)
    return (
        stream.groupBy(window.alias("w"), *keys)
        .agg(*[m.alias(name) for name, m in measures.items()])
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                *keys, *measures)
    )


def current_user_risk(scored: DataFrame) -> DataFrame:
    """Score of every user's newest transaction; for update mode."""
    newest = F.struct("event_timestamp", "transaction_id")
    return scored.groupBy("user_id").agg(
        F.max_by("fraud_score", newest).alias("risk_score"),
        F.max("event_timestamp").alias("scored_at"),
    )
