"""Speed layer job: one query that feeds every realtime table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskweave.functions.scoring import profile, score
from riskweave.operators import sketches
from riskweave.operators.model import predict
from riskweave.operators.quality import (
    accepted, dead_letters, lateness, parse_messages, validate,
)
from riskweave.schema import ALERT_COLUMNS, TRANSACTION
from riskweave.session import rocksdb_state
from riskweave.settings import DEFAULTS, Settings
from riskweave.sources.risk_tables import read_versions
from riskweave.sources.stores import publish_messages, read_view
from riskweave.streaming import sinks, speed, user_state


def start(records: DataFrame, root: str, checkpoint: str, model: PipelineModel | None = None,
          s: Settings = DEFAULTS, available_now: bool = False, risks: str | None = None,
          profiles: str | None = None) -> StreamingQuery:
    """Score ``records`` by the rules (and the model, if there is one) into ``root``.

    ``risks`` is a folder of risk versions, ``profiles`` the output of the batch job. Both are
    read anew for every micro-batch, so that updates need no restart.
    """
    unique = speed.to_transactions(records)
    if risks is None and profiles is None:
        scored = speed.score_stream(unique, s=s)
        return sinks.start(scored if model is None else predict(model, scored),
                           sinks.fan_out(root), checkpoint, s=s, available_now=available_now)

    def prepare(batch: DataFrame) -> DataFrame:
        spark = batch.sparkSession
        scored = speed.score_batch(batch, read_versions(spark, risks), newest_profiles(
            spark, profiles) if profiles else None, s)
        return scored if model is None else predict(model, scored)

    return sinks.start(speed.unique_stream(unique, s), sinks.fan_out(root, prepare=prepare),
                       checkpoint, s=s, available_now=available_now)


def newest_profiles(spark: SparkSession, root: str) -> DataFrame | None:
    """User profiles of the newest batch run; None before the first."""
    try:
        return read_view(spark, root, "user_profiles")
    except LookupError:
        return None


def start_dead_letters(records: DataFrame, root: str, checkpoint: str,
                       s: Settings = DEFAULTS, available_now: bool = False) -> StreamingQuery:
    """Keep rejected records with the reason, beside the main query."""
    rejected = dead_letters(validate(parse_messages(records)))
    return sinks.start(rejected, sinks.append_batches(root, "dead_letters"), checkpoint,
                       s=s, available_now=available_now)


def start_windows(records: DataFrame, root: str, checkpoint: str, s: Settings = DEFAULTS,
                  available_now: bool = False) -> StreamingQuery:
    """Counts and amounts per country and sliding event-time window."""
    scored = speed.score_stream(speed.to_transactions(records), s=s)
    stats = speed.window_stats(scored, s, s.window_duration, s.window_slide, "country",
                               watermarked=True)
    return sinks.start(stats, sinks.append_batches(root, "window_stats"), checkpoint, s=s,
                       available_now=available_now)


def start_user_risk(records: DataFrame, root: str, checkpoint: str, s: Settings = DEFAULTS,
                    available_now: bool = False) -> StreamingQuery:
    """Score of every user's newest transaction, until the user has been idle for
    ``user_idle_seconds``; read it with ``user_state.active``."""
    risk = user_state.current_user_risk(score(speed.to_transactions(records), profile(
        "stream", s.fraud_threshold), high_amount=s.high_amount), s)
    with rocksdb_state(records.sparkSession):
        return sinks.start(risk, sinks.append_batches(root, "user_risk"), checkpoint, "update",
                           s, available_now)


def start_user_sketches(records: DataFrame, root: str, checkpoint: str,
                        s: Settings = DEFAULTS, available_now: bool = False) -> StreamingQuery:
    """Mergeable sketches per window of the users seen and of the delays; read them with
    ``sketches.active_users`` and ``sketches.quantiles``."""
    rows = sketches.per_window(speed.to_transactions(records).withWatermark(
        "event_timestamp", s.watermark_delay), s.window_duration)
    return sinks.start(rows, sinks.append_batches(root, "sketches"), checkpoint, s=s,
                       available_now=available_now)


def start_late_events(records: DataFrame, root: str, checkpoint: str,
                      s: Settings = DEFAULTS, available_now: bool = False) -> StreamingQuery:
    """Events that arrived late, kept with their delay and class; the watermark of the
    scoring query may drop them."""
    late = lateness(speed.to_transactions(records)).filter("lateness <> 'on_time'")
    return sinks.start(late, sinks.append_batches(root, "late_events"), checkpoint, s=s,
                       available_now=available_now)


def start_landing(records: DataFrame, root: str, checkpoint: str,
                  s: Settings = DEFAULTS) -> StreamingQuery:
    """Valid messages below date folders, as the batch job reads them."""
    valid = accepted(validate(parse_messages(records)))
    return sinks.start_landing(valid.select(*TRANSACTION.names), root, checkpoint, s)


def start_alert_topic(records: DataFrame, root: str, checkpoint: str,
                      s: Settings = DEFAULTS, available_now: bool = False) -> StreamingQuery:
    """Alerts to their own topic; needs the connector. ``root`` is not used."""
    scored = speed.score_stream(speed.to_transactions(records), s=s)
    alerts = scored.filter("is_fraud_predicted").select(*ALERT_COLUMNS)
    return sinks.start(alerts, lambda rows, _: publish_messages(
        rows, s, s.kafka_topic_fraud_alerts), checkpoint, s=s, available_now=available_now)


# Outputs that run as jobs of their own, each with its own checkpoint and consumer.
JOBS = {"dead-letters": start_dead_letters, "windows": start_windows,
        "user-risk": start_user_risk, "sketches": start_user_sketches, "late-events": start_late_events,
        "landing": start_landing, "alert-topic": start_alert_topic}
