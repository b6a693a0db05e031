"""Batch layer: full recomputation of all views from the master dataset."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.scoring import profile, score
from riskweave.operators import model, profiles, serving, views
from riskweave.operators.dedup import first_arrivals
from riskweave.operators.history import history_features, large_users
from riskweave.operators.quality import (
    TOO_LATE_AFTER, accepted, dead_letters, parse_messages, validate,
)
from riskweave.schema import FRAUD_RESULT_COLUMNS
from riskweave.settings import DEFAULTS, Settings
from riskweave.sources import stores
from riskweave.sources.risk_tables import read_versions
from riskweave.times import moment


def scored(txns: DataFrame, window_seconds: int | None = None,
           s: Settings = DEFAULTS, large: DataFrame | None = None,
           versions: DataFrame | None = None) -> DataFrame:
    """History features, lookups and batch rules over deduplicated transactions. Risks come
    from the built-in tables, or from ``versions`` by event time.

    The lookups come after the history shuffle: they are map-side joins and their output
    need not be shuffled.
    """
    window = s.velocity_window_seconds if window_seconds is None else window_seconds
    features = history_features(txns, window, s.history_slice_seconds, large)
    return score(features, profile("batch", s.fraud_threshold), versions=versions)


def stream_models(root: str) -> str:
    """Folder of the models that the speed layer can apply."""
    return f"{root}/stream_models"


def read_valid(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Landed messages: those that pass the checks of the speed layer, and the others with
    their text and the reason."""
    checked = validate(parse_messages(stores.read_landed_text(spark, root)))
    return accepted(checked), dead_letters(checked)


@dataclass(frozen=True)
class BatchRun:
    run_id: str
    root: str
    summary: dict
    auc: float | None = None
    paths: dict = field(default_factory=dict)


def run(spark: SparkSession, transactions: DataFrame, root: str, at: datetime,
        s: Settings = DEFAULTS, train_model: bool = True,
        serving_limit: int | None = None, rejected: DataFrame | None = None,
        risks: str | None = None) -> BatchRun:
    """Build and publish every view; the run becomes visible with its last step.

    Two tables are written instead of cached: the deduplicated transactions and the scored
    rows, which are a published view as well. Each later step reads only the columns it needs from them, and a
    lost executor costs the tasks at hand, not the lineage back to the raw files.
    """
    # Unique, so that a rerun never overwrites a version that is being read.
    run_id = f"{at:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
    stamp = moment(at)
    paths: dict[str, str] = {}

    def put(df: DataFrame, name: str) -> DataFrame:
        paths[name] = stores.publish(df, root, name, run_id)
        return spark.read.schema(df.schema).parquet(paths[name])

    if rejected is not None:
        put(rejected, "dead_letters")
    curated = put(first_arrivals(transactions), "transactions")
    users = put(profiles.user_profiles(curated, stamp), "user_profiles")
    # One table for the published view and the training: the view's columns come first.
    full = scored(curated, s=s, large=large_users(curated), versions=read_versions(
        spark, risks) if risks else None).withColumn("batch_timestamp", stamp)
    rows = put(full.select(*FRAUD_RESULT_COLUMNS, "batch_timestamp", *[
        c for c in full.columns if c not in (*FRAUD_RESULT_COLUMNS, "batch_timestamp")]),
        "fraud_results")
    results = views.fraud_results(rows, stamp)
    put(views.daily_stats(results).withColumn("batch_timestamp", stamp), "daily_stats")
    put(views.country_stats(results), "country_stats")
    put(views.calendar_stats(results), "calendar_stats")
    alerts = results.filter("is_fraud_predicted")
    put(alerts if serving_limit is None else serving.serving_cap(alerts, serving_limit),
        "batch_views")

    trained = model.train(rows, s=s) if train_model else None
    if trained:
        paths["model"] = model.save(trained.model, f"{root}/models", at)
        model.register(spark, root, paths["model"], at, trained.auc)
        # The stream knows no history, so it gets a model of what it can compute.
        online = model.train(rows, model.STREAM_FEATURES, s)
        paths["stream_model"] = model.save(online.model, stream_models(root), at)
        model.register(spark, stream_models(root), paths["stream_model"], at, online.auc)

    newest = curated.agg(F.max("event_timestamp").cast("string").alias("t")).first()["t"]
    marks = {"current_run": run_id, "last_batch_timestamp": at.isoformat()}
    if newest:
        # Rows with later event times may still arrive; the realtime layer answers for them.
        marks["complete_until"] = (datetime.fromisoformat(newest)
                                   - timedelta(seconds=TOO_LATE_AFTER)).isoformat()
    stores.put_metadata(spark, root, marks, at)
    return BatchRun(run_id, root, views.run_summary(results).first().asDict(),
                    trained.auc if trained else None, paths)
