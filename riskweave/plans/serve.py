"""Query API over the published tables of both layers."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import metrics, serving, views
from riskweave.sources import manifest, microbatches, stores
from riskweave.times import moment

# Columns both layers share in merged answers.
REALTIME_COLUMNS = (
    "transaction_id", "user_id", "amount", "country", "merchant_category",
    "fraud_score", "is_fraud_predicted", "event_timestamp", "processing_time",
    "country_risk", "merchant_risk", "hour_of_day",
)


# Tables of the speed layer.
LIVE_TABLES = ["realtime_views", "fraud_alerts", "dashboard_stats"]
# How long a replaced folder stays for readers that have it open.
KEEP_REPLACED = timedelta(hours=1)


def realtime_view(spark: SparkSession, root: str) -> DataFrame:
    """Rows of all micro-batches, packed or not, as one manifest read finds them."""
    return microbatches.read(spark, root, "realtime_views").select(*REALTIME_COLUMNS)


def purge_realtime(spark: SparkSession, root: str, as_of: datetime, hours: int = 2) -> int:
    """Drop realtime rows past their retention; returns how many.

    What is kept of the batches before the newest is packed anew and takes effect with one
    manifest commit. The newest batch may still be written, and others may arrive meanwhile:
    all of them stay as they are. Without an earlier batch nothing happens.
    """
    parts = manifest.read(spark, root).of("realtime_views")
    if not microbatches.waiting(spark, root, "realtime_views", parts):
        return 0
    now = moment(as_of)
    newest = microbatches.batch_ids(spark, root, "realtime_views")[-1]
    rows = microbatches.read(spark, root, "realtime_views", newest - 1, parts)
    gone = serving.retention_counts(rows, now, hours).first()["deleted"]
    microbatches.compact(spark, root, "realtime_views", as_of,
                         kept=lambda packed: serving.retained(packed, now, hours))
    return gone


def maintain(spark: SparkSession, root: str, as_of: datetime, hours: int = 2,
             keep: timedelta = KEEP_REPLACED) -> dict[str, int]:
    """Retention, compaction and removal of dead folders of the speed layer's tables; the
    number of rows dropped, batches packed and folders deleted."""
    dropped = purge_realtime(spark, root, as_of, hours)
    packed = sum(microbatches.compact(spark, root, table, as_of) for table in LIVE_TABLES[1:])
    return {"rows_dropped": dropped, "batches_packed": packed,
            "folders_deleted": len(microbatches.collect(spark, root, LIVE_TABLES, as_of, keep))}


def create_api(spark: SparkSession, batch_root: str, realtime_root: str,
               clock: Callable[[], datetime] | None = None) -> dict[str, Callable]:
    """Name to function; every function returns a frame or a dict of frames."""
    clock = clock or (lambda: datetime.now(timezone.utc).replace(tzinfo=None))

    def now():
        return moment(clock())

    def live() -> DataFrame:
        return realtime_view(spark, realtime_root)

    def known() -> dict[str, str]:
        return stores.metadata(spark, batch_root)

    def batch(of: dict[str, str], view: str = "fraud_results") -> DataFrame:
        return stores.read_view(spark, batch_root, view, of)

    def get_fraud_alerts(user_id=None, start_time=None, end_time=None, limit=100):
        of = known()
        # Only alerts are asked for, so the view that holds nothing else is read. Batch rows
        # answer up to the event time that the run has seen completely.
        return serving.fraud_alerts(batch(of, "batch_views"), live(),
                                    stores.time_of(of, "complete_until"),
                                    end_time or clock(), start_time, user_id, limit)

    def get_layer_stats():
        of = known()
        return metrics.view_sizes({
            "batch_views": batch(of, "batch_views"),
            "realtime_views": live(),
            "fraud_alerts": live().filter("is_fraud_predicted"),
            "user_profiles": batch(of, "user_profiles"),
        }, F.lit(of.get("last_batch_timestamp")))

    def get_transactions_by_country():
        rows = live()
        # A stored table: this looks at one row of one file.
        return serving.transactions_by_country(rows, batch(known()), not rows.isEmpty())

    def get_recent_stats():
        last = stores.time_of(known(), "last_batch_timestamp")
        return views.recent_stats(live(), now()).withColumn(
            "last_batch", moment(last) if last else F.lit(None).cast("timestamp"))

    api = {
        "get_fraud_alerts": get_fraud_alerts,
        "get_user_profile": lambda user_id: serving.user_profile(
            batch(known(), "user_profiles"), user_id),
        "get_user_fraud_history":
            lambda user_id, limit=50: get_fraud_alerts(user_id=user_id, limit=limit),
        "get_fraud_rate_over_time":
            lambda hours=24: views.fraud_rate_over_time(live(), now(), hours),
        "get_transactions_by_country": get_transactions_by_country,
        "get_high_risk_users": lambda limit=10: views.high_risk_users(live(), 3, limit),
        "get_recent_stats": get_recent_stats,
        "get_layer_stats": get_layer_stats,
    }
    api["get_live_dashboard_data"] = lambda: {
        "stats": api["get_recent_stats"](),
        "fraud_by_country": api["get_transactions_by_country"](),
        "high_risk_users": api["get_high_risk_users"](),
        "recent_alerts": get_fraud_alerts(limit=20),
    }
    return api
