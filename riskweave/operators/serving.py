"""Query layer over batch and realtime views.

Batch rows answer for times before the last batch run, realtime rows from then on, so a
transaction present in both views is counted once.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators import views
from riskweave.times import moment, naive_utc


def merged_rows(batch_view: DataFrame, realtime_view: DataFrame,
                last_batch: datetime | None, start: datetime | None = None,
                end: datetime | None = None) -> DataFrame:
    """Both layers over [start, end]; the bounds are literals and reach the scans."""
    def between(df: DataFrame, low: datetime | None, below: datetime | None) -> DataFrame:
        t = F.col("event_timestamp")
        if low is not None:
            df = df.filter(t >= moment(low))
        if below is not None:
            df = df.filter(t < moment(below))
        return df if end is None else df.filter(t <= moment(end))

    if last_batch is None:
        return between(realtime_view, start, None).withColumn("source", F.lit("realtime"))
    later = last_batch if start is None else max(start, last_batch, key=naive_utc)
    return between(batch_view, start, last_batch).withColumn(
        "source", F.lit("batch")
    ).unionByName(
        between(realtime_view, later, None).withColumn("source", F.lit("realtime")),
        allowMissingColumns=True,
    )


def fraud_alerts(batch_view: DataFrame, realtime_view: DataFrame,
                 last_batch: datetime | None, end: datetime, start: datetime | None = None,
                 user_id: str | None = None, limit: int = 100) -> DataFrame:
    """Newest flagged transactions of both layers; the last day when no start is given."""
    start = start or end - timedelta(hours=24)
    rows = merged_rows(
        batch_view.filter("is_fraud_predicted"), realtime_view.filter("is_fraud_predicted"),
        last_batch, start, end,
    )
    if user_id is not None:
        rows = rows.filter(F.col("user_id") == user_id)
    return rows.orderBy(F.desc("event_timestamp"), "transaction_id").limit(limit)


def user_profile(profiles: DataFrame, user_id: str) -> DataFrame:
    return profiles.filter(F.col("user_id") == user_id)


def transactions_by_country(realtime_view: DataFrame, batch_view: DataFrame,
                            realtime_has_rows: bool, top: int = 20) -> DataFrame:
    """Realtime rows, or batch rows while there are none. Whether there are any is known
    from the stored table; building the answer runs no job."""
    return views.by_country(realtime_view if realtime_has_rows else batch_view, top)


def expired(realtime_view: DataFrame, as_of: Column, hours: int = 2) -> Column:
    """Condition for rows past their retention."""
    return F.col("processing_time") < as_of - F.make_dt_interval(hours=F.lit(hours))


def retained(realtime_view: DataFrame, as_of: Column, hours: int = 2) -> DataFrame:
    gone = expired(realtime_view, as_of, hours)
    return realtime_view.filter(~F.coalesce(gone, F.lit(False)))


def retention_counts(realtime_view: DataFrame, as_of: Column, hours: int = 2) -> DataFrame:
    gone = F.coalesce(expired(realtime_view, as_of, hours), F.lit(False))
    return realtime_view.agg(
        F.count_if(gone).alias("deleted"), F.count_if(~gone).alias("kept")
    )


def serving_cap(alerts: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` highest-scoring alerts, for a store that holds only so many. An option
    of the caller; views are published whole."""
    return alerts.filter("is_fraud_predicted").orderBy(
        F.desc("fraud_score"), F.desc("event_timestamp"), "transaction_id"
    ).limit(limit)
