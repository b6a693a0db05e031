"""Batch layer by day: recompute a range of days and replace only their parts.

The landing folder is read for the range only (its date folders are pruned), the views are
split by day, and a commit to the manifest swaps the days of the range in all views at once.
What the features of a day need from other days comes from stored parts:

* velocity looks back over its window, so the transactions of that many days before the range
  are read too;
* the previous transaction of a user, and the user's mean and deviation over all days, come
  from ``user_days``, one row of moments per user and day.

Days outside the range keep their parts: their z-scores are those of the run that wrote them,
until they are run again. Copies of a message carry its event time, so they lie in one day.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.functions.scoring import amount_flags, profile, score
from riskweave.operators import views
from riskweave.operators.dedup import first_arrivals
from riskweave.operators.history import (
    history_features, large_users, whole_histories, zscore)
from riskweave.operators.quality import accepted, parse_messages, validate
from riskweave.schema import FRAUD_RESULT_COLUMNS
from riskweave.settings import DEFAULTS, NO_PREVIOUS_SECONDS, Settings
from riskweave.sources import files, manifest, stores
from riskweave.times import moment

VIEWS = ["transactions", "user_days", "fraud_results", "batch_views", "daily_stats",
         "country_days", "dead_letters"]
DAY = 86_400


@dataclass(frozen=True)
class DayRun:
    """What a run has replaced: its version, and the days with and without rows."""

    run_id: str
    version: int
    days: list[date]
    empty: list[date]


def days_between(first: date, last: date) -> list[date]:
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def part(day: date) -> str:
    return f"day={day.isoformat()}"


def read_days(spark: SparkSession, root: str, view: str, first: date | None = None,
              last: date | None = None, live: manifest.Manifest | None = None) -> DataFrame:
    """A view with its ``day``, from one manifest. The range, like any filter on ``day``,
    leaves folders out."""
    live = live or manifest.read(spark, root)
    paths = [path for name, path in sorted(live.of(view).items())
             if (first is None or name >= part(first)) and (last is None or name <= part(last))]
    if not paths:
        raise LookupError(f"no days of {view} below {root}")
    return spark.read.option("basePath", f"{root}/{view}").parquet(
        *[f"{root}/{path}" for path in paths]).drop("run_id")


def user_days(txns: DataFrame) -> DataFrame:
    """Moments of each user's amounts per day, and the last transaction."""
    return txns.groupBy("user_id", "day").agg(
        F.count("amount").alias("n"), F.avg("amount").alias("mean"),
        F.var_pop("amount").alias("var"), F.min("amount").alias("low"),
        F.max("amount").alias("high"), F.max("event_timestamp").alias("last"))


def user_totals(parts: DataFrame, before: date) -> DataFrame:
    """user, avg_amount, stddev_amount over all days, and ``carried``: the user's last
    transaction before a day. The windows see one row per user and day."""
    user = Window.partitionBy("user_id")
    total = F.sum("n").over(user)
    mean = F.sum(F.col("n") * F.col("mean")).over(user) / F.when(total > 0, total)
    merged = parts.withColumns({"total": total, "avg_amount": mean}).groupBy("user_id").agg(
        F.first("total").alias("total"), F.first("avg_amount").alias("avg_amount"),
        F.sum(F.col("n") * (F.col("var") + F.pow(F.col("mean") - F.col("avg_amount"), 2)))
        .alias("spread"), (F.min("low") == F.max("high")).alias("flat"),
        F.max(F.when(F.col("day") < F.lit(before), F.col("last"))).alias("carried"))
    # Equal amounts have no deviation; rounding of the means must not invent one.
    deviation = F.when(F.col("total") > 1, F.when(F.col("flat"), F.lit(0.0)).otherwise(
        F.sqrt(F.col("spread") / (F.col("total") - 1))))
    return merged.select(F.col("user_id").alias("_of"), "avg_amount",
                         deviation.alias("stddev_amount"), "carried")


def features(scope: DataFrame, totals: DataFrame, window_seconds: int,
             s: Settings = DEFAULTS) -> DataFrame:
    """History features of the rows in scope, completed by what the other days know."""
    large = large_users(scope)
    own = whole_histories(scope, window_seconds) if large.isEmpty() else history_features(
        scope, window_seconds, s.history_slice_seconds, large)
    kept = [c for c in own.columns if c not in (
        "avg_amount", "stddev_amount", "amount_zscore", "is_high_amount",
        "is_very_high_amount")]
    # A user may own many rows: the planner splits such a key when it joins.
    joined = own.select(*kept).join(totals, F.col("user_id").eqNullSafe(F.col("_of")), "left")
    previous = F.coalesce("prev_timestamp", "carried")
    gap = F.unix_timestamp("event_timestamp") - F.unix_timestamp(previous)
    return amount_flags(joined.withColumns({
        "amount_zscore": zscore(), "prev_timestamp": previous,
        "time_since_last": F.coalesce(gap, F.lit(NO_PREVIOUS_SECONDS).cast("bigint")),
    }).drop("_of", "carried"))


def landed(spark: SparkSession, root: str, first: date, last: date) -> DataFrame:
    """Lines of the days' folders as records with a ``value`` and their ``day``."""
    day = F.make_date("year", "month", "day")
    return stores.read_landed_days(spark, root).where(
        day.between(F.lit(first), F.lit(last))).withColumn("day", day)


def run_days(spark: SparkSession, landing: str, root: str, first: date, last: date,
             at: datetime, window_seconds: int | None = None, s: Settings = DEFAULTS) -> DayRun:
    """Recompute the days from ``first`` to ``last`` and make them live in one step."""
    window = s.velocity_window_seconds if window_seconds is None else window_seconds
    run_id = f"{at:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
    before = manifest.read(spark, root)
    in_range = F.col("day").between(F.lit(first), F.lit(last))

    def put(df: DataFrame, view: str) -> DataFrame:
        """Written by day; the rows of a day stay together unless there are very many."""
        path = f"{root}/{view}/run_id={run_id}"
        df.hint("rebalance", "day").write.partitionBy("day").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    checked = validate(parse_messages(landed(spark, landing, first, last), keep=("day",)))
    faulty_day, faults = F.when(~F.col("valid"), F.col("day")), Observation()
    watched = checked.observe(faults, F.min(faulty_day).alias("first"),
                              F.max(faulty_day).alias("last"))
    curated = put(first_arrivals(accepted(watched)), "transactions")
    # Parsing is dear: only from the first to the last day with a fault it is done again. A plan
    # that turns out empty reports nothing.
    reported = {"first": first, "last": last} if curated.isEmpty() else faults.get
    if reported["first"]:
        put(checked.where(~F.col("valid") & F.col("day").between(
            F.lit(reported["first"]), F.lit(reported["last"]))).select(
                "raw_value", "reason", "day"), "dead_letters")
    own_days = put(user_days(curated), "user_days")

    def others(view: str, lower: date | None, upper: date | None) -> DataFrame | None:
        """Stored days of a view outside the range."""
        try:
            return read_days(spark, root, view, lower, upper, before).where(~in_range)
        except LookupError:
            return None

    lookback = first - timedelta(days=-(-window // DAY))
    earlier = others("transactions", lookback, first - timedelta(days=1))
    scope = curated if earlier is None else curated.unionByName(earlier)
    known = others("user_days", None, None)
    parts = own_days if known is None else own_days.unionByName(known)
    # Days of the scope answer for themselves, the ones before come from the moments.
    full = features(scope, user_totals(parts, lookback), window, s).where(in_range)
    stamp = moment(at)
    scored = score(full, profile("batch", s.fraud_threshold))
    results = put(scored.select(*FRAUD_RESULT_COLUMNS, *[
        c for c in scored.columns if c not in FRAUD_RESULT_COLUMNS]).withColumn(
        "batch_timestamp", stamp), "fraud_results")
    put(results.where("is_fraud_predicted").select(
        *FRAUD_RESULT_COLUMNS, "batch_timestamp", "day"), "batch_views")
    put(views.period_stats(results, F.col("day")), "daily_stats")
    put(views.period_stats(results, F.col("day"), F.col("country")), "country_days")

    days = days_between(first, last)
    changes: dict[tuple[str, str], str | None] = {}
    for view in VIEWS:
        path = f"{view}/run_id={run_id}"
        found = files.folders(spark, f"{root}/{path}")
        changes |= {(view, part(d)): f"{path}/{part(d)}" if part(d) in found else None
                    for d in days}
    version = manifest.commit(spark, root, changes, at)
    full_days = [d for d in days if changes["transactions", part(d)]]
    return DayRun(run_id, version, full_days, [d for d in days if d not in full_days])


def daily_stats(spark: SparkSession, root: str) -> DataFrame:
    return read_days(spark, root, "daily_stats").select(
        F.col("day").cast("timestamp").alias("date"), "total_transactions", "total_amount",
        "fraud_count", "avg_fraud_score")


def country_stats(spark: SparkSession, root: str) -> DataFrame:
    """Countries over all days, from one row per country and day."""
    score_sum: Column = F.sum(F.col("avg_fraud_score") * F.col("total_transactions"))
    return read_days(spark, root, "country_days").groupBy("country").agg(
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("total_amount").alias("total_amount"), F.sum("fraud_count").alias("fraud_count"),
        (score_sum / F.sum("total_transactions")).alias("avg_fraud_score"),
    ).withColumn("fraud_rate", views.rate("fraud_count", "total_transactions"))


def collect(spark: SparkSession, root: str, now: datetime,
            keep: timedelta = timedelta(days=1)) -> list[str]:
    """Delete replaced days that no reader of the last ``keep`` can have open."""
    return manifest.collect(spark, root, VIEWS, now, keep)
