"""Named queries over the test tables; each takes (spark, sf_dir) and returns a frame.

Times leave a query as text and decimal fractions are rounded, so that two engines can be
compared value by value.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import scoring
from riskweave.operators import (
    dedup, enrich, history, metrics, model, profiles, quality, serving, sketches, views,
)
from riskweave.plans import batch as batch_plan
from riskweave.plans import incremental
from riskweave.plans import stream as stream_plan
from riskweave.session import rocksdb_state, work_path
from riskweave.settings import (
    CATEGORY_RISK, COUNTRY_RISK, DEFAULTS, E2E_LATENCY_BOUNDS, JOB_CATEGORY_RISK,
    JOB_COUNTRY_RISK, PROCESSING_LATENCY_BOUNDS, SCORE_BOUNDS,
)
from riskweave.schema import ALERT_COLUMNS
from riskweave.sources import events, files, manifest, microbatches, stores
from riskweave.sources.risk_tables import constant_table, publish_version, read_versions
from riskweave.streaming import inspection, replay, sinks, speed, user_state
from riskweave.times import moment

Query = Callable[[SparkSession, str], DataFrame]

# Clock of all time-dependent queries: the day after the last event of the test tables,
# and a batch run some days earlier.
AS_OF = datetime(2024, 1, 31)
LAST_BATCH = datetime(2024, 1, 25)
# One day of history makes the velocity rules fire on the sparse test tables.
DAY = 86_400
A_USER = "USER_00007"
# Rows of one landed file of the replay, about.
ROWS_OF_FILE = 100_000
# The model queries train on tables of any size.
SMALL_TRAINING = replace(DEFAULTS, min_training_rows=1)

_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# ---- shared frames -------------------------------------------------------------------

def as_of() -> Column:
    return moment(AS_OF)


def text(column: str | Column, micros: bool = False) -> Column:
    pattern = "yyyy-MM-dd HH:mm:ss" + (".SSSSSS" if micros else "")
    return F.date_format(column, pattern)


def r4(column: str | Column) -> Column:
    return F.round(column, 4)


def r6(column: str | Column) -> Column:
    return F.round(column, 6)


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.transactions(spark, sf_dir)


def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated transactions, as the batch layer sees them."""
    return dedup.first_arrivals(raw(spark, sf_dir))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stored table, for plans that read it more than once."""
    return staged(spark, unique(spark, sf_dir), "transactions")


def large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.large_users(raw(spark, sf_dir))


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a frame that is read several times to the shared folder and read it back."""
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_is_fraud(df: DataFrame) -> DataFrame:
    return df.withColumn("is_fraud", F.col("_label") == "fraud")


def batch_rows(spark: SparkSession, sf_dir: str, window_seconds: int = DAY) -> DataFrame:
    return batch_plan.scored(stored(spark, sf_dir), window_seconds, large=large(spark, sf_dir))


def realtime_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated transactions under the stream rules, with their arrival time."""
    return scoring.score(unique(spark, sf_dir), "stream").withColumn(
        "processing_time", F.col("processing_timestamp")
    )


def alert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return realtime_rows(spark, sf_dir).filter("is_fraud_predicted")


def scored_columns(df: DataFrame) -> DataFrame:
    return df.select("transaction_id", r6("fraud_score").alias("fraud_score"),
                     "is_fraud_predicted")


def messages_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire text of every transaction, some of it damaged by a fixed rule on the id:
    no JSON, an amount of the wrong type, a missing field, a time that is none."""
    wire = events.to_messages(raw(spark, sf_dir))
    number = F.substring("transaction_id", 5, 8).cast("bigint")
    fault = F.pmod(number, F.lit(40))
    good = F.struct(*wire.columns)
    wrong_type = F.struct(*[
        F.lit("much").alias(c) if c == "amount" else F.col(c) for c in wire.columns
    ])
    no_merchant = F.struct(*[c for c in wire.columns if c != "merchant_id"])
    bad_time = F.struct(*[
        F.lit("yesterday").alias(c) if c == "event_time" else F.col(c) for c in wire.columns
    ])
    return wire.select(
        F.when(fault == 7, F.concat(F.lit("not json "), F.col("transaction_id")))
        .when(fault == 17, F.to_json(wrong_type))
        .when(fault == 27, F.to_json(no_merchant))
        .when(fault == 37, F.to_json(bad_time))
        .otherwise(F.to_json(good)).alias("value")
    )


def stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream of transactions that went through the wire format."""
    source = events.to_transactions(events.stream_events(spark, sf_dir))
    return speed.to_transactions(stores.kafka_envelope(events.to_messages(source)),
                                 F.col("processing_timestamp"))


def run_stream(spark: SparkSession, name: str, stream: DataFrame,
               mode: str = "append") -> DataFrame:
    """Drain a stream into a table of micro-batches and read that table."""
    root = work_path(spark, name)
    sinks.drain(stream, sinks.append_batches(root, name), f"{root}/checkpoint", mode)
    return sinks.read_batches(spark, root, name)


def speed_outputs(spark: SparkSession, sf_dir: str) -> str:
    """Run the whole speed layer once; returns the folder of its tables."""
    root = work_path(spark, "speed")
    scored = speed.score_stream(stream_rows(spark, sf_dir))
    sinks.drain(scored, sinks.fan_out(root, AS_OF), f"{root}/checkpoint")
    return root


# ---- scans, sources, sinks -----------------------------------------------------------

@query
def scan_master(spark, sf_dir):
    root = work_path(spark, "landing")
    stores.land(events.to_messages(raw(spark, sf_dir)), root)
    rows = dedup.first_arrivals(stores.read_master(spark, root))
    return rows.select(
        "transaction_id", "user_id", "amount", "country", "is_online", "hour_of_day",
        text("event_timestamp", True).alias("event_at"),
        text("processing_timestamp", True).alias("arrived_at"),
        F.col("_label").alias("label"), "year", "month", "day",
    )


@query
def stream_ingest(spark, sf_dir):
    rows = run_stream(spark, "ingest", stream_rows(spark, sf_dir))
    return rows.select(
        "transaction_id", "user_id", "amount", "merchant_category", "country", "is_online",
        text("event_timestamp", True).alias("event_at"),
        text("processing_time", True).alias("arrived_at"),
    )


@query
def risk_tables(spark, sf_dir):
    """Every table entry with the number of transactions that use it."""
    txns = unique(spark, sf_dir)

    def used(name: str, values: dict, key: str) -> DataFrame:
        counts = txns.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        table = constant_table(spark, values, key, "risk")
        return table.join(counts, key, "left").select(
            F.lit(name).alias("risk_table"), F.col(key).alias("entry"), "risk",
            F.coalesce("n", F.lit(0)).alias("transactions"),
        )

    return (
        used("country", COUNTRY_RISK, "country")
        .unionByName(used("category", CATEGORY_RISK, "merchant_category"))
        .unionByName(used("job_country", JOB_COUNTRY_RISK, "country"))
        .unionByName(used("job_category", JOB_CATEGORY_RISK, "merchant_category"))
    )


@query
def alerts_from_partitioned(spark, sf_dir):
    path = work_path(spark, "by-flag")
    stores.write_by_flag(scoring.score(with_is_fraud(unique(spark, sf_dir)), "sql"), path)
    return (
        stores.read_by_flag(spark, path).filter("is_fraud_predicted")
        .select("transaction_id", "amount", r6("fraud_score").alias("fraud_score"))
    )


@query
def landing_partitions(spark, sf_dir):
    root = work_path(spark, "landing")
    stores.land(events.to_messages(raw(spark, sf_dir)), root)
    return stores.read_landing(spark, root).groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def kafka_envelope(spark, sf_dir):
    records = stores.kafka_envelope(events.to_messages(raw(spark, sf_dir)))
    value = F.col("value")
    return records.select(
        "key", F.get_json_object(value, "$.transaction_id").alias("transaction_id"),
        F.get_json_object(value, "$.timestamp").alias("sent_at"),
        F.get_json_object(value, "$.country").alias("country"),
    )


@query
def alert_envelope(spark, sf_dir):
    """Alerts as records of their own topic."""
    records = stores.kafka_envelope(alert_rows(spark, sf_dir).select(
        "transaction_id", "user_id", "amount", "country"))
    return records.select(
        "key", F.get_json_object("value", "$.transaction_id").alias("transaction_id"),
        F.get_json_object("value", "$.amount").cast("double").alias("amount"),
    )


@query
def serving_alert_cap(spark, sf_dir):
    capped = serving.serving_cap(batch_rows(spark, sf_dir), 10_000)
    return capped.select("transaction_id", "user_id", r6("fraud_score").alias("fraud_score"))


@query
def serving_alerts(spark, sf_dir):
    """All alerts of the batch layer, as they are published."""
    alerts = batch_rows(spark, sf_dir).filter("is_fraud_predicted")
    return alerts.select("transaction_id", "user_id", r6("fraud_score").alias("fraud_score"))


@query
def metadata_latest(spark, sf_dir):
    """One batch run per day of data; the newest value of each key."""
    days = unique(spark, sf_dir).groupBy(
        F.date_trunc("day", "event_timestamp").alias("day")
    ).agg(F.max("processing_timestamp").alias("updated_at"))
    keys = F.explode(F.array(
        F.struct(F.lit("last_batch_timestamp").alias("key"), text("day").alias("value")),
        F.struct(F.lit("last_arrival").alias("key"), text("updated_at").alias("value")),
    ))
    history_rows = days.withColumn("kv", keys).select("kv.key", "kv.value", "updated_at")
    return metrics.latest_value(history_rows).select(
        "key", "value", text("updated_at").alias("updated_at")
    )


# ---- projections, filters, scalar functions ------------------------------------------

@query
def parse_times(spark, sf_dir):
    wire = events.to_messages(raw(spark, sf_dir))
    return quality.add_times(wire).select(
        "transaction_id", F.col("_label").alias("label"),
        text("event_timestamp", True).alias("event_at"),
        text("processing_timestamp", True).alias("arrived_at"),
        quality.delay_seconds().alias("delay_seconds"),
    )


@query
def parse_json_props(spark, sf_dir):
    return events.read_events(spark, sf_dir).select(
        "event_id", F.from_json("props", "k BIGINT").getField("k").alias("k")
    )


@query
def time_parts(spark, sf_dir):
    t = F.col("event_timestamp")
    return raw(spark, sf_dir).select(
        "transaction_id", F.col("_label").alias("label"), F.year(t).alias("year"),
        F.month(t).alias("month"), F.dayofmonth(t).alias("day"), F.hour(t).alias("hour"),
    )


@query
def risk_enriched(spark, sf_dir):
    return enrich.add_risk(unique(spark, sf_dir)).select(
        "transaction_id", "country", "merchant_category", "country_risk", "merchant_risk"
    )


@query
def amount_flags(spark, sf_dir):
    return scoring.amount_flags(unique(spark, sf_dir)).select(
        "transaction_id", "amount", "is_high_amount", "is_very_high_amount"
    )


@query
def fraud_results(spark, sf_dir):
    rows = views.fraud_results(batch_rows(spark, sf_dir, 300), as_of())
    return rounded(rows, fraud_score=6, amount_zscore=4).withColumns({
        "event_timestamp": text("event_timestamp", True),
        "batch_timestamp": text("batch_timestamp"),
    })


@query
def alerts(spark, sf_dir):
    rows = alert_rows(spark, sf_dir).select(*ALERT_COLUMNS)
    return rounded(rows, fraud_score=6).withColumn(
        "processing_time", text("processing_time", True)
    )


@query
def alert_display(spark, sf_dir):
    return views.alert_display(alert_rows(spark, sf_dir))


# ---- rule profiles -------------------------------------------------------------------

def _profile_query(name: str) -> Query:
    def run(spark, sf_dir):
        return scored_columns(scoring.score(with_is_fraud(unique(spark, sf_dir)), name))

    run.__name__ = f"score_{name}"
    return run


for _name in ("stream", "sql", "job", "processor", "simple"):
    query(_profile_query(_name))


@query
def score_sql_rescored(spark, sf_dir):
    """A second profile over rows that another one scored before."""
    first = scoring.score(with_is_fraud(unique(spark, sf_dir)), "stream")
    return scored_columns(scoring.score(first, "sql"))


@query
def score_batch(spark, sf_dir):
    return scored_columns(batch_rows(spark, sf_dir, 300))


@query
def score_batch_86400(spark, sf_dir):
    return scored_columns(batch_rows(spark, sf_dir))


@query
def score_scorer(spark, sf_dir):
    rows = history.velocity(stored(spark, sf_dir), DAY, large=large(spark, sf_dir))
    scored = scoring.score_features(scoring.score(rows, "scorer"))
    return scored.select(
        "transaction_id", r6("fraud_score").alias("fraud_score"), "is_fraud_predicted",
        "features.*",
    )


@query
def score_sql_udf(spark, sf_dir):
    scoring.register_score_function(spark)
    rows = scoring.add_velocity_flag(enrich.add_risk(unique(spark, sf_dir)))
    score = F.expr("risk_score(amount, country_risk, merchant_risk, is_online, "
                   "hour_of_day, velocity_flag)")
    return rows.select("transaction_id", r6(score).alias("fraud_score"))


@query
def blacklist_hits(spark, sf_dir):
    return enrich.blacklist_hits(unique(spark, sf_dir)).select("transaction_id", "merchant_id")


@query
def blacklist_clean(spark, sf_dir):
    return enrich.blacklist_clean(unique(spark, sf_dir)).select("transaction_id", "merchant_id")


@query
def blacklist_flags(spark, sf_dir):
    return enrich.flag_blacklisted(unique(spark, sf_dir)).groupBy("is_blacklisted").agg(
        F.count(F.lit(1)).alias("n"), r4(F.sum("amount")).alias("total_amount")
    )


# ---- deduplication, profiles, history ------------------------------------------------

@query
def dedup_batch(spark, sf_dir):
    return unique(spark, sf_dir).select(
        "transaction_id", F.col("_label").alias("label"),
        text("processing_timestamp", True).alias("arrived_at"),
    )


@query
def user_profiles(spark, sf_dir):
    rows = profiles.user_profiles(unique(spark, sf_dir), as_of())
    return rounded(rows, total_amount=4, avg_amount=10, stddev_amount=4, fraud_rate=9,
                   online_rate=9).withColumns({
        "first_transaction": text("first_transaction", True),
        "last_transaction": text("last_transaction", True),
        "countries_used": F.array_join("countries_used", ","),
        "categories_used": F.array_join("categories_used", ","),
    })


@query
def user_profile_lookup(spark, sf_dir):
    found = serving.user_profile(profiles.user_profiles(unique(spark, sf_dir), as_of()), A_USER)
    return found.select("user_id", "total_transactions", F.round("avg_amount", 10).alias("avg_amount"),
                        "unique_countries", "account_age_days")


@query
def user_features(spark, sf_dir):
    return rounded(profiles.user_features(unique(spark, sf_dir)),
                   avg_amount=10, stddev_amount=4, total_amount=4)


@query
def hourly_pivot(spark, sf_dir):
    return profiles.hourly_pattern(unique(spark, sf_dir))


@query
def avg_profile_rate(spark, sf_dir):
    rows = profiles.average_profile(profiles.user_profiles(unique(spark, sf_dir), as_of()))
    return rounded(rows, avg_fraud_rate=12, avg_online_rate=12)


@query
def profile_enriched(spark, sf_dir):
    txns = unique(spark, sf_dir)
    rows = profiles.enrich_with_profile(txns, profiles.user_profiles(txns, as_of()))
    return rows.select("transaction_id", "user_id", "amount", "total_transactions",
                       F.round("avg_amount", 10).alias("avg_amount"),
                       F.round("fraud_rate", 9).alias("fraud_rate"))


@query
def new_country_for_user(spark, sf_dir):
    """Transactions since the last batch run, against the profiles of that run."""
    txns = unique(spark, sf_dir)
    cut = moment(LAST_BATCH)
    known = profiles.user_profiles(txns.filter(F.col("event_timestamp") < cut), cut)
    recent = txns.filter(F.col("event_timestamp") >= cut)
    return profiles.unusual_countries(recent, known).select(
        "transaction_id", "user_id", "country", "is_new_country"
    )


@query
def amount_zscore(spark, sf_dir):
    txns = unique(spark, sf_dir)
    rows = history.amount_zscore(txns, profiles.user_features(txns))
    return rows.select("transaction_id", r4("amount_zscore").alias("amount_zscore"))


def _velocity_query(seconds: int) -> Query:
    def run(spark, sf_dir):
        return history.velocity(stored(spark, sf_dir), seconds,
                                large=large(spark, sf_dir)).select(
            "transaction_id", "velocity_count", r4("velocity_amount").alias("velocity_amount")
        )

    run.__name__ = f"velocity_{seconds}"
    return run


query(_velocity_query(300))
query(_velocity_query(DAY))


@query
def time_since_last(spark, sf_dir):
    return history.time_since_last(stored(spark, sf_dir), large=large(spark, sf_dir)).select(
        "transaction_id", text("prev_timestamp", True).alias("prev_at"), "time_since_last"
    )


# ---- views and charts ----------------------------------------------------------------

@query
def daily_stats(spark, sf_dir):
    rows = views.daily_stats(batch_rows(spark, sf_dir))
    return rounded(rows, total_amount=4, avg_fraud_score=12).withColumn("date", text("date"))


@query
def country_stats(spark, sf_dir):
    return rounded(views.country_stats(batch_rows(spark, sf_dir)),
                   total_amount=4, avg_fraud_score=12, fraud_rate=9)


@query
def period_stats(spark, sf_dir):
    rows = views.calendar_stats(batch_rows(spark, sf_dir))
    return rounded(rows, total_amount=4, avg_fraud_score=12).withColumn(
        "period_start", text("period_start"))


@query
def run_summary(spark, sf_dir):
    scored = scoring.score(with_is_fraud(unique(spark, sf_dir)), "sql")
    return rounded(views.run_summary(scored), avg_score=12, fraud_rate=9)


@query
def fraud_rate_over_time(spark, sf_dir):
    return rounded(views.fraud_rate_over_time(realtime_rows(spark, sf_dir), as_of()),
                   avg_score=12)


@query
def transactions_by_country(spark, sf_dir):
    rows = serving.transactions_by_country(
        realtime_rows(spark, sf_dir), batch_rows(spark, sf_dir), True)
    return rounded(rows, total_amount=4, fraud_rate=9)


@query
def transactions_by_country_fallback(spark, sf_dir):
    """The batch layer answers while the realtime table is empty."""
    rows = serving.transactions_by_country(
        realtime_rows(spark, sf_dir).limit(0), batch_rows(spark, sf_dir), False)
    return rounded(rows, total_amount=4, fraud_rate=9)


@query
def by_country(spark, sf_dir):
    return rounded(views.by_country(realtime_rows(spark, sf_dir), 8, "Unknown"),
                   total_amount=4, fraud_rate=9)


@query
def by_country_15(spark, sf_dir):
    return rounded(views.by_country(alert_rows(spark, sf_dir), 15),
                   total_amount=4, fraud_rate=9)


@query
def by_country_10(spark, sf_dir):
    return views.by_country(realtime_rows(spark, sf_dir), 10).select(
        "country", F.col("total").alias("count"), F.col("fraud_count").alias("fraud"))


@query
def country_bubble(spark, sf_dir):
    rows = views.country_bubble(views.by_country(realtime_rows(spark, sf_dir), 8, "Unknown"))
    return rows.select("country", "total", r4("bubble_size").alias("bubble_size"))


@query
def by_category(spark, sf_dir):
    return rounded(views.by_category(realtime_rows(spark, sf_dir)), amount=4, shown_amount=4)


@query
def high_risk_users(spark, sf_dir):
    return rounded(views.high_risk_users(realtime_rows(spark, sf_dir)),
                   total_amount=4, avg_score=12, fraud_rate=9)


@query
def high_risk_users_min2(spark, sf_dir):
    return rounded(views.high_risk_users(alert_rows(spark, sf_dir), 2),
                   total_amount=4, avg_score=12, fraud_rate=9)


@query
def recent_stats(spark, sf_dir):
    return rounded(views.recent_stats(realtime_rows(spark, sf_dir), as_of()),
                   avg_amount=10, fraud_rate=9, recent_fraud_rate=9)


@query
def dashboard_summary(spark, sf_dir):
    return rounded(views.dashboard_summary(realtime_rows(spark, sf_dir), as_of()),
                   avg_amount=10, fraud_rate=9, recent_fraud_rate=9)


@query
def hourly_trend(spark, sf_dir):
    return views.hourly_trend(realtime_rows(spark, sf_dir))


@query
def amount_buckets(spark, sf_dir):
    return views.amount_buckets(realtime_rows(spark, sf_dir))


@query
def score_histogram(spark, sf_dir):
    return views.score_histogram(alert_rows(spark, sf_dir))


@query
def confusion_metrics(spark, sf_dir):
    return rounded(views.confusion(realtime_rows(spark, sf_dir)),
                   detection_rate=9, false_positive_rate=9, precision=9)


@query
def label_mix(spark, sf_dir):
    return rounded(views.label_mix(raw(spark, sf_dir)), percent=8)


@query
def period_growth(spark, sf_dir):
    rows = views.period_growth(realtime_rows(spark, sf_dir))
    return rounded(rows, growth=8).withColumn("day", text("day"))


@query
def txn_over_time(spark, sf_dir):
    rows = views.transactions_over_time(unique(spark, sf_dir))
    return rounded(rows, total_amount=4).withColumn("window_start", text("window_start"))


@query
def window_tag(spark, sf_dir):
    return views.tag_windows(unique(spark, sf_dir)).select(
        "transaction_id", text("window_start").alias("window_start"),
        text("window_end").alias("window_end"))


@query
def loss_check(spark, sf_dir):
    """Produced transactions that the ingest did not store."""
    checked = quality.validate(quality.parse_messages(messages_with_faults(spark, sf_dir)))
    return views.missing_from(raw(spark, sf_dir), quality.accepted(checked)).select(
        "transaction_id", F.col("_label").alias("label"))


# ---- batch by day --------------------------------------------------------------------

RERUN = (date(2024, 1, 10), date(2024, 1, 11))


def day_views(spark: SparkSession, sf_dir: str) -> str:
    """All days, run as one range, then two of them once more."""
    landing, root = work_path(spark, "landing"), work_path(spark, "days")
    stores.land(events.to_messages(raw(spark, sf_dir)), landing)
    for first, last in ((date(2024, 1, 1), date(2024, 1, 31)), RERUN):
        incremental.run_days(spark, landing, root, first, last, AS_OF, 300)
    return root


@query
def incremental_scored(spark, sf_dir):
    """Scored rows of all days after a rerun of two: those of the full batch."""
    return rounded(incremental.read_days(spark, day_views(spark, sf_dir), "fraud_results").select(
        "transaction_id", "user_id", "amount", "country_risk", "merchant_risk",
        "velocity_count", "velocity_amount", "time_since_last", "amount_zscore",
        "fraud_score", "is_fraud_predicted",
    ), velocity_amount=4, amount_zscore=4, fraud_score=6)


@query
def incremental_country_stats(spark, sf_dir):
    rows = incremental.country_stats(spark, day_views(spark, sf_dir))
    return rounded(rows, total_amount=4, avg_fraud_score=10, fraud_rate=9)


@query
def incremental_parts(spark, sf_dir):
    """Version and rows of every live day; two days were replaced."""
    root = day_views(spark, sf_dir)
    versions = manifest.entries(spark, root).where("view = 'daily_stats'").groupBy("part").agg(
        F.max("version").alias("version"))
    rows = incremental.read_days(spark, root, "daily_stats").select(
        F.concat(F.lit("day="), F.col("day").cast("string")).alias("part"),
        "total_transactions")
    return rows.join(versions, "part")


# ---- serving -------------------------------------------------------------------------

def _alert_result(df: DataFrame) -> DataFrame:
    return df.select("transaction_id", "user_id", "amount", "source",
                     r6("fraud_score").alias("fraud_score"),
                     text("event_timestamp", True).alias("event_at"))


@query
def merged_alerts(spark, sf_dir):
    return _alert_result(serving.fraud_alerts(
        batch_rows(spark, sf_dir), realtime_rows(spark, sf_dir), LAST_BATCH,
        end=AS_OF, start=datetime(2024, 1, 1)))


@query
def merged_totals(spark, sf_dir):
    """Both layers over the whole range: every transaction counted once."""
    rows = serving.merged_rows(
        batch_rows(spark, sf_dir), realtime_rows(spark, sf_dir), LAST_BATCH)
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("total"), views.flagged_count().alias("fraud"))


@query
def user_fraud_history(spark, sf_dir):
    return _alert_result(serving.fraud_alerts(
        batch_rows(spark, sf_dir), realtime_rows(spark, sf_dir), LAST_BATCH,
        end=AS_OF, start=datetime(2024, 1, 1), user_id=A_USER, limit=50))


@query
def recent_alerts(spark, sf_dir):
    rows = views.latest_alerts(alert_rows(spark, sf_dir), 50, *ALERT_COLUMNS)
    return rounded(rows, fraud_score=6).withColumn(
        "processing_time", text("processing_time", True))


@query
def dashboard_timeline(spark, sf_dir):
    """Hourly country statistics in place of micro-batches; the newest hundred rows."""
    hours = views.period_stats(
        realtime_rows(spark, sf_dir),
        F.window("event_timestamp", "1 hour").end.alias("timestamp"), F.col("country"),
    ).withColumnRenamed("total_transactions", "transaction_count")
    rows = rounded(views.dashboard_timeline(hours), total_amount=4, avg_fraud_score=12)
    return rows.withColumn("timestamp", text("timestamp"))


@query
def realtime_retention(spark, sf_dir):
    return serving.retention_counts(realtime_rows(spark, sf_dir), as_of(), hours=2)


@query
def layer_stats(spark, sf_dir):
    txns = unique(spark, sf_dir)
    live = realtime_rows(spark, sf_dir)
    return metrics.view_sizes({
        "batch_views": batch_rows(spark, sf_dir).filter("is_fraud_predicted"),
        "realtime_views": live,
        "fraud_alerts": live.filter("is_fraud_predicted"),
        "user_profiles": profiles.user_features(txns),
    }, text(moment(LAST_BATCH)))


# ---- quality -------------------------------------------------------------------------

@query
def lateness_split(spark, sf_dir):
    return quality.lateness_split(raw(spark, sf_dir))


@query
def quality_report(spark, sf_dir):
    return quality.quality_report(
        quality.validate(quality.parse_messages(messages_with_faults(spark, sf_dir))))


@query
def dead_letter(spark, sf_dir):
    rejected = quality.dead_letters(
        quality.validate(quality.parse_messages(messages_with_faults(spark, sf_dir))))
    return rejected.select(
        F.regexp_extract("raw_value", "TXN-[0-9]+", 0).alias("transaction_id"), "reason")


@query
def batch_rejected(spark, sf_dir):
    """Faulty messages that the batch job finds in the landing folder."""
    root = work_path(spark, "faulty")
    messages_with_faults(spark, sf_dir).write.text(root)
    _, rejected = batch_plan.read_valid(spark, root)
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


@query
def late_events(spark, sf_dir):
    """Every event that arrived late, with its class."""
    return quality.lateness(raw(spark, sf_dir)).filter("lateness <> 'on_time'").select(
        "transaction_id", "delay_seconds", "lateness")


@query
def rejection_rate(spark, sf_dir):
    checked = quality.validate(quality.parse_messages(messages_with_faults(spark, sf_dir)))
    return rounded(metrics.rejection_rate(checked), rejection_rate=9)


@query
def imputed(spark, sf_dir):
    """Optional fields filled for analytics."""
    return quality.fill_optional(unique(spark, sf_dir)).groupBy(
        "country", "merchant_category").agg(F.count(F.lit(1)).alias("n"))


# ---- streaming -----------------------------------------------------------------------

@query
def dedup_stream(spark, sf_dir):
    rows = run_stream(spark, "dedup", dedup.stream_first_seen(
        stream_rows(spark, sf_dir), DEFAULTS.watermark_delay))
    return rows.select("transaction_id", "user_id", "amount",
                       text("event_timestamp", True).alias("event_at"))


@query
def dedup_stream_by_id(spark, sf_dir):
    rows = run_stream(spark, "dedup", dedup.stream_first_seen_by_id(
        stream_rows(spark, sf_dir), DEFAULTS.dedup_window))
    return rows.select("transaction_id", "user_id", "amount")


@query
def stream_enriched(spark, sf_dir):
    rows = run_stream(spark, "enriched", enrich.add_risk(stream_rows(spark, sf_dir)))
    return rows.select("transaction_id", text("processing_time", True).alias("arrived_at"),
                       "country_risk", "merchant_risk")


# The risk tables that hold from a time in the middle of the test tables on.
NEW_RISKS = {"country_risk": {"US": 0.5, "NG": 0.1, "UA": 0.95, "DE": 0.3},
             "merchant_risk": {"grocery": 0.9, "crypto": 0.2, "travel": 0.6}, "blacklist": []}
NEW_RISKS_FROM = datetime(2024, 1, 16, 12)


def risk_versions(spark: SparkSession) -> str:
    """A folder of risk versions with one published file."""
    root = work_path(spark, "risks")
    spark.sql("SELECT :doc AS value", args={"doc": json.dumps(NEW_RISKS)}).coalesce(
        1).write.text(f"{root}/file")
    publish_version(spark, root, f"{root}/file", NEW_RISKS_FROM)
    return root


@query
def batch_scored_as_of(spark, sf_dir):
    """Batch scores with the risks that held at each transaction's time."""
    rows = batch_plan.scored(stored(spark, sf_dir), 300, large=large(spark, sf_dir),
                             versions=read_versions(spark, risk_versions(spark)))
    return rounded(rows.select("transaction_id", "country_risk", "merchant_risk",
                               "fraud_score", "is_fraud_predicted"), fraud_score=6)


@query
def stream_scored_as_of(spark, sf_dir):
    """The speed layer with risk versions and user profiles read for each micro-batch."""
    root, risks = work_path(spark, "speed"), risk_versions(spark)
    earlier = unique(spark, sf_dir).where(F.col("event_timestamp") < moment(LAST_BATCH))
    users = staged(spark, profiles.user_profiles(earlier, as_of()), "profiles")
    sinks.drain(speed.unique_stream(stream_rows(spark, sf_dir)), sinks.fan_out(
        root, AS_OF, lambda batch: speed.score_batch(
            batch, read_versions(spark, risks), users)), f"{root}/checkpoint")
    return sinks.read_batches(spark, root, "realtime_views").select(
        "transaction_id", "country_risk", "merchant_risk",
        r6("fraud_score").alias("fraud_score"), "is_fraud_predicted",
        r4("amount_zscore").alias("amount_zscore"), "is_new_country")


@query
def stream_window_stats(spark, sf_dir):
    scored = scoring.score(stream_rows(spark, sf_dir), "stream")
    rows = run_stream(spark, "windows", speed.window_stats(
        scored, DEFAULTS, "1 minute", None, "country"))
    return rounded(rows.drop("batch_id"), total_amount=4).withColumns({
        "window_start": text("window_start"), "window_end": text("window_end")})


@query
def stream_sliding_stats(spark, sf_dir):
    rows = run_stream(spark, "windows", speed.window_stats(
        stream_rows(spark, sf_dir), DEFAULTS, "1 minute", "30 seconds"))
    return rounded(rows.drop("batch_id"), total_amount=4).withColumns({
        "window_start": text("window_start"), "window_end": text("window_end")})


@query
def stream_alerts(spark, sf_dir):
    rows = sinks.read_batches(spark, speed_outputs(spark, sf_dir), "fraud_alerts")
    return rows.select("transaction_id", "user_id", "amount", "country",
                       r6("fraud_score").alias("fraud_score"))


@query
def stream_scored(spark, sf_dir):
    """The flagship speed-layer run: every scored row with its window."""
    rows = sinks.read_batches(spark, speed_outputs(spark, sf_dir), "realtime_views")
    return rows.select(
        "transaction_id", "user_id", "amount", r6("fraud_score").alias("fraud_score"),
        "is_fraud_predicted", text("window_start").alias("window_start"),
        text("window_end").alias("window_end"))


def land_in_turn(spark: SparkSession, sf_dir: str, path: str) -> int:
    """Messages of five spans of days, one after the other, each in the same number of files;
    returns that number. A stream takes files in the order of their writing."""
    rows, day = raw(spark, sf_dir), F.dayofmonth("event_timestamp")
    each = max(1, ceil(events.read_events(spark, sf_dir).count() / 5 / ROWS_OF_FILE))
    spans = ((1, 6), (7, 12), (13, 18), (19, 24), (25, 31))
    for i, (first, last) in enumerate(spans, 1):
        span = rows.where(day.between(first, last)).repartition(each)
        stores.kafka_envelope(events.to_messages(span)).select("value").write.mode(
            "append").text(path)
        # Tasks without rows write no file.
        for _ in range(i * each - files.measure(spark, path)[1]):
            spark.createDataFrame([], "value string").write.mode("append").text(path)
    return each


@query
def replayed_view(spark, sf_dir):
    """The speed layer over five spans of days in turn, packed, with its middle batches replayed."""
    root = work_path(spark, "replayed")
    files_each = land_in_turn(spark, sf_dir, f"{root}/in")
    stream_plan.start(speed.read_landing_stream(spark, f"{root}/in", files_each), f"{root}/out",
                      f"{root}/checkpoint", available_now=True).awaitTermination()
    microbatches.compact(spark, f"{root}/out", "realtime_views", AS_OF)
    replay.replay(spark, f"{root}/checkpoint", f"{root}/out", 1, 3, AS_OF)
    rows = sinks.read_batches(spark, f"{root}/out", "realtime_views")
    return rows.select(
        "transaction_id", "user_id", "amount", r6("fraud_score").alias("fraud_score"),
        "is_fraud_predicted", text("window_start").alias("window_start"),
        text("window_end").alias("window_end"))


@query
def microbatch_country_stats(spark, sf_dir):
    rows = sinks.read_batches(spark, speed_outputs(spark, sf_dir), "dashboard_stats")
    return rounded(rows.drop("batch_id"), total_amount=4, avg_fraud_score=12).withColumn(
        "timestamp", text("timestamp"))


@query
def fanout_counts(spark, sf_dir):
    root = speed_outputs(spark, sf_dir)
    return metrics.view_sizes(
        {t: sinks.read_batches(spark, root, t)
         for t in ("realtime_views", "fraud_alerts", "dashboard_stats")},
        text(as_of()))


@query
def current_user_risk(spark, sf_dir):
    scored = scoring.score(stream_rows(spark, sf_dir), "stream")
    updates = run_stream(spark, "risk", speed.current_user_risk(scored), "update")
    return sinks.newest_per_user(updates).select(
        "user_id", r6("risk_score").alias("risk_score"),
        text("scored_at", True).alias("scored_at"))


@query
def active_user_risk(spark, sf_dir):
    """Current score of the users that have not been idle for a day; the others have left
    the state."""
    scored = scoring.score(stream_rows(spark, sf_dir), "stream")
    with rocksdb_state(spark):
        updates = run_stream(spark, "active-risk", user_state.current_user_risk(scored),
                             "update")
    return user_state.active(updates).select(
        "user_id", r6("risk_score").alias("risk_score"),
        text("scored_at", True).alias("scored_at"))


@query
def user_risk_state(spark, sf_dir):
    """The same users, read from the state that the stopped stream has left."""
    scored = scoring.score(stream_rows(spark, sf_dir), "stream")
    root = work_path(spark, "risk-state")
    with rocksdb_state(spark):
        sinks.drain(user_state.current_user_risk(scored), sinks.append_batches(root, "t"),
                    f"{root}/checkpoint", "update")
    return inspection.user_records(spark, f"{root}/checkpoint").select(
        "user_id", r6("risk_score").alias("risk_score"),
        text("scored_at", True).alias("scored_at"))


@query
def dedup_state(spark, sf_dir):
    """Keys that a deduplication with a watermark of a day still remembers at its end."""
    root = work_path(spark, "dedup-state")
    sinks.drain(dedup.stream_first_seen(stream_rows(spark, sf_dir), "1 day"),
                sinks.append_batches(root, "t"), f"{root}/checkpoint")
    return inspection.dedup_keys(spark, f"{root}/checkpoint").select(
        "transaction_id", text("event_timestamp", True).alias("event_at"))


def window_sketches(spark, sf_dir) -> DataFrame:
    """Sketches per closed minute, written by a stream."""
    rows = stream_rows(spark, sf_dir).withWatermark("event_timestamp", DEFAULTS.watermark_delay)
    return run_stream(spark, "sketches", sketches.per_window(rows, DEFAULTS.window_duration))


@query
def active_users_sketch(spark, sf_dir):
    """Distinct users per hour, per day and in all, merged from the sketches per minute."""
    written = window_sketches(spark, sf_dir)
    parts = [sketches.active_users(written, every).select(
        F.lit(name).alias("span"), text("window_start").alias("window_start"), "active_users")
        for name, every in (("hour", "1 hour"), ("day", "1 day"))]
    return parts[0].unionByName(parts[1]).unionByName(sketches.active_users(written).select(
        F.lit("all").alias("span"), F.lit(None).cast("string").alias("window_start"),
        "active_users"))


@query
def delay_sketch_quantiles(spark, sf_dir):
    """Quantiles of the delay per hour, merged from the sketches per minute."""
    rows = sketches.quantiles(window_sketches(spark, sf_dir), "1 hour")
    return rounded(rows, p50=6, p95=6, p99=6).withColumn("window_start", text("window_start"))


# ---- model ---------------------------------------------------------------------------

@query
def training_set(spark, sf_dir):
    rows = model.training_set(unique(spark, sf_dir))
    return rows.withColumn("in_train", model.in_train_part(DEFAULTS.train_share)).select(
        "transaction_id", "label", "in_train")


def _predictions(df: DataFrame, *columns: str) -> DataFrame:
    """Rounded where fits on other layouts of the same rows still agree."""
    return df.select(*columns, F.round("fraud_probability", 4).alias("fraud_probability"),
                     "prediction")


@query
def model_eval(spark, sf_dir):
    """Every held-out row under both models, trained on the other rows."""
    # Training passes over its input many times, so the features are written once.
    rows = staged(spark, batch_rows(spark, sf_dir), "features")
    held_out = model.training_set(rows).filter(~model.in_train_part(DEFAULTS.train_share))
    out = None
    for name, features in (("history", model.HISTORY_FEATURES),
                           ("online", model.ONLINE_FEATURES)):
        trained = model.train(rows, features, SMALL_TRAINING)
        part = _predictions(
            model.predict(trained.model, held_out).withColumn("features", F.lit(name)),
            "features", "transaction_id", "label")
        out = part if out is None else out.unionByName(part)
    return out


@query
def stream_model_score(spark, sf_dir):
    """A model trained on what a stream can compute, saved by the batch side, loaded and
    applied to the stream beside the rules."""
    features = scoring.score(unique(spark, sf_dir), "stream")
    trained = model.train(staged(spark, features, "features"), model.STREAM_FEATURES,
                          SMALL_TRAINING)
    fitted = model.load(model.save(trained.model, work_path(spark, "model"), AS_OF))
    rows = run_stream(spark, "modelled", model.predict_or_rules(
        stream_rows(spark, sf_dir), fitted))
    return _predictions(rows.withColumn("fraud_score", r6("fraud_score")),
                        "transaction_id", "fraud_score")


# ---- metrics -------------------------------------------------------------------------

def _layers(spark, sf_dir) -> DataFrame:
    live = realtime_rows(spark, sf_dir).select(
        F.lit("stream").alias("layer"), "country", "is_fraud_predicted")
    full = batch_rows(spark, sf_dir).select(
        F.lit("batch").alias("layer"), "country", "is_fraud_predicted")
    return live.unionByName(full)


def _outcomes(spark, sf_dir) -> DataFrame:
    """Ingest outcome of every message, under the time it arrived (unknown where the
    message was not readable; those fall into no rate window)."""
    checked = quality.validate(quality.parse_messages(messages_with_faults(spark, sf_dir)))
    return checked.select(
        F.lit("stream").alias("layer"),
        F.when(F.col("valid"), "success").otherwise("error").alias("status"),
        F.col("processing_timestamp").alias("event_timestamp"))


@query
def metric_transactions(spark, sf_dir):
    return metrics.transactions_total(_outcomes(spark, sf_dir))


@query
def metric_fraud(spark, sf_dir):
    return metrics.fraud_total(_layers(spark, sf_dir))


@query
def latency_histogram(spark, sf_dir):
    rows = events.read_events(spark, sf_dir).withColumn("layer", F.lit("stream"))
    return rounded(metrics.histogram(rows, F.col("value") / 100, PROCESSING_LATENCY_BOUNDS,
                                     F.col("layer")), sum=4)


@query
def e2e_latency_histogram(spark, sf_dir):
    rows = raw(spark, sf_dir).withColumn("layer", F.lit("stream"))
    delay = quality.delay_seconds().cast("double")
    return rounded(metrics.histogram(rows, delay, E2E_LATENCY_BOUNDS, F.col("layer")), sum=4)


@query
def metric_score_histogram(spark, sf_dir):
    score = F.round("fraud_score", 6)
    return rounded(metrics.histogram(realtime_rows(spark, sf_dir), score, SCORE_BOUNDS), sum=4)


@query
def active_users(spark, sf_dir):
    rows = metrics.active_users(unique(spark, sf_dir))
    return rows.withColumn("window_start", text("window_start"))


@query
def rate_5m(spark, sf_dir):
    rows = metrics.rate_per_second(_outcomes(spark, sf_dir), "layer", "status")
    return rounded(rows, rate=9).withColumn("window_start", text("window_start"))


@query
def fraud_rate_5m(spark, sf_dir):
    rows = metrics.rate_per_second(alert_rows(spark, sf_dir), "country")
    return rounded(rows, rate=9).withColumn("window_start", text("window_start"))


@query
def latency_quantiles(spark, sf_dir):
    rows = events.read_events(spark, sf_dir).withColumn("t", F.col("ts").cast("timestamp"))
    out = metrics.histogram_quantiles(
        rows, F.col("value") / 100, {"p50": 0.50, "p95": 0.95, "p99": 0.99},
        F.window("t", "5 minutes").start.alias("window_start"))
    return rounded(out, p50=9, p95=9, p99=9).withColumn("window_start", text("window_start"))


# ---- flagship ------------------------------------------------------------------------

@query
def batch_scored(spark, sf_dir):
    """Dedup, lookups, history features and batch rules over the full table."""
    return rounded(batch_rows(spark, sf_dir, 300).select(
        "transaction_id", "user_id", "amount", "country_risk", "merchant_risk",
        "velocity_count", "velocity_amount", "time_since_last", "amount_zscore",
        "fraud_score", "is_fraud_predicted",
    ), velocity_amount=4, amount_zscore=4, fraud_score=6)
