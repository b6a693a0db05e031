"""Batch views and the aggregates behind charts: grouped, partially aggregated passes.

Every function takes scored rows and returns one small result. Where a result is cut to
the largest groups, the order ends in a unique key so that the cut is repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.schema import FRAUD_RESULT_COLUMNS
from riskweave.settings import AMOUNT_BUCKETS


def flagged_count() -> Column:
    return F.count_if(F.coalesce("is_fraud_predicted", F.lit(False)))


def rate(part: str, whole: str) -> Column:
    """Share with an empty whole counted as one."""
    return F.col(part) / F.greatest(F.lit(1), F.col(whole))


def fraud_results(scored: DataFrame, batch_timestamp: Column) -> DataFrame:
    return scored.select(*FRAUD_RESULT_COLUMNS, batch_timestamp.alias("batch_timestamp"))


def period_stats(scored: DataFrame, *keys: Column) -> DataFrame:
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("amount").alias("total_amount"),
        flagged_count().alias("fraud_count"),
        F.avg("fraud_score").alias("avg_fraud_score"),
    )


def daily_stats(scored: DataFrame) -> DataFrame:
    return period_stats(scored, F.date_trunc("day", "event_timestamp").alias("date"))


def country_stats(scored: DataFrame) -> DataFrame:
    return period_stats(scored, F.col("country")).withColumn(
        "fraud_rate", rate("fraud_count", "total_transactions")
    )


def calendar_stats(scored: DataFrame) -> DataFrame:
    """Day, week and month in one pass: days are aggregated first, the coarser grains
    are rolled up from the (few) days."""
    days = scored.groupBy(F.date_trunc("day", "event_timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"),
        flagged_count().alias("fraud"), F.sum("fraud_score").alias("score"),
    )
    grains = F.explode(F.array(*[
        F.struct(F.lit(g).alias("grain"), F.date_trunc(g, "day").alias("period_start"))
        for g in ("day", "week", "month")
    ]))
    return (
        days.withColumn("g", grains)
        .groupBy(F.col("g.grain").alias("grain"), F.col("g.period_start").alias("period_start"))
        .agg(
            F.sum("n").alias("total_transactions"), F.sum("amount").alias("total_amount"),
            F.sum("fraud").alias("fraud_count"),
            (F.sum("score") / F.sum("n")).alias("avg_fraud_score"),
        )
    )


def run_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("total"),
        flagged_count().alias("fraud_count"),
        F.avg("fraud_score").alias("avg_score"),
    ).withColumn("fraud_rate", rate("fraud_count", "total"))


def with_throughput(summary: DataFrame, elapsed_seconds: float) -> DataFrame:
    return summary.withColumn(
        "records_per_second", F.col("total") / F.greatest(F.lit(1.0), F.lit(elapsed_seconds))
    )


def fraud_rate_over_time(scored: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    since = as_of - F.make_dt_interval(hours=F.lit(hours))
    return (
        scored.filter(F.col("event_timestamp") >= since)
        .groupBy(F.date_format("event_timestamp", "yyyy-MM-dd HH:00").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("total"), flagged_count().alias("fraud_count"),
            F.avg("fraud_score").alias("avg_score"),
        )
        .orderBy("hour")
    )


def by_country(scored: DataFrame, top: int, label: str | None = None) -> DataFrame:
    """Largest countries with their flagged rows and rate; ``label`` names the null group."""
    country = F.coalesce("country", F.lit(label)) if label else F.col("country")
    return (
        scored.groupBy(country.alias("country"))
        .agg(
            F.count(F.lit(1)).alias("total"), flagged_count().alias("fraud_count"),
            F.sum("amount").alias("total_amount"),
        )
        .orderBy(F.desc("total"), F.asc_nulls_last("country"))
        .limit(top)
        .withColumn("fraud_rate", rate("fraud_count", "total"))
    )


def country_bubble(countries: DataFrame) -> DataFrame:
    """Marker size relative to the largest amount; the input holds a few top groups."""
    largest = F.max("total_amount").over(Window.partitionBy())
    return countries.withColumn("bubble_size", F.col("total_amount") / largest * 50 + 10)


def by_category(scored: DataFrame, top: int = 6) -> DataFrame:
    """Largest categories, their amounts and the total amount over those shown."""
    shown = (
        scored.groupBy(F.coalesce("merchant_category", F.lit("Other")).alias("category"))
        .agg(F.count(F.lit(1)).alias("total"), F.sum("amount").alias("amount"))
        .orderBy(F.desc("total"), "category")
        .limit(top)
    )
    return shown.withColumn("shown_amount", F.sum("amount").over(Window.partitionBy()))


def high_risk_users(scored: DataFrame, min_transactions: int = 3, top: int = 10) -> DataFrame:
    return (
        scored.groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            flagged_count().alias("fraud_count"),
            F.sum("amount").alias("total_amount"),
            F.avg("fraud_score").alias("avg_score"),
        )
        .filter(F.col("total_transactions") >= min_transactions)
        .withColumn("fraud_rate", rate("fraud_count", "total_transactions"))
        .orderBy(F.desc("fraud_rate"), "user_id")
        .limit(top)
    )


def recent_stats(scored: DataFrame, as_of: Column, hours: int = 1) -> DataFrame:
    """Last hours and all time from one conditional pass."""
    recent = F.col("processing_time") >= as_of - F.make_dt_interval(hours=F.lit(hours))
    flagged = F.coalesce("is_fraud_predicted", F.lit(False))
    return scored.agg(
        F.count_if(recent).alias("recent_total"),
        F.count_if(recent & flagged).alias("recent_fraud"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(flagged).alias("fraud"),
        F.avg("amount").alias("avg_amount"),
    ).withColumns({
        "recent_fraud_rate": rate("recent_fraud", "recent_total"),
        "fraud_rate": rate("fraud", "total"),
    })


def dashboard_summary(scored: DataFrame, as_of: Column) -> DataFrame:
    return recent_stats(scored, as_of).select(
        F.col("total").alias("total_transactions"), F.col("fraud").alias("total_fraud"),
        "fraud_rate", F.col("recent_total").alias("recent_transactions"),
        "recent_fraud", "recent_fraud_rate", "avg_amount",
    )


def hourly_trend(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy(F.col("hour_of_day").alias("hour"))
        .agg(F.count(F.lit(1)).alias("total"), flagged_count().alias("fraud"))
        .orderBy("hour")
    )


def amount_buckets(scored: DataFrame) -> DataFrame:
    """Counts per half-open amount range; the label travels with its bound."""
    amount, label = F.col("amount"), None
    for low, high, name in AMOUNT_BUCKETS:
        inside = (amount >= low) & (amount < high)
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return scored.groupBy(label.otherwise("Other").alias("range")).agg(
        F.count(F.lit(1)).alias("count"), flagged_count().alias("fraud")
    )


def latest_alerts(alerts: DataFrame, limit: int, *columns: str) -> DataFrame:
    """Newest alerts by processing time; a top-k, so no full sort of the table."""
    out = (
        alerts.filter("is_fraud_predicted")
        .orderBy(F.desc_nulls_last("processing_time"), "transaction_id")
        .limit(limit)
    )
    return out.select(*columns) if columns else out


def score_histogram(alerts: DataFrame, last: int = 500, bins: int = 20) -> DataFrame:
    """Score distribution over the newest alerts, as the chart shows it."""
    bucket = F.least(F.floor(F.round(F.col("fraud_score") * bins, 6)), F.lit(bins - 1))
    return (
        latest_alerts(alerts, last, "fraud_score", "processing_time", "transaction_id")
        .groupBy(bucket.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("bin_start", F.col("bin") / bins)
    )


def alert_display(alerts: DataFrame, limit: int = 20) -> DataFrame:
    """Table cells as text: money, percent, ids cut to twelve characters."""
    tid = F.col("transaction_id")
    return latest_alerts(alerts, limit).select(
        F.when(F.length(tid) > 12, F.concat(F.substring(tid, 1, 12), F.lit("...")))
        .otherwise(tid).alias("transaction_id"),
        "user_id",
        F.coalesce(F.concat(F.lit("$"), F.format_number("amount", 2)), F.lit("N/A"))
        .alias("amount"),
        "country", "merchant_category",
        F.coalesce(
            F.concat(F.format_number(F.round(F.col("fraud_score") * 100, 6), 2), F.lit("%")),
            F.lit("N/A"),
        ).alias("fraud_score"),
    )


def dashboard_timeline(stats: DataFrame, limit: int = 100) -> DataFrame:
    """Newest per-micro-batch statistics."""
    return stats.orderBy(
        F.desc("timestamp"), F.desc("transaction_count"), F.asc_nulls_last("country")
    ).limit(limit)


def confusion(scored: DataFrame) -> DataFrame:
    """Predicted flag against the label, with the rates derived from the four counts."""
    actual = F.col("_label") == "fraud"
    hit = F.coalesce("is_fraud_predicted", F.lit(False))
    return scored.agg(
        F.count_if(actual & hit).alias("tp"), F.count_if(~actual & hit).alias("fp"),
        F.count_if(actual & ~hit).alias("fn"), F.count_if(~actual & ~hit).alias("tn"),
    ).withColumns({
        "detection_rate": F.col("tp") / F.greatest(F.lit(1), F.col("tp") + F.col("fn")),
        "false_positive_rate": F.col("fp") / F.greatest(F.lit(1), F.col("fp") + F.col("tn")),
        "precision": F.col("tp") / F.greatest(F.lit(1), F.col("tp") + F.col("fp")),
    })


def label_mix(txns: DataFrame) -> DataFrame:
    """Rows per label with their share; the window runs over the handful of labels."""
    counts = txns.groupBy(F.col("_label").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    everything = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("percent", F.col("n") * 100 / everything)


def period_growth(scored: DataFrame) -> DataFrame:
    """Each day's total against the day before; the window runs over days."""
    days = scored.groupBy(F.date_trunc("day", "event_timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("total"), flagged_count().alias("fraud")
    )
    in_time = Window.orderBy("day")
    before = F.lag("total").over(in_time)
    return days.withColumns({
        "prev_total": before,
        "prev_fraud": F.lag("fraud").over(in_time),
        "growth": (F.col("total") - before) / F.greatest(F.lit(1), before) * 100,
    })


def transactions_over_time(txns: DataFrame, every: str = "1 hour") -> DataFrame:
    return txns.groupBy(F.window("event_timestamp", every).start.alias("window_start")).agg(
        F.count(F.lit(1)).alias("total"), F.sum("amount").alias("total_amount")
    )


def tag_windows(df: DataFrame, duration: str = "1 minute",
                event_time: str = "event_timestamp") -> DataFrame:
    """Start and end of the tumbling window of each row, without aggregating."""
    w = F.window(event_time, duration)
    return df.withColumns({"window_start": w.start, "window_end": w.end})


def missing_from(source: DataFrame, sink: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows produced but not stored. The ids are as many as the rows, whatever the size of the
    files they are read from suggests, so they are shuffled and never sent to every task."""
    return source.join(sink.select(key).hint("merge"), key, "left_anti")
