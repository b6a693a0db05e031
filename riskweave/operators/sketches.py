"""Mergeable sketches: distinct users and quantiles of delays per window.

A window's sketch is a few KB however many rows it stands for. Sketches of disjoint windows,
micro-batches or partitions merge without the rows, so a stream writes small ones and any
longer span is answered by merging them. Distinct counts of a longer span cannot be had from
the counts of its windows, and quantiles not from theirs.

Errors: a distinct count is within 2.6 / sqrt(2^LG_K) of the true one (99 %, some 2 %; counts
up to about 1,500 are exact), a quantile's rank within 1.33 % (99 %; exact for up to KLL_K
values). Null users and null delays are not counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14
KLL_K = 200
QUANTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}


def delay_seconds() -> Column:
    """Seconds from the event to its arrival, with fractions."""
    return (F.unix_micros("processing_time") - F.unix_micros("event_timestamp")) / 1e6


def per_window(rows: DataFrame, every: str = "1 minute", *keys: str) -> DataFrame:
    """window_start, window_end, keys, n, users (sketch), delays (sketch); for batches and
    for watermarked streams."""
    window = F.window("event_timestamp", every)
    return rows.groupBy(window.alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg("user_id", LG_K).alias("users"),
        F.kll_sketch_agg_double(delay_seconds(), KLL_K).alias("delays"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
             "n", "users", "delays")


def _span(every: str) -> Column:
    return F.window("window_start", every).start.alias("window_start")


def active_users(sketches: DataFrame, every: str | None = None, *keys: str) -> DataFrame:
    """Distinct users per span of windows; of all windows together without ``every``."""
    spans = [_span(every)] if every else []
    users = F.hll_sketch_estimate(F.hll_union_agg("users"))
    return sketches.groupBy(*spans, *keys).agg(users.alias("active_users"))


def quantiles(sketches: DataFrame, every: str | None = None, *keys: str,
              of: dict[str, float] = QUANTILES) -> DataFrame:
    """Count and quantiles of the delays per span of windows."""
    spans = [_span(every)] if every else []
    # Sketches of windows without a delay are empty and have no quantile.
    merged = sketches.groupBy(*spans, *keys).agg(F.kll_merge_agg_double("delays").alias("_all"))
    names = [c for c in merged.columns if c != "_all"]
    count = F.kll_sketch_get_n_double("_all")
    return merged.select(*names, count.alias("count"), *[
        F.when(count > 0, F.kll_sketch_get_quantile_double("_all", F.lit(q))).alias(n)
        for n, q in of.items()])
