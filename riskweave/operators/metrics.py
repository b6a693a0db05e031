"""Operational metrics as aggregates over scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.settings import PROCESSING_LATENCY_BOUNDS


def transactions_total(df: DataFrame) -> DataFrame:
    """Rows per layer and outcome."""
    return df.groupBy("layer", "status").agg(F.count(F.lit(1)).alias("total"))


def fraud_total(scored: DataFrame) -> DataFrame:
    return (
        scored.filter("is_fraud_predicted").groupBy("layer", "country")
        .agg(F.count(F.lit(1)).alias("total"))
    )


def histogram(df: DataFrame, value: Column, bounds: tuple[float, ...],
              *keys: Column) -> DataFrame:
    """Cumulative counts per upper bound, with count and sum, in one pass.

    All bounds are counted in the same aggregation and turned into rows afterwards, so
    the input is neither repeated nor expanded.
    """
    cells = {f"b{i}": F.count_if(value <= b) for i, b in enumerate(bounds)}
    wide = df.groupBy(*keys).agg(
        *[c.alias(n) for n, c in cells.items()],
        F.count(value).alias("count"), F.sum(value).alias("sum"),
    )
    names = [c for c in wide.columns if c not in cells]
    rows = F.explode(F.array(
        *[F.struct(F.lit(str(float(b))).alias("le"), F.col(f"b{i}").alias("cumulative"))
          for i, b in enumerate(bounds)],
        F.struct(F.lit("+Inf").alias("le"), F.col("count").alias("cumulative")),
    ))
    return wide.select(*names, rows.alias("_r")).select(*names, "_r.le", "_r.cumulative")


def histogram_quantiles(df: DataFrame, value: Column, quantiles: dict[str, float],
                        *keys: Column,
                        bounds: tuple[float, ...] = PROCESSING_LATENCY_BOUNDS) -> DataFrame:
    """Quantiles estimated from cumulative bucket counts, linear inside a bucket.

    Only the bucket counts are grouped, so a hot time window costs no more than any
    other. A rank beyond the last bound reports that bound.
    """
    wide = df.groupBy(*keys).agg(
        *[F.count_if(value <= b).alias(f"b{i}") for i, b in enumerate(bounds)],
        F.count(value).alias("count"),
    )
    names = [c for c in wide.columns if not (c.startswith("b") and c[1:].isdigit())]

    def estimate(q: float) -> Column:
        rank = F.col("count") * q
        out = None
        for i, upper in enumerate(bounds):
            low = bounds[i - 1] if i else 0.0
            below = F.col(f"b{i - 1}") if i else F.lit(0)
            inside = F.col(f"b{i}") - below
            point = F.lit(low) + (upper - low) * (rank - below) / F.when(inside > 0, inside)
            hit = F.col(f"b{i}") >= rank
            out = F.when(hit, point) if out is None else out.when(hit, point)
        return out.otherwise(F.lit(bounds[-1]))

    return wide.select(*names, *[estimate(q).alias(n) for n, q in quantiles.items()])


def active_users(df: DataFrame, every: str = "1 hour", exact: bool = True) -> DataFrame:
    count = F.countDistinct("user_id") if exact else F.approx_count_distinct("user_id")
    return df.groupBy(F.window("event_timestamp", every).start.alias("window_start")).agg(
        count.alias("active_users")
    )


def rate_per_second(df: DataFrame, *keys: str, seconds: int = 300) -> DataFrame:
    """Arrivals per second over fixed windows, per label."""
    window = F.window("event_timestamp", f"{seconds} seconds").start.alias("window_start")
    return df.groupBy(window, *keys).agg(
        F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) / seconds).alias("rate")
    )


def view_sizes(views: dict[str, DataFrame], last_batch: Column) -> DataFrame:
    """Row count per view, with the time of the last batch run."""
    parts = [
        v.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("view"), "rows")
        for name, v in views.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("last_batch", last_batch)


def latest_value(metadata: DataFrame) -> DataFrame:
    """Newest value of every key of an append-only key/value table."""
    return metadata.groupBy("key").agg(
        F.max_by("value", "updated_at").alias("value"),
        F.max("updated_at").alias("updated_at"),
    )


def rejection_rate(validated: DataFrame) -> DataFrame:
    return validated.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(~F.col("valid")).alias("rejected")
    ).withColumn("rejection_rate",
                 F.col("rejected") / F.greatest(F.lit(1), F.col("total")))


def source_lag(progress: dict) -> dict[str, int]:
    """Records still waiting per source partition, read from a query's progress report."""
    lag: dict[str, int] = {}
    for source in progress.get("sources", []):
        newest, done = source.get("latestOffset"), source.get("endOffset")
        if not isinstance(newest, dict) or not isinstance(done, dict):
            continue
        for topic, parts in newest.items():
            if isinstance(parts, dict):
                for part, offset in parts.items():
                    reached = done.get(topic, {}).get(part, 0)
                    lag[f"{topic}-{part}"] = max(0, int(offset) - int(reached))
    return lag


def trigger_seconds(progress: dict) -> float:
    """Duration of the last micro-batch."""
    return progress.get("durationMs", {}).get("triggerExecution", 0) / 1000.0
