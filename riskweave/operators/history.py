"""Per-user features that look along a user's own history.

A user may own a large share of all rows, so the transactions of such a user are never
windowed over as a whole. Their time is cut into narrow slices, and the rows are shuffled by
(user, slice); every other user is one slice. Which users are cut comes from
``large_users``, or all are cut; the results are the same. What a slice needs from the rest
of the history is one row of a summary per (user, slice), built from a partially aggregated
pass and joined on the key by which the rows are shuffled already:

* velocity: a transaction counts +1 when it happens and -1 when it leaves the window. The
  total at any time is the net of all earlier slices (from the summary) plus a running
  total inside the slice. That is one pass however many rows a window holds; no frame is
  kept in memory. Amounts are summed as decimals, so adding and taking off cancel exactly.
* previous transaction: the one before in the slice, else the last of the slices before.
* mean and deviation: combined from the moments of all slices of the user.

The windows over slices see one row per slice, a number bounded by time and not by rows.
Rows without a user share one history. Rows without a time see each other only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.scoring import amount_flags
from riskweave.settings import DEFAULTS, NO_PREVIOUS_SECONDS

_KEYS = ["_user", "_slice"]
# Users with more rows than this are cut into slices of time.
LARGE_USER_ROWS = 100_000
# At most so many users are: their ids are sent to every task.
MOST_LARGE_USERS = 100_000


def large_users(rows: DataFrame, more_than: int | None = None) -> DataFrame:
    """Ids of the users whose history does not belong into one task. Copies may count:
    the ids decide about the plan only.

    At most one id per ``more_than`` rows. By default that is LARGE_USER_ROWS, or more where
    the table is so long that there could be more than MOST_LARGE_USERS such ids, so what is
    broadcast has a bound that does not grow with the table.
    """
    if more_than is None:
        more_than = max(LARGE_USER_ROWS, rows.count() // MOST_LARGE_USERS)
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).filter(
        F.col("_n") > more_than).select("user_id")

NO_TIME = -(1 << 62)


def _slice_start(second: Column, width: int) -> Column:
    return second - F.pmod(second, F.lit(width))


def _marks(df: DataFrame, window_seconds: int | None, width: int,
           large: DataFrame | None) -> DataFrame:
    """Every row in its slice; with a window also a slim row (-1) where it leaves."""
    second = F.unix_timestamp("event_timestamp")
    columns = df.columns
    if large is None:
        df = df.withColumn("_cut", F.lit(True))
    else:
        # Bounded by its definition, see ``large_users``.
        ids = F.broadcast(large.select(F.col("user_id").alias("_large")))
        df = df.join(ids, F.col("user_id").eqNullSafe(F.col("_large")), "left").withColumn(
            "_cut", F.col("_large").isNotNull())

    def mark(at: Column, step: int, real: bool) -> Column:
        start = F.when(F.col("_cut"), _slice_start(at, width)).otherwise(F.lit(0))
        return F.struct(
            F.when(at.isNull(), F.lit(NO_TIME)).otherwise(start).alias("slice"),
            at.alias("at"),
            F.lit(step).alias("step"), F.lit(real).alias("real"),
        )

    here = mark(second, 1, True)
    if window_seconds is None:
        marks = F.array(here)
    else:
        gone = mark(second + window_seconds + 1, -1, False)
        marks = F.when(second.isNull(), F.array(here)).otherwise(F.array(here, gone))
    payload = [c for c in columns if c not in ("user_id", "amount")]
    # Plain equality on this key also brings rows without a user together.
    user = F.coalesce(F.concat(F.lit("u"), F.col("user_id").cast("string")), F.lit("-"))
    return df.withColumn("_m", F.explode(marks)).select(
        user.alias("_user"), "user_id", "amount", *[F.col(f"_m.{c}").alias(f"_{c}")
                               for c in ("slice", "at", "step", "real")],
        (F.col("amount").try_cast("decimal(24,6)") * F.col("_m.step")).alias("_money"),
        *[F.when(F.col("_m.real"), F.col(c)).alias(c) for c in payload],
    )


def _within_slices(marks: DataFrame) -> DataFrame:
    """Running values inside each slice; the three windows share one sort."""
    so_far = Window.partitionBy(*_KEYS).orderBy("_at")
    before = (
        Window.partitionBy(*_KEYS).orderBy("_at", "event_timestamp", "transaction_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return marks.withColumn(
        "_before", F.last("event_timestamp", ignorenulls=True).over(before)
    ).withColumns({
        "_count": F.sum("_step").over(so_far), "_amount": F.sum("_money").over(so_far),
    }).filter("_real")


def _slice_summary(marks: DataFrame) -> DataFrame:
    """One row per (user, slice): what came before it, and the user's overall moments."""
    amount = F.when(F.col("_real"), F.col("amount"))
    timed = F.col("_slice") != NO_TIME
    per_slice = marks.groupBy(*_KEYS).agg(
        F.count_if("_real").alias("_rows"),
        F.sum(F.when(timed, F.col("_step"))).alias("_net"),
        F.sum(F.when(timed, F.col("_money"))).alias("_net_money"),
        F.max("event_timestamp").alias("_last"),
        F.count(amount).alias("_n"), F.avg(amount).alias("_mean"),
        F.var_pop(amount).alias("_var"),
        F.min(amount).alias("_low"), F.max(amount).alias("_high"),
    )
    user = Window.partitionBy("_user")
    earlier = user.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    with_mean = per_slice.withColumns({
        "_open": F.sum("_net").over(earlier),
        "_open_money": F.sum("_net_money").over(earlier),
        "_carried": F.last("_last", ignorenulls=True).over(earlier),
        "_total": F.sum("_n").over(user),
        "_sum": F.sum(F.col("_n") * F.col("_mean")).over(user),
        # Equal amounts have no deviation; rounding of the means must not invent one.
        "_flat": F.min("_low").over(user) == F.max("_high").over(user),
    }).withColumn("avg_amount", F.col("_sum") / F.when(F.col("_total") > 0, F.col("_total")))
    from_mean = F.col("_var") + F.pow(F.col("_mean") - F.col("avg_amount"), 2)
    several = F.col("_total") > 1
    spread = F.sum(F.col("_n") * from_mean).over(user)
    # Slices in which transactions only leave have done their part by now.
    return with_mean.withColumn("_spread", spread).filter("_rows > 0").select(
        *_KEYS, "_open", "_open_money", "_carried", "avg_amount",
        F.when(several & F.col("_flat"), F.lit(0.0))
        .when(several, F.sqrt(F.col("_spread") / (F.col("_total") - 1)))
        .alias("stddev_amount"),
    )


def zscore() -> Column:
    """Deviation from the user's mean; zero where a deviation is not defined."""
    return F.when(
        F.col("stddev_amount") > 0,
        (F.col("amount") - F.col("avg_amount")) / F.col("stddev_amount"),
    ).otherwise(F.lit(0.0))


def history_features(df: DataFrame, window_seconds: int | None = 300,
                     slice_seconds: int = DEFAULTS.history_slice_seconds,
                     large: DataFrame | None = None) -> DataFrame:
    """All features of a user's history behind a single shuffle of the transactions.

    The rows are read twice, for the windows and for the summary, so ``df`` should be a
    stored table. ``large`` are the users to cut into slices, all if it is None.

    Columns a caller does not select cost nothing: the optimizer drops their windows and
    aggregates.
    """
    marks = _marks(df, window_seconds, slice_seconds, large)
    joined = _within_slices(marks).join(_slice_summary(marks), _KEYS, "left")
    gap = F.unix_timestamp("event_timestamp") - F.unix_timestamp("prev_timestamp")
    features = joined.withColumns({
        "velocity_count": F.col("_count") + F.coalesce("_open", F.lit(0)),
        "velocity_amount": (
            F.coalesce("_amount", F.lit(0)) + F.coalesce("_open_money", F.lit(0))
        ).cast("double"),
        "prev_timestamp": F.coalesce("_before", "_carried"),
        "amount_zscore": zscore(),
    }).withColumn(
        "time_since_last", F.coalesce(gap, F.lit(NO_PREVIOUS_SECONDS).cast("bigint"))
    )
    return amount_flags(features).select(
        *df.columns, "velocity_count", "velocity_amount", "prev_timestamp",
        "time_since_last", "avg_amount", "stddev_amount", "amount_zscore",
        "is_high_amount", "is_very_high_amount",
    )


def whole_histories(df: DataFrame, window_seconds: int) -> DataFrame:
    """velocity and time_since_last where no user is cut: a slice holds all of its user, so
    there is no summary to build and to join, and the rows are read once."""
    marks = _marks(df, window_seconds, 1, df.select("user_id").limit(0))
    gap = F.unix_timestamp("event_timestamp") - F.unix_timestamp("_before")
    return _within_slices(marks).select(
        *df.columns, F.col("_count").alias("velocity_count"),
        F.coalesce("_amount", F.lit(0)).cast("double").alias("velocity_amount"),
        F.col("_before").alias("prev_timestamp"),
        F.coalesce(gap, F.lit(NO_PREVIOUS_SECONDS).cast("bigint")).alias("time_since_last"),
    )


def velocity(df: DataFrame, window_seconds: int = 300,
             slice_seconds: int = DEFAULTS.history_slice_seconds,
             large: DataFrame | None = None) -> DataFrame:
    """Count and sum of the user's transactions in the last ``window_seconds`` (both
    ends included, whole seconds; transactions of the same second see each other)."""
    return history_features(df, window_seconds, slice_seconds, large).select(
        *df.columns, "velocity_count", "velocity_amount"
    )


def time_since_last(df: DataFrame,
                    slice_seconds: int = DEFAULTS.history_slice_seconds,
                    large: DataFrame | None = None) -> DataFrame:
    """Previous event of the same user and the whole seconds since."""
    return history_features(df, None, slice_seconds, large).select(
        *df.columns, "prev_timestamp", "time_since_last"
    )


def amount_zscore(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """Z-score against given profiles. The join is left to the planner: a small profile
    table is broadcast by its size, hot users are split by the adaptive skew join."""
    stats = profiles.select("user_id", "avg_amount", "stddev_amount")
    return df.join(stats, "user_id", "left").withColumn("amount_zscore", zscore())
