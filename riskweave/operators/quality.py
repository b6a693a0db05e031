"""Parsing, validation and lateness of incoming messages; usable on batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.schema import OPTIONAL_DEFAULTS, REQUIRED_FIELDS, TRANSACTION

CORRUPT = "_corrupt_record"
# Seconds after which an event counts as late and as too late.
LATE_AFTER = 30
TOO_LATE_AFTER = 300


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def parse_messages(raw: DataFrame, schema: T.StructType = TRANSACTION,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """``value`` (bytes or text) to typed columns, beside the columns to ``keep``.

    The raw text is kept in ``raw_value``; ``_corrupt_record`` is set where the text is
    no JSON or a field has the wrong type. Times that do not parse become null.
    """
    target = T.StructType(
        [*_nullable(schema).fields, T.StructField(CORRUPT, T.StringType(), True)]
    )
    parsed = F.from_json("raw_value", target,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # ``inline`` of a one-element array keeps filters above the parse; pushed below it,
    # every condition would parse the text again.
    return add_times(
        raw.select(F.col("value").cast("string").alias("raw_value"), *keep)
        .select("raw_value", *keep, F.inline(F.array(parsed)))
    )


def add_times(messages: DataFrame) -> DataFrame:
    return messages.withColumns({
        "event_timestamp": F.try_to_timestamp("event_time"),
        "processing_timestamp": F.try_to_timestamp("timestamp"),
    })


def validate(parsed: DataFrame) -> DataFrame:
    """Add ``valid`` and ``reason`` (the first check that fails)."""
    reason = F.when(
        F.col(CORRUPT).isNotNull() | F.col("raw_value").isNull(), F.lit("malformed")
    )
    for name in REQUIRED_FIELDS:
        reason = reason.when(F.col(name).isNull(), F.lit(f"missing {name}"))
    reason = (
        reason
        .when(F.col("event_timestamp").isNull(), F.lit("bad event_time"))
        .when(F.col("processing_timestamp").isNull(), F.lit("bad timestamp"))
        .when(F.col("amount") <= 0, F.lit("amount not positive"))
    )
    return parsed.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())


def accepted(validated: DataFrame) -> DataFrame:
    """Valid messages as transactions."""
    return validated.filter("valid").drop("valid", "reason", "raw_value", CORRUPT)


def dead_letters(validated: DataFrame) -> DataFrame:
    """Rejected messages with their text and the reason."""
    return validated.filter(~F.col("valid")).select("raw_value", "reason")


def fill_optional(df: DataFrame) -> DataFrame:
    """Defaults for optional text fields, for analytics that need a value."""
    return df.fillna({k: v for k, v in OPTIONAL_DEFAULTS.items() if k in df.columns})


def quality_report(validated: DataFrame) -> DataFrame:
    return validated.groupBy(F.coalesce("reason", F.lit("valid")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages")
    )


def delay_seconds() -> Column:
    return F.unix_timestamp("processing_timestamp") - F.unix_timestamp("event_timestamp")


def lateness(df: DataFrame) -> DataFrame:
    """Class of each row by the seconds between event and arrival."""
    d = F.col("delay_seconds")
    return df.withColumn("delay_seconds", delay_seconds()).withColumn(
        "lateness",
        F.when(d <= LATE_AFTER, "on_time").when(d <= TOO_LATE_AFTER, "late")
        .otherwise("too_late"),
    )


def lateness_split(df: DataFrame) -> DataFrame:
    return lateness(df).groupBy("lateness").agg(
        F.count(F.lit(1)).alias("n"), F.max("delay_seconds").alias("max_delay")
    )
