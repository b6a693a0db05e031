"""Declared schemas; nothing in this package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the incoming messages.
TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("amount", T.DoubleType(), False),
    T.StructField("currency", T.StringType(), True),
    T.StructField("merchant_id", T.StringType(), False),
    T.StructField("merchant_category", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("card_type", T.StringType(), True),
    T.StructField("is_online", T.BooleanType(), True),
    T.StructField("timestamp", T.StringType(), False),
    T.StructField("event_time", T.StringType(), False),
    T.StructField("hour_of_day", T.IntegerType(), True),
    T.StructField("_label", T.StringType(), True),
])

COMPACT_TRANSACTION = T.StructType(
    [T.StructField(f.name, f.dataType, True) for f in TRANSACTION
     if f.name not in ("event_time", "_label")]
    + [T.StructField("is_fraud", T.BooleanType(), True)]
)

REQUIRED_FIELDS = tuple(f.name for f in TRANSACTION if not f.nullable)

# Types of the optional fields that get a default when a message lacks them.
OPTIONAL_DEFAULTS = {"currency": "USD", "country": "UNKNOWN", "merchant_category": "unknown"}

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# Column lists of the published views (fixed values).
FRAUD_RESULT_COLUMNS = (
    "transaction_id", "user_id", "amount", "country", "merchant_category",
    "fraud_score", "is_fraud_predicted", "event_timestamp", "country_risk",
    "merchant_risk", "velocity_count", "amount_zscore",
)
ALERT_COLUMNS = (
    "transaction_id", "user_id", "amount", "country", "merchant_category",
    "fraud_score", "is_fraud_predicted", "processing_time",
)
