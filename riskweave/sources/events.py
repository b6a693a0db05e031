"""Transactions derived from the ``events`` table.

The projection needs no join: category and country names are picked from constant
arrays by position, and an extra copy of a row is an ``explode`` of a one- or
two-element array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.schema import EVENTS
from riskweave.session import prepare
from riskweave.settings import CATEGORY_RISK, COUNTRY_RISK

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str, max_files: int = 1) -> DataFrame:
    """The same table as an unbounded source, one file per trigger."""
    return (
        prepare(spark).readStream.schema(EVENTS)
        .option("maxFilesPerTrigger", max_files)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )


def _pick(names: list[str | None], position: Column) -> Column:
    return F.get(F.array(*[F.lit(n).cast("string") for n in names]), position.cast("int"))


def to_transactions(events: DataFrame) -> DataFrame:
    """One row per event and per extra copy, with both times as timestamps."""
    eid, uid = F.col("event_id"), F.col("user_id")
    # A copy arrives 400 s after its original; see the table of shares in FIXTURES.md.
    copies = F.when(eid % 100 == 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = events.withColumn("copy", F.explode(copies))

    fraud = eid % 20 == 3
    country = _pick([*COUNTRY_RISK, "ZZ", None], (eid * 7 + uid) % 29)
    category = _pick([*CATEGORY_RISK, "florist", None], (eid * 5 + uid * 3) % 20)
    fraud_country = _pick(["NG", "UA", "UNKNOWN"], eid % 3)
    step = (eid - 3) % 80
    fraud_category = (
        F.when(step == 0, "crypto").when(step == 20, "gambling")
        .when(step == 40, "jewelry").otherwise("wire_transfer")
    )
    delay = (
        F.when(F.col("copy") == 1, F.lit(400))
        .when(eid % 50 == 1, 60 + eid % 241)
        .otherwise(eid % 3)
    )
    event_ts = F.col("ts").cast("timestamp")
    return rows.select(
        F.concat(F.lit("TXN-"), F.lpad(eid.cast("string"), 8, "0")).alias("transaction_id"),
        F.concat(F.lit("USER_"), F.lpad(uid.cast("string"), 5, "0")).alias("user_id"),
        F.when(fraud, F.least(1000 + F.round(F.col("value") * 90, 2), F.lit(10000.0)))
        .otherwise(F.least(F.round(F.col("value") * 8, 2), F.lit(2000.0))).alias("amount"),
        F.lit("USD").alias("currency"),
        F.concat(
            F.lit("MERCHANT_"),
            F.when(eid % 100 == 3, "999")
            .otherwise(F.lpad(((eid * 13) % 100).cast("string"), 3, "0")),
        ).alias("merchant_id"),
        F.when(fraud, fraud_category).otherwise(category).alias("merchant_category"),
        F.when(fraud, fraud_country).otherwise(country).alias("country"),
        _pick(["visa", "mastercard", "amex"], eid % 3).alias("card_type"),
        F.when(eid % 97 == 0, F.lit(None).cast("boolean"))
        .when(fraud, eid % 200 != 3)
        .otherwise(F.col("event_type").isin("click", "view")).alias("is_online"),
        F.hour(event_ts).alias("hour_of_day"),
        F.when(F.col("copy") == 1, "duplicate").when(fraud, "fraud")
        .when(eid % 50 == 1, "late").otherwise("normal").alias("_label"),
        event_ts.alias("event_timestamp"),
        (event_ts + F.make_dt_interval(secs=delay)).alias("processing_timestamp"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_transactions(read_events(spark, sf_dir))


def to_messages(txns: DataFrame) -> DataFrame:
    """Wire shape of the declared schema: both times as ISO strings in UTC."""
    return txns.select(
        *[c for c in txns.columns if c not in ("event_timestamp", "processing_timestamp")],
        F.date_format("processing_timestamp", ISO).alias("timestamp"),
        F.date_format("event_timestamp", ISO).alias("event_time"),
    )
