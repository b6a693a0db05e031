"""Lookups against small reference tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.settings import (
    BLACKLISTED_MERCHANTS, CATEGORY_RISK, COUNTRY_RISK,
)
from riskweave.sources.risk_tables import KINDS, constant_keys, constant_table


def lookup(df: DataFrame, table: DataFrame, key: str, value: str,
           default: float | Column) -> DataFrame:
    """Left join on ``key``; ``default`` where the table has no entry.

    Constant tables come in hinted, as their size is known; tables from files are left to
    the planner, which broadcasts them by their size.
    """
    default = F.lit(default) if isinstance(default, (int, float)) else default
    joined = df.join(table, key, "left")
    return joined.withColumn(value, F.coalesce(F.col(value), default))


def add_risk(df: DataFrame, country_table: DataFrame | None = None,
             category_table: DataFrame | None = None,
             unknown_country: float | Column = 0.9,
             unknown_category: float | Column = 0.5) -> DataFrame:
    """Add ``country_risk`` and ``merchant_risk``; works on batch and stream alike."""
    spark = df.sparkSession
    if country_table is None:
        country_table = country_risk(spark)
    if category_table is None:
        category_table = category_risk(spark)
    df = lookup(df, country_table, "country", "country_risk", unknown_country)
    return lookup(df, category_table, "merchant_category", "merchant_risk", unknown_category)


def add_risk_as_of(df: DataFrame, versions: DataFrame, unknown_country: float | Column = 0.9,
                   unknown_category: float | Column = 0.5,
                   at: str = "event_timestamp") -> DataFrame:
    """The same from versioned tables, by the version that holds at a row's event time. Rows
    without a time get the version that holds now."""
    columns = df.columns
    for (key, value), default in zip(KINDS.items(), (unknown_country, unknown_category)):
        table = versions.where(F.col("kind") == key).select(
            F.col("name").alias("_name"), F.col("risk").alias("_risk"), "valid_from", "valid_to")
        holds = F.when(F.col(at).isNull(), F.col("valid_to").isNull()).otherwise(
            (F.col("valid_from") <= F.col(at))
            & (F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to"))))
        default = F.lit(default) if isinstance(default, (int, float)) else default
        # At most one version holds, so a row stays one row.
        df = df.join(table, (F.col(key) == F.col("_name")) & holds, "left").select(
            *columns, *[v for v in KINDS.values() if v in df.columns and v not in columns],
            F.coalesce("_risk", default).alias(value))
    return df


def country_risk(spark: SparkSession, values: dict[str, float] = COUNTRY_RISK) -> DataFrame:
    return F.broadcast(constant_table(spark, values, "country", "country_risk"))


def category_risk(spark: SparkSession, values: dict[str, float] = CATEGORY_RISK) -> DataFrame:
    return F.broadcast(constant_table(spark, values, "merchant_category", "merchant_risk"))


def _blacklist(df: DataFrame) -> DataFrame:
    return F.broadcast(constant_keys(df.sparkSession, BLACKLISTED_MERCHANTS, "merchant_id"))


def blacklist_hits(df: DataFrame, table: DataFrame | None = None) -> DataFrame:
    return df.join(_blacklist(df) if table is None else table, "merchant_id", "left_semi")


def blacklist_clean(df: DataFrame, table: DataFrame | None = None) -> DataFrame:
    return df.join(_blacklist(df) if table is None else table, "merchant_id", "left_anti")


def flag_blacklisted(df: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """The same test as a column, for views that keep all rows."""
    listed = (_blacklist(df) if table is None else table).withColumn("_listed", F.lit(True))
    return (
        df.join(listed, "merchant_id", "left")
        .withColumn("is_blacklisted", F.coalesce("_listed", F.lit(False)))
        .drop("_listed")
    )
