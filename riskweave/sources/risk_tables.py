"""Risk lookup tables: built-in constants or JSON files kept by the operators.

A file can be published as a version that holds from a point in time on. Both layers choose
the version by a transaction's event time, so a rerun or replay of old rows gives the risks of
their time, and an update changes later rows only. The stream reads the versions anew for every
micro-batch.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.settings import CATEGORY_RISK, COUNTRY_RISK
from riskweave.times import moment

RISK_FILE = T.StructType([
    T.StructField("country_risk", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("merchant_risk", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("blacklist", T.ArrayType(T.StringType())),
])


# One row per name and version; ``kind`` is country or merchant_category.
VERSIONS = "kind string, name string, risk double, valid_from timestamp"
KINDS = {"country": "country_risk", "merchant_category": "merchant_risk"}


def constant_table(spark: SparkSession, values: dict[str, float], key: str,
                   value: str) -> DataFrame:
    """A literal relation: known size, no job to build it."""
    args: dict[str, object] = {}
    rows = []
    for i, (name, risk) in enumerate(values.items()):
        args[f"k{i}"], args[f"v{i}"] = name, float(risk)
        rows.append(f"(:k{i}, :v{i})")
    return spark.sql(
        f"SELECT * FROM VALUES {', '.join(rows)} AS t({key}, {value})", args=args
    )


def constant_keys(spark: SparkSession, keys, name: str) -> DataFrame:
    args = {f"k{i}": k for i, k in enumerate(keys)}
    rows = ", ".join(f"(:{k})" for k in args)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({name})", args=args)


def read_risk_file(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Three tables out of one multi-line JSON document."""
    doc = spark.read.schema(RISK_FILE).option("multiLine", True).json(path)
    return {
        "country": doc.select(F.explode("country_risk").alias("country", "country_risk")),
        "merchant_category": doc.select(
            F.explode("merchant_risk").alias("merchant_category", "merchant_risk")
        ),
        "blacklist": doc.select(F.explode("blacklist").alias("merchant_id")),
    }


def built_in(spark: SparkSession) -> DataFrame:
    """The constants as the version that holds before any other."""
    always = moment(datetime(1, 1, 1)).alias("valid_from")
    parts = [constant_table(spark, values, "name", "risk").select(
        F.lit(kind).alias("kind"), "name", "risk", always)
        for kind, values in (("country", COUNTRY_RISK), ("merchant_category", CATEGORY_RISK))]
    return parts[0].unionByName(parts[1])


def publish_version(spark: SparkSession, root: str, path: str, valid_from: datetime) -> None:
    """Make a risk file hold from a time on. It replaces the earlier version as a whole, so a
    name that it lacks is unknown from then on. One append of one file: readers see all of a
    version or nothing."""
    tables = read_risk_file(spark, path)
    parts = [tables[kind].select(F.lit(kind).alias("kind"), F.col(kind).alias("name"),
                                 F.col(value).alias("risk"), moment(valid_from).alias(
                                     "valid_from")) for kind, value in KINDS.items()]
    parts[0].unionByName(parts[1]).coalesce(1).write.mode("append").parquet(
        f"{root}/risk_versions")


def read_versions(spark: SparkSession, root: str | None) -> DataFrame:
    """kind, name, risk, valid_from, valid_to (null: still valid). The newest files are listed
    with every call. Of a version that was published twice the last file does not win over
    the first: equal names must agree."""
    rows = built_in(spark)
    try:
        if root is not None:
            rows = rows.unionByName(spark.read.schema(VERSIONS).parquet(f"{root}/risk_versions"))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    # One row per version: the window sees a handful of rows.
    starts = rows.select("valid_from").distinct().withColumn(
        "valid_to", F.lead("valid_from").over(Window.orderBy("valid_from")))
    return rows.groupBy("kind", "name", "valid_from").agg(F.max("risk").alias("risk")).join(
        starts, "valid_from").select("kind", "name", "risk", "valid_from", "valid_to")
