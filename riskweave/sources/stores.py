"""Published views, landing files and connector options.

A view version is written to its own ``run_id`` folder; a run becomes visible by one
append to the metadata table. Readers resolve the newest committed run first, so they see
either the old or the new version and a failed run leaves nothing visible.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators.metrics import latest_value
from riskweave.operators.quality import add_times
from riskweave.schema import COMPACT_TRANSACTION, TRANSACTION
from riskweave.settings import DEFAULTS, Settings
from riskweave.times import moment

METADATA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
])


def publish(df: DataFrame, root: str, view: str, run_id: str,
            partition_by: list[str] | None = None) -> str:
    path = f"{root}/{view}/run_id={run_id}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def append_row(spark: SparkSession, path: str, values: dict[str, object]) -> None:
    """Append one small record; built from literals, so no data leaves the driver's plan."""
    row = spark.range(1, numPartitions=1).select(
        *[F.lit(v).alias(name) for name, v in values.items()]
    )
    row.write.mode("append").parquet(path)


def put_metadata(spark: SparkSession, root: str, values: dict[str, str],
                 at: datetime) -> None:
    """Append all values of one run in a single commit."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in values.items()
    ]))
    rows = spark.range(1, numPartitions=1).select(pairs.alias("p")).select(
        "p.key", "p.value", moment(at).alias("updated_at")
    )
    rows.write.mode("append").parquet(f"{root}/system_metadata")


def read_metadata(spark: SparkSession, root: str) -> DataFrame:
    """Newest value per key."""
    return latest_value(spark.read.schema(METADATA).parquet(f"{root}/system_metadata"))


def metadata(spark: SparkSession, root: str) -> dict[str, str]:
    """All keys with their newest values, from one read: values that one run wrote together
    are seen together. Empty before the first run."""
    try:
        rows = read_metadata(spark, root).select("key", "value").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r["key"]: r["value"] for r in rows}


def get_metadata(spark: SparkSession, root: str, key: str) -> str | None:
    row = read_metadata(spark, root).filter(F.col("key") == key).first()
    return row["value"] if row else None


def time_of(known: dict[str, str], key: str) -> datetime | None:
    value = known.get(key)
    return datetime.fromisoformat(value) if value else None


def last_batch_timestamp(spark: SparkSession, root: str) -> datetime | None:
    return time_of(metadata(spark, root), "last_batch_timestamp")


def read_view(spark: SparkSession, root: str, view: str,
              known: dict[str, str] | None = None) -> DataFrame:
    """The version of a view that ``known`` (or the newest metadata) names."""
    run_id = (metadata(spark, root) if known is None else known).get("current_run")
    if run_id is None:
        raise LookupError(f"no committed run below {root}")
    return spark.read.parquet(f"{root}/{view}/run_id={run_id}")


def land(messages: DataFrame, root: str, mode: str = "append") -> None:
    """JSON lines below ``year=/month=/day=`` of the event time.

    The rebalance hint brings a day's rows together and lets adaptive execution split a
    day that is too large for one task, so files come out neither tiny nor huge.
    """
    (
        with_landing_date(messages).hint("rebalance", "year", "month", "day")
        .write.mode(mode).partitionBy("year", "month", "day").json(root)
    )


def with_landing_date(messages: DataFrame) -> DataFrame:
    t = F.try_to_timestamp("event_time")
    return messages.withColumns({
        "year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t),
    })


def read_landing(spark: SparkSession, root: str,
                 schema: T.StructType = TRANSACTION) -> DataFrame:
    """Messages below ``root``; the date folders become columns that filters prune on."""
    dates = [T.StructField(n, T.IntegerType()) for n in ("year", "month", "day")]
    return spark.read.schema(T.StructType([*schema.fields, *dates])).json(root)


def read_master(spark: SparkSession, root: str) -> DataFrame:
    """Full-schema messages with typed times."""
    return add_times(read_landing(spark, root))


def read_landed_text(spark: SparkSession, root: str) -> DataFrame:
    """Landed lines as records with a ``value``, so that faulty ones can be told apart."""
    return spark.read.option("recursiveFileLookup", True).text(root)


def read_landed_days(spark: SparkSession, root: str) -> DataFrame:
    """The same with year, month and day of the folders, so that filters on them leave
    folders out."""
    dates = [T.StructField(n, T.IntegerType()) for n in ("year", "month", "day")]
    return spark.read.schema(T.StructType(
        [T.StructField("value", T.StringType()), *dates])).text(root)


def read_compact(spark: SparkSession, root: str) -> DataFrame:
    return read_landing(spark, root, COMPACT_TRANSACTION)


def write_by_flag(scored: DataFrame, path: str) -> None:
    """Scored rows split by their flag, so that alert readers open alert files only."""
    scored.write.mode("overwrite").partitionBy("is_fraud_predicted").parquet(path)


def read_by_flag(spark: SparkSession, path: str) -> DataFrame:
    """The table of ``write_by_flag``. Folder names come back as text, so the flag's type
    is declared; a filter on it opens the matching folder only."""
    files = spark.read.parquet(path).schema
    schema = T.StructType([
        f if f.name != "is_fraud_predicted" else T.StructField(f.name, T.BooleanType())
        for f in files
    ])
    return spark.read.schema(schema).parquet(path)


def kafka_envelope(df: DataFrame) -> DataFrame:
    """Key and JSON value of the outgoing records, keyed by user."""
    return df.select(
        F.col("user_id").alias("key"), F.to_json(F.struct(*df.columns)).alias("value")
    )


def kafka_source_options(s: Settings = DEFAULTS, starting_offsets: str = "latest") -> dict:
    return {
        "kafka.bootstrap.servers": s.kafka_bootstrap_servers,
        "subscribe": s.kafka_topic_transactions,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(s.fail_on_data_loss).lower(),
        "maxOffsetsPerTrigger": str(s.max_offsets_per_trigger),
        # A prefix only: queries that shared one group could each get part of the records.
        "groupIdPrefix": s.kafka_consumer_group,
    }


def kafka_sink_options(s: Settings = DEFAULTS, topic: str | None = None) -> dict:
    return {
        "kafka.bootstrap.servers": s.kafka_bootstrap_servers,
        "topic": topic or s.kafka_topic_transactions,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.max.in.flight.requests.per.connection": "1",
    }


def mongodb_options(collection: str, s: Settings = DEFAULTS) -> dict:
    return {
        "connection.uri": s.mongodb_uri,
        "database": s.mongodb_database,
        "collection": collection,
    }


def write_mongodb(df: DataFrame, collection: str, s: Settings = DEFAULTS,
                  mode: str = "append") -> None:
    """Executors write straight to the store; needs its connector on the class path."""
    df.write.format("mongodb").options(**mongodb_options(collection, s)).mode(mode).save()


def publish_messages(df: DataFrame, s: Settings = DEFAULTS, topic: str | None = None) -> None:
    """Send rows to a topic; alerts go to their own topic by passing its name."""
    kafka_envelope(df).write.format("kafka").options(**kafka_sink_options(s, topic)).save()
