"""Trained scoring: logistic regression on scaled features as one MLlib pipeline."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.functions.scoring import Profile, score
from riskweave.settings import DEFAULTS, Settings
from riskweave.sources.stores import append_row
from riskweave.times import moment

# The two feature lists of the model.
HISTORY_FEATURES = (
    "amount", "country_risk", "merchant_risk", "velocity_count", "velocity_amount",
    "hour_of_day",
)
ONLINE_FEATURES = (
    "amount", "country_risk", "merchant_risk", "is_online", "hour_of_day",
    "velocity_count",
)
# What the speed layer knows of a single transaction: no history.
STREAM_FEATURES = ("amount", "country_risk", "merchant_risk", "is_online", "hour_of_day")


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    auc: float


def training_set(scored: DataFrame) -> DataFrame:
    """Rows with a clear label; late and duplicate arrivals carry none."""
    return scored.filter(F.col("_label").isin("normal", "fraud")).withColumn(
        "label", F.when(F.col("_label") == "fraud", F.lit(1.0)).otherwise(F.lit(0.0))
    )


def in_train_part(share: float, key: str = "transaction_id") -> Column:
    """Split by a hash of the id: the same rows on every run and every layout."""
    bucket = F.conv(F.substring(F.md5(F.col(key)), 1, 8), 16, 10).cast("bigint") % 100
    return bucket < F.lit(int(round(share * 100)))


def _stages(features: tuple[str, ...], s: Settings) -> list:
    # Missing values are filled inside the fitted pipeline, so that later batches and
    # streams are treated like the training rows.
    filled = ", ".join(f"coalesce(cast({c} AS double), 0D) AS f_{c}" for c in features)
    return [
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"f_{c}" for c in features], outputCol="features_raw"),
        StandardScaler(inputCol="features_raw", outputCol="features_scaled",
                       withMean=True, withStd=True),
        LogisticRegression(featuresCol="features_scaled", labelCol="label",
                           maxIter=s.max_iter, regParam=s.reg_param),
    ]


def train(scored: DataFrame, features: tuple[str, ...] = HISTORY_FEATURES,
          s: Settings = DEFAULTS) -> Trained | None:
    """Fit and evaluate; None when there are too few labelled rows."""
    columns = sorted({*features, "transaction_id", "_label"})
    rows = training_set(scored.select(*columns))
    if rows.limit(s.min_training_rows).count() < s.min_training_rows:
        return None
    chosen = in_train_part(s.train_share)
    model = Pipeline(stages=_stages(features, s)).fit(rows.filter(chosen))
    return Trained(model, evaluate(model, rows.filter(~chosen)))


def evaluate(model: PipelineModel, labelled: DataFrame) -> float:
    return BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderROC"
    ).evaluate(model.transform(labelled))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Works on batches and streams; the probability of fraud becomes a plain column."""
    out = model.transform(df).withColumn(
        "fraud_probability", vector_to_array("probability")[1]
    )
    return out.select(*df.columns, "fraud_probability", "prediction")


def predict_or_rules(df: DataFrame, model: PipelineModel | None,
                     rules: Profile | str = "stream", absent: tuple[str, ...] = ()
                     ) -> DataFrame:
    """Rule scores always; the model's view beside them once there is a model."""
    scored = score(df, rules, absent=absent)
    return scored if model is None else predict(model, scored)


def save(model: PipelineModel, root: str, at: datetime) -> str:
    path = f"{root}/model_{at:%Y%m%d_%H%M%S}"
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def register(spark: SparkSession, root: str, path: str, at: datetime, auc: float) -> None:
    """Append a row to the model registry."""
    append_row(spark, f"{root}/ml_models", {
        "path": path, "trained_at": moment(at), "auc": float(auc)})


def newest(spark: SparkSession, root: str) -> str | None:
    rows = spark.read.parquet(f"{root}/ml_models")
    return rows.agg(F.max_by("path", "trained_at")).first()[0]


def standings(spark: SparkSession, root: str, tolerance: float = 0.01) -> DataFrame:
    """The registry with what each model was when it was registered: the champion of its time
    (``won``) or a challenger that did not get there.

    A model wins if its held-out area under the curve is at most ``tolerance`` below that of
    the best one before it: a newer model has seen newer rows, so a draw goes to it, but many
    small losses do not add up, as the best ever is the mark.
    """
    # One row per training run.
    before = Window.orderBy("trained_at", "path").rowsBetween(Window.unboundedPreceding, -1)
    rows = spark.read.parquet(f"{root}/ml_models").withColumn(
        "mark", F.max(F.when(~F.isnan("auc"), F.col("auc"))).over(before))
    return rows.withColumn("won", ~F.isnan("auc") & (
        F.col("mark").isNull() | (F.col("auc") >= F.col("mark") - tolerance)))


def champion(spark: SparkSession, root: str, tolerance: float = 0.01) -> str | None:
    """Path of the model to serve: the newest that has won. None without a registered one."""
    try:
        rows = standings(spark, root, tolerance)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.where("won").agg(F.max_by("path", F.struct("trained_at", "path"))).first()[0]
