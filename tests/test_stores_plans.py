from __future__ import annotations

import json
import subprocess
import sys
from dataclasses import replace
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from riskweave.functions import scoring
from riskweave.operators import dedup, history, model, profiles
from riskweave.plans import batch, serve, stream
from riskweave.session import work_path, work_root
from riskweave.settings import DEFAULTS, Settings
from riskweave.sources import events, risk_tables, stores
from riskweave.streaming import speed

AT = datetime(2024, 1, 31)


@pytest.fixture(scope="module")
def landing(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing") / "transactions")
    stores.land(events.to_messages(events.transactions(spark, sf_dir)), root)
    return root


def test_date_filters_prune_folders(spark, landing):
    day = stores.read_landing(spark, landing).filter("year = 2024 AND month = 1 AND day = 5")
    assert day.count() > 0
    plan = plan_of(day)
    assert "PartitionFilters: [isnotnull(year" in plan and "(day#" in plan


def test_compact_schema_reads_the_same_files(spark, landing):
    rows = stores.read_compact(spark, landing)
    assert "event_time" not in rows.columns and "is_fraud" in rows.columns
    assert rows.filter("is_fraud IS NOT NULL").isEmpty()
    assert rows.count() == stores.read_master(spark, landing).count()


def test_alert_readers_open_alert_files_only(spark, make_txns, tmp_path):
    path = str(tmp_path / "flagged")
    stores.write_by_flag(scoring.score(make_txns([
        {"amount": a, "country": "NG", "merchant_category": "crypto", "is_online": True}
        for a in (1.0, 9000.0)]), "sql", absent=("is_fraud",)), path)
    alerts = stores.read_by_flag(spark, path).filter("is_fraud_predicted")
    assert alerts.count() == 1
    plan = plan_of(alerts)
    assert "PartitionFilters: [isnotnull(is_fraud_predicted" in plan


def test_user_filter_and_columns_reach_the_scan(spark, make_txns, tmp_path):
    path = str(tmp_path / "rows")
    make_txns([{}, {}]).write.parquet(path)
    plan = plan_of(spark.read.parquet(path).filter("user_id = 'U'").select("amount"))
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,U)]" in plan
    assert "ReadSchema: struct<user_id:string,amount:double>" in plan


@pytest.fixture(scope="module")
def batch_run(spark, landing, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("views"))
    return batch.run(spark, stores.read_master(spark, landing), root, AT)


def test_batch_run_publishes_all_views(spark, batch_run):
    for view in ("fraud_results", "user_profiles", "daily_stats", "country_stats",
                 "batch_views", "calendar_stats"):
        assert not stores.read_view(spark, batch_run.root, view).isEmpty()
    assert batch_run.summary["total"] == 1000
    assert stores.read_view(spark, batch_run.root, "fraud_results").count() == 1000
    assert stores.last_batch_timestamp(spark, batch_run.root) == AT
    assert batch_run.auc > 0.9


def test_rerun_gives_the_same_views(spark, landing, batch_run):
    again = batch.run(spark, stores.read_master(spark, landing), batch_run.root,
                      datetime(2024, 2, 1), train_model=False)
    assert again.summary == batch_run.summary
    for view in ("fraud_results", "country_stats"):
        old = spark.read.parquet(batch_run.paths[view]).drop("batch_timestamp")
        new = stores.read_view(spark, batch_run.root, view).drop("batch_timestamp")
        rounding = [F.round(c, 9).alias(c) if t == "double" else F.col(c)
                    for c, t in old.dtypes]
        assert new.select(*rounding).exceptAll(old.select(*rounding)).isEmpty()


def test_an_unfinished_run_stays_invisible(spark, tmp_path, make_txns):
    root = str(tmp_path)
    stores.publish(make_txns([{}]), root, "v", "1")
    stores.put_metadata(spark, root, {"current_run": "1"}, datetime(2024, 1, 1))
    stores.publish(make_txns([{}, {}]), root, "v", "2")
    assert stores.read_view(spark, root, "v").count() == 1
    stores.put_metadata(spark, root, {"current_run": "2"}, datetime(2024, 1, 2))
    assert stores.read_view(spark, root, "v").count() == 2
    assert stores.get_metadata(spark, root, "absent") is None


def test_api_over_both_layers(spark, landing, batch_run, tmp_path):
    root = str(tmp_path / "live")
    records = spark.readStream.option("recursiveFileLookup", True).option(
        "maxFilesPerTrigger", 8).text(landing)
    stream.start(records, root, f"{root}/checkpoint", available_now=True).awaitTermination()
    api = serve.create_api(spark, batch_run.root, root, clock=lambda: datetime(2024, 1, 31))
    assert api["get_user_profile"]("USER_00007").count() == 1
    assert api["get_user_profile"]("nobody").isEmpty()
    sizes = {r["view"]: r["rows"] for r in api["get_layer_stats"]().collect()}
    assert sizes["realtime_views"] == 1000 and sizes["fraud_alerts"] > 0
    assert set(api["get_live_dashboard_data"]()) == {
        "stats", "fraud_by_country", "high_risk_users", "recent_alerts"}
    alerts = api["get_fraud_alerts"](start_time=datetime(2024, 1, 1), limit=7).collect()
    assert len(alerts) == 7 and {r["source"] for r in alerts} == {"batch"}
    assert api["get_user_fraud_history"]("USER_00007").count() <= 50
    assert not api["get_transactions_by_country"]().isEmpty()
    assert not api["get_fraud_rate_over_time"]().isEmpty()

    gone = serve.purge_realtime(spark, root, datetime(2100, 1, 1), hours=0)
    assert gone > 0 and serve.realtime_view(spark, root).count() == 1000 - gone
    assert serve.purge_realtime(spark, root, datetime(2100, 1, 2), hours=24) == 0


def test_hot_user_is_split_by_the_skew_join(spark, tmp_path):
    """Half of all rows belong to one user; the adaptive plan must split its partition."""
    facts = spark.range(400_000).selectExpr(
        "id AS transaction_id", "if(id % 2 = 0, 'HOT', concat('U', id % 5000)) AS user_id",
        "cast(id % 97 AS double) AS amount", "repeat('x', 40) AS payload")
    stats = profiles.user_features(facts.selectExpr(
        "*", "'US' AS country", "'M' AS merchant_id", "true AS is_online"))
    path = str(tmp_path / "stats")
    stats.write.parquet(path)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = history.amount_zscore(facts.repartition(8), spark.read.parquet(path))
        total = out.agg(F.count("payload"), F.count("amount_zscore"))
        assert tuple(total.collect()[0]) == (400_000, 400_000)
        assert "skew=true" in plan_of(total)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_risk_file(spark, tmp_path):
    path = tmp_path / "risk.json"
    path.write_text(json.dumps({
        "country_risk": {"US": 0.2, "XX": 1.0}, "merchant_risk": {"grocery": 0.3},
        "blacklist": ["M1"]}, indent=1))
    tables = risk_tables.read_risk_file(spark, str(path))
    assert {tuple(r) for r in tables["country"].collect()} == {("US", 0.2), ("XX", 1.0)}
    assert tables["merchant_category"].first()["merchant_risk"] == 0.3
    assert tables["blacklist"].first()["merchant_id"] == "M1"


def test_connector_options():
    s = Settings(kafka_bootstrap_servers="h:1", max_offsets_per_trigger=5)
    source = stores.kafka_source_options(s, "earliest")
    assert source["subscribe"] == "transactions" and source["maxOffsetsPerTrigger"] == "5"
    assert source["startingOffsets"] == "earliest" and source["failOnDataLoss"] == "true"
    assert stores.kafka_sink_options(s, "fraud-alerts")["topic"] == "fraud-alerts"
    assert stores.kafka_sink_options(s)["kafka.acks"] == "all"
    assert stores.mongodb_options("c")["collection"] == "c"


def test_settings_from_the_environment(monkeypatch):
    monkeypatch.setenv("FRAUD_THRESHOLD", "0.8")
    monkeypatch.setenv("MAX_ITER", "7")
    s = Settings.from_env()
    assert (s.fraud_threshold, s.max_iter) == (0.8, 7)
    assert 0 <= DEFAULTS.fraud_threshold <= 1


def test_work_folder_is_the_shared_one(spark):
    assert work_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "x") != work_path(spark, "x")


def test_training_needs_rows_and_labels(spark, sf_dir):
    few = batch.scored(dedup.first_arrivals(events.transactions(spark, sf_dir)).limit(50))
    assert model.train(few) is None


def test_split_does_not_depend_on_the_layout(spark):
    ids = spark.range(1000).selectExpr("cast(id AS string) AS transaction_id")
    part = ids.filter(model.in_train_part(0.8))
    again = ids.repartition(7).filter(model.in_train_part(0.8))
    assert part.exceptAll(again).isEmpty() and 750 < part.count() < 850


def test_model_round_trip_and_imputation(spark, batch_run):
    fitted = model.load(batch_run.paths["model"])
    assert model.newest(spark, batch_run.root) == batch_run.paths["model"]
    gaps = spark.createDataFrame(
        [(None,) * 6], ", ".join(f"{c} double" for c in model.HISTORY_FEATURES))
    row = model.predict(fitted, gaps).first()
    assert 0 <= row["fraud_probability"] <= 1


def test_rules_score_alone_without_a_model(make_txns):
    out = model.predict_or_rules(make_txns([{}]), None)
    assert "fraud_score" in out.columns and "fraud_probability" not in out.columns


LIVE_COLUMNS = {"amount": "double", "fraud_score": "double", "is_fraud_predicted": "boolean",
                "event_timestamp": "timestamp", "processing_time": "timestamp",
                "country_risk": "double", "merchant_risk": "double", "hour_of_day": "int"}


def live_rows(spark, n, at="2024-01-31 00:00:00"):
    return spark.range(n).select(*[
        F.lit(at).cast("timestamp").alias(c) if c == "processing_time"
        else F.lit(None).cast(LIVE_COLUMNS.get(c, "string")).alias(c)
        for c in serve.REALTIME_COLUMNS])


def test_purging_neither_loses_nor_repeats_batches(spark, tmp_path):
    root, now = str(tmp_path), datetime(2024, 1, 31)
    live_rows(spark, 0).write.parquet(f"{root}/realtime_views/batch_id=0")
    assert serve.purge_realtime(spark, root, now) == 0
    assert serve.realtime_view(spark, root).count() == 0
    for batch_id, n in ((1, 10), (2, 7)):
        live_rows(spark, n).write.parquet(f"{root}/realtime_views/batch_id={batch_id}")
    live_rows(spark, 4, "2024-01-01 00:00:00").write.parquet(f"{root}/realtime_views/batch_id=3")
    live_rows(spark, 1).write.parquet(f"{root}/realtime_views/batch_id=4")
    assert serve.purge_realtime(spark, root, now) == 4
    # The newest batch was still being written.
    live_rows(spark, 5).write.mode("append").parquet(f"{root}/realtime_views/batch_id=4")
    assert serve.realtime_view(spark, root).count() == 10 + 7 + 6
    assert serve.purge_realtime(spark, root, now) == 0


def test_values_of_one_run_are_read_together(spark, tmp_path):
    root = str(tmp_path)
    assert stores.metadata(spark, root) == {}
    stores.put_metadata(spark, root, {"current_run": "1", "x": "a"}, datetime(2024, 1, 1))
    stores.put_metadata(spark, root, {"current_run": "2", "x": "b"}, datetime(2024, 1, 2))
    assert stores.metadata(spark, root) == {"current_run": "2", "x": "b"}


def test_batch_answers_only_for_what_it_has_seen_completely(spark, batch_run):
    known = stores.metadata(spark, batch_run.root)
    newest = stores.read_view(spark, batch_run.root, "transactions").agg(
        F.max("event_timestamp").cast("string")).first()[0]
    assert stores.time_of(known, "complete_until") == datetime.fromisoformat(
        newest) - timedelta(seconds=300)


def test_moments_do_not_depend_on_the_zone_of_the_driver(spark):
    """Names the same instant in a driver far from UTC."""
    code = ("import os, sys, time; os.environ['TZ'] = 'America/New_York'; time.tzset();"
            "from datetime import datetime; from riskweave.session import build_session;"
            "from riskweave.times import moment;"
            "s = build_session('zone', 'local[1]', {'spark.ui.enabled': 'false'});"
            "print('AT', s.range(1).select(moment(datetime(2024, 1, 31)).cast('string'))"
            ".first()[0])")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                         cwd=Path(__file__).resolve().parents[1], timeout=120)
    assert "AT 2024-01-31 00:00:00" in out.stdout, out.stderr[-500:]


@pytest.mark.parametrize("change", [{"fraud_threshold": 0.1}, {"high_amount": 1.0}])
def test_settings_act_on_the_stream_rules(make_txns, change):
    df = make_txns([{"amount": 900.0, "country": "NG", "is_online": True}]).withColumn(
        "processing_time", F.col("processing_timestamp"))

    def score(s):
        row = speed.score_stream(df, s=s).first()
        return row["fraud_score"], row["is_fraud_predicted"]

    assert score(replace(DEFAULTS, **change)) != score(DEFAULTS)


def test_the_stream_applies_the_model_of_the_batch_run(spark, landing, batch_run, tmp_path):
    root = str(tmp_path / "modelled")
    path = model.newest(spark, batch.stream_models(batch_run.root))
    assert path == batch_run.paths["stream_model"]
    records = spark.readStream.option("recursiveFileLookup", True).text(landing)
    stream.start(records, root, f"{root}/checkpoint", model.load(path),
                 available_now=True).awaitTermination()
    rows = spark.read.parquet(f"{root}/realtime_views")
    assert rows.filter("fraud_probability IS NULL").isEmpty()
    assert rows.select("prediction").distinct().count() == 2
