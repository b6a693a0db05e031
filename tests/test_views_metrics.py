from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from riskweave.functions import scoring
from riskweave.operators import metrics, serving, views

AS_OF = datetime(1970, 1, 2)


@pytest.fixture()
def make_scored(make_txns):
    def make(rows):
        df = scoring.score(make_txns(rows), "stream")
        return df.withColumn("processing_time", F.col("processing_timestamp"))
    return make


def test_country_sums_equal_totals(make_scored):
    df = make_scored([{"country": c, "amount": a} for c in ("US", "NG", None)
                      for a in (1.0, 6000.0)])
    by = views.country_stats(df).agg(F.sum("total_transactions"), F.sum("fraud_count")).first()
    whole = views.run_summary(df).first()
    assert (by[0], by[1]) == (whole["total"], whole["fraud_count"])


def test_throughput_counts_at_least_one_second(make_scored):
    summary = views.run_summary(make_scored([{}] * 4))
    assert views.with_throughput(summary, 0.1).first()["records_per_second"] == 4.0
    assert views.with_throughput(summary, 2.0).first()["records_per_second"] == 2.0


def test_labels_stay_with_their_bucket(make_scored):
    df = make_scored([{"amount": a} for a in (50.0, 700.0, 5000.0, 100000.0)])
    got = {r["range"]: r["count"] for r in views.amount_buckets(df).collect()}
    assert got == {"$0-100": 1, "$500-1K": 1, "$5K-10K": 1, "Other": 1}


def test_empty_input_gives_empty_charts(make_scored):
    none = make_scored([{}]).filter("false")
    assert views.hourly_trend(none).isEmpty() and views.by_country(none, 8).isEmpty()
    summary = views.recent_stats(none, F.lit(AS_OF)).first()
    assert summary["total"] == 0 and summary["fraud_rate"] == 0.0


def test_recent_stats_filter_on_time(make_scored):
    df = make_scored([{"event_s": 86_400.0 - s, "amount": 9000.0, "country": "NG",
                       "merchant_category": "crypto"} for s in (10, 3600, 3601)])
    got = views.recent_stats(df, F.lit(AS_OF)).first()
    assert (got["recent_total"], got["total"]) == (2, 3)


def test_ties_at_the_cut_are_ordered(make_scored):
    df = make_scored([{"user_id": u} for u in "cabcabcab"])
    got = views.high_risk_users(df, 3, 2).collect()
    assert [r["user_id"] for r in got] == ["a", "b"]


def test_growth_uses_the_day_before(make_scored):
    df = make_scored([{"event_s": d * 86_400.0 + i} for d, n in ((0, 2), (1, 3))
                      for i in range(n)])
    first, second = views.period_growth(df).orderBy("day").collect()
    assert first["growth"] is None and second["growth"] == 50.0


def test_alert_display_of_missing_values(make_scored):
    df = make_scored([{"transaction_id": "T" * 13, "amount": None}]).withColumn(
        "is_fraud_predicted", F.lit(True))
    row = views.alert_display(df).first()
    assert row["transaction_id"] == "T" * 12 + "..." and row["amount"] == "N/A"


def test_histogram_is_cumulative(make_scored):
    df = make_scored([{"amount": a} for a in (0.5, 1.0, 3.0)])
    got = {r["le"]: r["cumulative"]
           for r in metrics.histogram(df, F.col("amount"), (1.0, 2.0)).collect()}
    assert got == {"1.0": 2, "2.0": 2, "+Inf": 3}


def test_quantiles_interpolate_inside_a_bucket(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.5, 1.6, 9.0)], "v double")
    got = metrics.histogram_quantiles(
        df, F.col("v"), {"p25": 0.25, "p50": 0.5, "p99": 0.99}, bounds=(1.0, 2.0)).first()
    assert got["p25"] == 1.0 and got["p50"] == pytest.approx(1.5) and got["p99"] == 2.0


def test_lag_from_a_progress_report():
    progress = {"durationMs": {"triggerExecution": 1500}, "sources": [
        {"endOffset": {"t": {"0": 5, "1": 7}}, "latestOffset": {"t": {"0": 9, "1": 7}}},
        {"endOffset": "text", "latestOffset": None}]}
    assert metrics.source_lag(progress) == {"t-0": 4, "t-1": 0}
    assert metrics.trigger_seconds(progress) == 1.5


def test_layers_meet_at_the_last_batch_without_overlap(make_scored):
    df = make_scored([{"event_s": float(s), "amount": 9000.0, "country": "NG",
                       "merchant_category": "crypto", "is_online": True,
                       "hour_of_day": 1} for s in (99, 100, 101)])
    cut = datetime(1970, 1, 1, 0, 1, 40)
    rows = serving.merged_rows(df, df, cut).orderBy("event_timestamp").collect()
    assert [r["source"] for r in rows] == ["batch", "realtime", "realtime"]
    only_live = serving.merged_rows(df, df, None)
    assert {r["source"] for r in only_live.collect()} == {"realtime"}
    alerts = serving.fraud_alerts(df, df, cut, end=datetime(1970, 1, 1, 0, 1, 41),
                                  start=cut, limit=1).collect()
    assert [r["transaction_id"] for r in alerts] == ["T2"]


def test_default_range_is_the_last_day(make_scored):
    df = make_scored([{"event_s": s, "amount": 9000.0, "country": "NG",
                       "merchant_category": "crypto", "is_online": True}
                      for s in (0.0, 172_000.0)])
    got = serving.fraud_alerts(df, df, None, end=datetime(1970, 1, 3)).collect()
    assert [r["transaction_id"] for r in got] == ["T1"]


def test_countries_fall_back_to_the_batch_view(make_scored):
    df = make_scored([{"country": "US"}])
    none = df.filter("false")
    assert serving.transactions_by_country(none, df, False).first()["country"] == "US"


def test_retention_keeps_the_bound(make_scored):
    df = make_scored([{"event_s": s} for s in (86_400.0 - 7200, 86_400.0 - 7201)])
    assert serving.retention_counts(df, F.lit(AS_OF)).first().asDict() == {
        "deleted": 1, "kept": 1}
    assert serving.retained(df, F.lit(AS_OF)).count() == 1


def test_missing_rows_are_found_without_a_broadcast(spark):
    source = spark.range(50).selectExpr("CAST(id AS string) AS transaction_id")
    sink = source.where("CAST(transaction_id AS int) % 7 <> 0")
    missing = views.missing_from(source, sink)
    assert "Broadcast" not in plan_of(missing)
    assert sorted(int(r[0]) for r in missing.collect()) == list(range(0, 50, 7))
