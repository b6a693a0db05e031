from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from riskweave.functions import scoring
from riskweave.settings import CATEGORY_RISK, COUNTRY_RISK

FIELDS = ("amount double, country string, merchant_category string, is_online boolean, "
          "hour_of_day int, velocity_count int")
# Worked out by hand from the rules of the ``scorer`` profile.
GOLDEN = [
    ((50.0, "US", "grocery", False, 14, 1), 0.045, False),
    ((10000.0, "NG", "crypto", True, 3, 10), 0.93, True),
    ((5000.0, "RU", "gambling", True, 2, None), 0.595, False),
    ((None, None, None, None, None, None), 0.325, False),
    ((5000.0, "NG", "crypto", True, 3, None), 0.68, False),
]


def scored(df, rules):
    """Scores of frames that lack some inputs of a profile."""
    terms = (scoring.PROFILES[rules] if isinstance(rules, str) else rules).terms
    return scoring.score(df, rules, absent=tuple(t.column for t in terms))


@pytest.mark.parametrize("row, want, flag", GOLDEN)
def test_golden_scores(spark, row, want, flag):
    got = scoring.score(spark.createDataFrame([row], FIELDS), "scorer").first()
    assert got["fraud_score"] == pytest.approx(want, abs=1e-9)
    assert got["is_fraud_predicted"] is flag


def test_score_features_hold_the_inputs(spark):
    df = scoring.score(spark.createDataFrame([GOLDEN[1][0]], FIELDS), "scorer")
    assert scoring.score_features(df).first()["features"].asDict() == {
        "country_risk": 0.8, "merchant_risk": 0.9, "amount_risk": 1.0, "is_online": 1.0,
        "hour_risk": 1.0, "velocity_risk": 1.0}


def test_absent_columns_count_as_zero(spark):
    df = spark.createDataFrame([("NG", "crypto")], "country string, merchant_category string")
    score = scored(df, "sql").first()["fraud_score"]
    assert score == pytest.approx(0.25 * 0.8 + 0.2 * 0.9)


@pytest.mark.parametrize("name, null, unlisted, unknown", [
    ("batch", 0.9, 0.9, 0.9), ("stream", 0.9, 0.9, 0.9), ("scorer", 0.9, 0.9, 0.9),
    ("sql", 0.5, 0.5, 0.9), ("processor", 0.5, 0.5, 0.9), ("job", 0.5, 0.5, 0.5),
    ("simple", 0.9, 0.5, 0.9),
])
def test_unknown_countries_per_profile(spark, name, null, unlisted, unknown):
    df = spark.createDataFrame(
        [(0, None), (1, "ZZ"), (2, "UNKNOWN")],
        "i int, country string").withColumns({
            "merchant_category": F.lit("grocery"), "amount": F.lit(1.0)})
    got = [r["country_risk"] for r in scored(df, name).orderBy("i").collect()]
    assert got == [null, unlisted, unknown]


def test_amount_bounds_are_strict(spark):
    df = spark.createDataFrame([(i, a, "US", "grocery") for i, a in enumerate(
        (1000.0, 1000.01, 5000.0, 5000.01))],
        "i int, amount double, country string, merchant_category string")
    got = [round(r["fraud_score"] - 0.045, 6)
           for r in scored(df, "sql").orderBy("i").collect()]
    assert got == [0.0, 0.1, 0.1, 0.2]


def test_score_is_capped_at_one(spark):
    df = spark.createDataFrame(
        [(9e9, "UNKNOWN", "crypto", True, 0, True)],
        "amount double, country string, merchant_category string, is_online boolean, "
        "hour_of_day int, is_fraud boolean")
    rules = scoring.Profile("all", scoring.PROFILES["sql"].terms * 3, 0.6, 0.9)
    assert scored(df, rules).first()["fraud_score"] == 1.0


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(
    st.one_of(st.none(), st.floats(0, 20000)),
    st.one_of(st.none(), st.sampled_from([*COUNTRY_RISK, "ZZ"])),
    st.one_of(st.none(), st.sampled_from([*CATEGORY_RISK, "zz"])),
    st.one_of(st.none(), st.booleans()),
    st.one_of(st.none(), st.integers(0, 23)),
    st.one_of(st.none(), st.integers(0, 20)),
), min_size=1, max_size=20))
def test_scores_stay_in_range_and_rise_with_the_amount(spark, rows):
    # Both amounts of every row under one profile per example keep this to two jobs.
    name = sorted(scoring.PROFILES)[len(rows) % len(scoring.PROFILES)]
    df = spark.createDataFrame(rows, FIELDS)
    low = scored(df, name)
    high = scored(df.withColumn("amount", F.col("amount") + 6000), name)
    lows = [r["fraud_score"] for r in low.collect()]
    highs = [r["fraud_score"] for r in high.collect()]
    assert all(0 <= a <= b + 1e-12 and b <= 1 for a, b in zip(lows, highs))
    assert len(lows) == len(rows)


def test_lookups_are_broadcast_and_no_python_runs(spark, make_txns):
    for name in scoring.PROFILES:
        plan = plan_of(scored(make_txns([{}]), name))
        assert plan.count("BroadcastHashJoin") == 2
        assert "Python" not in plan and "Exchange hashpartitioning" not in plan


def test_sql_function_equals_the_stream_profile(spark, make_txns):
    scoring.register_score_function(spark)
    rows = [{"amount": a, "country": c, "is_online": o, "hour_of_day": h}
            for a in (10.0, 2000.0, 6000.0) for c in ("NG", None)
            for o in (True, None) for h in (3, None)]
    df = scored(make_txns(rows), "stream").withColumn("udf", F.expr(
        "risk_score(amount, country_risk, merchant_risk, is_online, hour_of_day, "
        "velocity_flag)"))
    assert df.filter(F.abs(F.col("udf") - F.col("fraud_score")) > 1e-12).count() == 0


def test_an_absent_input_is_an_error_unless_named(make_txns):
    df = make_txns([{}])
    with pytest.raises(ValueError, match="is_fraud"):
        scoring.score(df, "sql")
    assert scoring.score(df, "sql", absent=("is_fraud",)).count() == 1


def test_a_second_profile_brings_its_own_risks(make_txns):
    df = make_txns([{"country": "ZZ"}, {"country": "NG"}]).withColumn("is_fraud", F.lit(False))
    for name in ("sql", "job"):
        direct = scoring.score(df, name).select("transaction_id", "fraud_score")
        again = scoring.score(scoring.score(df, "stream"), name).select(
            "transaction_id", "fraud_score")
        assert direct.exceptAll(again).isEmpty()
