from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from riskweave.operators import history, profiles


def brute_force(rows: list[dict], window: int) -> dict[str, tuple]:
    out = {}
    for r in rows:
        mine = [o for o in rows if o["user_id"] == r["user_id"]]
        now = int(r["event_s"] // 1)
        near = [o for o in mine if now - window <= int(o["event_s"] // 1) <= now]
        earlier = [o for o in mine if (o["event_s"], o["transaction_id"])
                   < (r["event_s"], r["transaction_id"])]
        last = max((int(o["event_s"] // 1) for o in earlier), default=None)
        dev = statistics.stdev([o["amount"] for o in mine]) if len(mine) > 1 else 0
        mean = statistics.fmean(o["amount"] for o in mine)
        out[r["transaction_id"]] = (
            len(near), round(sum(o["amount"] for o in near), 4),
            999999 if last is None else now - last,
            round((r["amount"] - mean) / dev, 4) if dev > 0 else 0.0)
    return out


def random_rows(n: int, users: int, span: float, seed: int) -> list[dict]:
    rng = random.Random(seed)
    # A third of the rows belongs to one user; many share a second.
    return [{
        "transaction_id": f"T{i:04d}",
        "user_id": "HOT" if i % 3 == 0 else f"U{rng.randrange(users)}",
        "amount": round(rng.uniform(0.01, 3000), 2),
        "event_s": 1_700_000_000 + round(rng.choice([rng.uniform(0, span),
                                                     float(rng.randrange(int(span)))]), 6),
    } for i in range(n)]


@pytest.mark.parametrize("slice_seconds", [1, 7, 60, 3600])
@pytest.mark.parametrize("window", [0, 30, 300])
@pytest.mark.parametrize("cut", ["all", "some", "none"])
def test_features_equal_brute_force(make_txns, window, slice_seconds, cut):
    rows = random_rows(300, 8, 900.0, window + slice_seconds)
    df = make_txns(rows)
    large = {"all": None, "some": df.filter("user_id IN ('U1', 'HOT')").select("user_id").distinct(),
             "none": df.select("user_id").limit(0)}[cut]
    got = history.history_features(df, window, slice_seconds, large)
    assert {
        r["transaction_id"]: (r["velocity_count"], round(r["velocity_amount"], 4),
                              r["time_since_last"], round(r["amount_zscore"], 4) + 0.0)
        for r in got.collect()
    } == brute_force(rows, window)


def test_window_ends_are_inclusive(make_txns):
    rows = [{"event_s": float(s)} for s in (0, 300, 601)]
    got = history.velocity(make_txns(rows), 300).orderBy("event_timestamp").collect()
    assert [r["velocity_count"] for r in got] == [1, 2, 1]


def test_parts_equal_the_whole(make_txns):
    df = make_txns(random_rows(200, 5, 500.0, 3))
    whole = history.history_features(df)
    for part in (history.velocity(df), history.time_since_last(df)):
        assert part.exceptAll(whole.select(*part.columns)).isEmpty()
        assert part.count() == 200


def test_profile_join_gives_the_same_zscore(make_txns):
    df = make_txns(random_rows(200, 5, 500.0, 4))
    joined = history.amount_zscore(df, profiles.user_features(df))
    pairs = joined.select("transaction_id", F.col("amount_zscore").alias("a")).join(
        history.history_features(df).select("transaction_id", "amount_zscore"),
        "transaction_id")
    assert pairs.filter(F.abs(F.col("a") - F.col("amount_zscore")) < 1e-9).count() == 200


def test_equal_amounts_have_no_deviation(make_txns):
    df = make_txns([{"amount": 0.1, "event_s": i * 100.0} for i in range(30)])
    assert {r["amount_zscore"] for r in history.history_features(df).collect()} == {0.0}


def test_totals_return_to_exact_zero(make_txns):
    rows = [{"amount": 0.1, "event_s": float(i)} for i in range(50)]
    rows.append({"amount": 5000.0, "event_s": 10_000.0})
    last = history.velocity(make_txns(rows)).orderBy(F.desc("event_timestamp")).first()
    assert (last["velocity_count"], last["velocity_amount"]) == (1, 5000.0)


def test_rows_without_a_time_are_kept(make_txns):
    df = make_txns([{"event_s": None}, {"event_s": 5.0}])
    got = {r["transaction_id"]: r for r in history.history_features(df).collect()}
    assert got["T0"]["velocity_count"] == 1 and got["T1"]["time_since_last"] == 999999


def test_rows_are_shuffled_once_and_sorted_once(spark, make_txns):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(history.history_features(make_txns(random_rows(50, 3, 50.0, 1))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The rows once; the summary when it is aggregated, by user, and back to the rows.
    assert plan.count("Exchange hashpartitioning(_user") == 4
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_profiles_of_one_user(make_txns):
    rows = [
        {"amount": 10.0, "country": "US", "merchant_id": "A", "is_online": True,
         "event_s": 0.0},
        {"amount": 30.0, "country": None, "merchant_id": "B", "is_online": None,
         "event_s": 86_400.0, "_label": "fraud"},
        {"amount": 20.0, "country": "NG", "merchant_id": "A", "event_s": 172_800.0,
         "merchant_category": "crypto"},
    ]
    as_of = F.lit("1970-01-11").cast("timestamp")
    got = profiles.user_profiles(make_txns(rows), as_of).first()
    assert got["total_transactions"] == 3 and got["total_amount"] == 60.0
    assert got["stddev_amount"] == 10.0 and got["account_age_days"] == 10
    assert got["unique_countries"] == 2 and got["countries_used"] == ["NG", "US"]
    assert got["unique_merchants"] == 2 and got["categories_used"] == ["crypto"]
    assert got["online_count"] == 1 and got["fraud_rate"] == pytest.approx(1 / 3)


def test_profiles_need_no_row_expansion(make_txns):
    as_of = F.lit("1970-01-11").cast("timestamp")
    assert "Expand" not in plan_of(profiles.user_profiles(make_txns([{}]), as_of))


def test_hourly_pattern_counts_every_row(make_txns):
    df = make_txns([{"hour_of_day": h % 24} for h in range(30)])
    got = profiles.hourly_pattern(df).first().asDict()
    assert got["h00"] == 2 and got["h05"] == 2 and got["h06"] == 1
    assert sum(v for k, v in got.items() if k != "user_id") == 30


def test_new_country_needs_a_profile(make_txns):
    as_of = F.lit("1970-01-02").cast("timestamp")
    known = profiles.user_profiles(make_txns([{"country": "US"}]), as_of)
    recent = make_txns([
        {"country": "US"}, {"country": "NG"}, {"country": None},
        {"country": "NG", "user_id": "NEW"}])
    got = profiles.unusual_countries(recent, known).orderBy("transaction_id").collect()
    assert [r["is_new_country"] for r in got] == [False, True, False, False]


def test_rows_without_a_user_share_a_history(make_txns):
    df = make_txns([{"user_id": None, "event_s": 899.0}, {"user_id": None, "event_s": 905.0}])
    rows = history.history_features(df, 300).orderBy("event_timestamp").collect()
    assert [r["velocity_count"] for r in rows] == [1, 2]
    assert rows[1]["time_since_last"] == 6


def test_large_users_are_those_with_many_rows(make_txns):
    df = make_txns([{"user_id": "A"}] * 5 + [{"user_id": None}] * 4 + [{"user_id": "B"}])
    assert {r.user_id for r in history.large_users(df, 3).collect()} == {"A", None}


def test_summary_of_uncut_users_is_one_row_each(make_txns):
    df = make_txns(random_rows(300, 8, 90_000.0, 3))
    marks = history._marks(df, 300, 60, df.select("user_id").limit(0))
    assert history._slice_summary(marks).count() == df.select("user_id").distinct().count()


def test_whole_histories_equal_the_features(spark, make_txns):
    """Without users to cut; rows without a time or user, ties, and equal seconds."""
    rng = random.Random(8)
    rows = [{"user_id": rng.choice(["A", "B", "C", None]), "amount": rng.choice([1.5, 20.0, None]),
             "event_s": rng.choice([None, float(rng.randrange(900)), rng.randrange(900) + 0.25])}
            for _ in range(400)]
    df = make_txns([{**r, "proc_s": 0.0} for r in rows])
    got = history.whole_histories(df, 60)
    want = history.history_features(df, 60, 900, df.select("user_id").limit(0))
    assert got.columns == want.columns[:len(got.columns)]
    key = lambda r: tuple(map(str, r))
    assert sorted(got.collect(), key=key) == sorted(want.select(got.columns).collect(), key=key)
