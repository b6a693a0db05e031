"""Expiring user state, inspection of state, and mergeable sketches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from riskweave.functions import scoring
from riskweave.operators import dedup, sketches
from riskweave.plans import stream
from riskweave.session import ROCKSDB_PROVIDER, rocksdb_state
from riskweave.settings import Settings
from riskweave.streaming import inspection, sinks, user_state
from test_streaming import Feed, message

IDLE = Settings(user_idle_seconds=60)


def run(feed, s=IDLE) -> dict:
    """Drain what has arrived as a query of its own on the same checkpoint."""
    with rocksdb_state(feed.spark):
        updates = feed.drain(user_state.current_user_risk(
            scoring.score(feed.transactions(), "stream"), s), "risk", "update")[1]
    return {r.user_id: (round(r.risk_score, 6), r.scored_at.timestamp() - 1_704_067_200)
            for r in user_state.active(updates).collect()}


def held(feed) -> set:
    return {r.user_id for r in inspection.user_records(
        feed.spark, f"{feed.out}/checkpoint-risk").collect()}


def test_idle_users_leave_the_state_and_may_return(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(message("a", 0), message("b", 50, user_id="V", amount=1.0), message("c", 10))
    first = run(feed)
    assert {u: at for u, (_, at) in first.items()} == {"U": 10, "V": 50}
    # A copy and an older transaction change nothing.
    feed.add(message("c", 10), message("d", 5, amount=1.0))
    assert run(feed) == first and held(feed) == {"U", "V"}
    # 110 - 30 has passed 10 + 60, not 50 + 60.
    feed.add(message("e", 110, user_id="W"))
    assert set(run(feed)) == held(feed) == {"V", "W"}
    feed.add(message("f", 200, user_id="U", amount=1.0))
    got = run(feed)
    assert set(got) == {"U"} == held(feed) and got["U"][1] == 200
    batches = sinks.read_batches(spark, feed.out, "risk")
    gone = [tuple(r) for r in batches.where("expired").orderBy("user_id").select(
        "user_id", "risk_score").collect()]
    assert gone == [("U", None), ("V", None), ("W", None)]


def test_a_later_transaction_puts_the_expiry_off(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(message("a", 0))
    run(feed)
    feed.add(message("b", 50))
    run(feed)
    feed.add(message("c", 100, user_id="V"))
    assert set(run(feed)) == {"U", "V"}  # 70 is behind 0 + 60, before 50 + 60


def test_rows_without_a_user_or_time_have_no_state(spark, make_txns, tmp_path):
    txns = make_txns([{"user_id": None}, {"event_s": None, "proc_s": 0.0}, {"user_id": "V"}])
    path = str(tmp_path / "in")
    txns.withColumn("processing_time", F.col("processing_timestamp")).write.parquet(path)
    source = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    with rocksdb_state(spark):
        sinks.drain(user_state.current_user_risk(scoring.score(source, "stream")),
                    sinks.append_batches(str(tmp_path), "risk"), str(tmp_path / "c"), "update")
    rows = user_state.active(sinks.read_batches(spark, str(tmp_path), "risk")).collect()
    assert [r.user_id for r in rows] == ["V"]


def test_the_job_uses_rocksdb_and_leaves_the_session_alone(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(message("a", 0), "no message")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    query = stream.start_user_risk(feed.records(), feed.out, f"{feed.out}/c",
                                   available_now=True)
    query.awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    assert ROCKSDB_PROVIDER != before
    assert user_state.active(sinks.read_batches(spark, feed.out, "user_risk")).count() == 1
    (row,) = inspection.operators(spark, f"{feed.out}/c").select(
        "operator", "partitions").distinct().collect()
    assert row.operator.startswith("transformWithState") and row.partitions == 4


def test_keys_of_a_stopped_deduplication(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(message("a", 0), message("a", 0), message("b", 90))
    feed.drain(dedup.stream_first_seen(feed.transactions(), "30 seconds"), "pairs")
    keys = inspection.dedup_keys(spark, f"{feed.out}/checkpoint-pairs")
    assert [r.transaction_id for r in keys.collect()] == ["b"]
    feed.drain(dedup.stream_first_seen_by_id(feed.transactions(), "300 seconds"), "ids")
    keys = inspection.dedup_keys(spark, f"{feed.out}/checkpoint-ids").orderBy("transaction_id")
    assert [(r.transaction_id, int(r.expires_at.timestamp()) - 1_704_067_200)
            for r in keys.collect()] == [("a", 300), ("b", 390)]


# ---- sketches ------------------------------------------------------------------------

def rows_of(spark, n: int, users: int):
    return spark.range(n).select(
        F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(users))).alias("user_id"),
        F.timestamp_seconds(F.col("id") % 7200).alias("event_timestamp"),
        (F.col("id") * 7919 % 100_003 / 1000.0).alias("delay"),
    ).withColumn("processing_time", F.timestamp_micros(
        F.unix_micros("event_timestamp") + (F.col("delay") * 1e6).cast("bigint")))


def test_errors_of_merged_sketches(spark):
    rows = rows_of(spark, 200_000, 50_000).cache()
    merged = sketches.per_window(rows)
    assert merged.count() == 120
    exact = rows.select("user_id").distinct().count()
    got = sketches.active_users(merged).first().active_users
    assert abs(got - exact) <= 2.6 / 2 ** (sketches.LG_K / 2) * exact
    # Not the sum over the windows, which is about three times as much.
    assert sketches.active_users(merged, "1 minute").agg(
        F.sum("active_users")).first()[0] > 2 * exact
    quantiles = sketches.quantiles(merged).first()
    assert quantiles["count"] == 200_000
    for name, q in sketches.QUANTILES.items():
        rank = rows.agg(F.avg((F.col("delay") <= quantiles[name] + 1e-6).cast("double"))
                        ).first()[0]
        assert abs(rank - q) <= 0.0266
    rows.unpersist()


def test_small_spans_are_exact_and_keys_split(spark):
    rows = rows_of(spark, 900, 40).withColumn("country", F.when(F.col("delay") > 50, "A"))
    merged = sketches.per_window(rows, "1 minute", "country")
    got = {(r.window_start, r.country): r.active_users
           for r in sketches.active_users(merged, "5 minutes", "country").collect()}
    want = rows.groupBy(F.window("event_timestamp", "5 minutes").start.alias("w"), "country").agg(
        F.countDistinct("user_id").alias("n")).collect()
    assert got == {(r.w, r.country): r.n for r in want}


def test_nulls_and_empty_input(spark):
    rows = rows_of(spark, 10, 3).withColumns({
        "user_id": F.lit(None).cast("string"),
        "processing_time": F.lit(None).cast("timestamp")})
    merged = sketches.per_window(rows)
    assert sketches.active_users(merged).first().active_users == 0
    assert tuple(sketches.quantiles(merged).first()) == (0, None, None, None)
    empty = sketches.per_window(rows.limit(0))
    assert sketches.active_users(empty, "1 hour").count() == 0


def test_sketches_of_micro_batches_add_up(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for batch in range(3):
        feed.add(*[message(f"{batch}-{i}", 100 * batch + i, user_id=f"u{i % 7 + batch}")
                   for i in range(40)])
    feed.add(message("end", 1000))
    stream.start_user_sketches(feed.records(), feed.out, f"{feed.out}/c",
                               available_now=True).awaitTermination()
    written = sinks.read_batches(spark, feed.out, "sketches")
    assert written.select("batch_id").distinct().count() > 1
    assert sketches.active_users(written).first().active_users == 9
    assert sketches.quantiles(written).first()["count"] == 120


def test_only_the_newest_row_of_a_user_reaches_the_state():
    frame = pd.DataFrame({"user_id": ["a", "b", "a", "a"], "transaction_id": ["3", "1", "2", "4"],
                          "risk_score": [0.1, 0.2, 0.3, 0.4], "scored_us": [5, 1, 9, 5]})
    (newest,) = user_state.newest_of_each(iter([frame]))
    assert {(r.user_id, r.transaction_id, r.scored_us) for r in newest.itertuples()} == {
        ("a", "2", 9), ("b", "1", 1)}
