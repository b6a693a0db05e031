"""Replay of a range of micro-batches, and risk tables by event time."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskweave.catalog import queries
from riskweave.functions import scoring
from riskweave.operators import profiles
from riskweave.plans import batch, stream
from riskweave.session import work_path
from riskweave.sources import files, microbatches, risk_tables
from riskweave.streaming import replay, sinks
from test_days_manifest import plain
from test_streaming import Feed, message

AT = datetime(2024, 2, 1)
TABLES = ("realtime_views", "fraud_alerts", "dashboard_stats")


@pytest.fixture()
def ran(spark, tmp_path):
    """A stream of seven batches with late rows, copies and faulty messages."""
    feed = Feed(spark, tmp_path)
    for rows in ([("a", 0), ("b", 60)], [("c", 61), ("a", 0), ("d", 20), ("b", 60)],
                 [("e", 200)], [("f", 150), ("g", 90), ("e", 200), ("e", 200)],
                 [("h", 100), ("i", 10), ("j", 210)], [("k", 211), ("k", 211)], [("l", 400)]):
        feed.add(*[message(t, s, amount=100.0 * s + 1) for t, s in rows], "no message")
    stream.start(feed.records(), feed.out, f"{feed.out}/c", available_now=True).awaitTermination()
    return feed


def content(spark, root) -> dict:
    # Arrival and the clock of the statistics are the batch's time in a replay.
    out = {}
    for table in TABLES:
        rows = sinks.read_batches(spark, root, table)
        out[table] = plain(rows.drop("timestamp"))
    return out


@pytest.mark.parametrize("first,last", [(0, 0), (2, 4), (1, 5)])
def test_a_replay_gives_the_rows_of_the_first_run(spark, ran, first, last):
    before = content(spark, ran.out)
    assert replay.replay(spark, f"{ran.out}/c", ran.out, first, last, AT) == 1
    assert content(spark, ran.out) == before
    # Once more, and after packing.
    microbatches.compact(spark, ran.out, "realtime_views", AT)
    assert replay.replay(spark, f"{ran.out}/c", ran.out, first, last,
                         AT + timedelta(hours=1)) == 3
    assert content(spark, ran.out) == before


def test_other_rules_change_the_range_only(spark, ran):
    before = content(spark, ran.out)["realtime_views"]
    replay.replay(spark, f"{ran.out}/c", ran.out, 2, 3, AT, scoring=lambda rows: scoring.score(
        rows, "stream").withColumn("is_fraud_predicted", F.lit(False)))
    rows = sinks.read_batches(spark, ran.out, "realtime_views")
    changed = rows.where("batch_id BETWEEN 2 AND 3")
    assert changed.where("is_fraud_predicted").isEmpty() and not changed.isEmpty()
    assert sinks.read_batches(spark, ran.out, "fraud_alerts").where(
        "batch_id BETWEEN 2 AND 3").isEmpty()
    assert rows.count() == len(before[1])
    # Maintenance packs around the replayed range and loses nothing.
    microbatches.compact(spark, ran.out, "realtime_views", AT + timedelta(hours=1))
    gone = microbatches.collect(spark, ran.out, list(TABLES), AT + timedelta(hours=5),
                                timedelta(hours=2))
    assert "realtime_views/batch_id=0" in gone and "realtime_views/batch_id=2" in gone
    assert sinks.read_batches(spark, ran.out, "realtime_views").count() == len(before[1])


def test_ranges_by_time_and_their_bounds(spark, ran):
    log = replay.batches(spark, f"{ran.out}/c")
    stamps = {b: datetime(1970, 1, 1) + timedelta(milliseconds=log[b].at) for b in (1, 4)}
    assert replay.between(log, stamps[1], stamps[4]) == (1, 3)
    with pytest.raises(LookupError):
        replay.between(log, datetime(2000, 1, 1), datetime(2000, 1, 2))
    newest = max(microbatches.batch_ids(spark, ran.out, "realtime_views"))
    for first, last in ((0, newest), (500, 501)):
        with pytest.raises(ValueError):
            replay.replay(spark, f"{ran.out}/c", ran.out, first, last, AT)


# ---- risks by time -------------------------------------------------------------------

def risk_file(path, **countries) -> str:
    path.write_text(json.dumps({"country_risk": countries, "merchant_risk": {"crypto": 0.3},
                                "blacklist": []}))
    return str(path)


def publish(spark, tmp_path, valid_from, **countries) -> str:
    root = str(tmp_path / "risks")
    risk_tables.publish_version(spark, root, risk_file(
        tmp_path / f"risks-{valid_from:%H%M%S}.json", **countries), valid_from)
    return root


def test_the_version_of_the_event_time_holds(spark, make_txns, tmp_path):
    root = publish(spark, tmp_path, datetime(1970, 1, 1, 0, 1), NG=0.2)
    publish(spark, tmp_path, datetime(1970, 1, 1, 0, 2), US=0.4)
    txns = make_txns([{"country": c, "event_s": t} for t in (59.0, 60.0, 119.9, 120.0)
                      for c in ("NG", "US", None)] + [{"country": "US", "event_s": None,
                                                       "proc_s": 0.0}])
    out = scoring.score(txns, "stream", versions=risk_tables.read_versions(spark, root))
    got = {(r.transaction_id): r.country_risk for r in out.collect()}
    built_in = {"NG": 0.8, "US": 0.2}
    plain_us = scoring.score(make_txns([{"country": "US"}]), "stream").first().country_risk
    built_in["US"] = plain_us
    want = [built_in["NG"], built_in["US"], 0.9, 0.2, 0.9, 0.9, 0.2, 0.9, 0.9, 0.9, 0.4, 0.9, 0.4]
    assert [got[f"T{i}"] for i in range(13)] == want
    assert out.count() == 13


def test_without_versions_the_built_in_tables_hold(spark, make_txns):
    txns = make_txns([{"country": c, "merchant_category": m}
                      for c in ("NG", "US", "XX", None) for m in ("crypto", None)])
    versions = risk_tables.read_versions(spark, None)
    assert plain(scoring.score(txns, "stream", versions=versions)) == plain(
        scoring.score(txns, "stream").select(scoring.score(
            txns, "stream", versions=versions).columns))


def test_an_update_changes_later_rows_without_a_restart(spark, tmp_path):
    feed, risks = Feed(spark, tmp_path), str(tmp_path / "risks")
    feed.add(message("a", 0), message("b", 100))
    run = lambda: stream.start(feed.records(), feed.out, f"{feed.out}/c", available_now=True,
                               risks=risks).awaitTermination()
    run()
    publish(spark, tmp_path, datetime(2024, 1, 1, 0, 3), NG=0.0)
    feed.add(message("c", 150), message("d", 200))
    run()
    rows = {r.transaction_id: r.country_risk for r in sinks.read_batches(
        spark, feed.out, "realtime_views").collect()}
    assert rows == {"a": 0.8, "b": 0.8, "c": 0.8, "d": 0.0}


def test_profiles_of_the_newest_run_enrich_the_stream(spark, make_txns, tmp_path):
    feed, views = Feed(spark, tmp_path), str(tmp_path / "views")
    feed.add(message("a", 0, country="NG"))
    args = dict(available_now=True, profiles=views)
    stream.start(feed.records(), feed.out, f"{feed.out}/c", **args).awaitTermination()
    txns = make_txns([{"user_id": "U", "country": "US", "amount": a} for a in (10.0, 20.0, 30.0)])
    batch.run(spark, txns.withColumns({c: F.lit(None).cast("string") for c in (
        "currency", "card_type")}), views, AT, train_model=False)
    assert profiles.user_profiles(txns, F.lit(AT)).count() == 1
    feed.add(message("b", 10, country="NG", amount=50.0), message("c", 11, user_id="V"))
    stream.start(feed.records(), feed.out, f"{feed.out}/c", **args).awaitTermination()
    rows = {r.transaction_id: r for r in spark.read.option("mergeSchema", True).parquet(
        f"{feed.out}/realtime_views").collect()}
    assert rows["a"].amount_zscore is None
    assert rows["b"].amount_zscore == pytest.approx(3.0) and rows["b"].is_new_country
    assert rows["c"].amount_zscore == 0.0 and not rows["c"].is_new_country


def test_batch_scores_by_event_time(spark, make_txns, tmp_path):
    root = publish(spark, tmp_path, datetime(1970, 1, 1, 0, 1), NG=0.0)
    txns = make_txns([{"country": "NG", "event_s": t} for t in (10.0, 70.0)])
    rows = batch.scored(txns, versions=risk_tables.read_versions(spark, root)).orderBy(
        "event_timestamp").collect()
    assert [r.country_risk for r in rows] == [0.8, 0.0]


def test_replay_input_in_several_files_a_span(spark, sf_dir, monkeypatch, tmp_path):
    """Each span of days has the same number of files, also where tasks have no rows, and the
    rows are those of one file a span."""
    plain = work_path(spark, "in")
    assert queries.land_in_turn(spark, sf_dir, plain) == 1
    one = spark.read.text(plain)
    monkeypatch.setattr(queries, "ROWS_OF_FILE", 40)
    several = work_path(spark, "in")
    each = queries.land_in_turn(spark, sf_dir, several)
    assert each > 1 and files.measure(spark, several)[1] == 5 * each
    assert spark.read.text(several).exceptAll(one).isEmpty()
    assert spark.read.text(several).count() == one.count()
    few = spark.read.parquet(f"{sf_dir}/events.parquet").where(
        "ts < TIMESTAMP '2024-01-04'").limit(30)
    few.write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(queries, "ROWS_OF_FILE", 2)
    assert queries.land_in_turn(spark, str(tmp_path), f"{tmp_path}/in") == 3
    assert files.measure(spark, f"{tmp_path}/in")[1] == 15
