from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskweave.functions import scoring
from riskweave.operators import dedup, quality, views
from riskweave.plans import stream
from riskweave.session import ROCKSDB_PROVIDER, use_rocksdb_state
from riskweave.settings import Settings
from riskweave.sources import events, stores
from riskweave.streaming import progress, sinks, speed

AT = datetime(2024, 1, 31)


def message(tid: str, second: float, **extra) -> str:
    stamp = datetime.fromtimestamp(1_704_067_200 + second).astimezone().isoformat()
    return json.dumps({
        "transaction_id": tid, "user_id": "U", "amount": 9000.0, "merchant_id": "M",
        "country": "NG", "merchant_category": "crypto", "is_online": True,
        "hour_of_day": 1, "timestamp": stamp, "event_time": stamp, **extra})


class Feed:
    """A folder of message files, read one file per micro-batch."""

    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, root, 0
        self.input, self.out = str(root / "in"), str(root / "out")
        (root / "in").mkdir()

    def add(self, *messages: str) -> None:
        (self.root / "in" / f"{self.n:03d}.json").write_text("\n".join(messages) + "\n")
        self.n += 1
        # Files are taken in order of their modification time.
        import os
        os.utime(self.root / "in" / f"{self.n - 1:03d}.json", (self.n * 10, self.n * 10))

    def records(self):
        return speed.read_landing_stream(self.spark, self.input, max_files=1)

    def transactions(self):
        return speed.to_transactions(self.records())

    def drain(self, df, table="t", mode="append"):
        query = sinks.drain(df, sinks.append_batches(self.out, table),
                            f"{self.out}/checkpoint-{table}", mode)
        return query, sinks.read_batches(self.spark, self.out, table)


@pytest.fixture()
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_late_rows_are_dropped_by_the_watermark(feed):
    for batch in ([("a", 0), ("b", 60)], [("c", 61), ("a", 0), ("d", 20), ("b", 60)],
                  [("e", 200)], [("f", 150), ("g", 90)],
                  [("h", 100), ("i", 10), ("j", 210)]):
        feed.add(*[message(t, s) for t, s in batch])
    _, rows = feed.drain(dedup.stream_first_seen(feed.transactions(), "30 seconds"))
    got = sorted(r["transaction_id"] for r in rows.collect())
    assert got == list("abcdefgj")


def test_ids_with_a_changed_event_time(feed):
    feed.add(message("a", 0), message("b", 1))
    feed.add(message("a", 5), message("c", 6))
    by_pair = feed.drain(dedup.stream_first_seen(feed.transactions(), "30 seconds"), "pair")[1]
    by_id = feed.drain(
        dedup.stream_first_seen_by_id(feed.transactions(), "300 seconds"), "id")[1]
    assert by_pair.count() == 4
    assert sorted(r["transaction_id"] for r in by_id.collect()) == list("abc")


def test_restart_continues_and_remembers(feed):
    scored = speed.score_stream(feed.transactions())
    feed.add(message("a", 0), message("b", 1))
    feed.drain(scored)
    feed.add(message("a", 0), message("c", 2))
    _, rows = feed.drain(speed.score_stream(feed.transactions()))
    got = sorted((r["transaction_id"], r["batch_id"]) for r in rows.collect())
    assert [t for t, _ in got] == list("abc") and got[2][1] > got[0][1]


def test_a_replayed_batch_replaces_its_output(spark, make_txns, tmp_path):
    scored = scoring.score(make_txns([{"amount": 9000.0, "country": "NG",
                                       "merchant_category": "crypto", "is_online": True,
                                       "hour_of_day": 1}, {}]), "stream").withColumn(
        "processing_time", F.col("processing_timestamp"))
    write = sinks.fan_out(str(tmp_path), AT)
    for _ in range(2):
        write(scored, 7)
    counts = {t: sinks.read_batches(spark, str(tmp_path), t).count()
              for t in ("realtime_views", "fraud_alerts", "dashboard_stats")}
    assert counts == {"realtime_views": 2, "fraud_alerts": 1, "dashboard_stats": 2}


def test_sink_errors_stop_the_query(feed):
    feed.add(message("a", 0))

    def fail(batch, batch_id):
        raise RuntimeError("store is down")

    with pytest.raises(Exception, match="store is down"):
        sinks.drain(feed.transactions(), fail, f"{feed.out}/checkpoint")


def test_windows_appear_once_closed(feed):
    feed.add(*[message(f"a{s}", s) for s in (0, 30, 59, 60, 100)])
    stats = speed.window_stats(feed.transactions(), Settings(), "1 minute")
    assert [r["n"] for r in feed.drain(stats)[1].collect()] == [3]
    feed.add(message("z", 400))
    rows = feed.drain(speed.window_stats(feed.transactions(), Settings(), "1 minute"))[1]
    assert sorted(r["n"] for r in rows.collect()) == [2, 3]


def test_sliding_windows_overlap(feed):
    feed.add(message("a", 45), message("z", 600))
    stats = speed.window_stats(feed.transactions(), Settings(), "1 minute", "30 seconds")
    rows = feed.drain(stats)[1].collect()
    assert len(rows) == 2 and {r["n"] for r in rows} == {1}


def test_dead_letters_and_good_rows_split(feed, spark):
    feed.add(message("a", 0), "nope", message("b", 1, amount="x"))
    stream.start(feed.records(), feed.out, f"{feed.out}/c1",
                 available_now=True).awaitTermination()
    stream.start_dead_letters(feed.records(), feed.out, f"{feed.out}/c2",
                              available_now=True).awaitTermination()
    assert sinks.read_batches(spark, feed.out, "realtime_views").count() == 1
    assert sinks.read_batches(spark, feed.out, "dead_letters").count() == 2


def test_current_risk_follows_the_newest_transaction(feed):
    feed.add(message("a", 0))
    feed.add(message("b", 10, amount=1.0), message("c", 5, user_id="V"))
    scored = scoring.score(feed.transactions(), "stream")
    updates = feed.drain(speed.current_user_risk(scored), "risk", "update")[1]
    got = {r["user_id"]: r["risk_score"] for r in sinks.newest_per_user(updates).collect()}
    low, high = 0.25 * 0.8 + 0.2 * 0.9 + 0.2, 0.25 * 0.8 + 0.2 * 0.9 + 0.55
    assert got == {"U": pytest.approx(low), "V": pytest.approx(high)}


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    """The stream rules over the whole table give the rows of the batch expression."""
    root = str(tmp_path)
    wire = stores.kafka_envelope(
        events.to_messages(events.to_transactions(events.stream_events(spark, sf_dir))))
    sinks.drain(speed.score_stream(speed.to_transactions(wire)),
                sinks.fan_out(root, AT), f"{root}/checkpoint")
    live = sinks.read_batches(spark, root, "realtime_views")
    full = views.tag_windows(scoring.score(
        dedup.first_arrivals(events.transactions(spark, sf_dir)), "stream"))
    columns = ["transaction_id", "user_id", "amount", "fraud_score", "is_fraud_predicted",
               "window_start", "window_end"]
    assert live.count() == 1000
    assert live.select(*columns).exceptAll(full.select(*columns)).isEmpty()


def test_replay_into_a_fresh_checkpoint_rebuilds_the_view(feed, spark, tmp_path):
    feed.add(message("a", 0), message("b", 1))
    roots = [str(tmp_path / n) for n in ("first", "second")]
    for root in roots:
        stream.start(feed.records(), root, f"{root}/checkpoint",
                     available_now=True).awaitTermination()
    # The processing time is that of each run.
    first, second = (sinks.read_batches(spark, r, "realtime_views").drop("processing_time")
                     for r in roots)
    assert first.count() == 2 and first.exceptAll(second).isEmpty()


def test_landing_stream_writes_date_folders(feed, spark, tmp_path):
    feed.add(message("a", 0), message("b", 86_400))
    landed = str(tmp_path / "landed")
    parsed = quality.parse_messages(feed.records()).drop(
        "raw_value", quality.CORRUPT, "event_timestamp", "processing_timestamp")
    query = sinks.start_landing(parsed, landed, f"{feed.out}/checkpoint")
    query.processAllAvailable()
    query.stop()
    days = stores.read_landing(spark, landed).groupBy("day").count().collect()
    assert {r["day"]: r["count"] for r in days} == {1: 1, 2: 1}


def test_console_prints_scored_rows(feed):
    feed.add(message("a", 0))
    query = sinks.start_console(
        speed.score_stream(feed.transactions()), f"{feed.out}/checkpoint")
    query.processAllAvailable()
    assert query.exception() is None
    query.stop()


def test_state_in_rocksdb(feed, spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    use_rocksdb_state(spark)
    try:
        assert spark.conf.get(key) == ROCKSDB_PROVIDER
        feed.add(message("a", 0), message("a", 0))
        query, rows = feed.drain(dedup.stream_first_seen(feed.transactions(), "30 seconds"))
        assert rows.count() == 1
        assert "rocksdbCommitCheckpointLatency" in str(query.recentProgress[0])
    finally:
        spark.conf.set(key, before)


def test_micro_batches_are_limited(feed):
    for i in range(3):
        feed.add(message(f"m{i}", i))
    query, _ = feed.drain(feed.transactions())
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1]


def test_further_outputs_run_as_jobs(feed, spark):
    feed.add(message("a", 0), message("b", 61), "nope")
    feed.add(message("c", 7200))
    out = {}
    for name in ("dead-letters", "windows", "user-risk", "late-events"):
        root = f"{feed.out}/{name}"
        stream.JOBS[name](feed.records(), root, f"{root}-checkpoint",
                          available_now=True).awaitTermination()
        table = name.replace("-", "_").replace("windows", "window_stats")
        out[name] = sinks.read_batches(spark, root, table)
    assert out["dead-letters"].count() == 1
    assert out["user-risk"].select("user_id").distinct().count() == 1
    assert out["windows"].agg(F.sum("n")).first()[0] >= 4  # sliding: each row twice
    assert set(out["late-events"].columns) >= {"transaction_id", "delay_seconds", "lateness"}


def test_progress_of_a_query_is_kept(spark, tmp_path):
    report = {"id": "q", "batchId": 3, "timestamp": "2024-01-01T00:00:00.000Z",
              "numInputRows": 7, "durationMs": {"triggerExecution": 1500}, "sources": [
                  {"latestOffset": {"t": {"0": 9}}, "endOffset": {"t": {"0": 5}}}]}
    progress.append(spark, str(tmp_path), report)
    row = progress.read_progress(spark, str(tmp_path)).first()
    assert row.asDict() == {"query_id": "q", "batch_id": 3, "at": report["timestamp"],
                            "input_rows": 7, "trigger_seconds": 1.5, "lag": 4,
                            "lag_by_partition": {"t-0": 4}}
