"""Batch by day, the manifest of live folders, compaction and removal of dead ones."""

from __future__ import annotations

import os
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from compare import rows_of
from riskweave.operators import dedup
from riskweave.plans import batch, explain, incremental, serve
from riskweave.sources import events, files, manifest, microbatches, stores
from riskweave.streaming import sinks

AT = datetime(2024, 2, 1)
FIRST, LAST = date(2024, 1, 1), date(2024, 1, 31)


@pytest.fixture(scope="module")
def landing(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("days") / "landing")
    stores.land(events.to_messages(events.transactions(spark, sf_dir)), root)
    return root


@pytest.fixture(scope="module")
def full_run(spark, landing, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("days") / "views")
    return root, incremental.run_days(spark, landing, root, FIRST, LAST, AT)


def plain(df) -> tuple:
    """Rows as text, sorted; digits that depend on the order of a sum are left out."""
    rounded = df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c)
                          for c, t in df.dtypes])
    return rows_of(rounded.columns, rounded.collect())


def test_days_equal_the_full_batch(spark, landing, full_run):
    root, done = full_run
    columns = ["transaction_id", "user_id", "amount", "velocity_count", "velocity_amount",
               "time_since_last", "avg_amount", "stddev_amount", "amount_zscore",
               "fraud_score", "is_fraud_predicted", "is_very_high_amount"]
    want = batch.scored(dedup.first_arrivals(stores.read_master(spark, landing)))
    got = incremental.read_days(spark, root, "fraud_results")
    assert plain(got.select(columns)) == plain(want.select(columns))
    assert done.version == 1 and len(done.days) + len(done.empty) == 31


@pytest.mark.parametrize("window", [300, 200_000])
def test_a_rerun_of_two_days_replaces_two_parts(spark, landing, tmp_path, window):
    root = str(tmp_path / "views")
    incremental.run_days(spark, landing, root, FIRST, LAST, AT, window)
    before = manifest.read(spark, root)
    rows = plain(incremental.read_days(spark, root, "fraud_results").drop("batch_timestamp"))
    days = [date(2024, 1, 10), date(2024, 1, 11)]
    incremental.run_days(spark, landing, root, *days, AT + timedelta(hours=1), window)
    after = manifest.read(spark, root)
    assert (before.version, after.version) == (1, 2)
    for view in incremental.VIEWS:
        changed = {p for p in after.of(view) if after.of(view)[p] != before.of(view).get(p)}
        assert changed <= {incremental.part(d) for d in days}
    assert len(after.of("fraud_results")) == len(before.of("fraud_results"))
    assert plain(incremental.read_days(
        spark, root, "fraud_results").drop("batch_timestamp")) == rows
    # Older versions can still be read.
    old = incremental.read_days(spark, root, "daily_stats", live=manifest.read(spark, root, 1))
    assert old.select("day").distinct().count() == len(before.of("daily_stats"))


def test_only_the_days_of_the_range_are_read(spark, landing, full_run):
    root, _ = full_run
    scans = [r for r in explain.plan_rows(incremental.landed(
        spark, landing, date(2024, 1, 10), date(2024, 1, 11))) if r["operator"] == "Scan"]
    assert scans and all("make_date" in r["partitions"] for r in scans)
    files_read = incremental.landed(spark, landing, date(2024, 1, 10), date(2024, 1, 11))
    days = {Path(f).parent.name for f in files_read.select(F.input_file_name()).distinct()
            .toPandas().iloc[:, 0]}
    assert days == {"day=10", "day=11"}
    view = incremental.read_days(spark, root, "fraud_results").where(
        F.col("day") == date(2024, 1, 12)).select("amount")
    (scan,) = [r for r in explain.plan_rows(view) if r["operator"] == "Scan"]
    assert "day" in scan["partitions"] and scan["columns"] == "struct<amount:double>"


def test_new_and_vanished_days(spark, make_txns, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "views")

    def land(rows, mode="append"):
        txns = make_txns(rows).withColumns({
            "currency": F.lit("USD"), "card_type": F.lit("visa")})
        stores.land(events.to_messages(txns), landing, mode)

    day = 86_400
    land([{"event_s": 10.0, "amount": 5.0}, {"event_s": day + 5.0, "amount": 7.0}])
    one, two, three = date(1970, 1, 1), date(1970, 1, 2), date(1970, 1, 3)
    done = incremental.run_days(spark, landing, root, one, three, AT)
    assert (done.days, done.empty) == ([one, two], [three])
    land([{"transaction_id": "new", "event_s": 2 * day + 1.0, "amount": 9.0}])
    done = incremental.run_days(spark, landing, root, three, three, AT)
    assert done.days == [three]
    (row,) = incremental.read_days(spark, root, "fraud_results", three).collect()
    assert (row.time_since_last, row.velocity_count) == (day - 4, 1)
    assert row.avg_amount == pytest.approx(7.0) and row.stddev_amount == pytest.approx(2.0)
    # A day whose messages are gone loses its part.
    land([{"event_s": day + 5.0, "amount": 7.0}], "overwrite")
    incremental.run_days(spark, landing, root, one, one, AT)
    left = incremental.read_days(spark, root, "transactions").select("day").distinct()
    assert sorted(r.day for r in left.collect()) == [two, three]


def test_only_days_with_faults_are_parsed_for_dead_letters(spark, make_txns, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "views")
    txns = make_txns([{"event_s": 86_400.0 * d + 5, "user_id": u} for d in range(4)
                      for u in "AB"]).withColumns(
        {"currency": F.lit("USD"), "card_type": F.lit("visa")})
    stores.land(events.to_messages(txns), landing)
    one, four = date(1970, 1, 1), date(1970, 1, 4)
    incremental.run_days(spark, landing, root, one, four, AT)
    # Nothing to write, so the messages were not parsed a second time.
    assert files.folders(spark, f"{root}/dead_letters") == []
    for d, lines in ((2, "not json\n"), (3, '{"transaction_id": "x"}\n' * 2)):
        (tmp_path / "landing" / "year=1970" / "month=1" / f"day={d}" / "bad.json").write_text(lines)
    incremental.run_days(spark, landing, root, one, four, AT + timedelta(hours=1))
    found = incremental.read_days(spark, root, "dead_letters").groupBy("day").count().collect()
    assert sorted((r.day.day, r["count"]) for r in found) == [(2, 1), (3, 2)]
    assert incremental.read_days(spark, root, "transactions").count() == 8


def test_faulty_messages_of_a_rerun_are_not_doubled(spark, landing, tmp_path):
    source, root = tmp_path / "landing", str(tmp_path / "views")
    for d in (1, 2):
        folder = source / "year=2024" / "month=1" / f"day={d}"
        folder.mkdir(parents=True)
        (folder / "part.json").write_text('{"transaction_id": "x"}\nnot json\n')
    for first in (1, 1, 2):
        incremental.run_days(spark, str(source), root, date(2024, 1, first),
                             date(2024, 1, 2), AT)
    rows = incremental.read_days(spark, root, "dead_letters")
    assert rows.count() == 4
    with pytest.raises(LookupError):
        incremental.read_days(spark, root, "transactions")


def test_country_and_daily_views(spark, landing, full_run):
    root, _ = full_run
    rows = incremental.read_days(spark, root, "fraud_results")
    assert incremental.daily_stats(spark, root).agg(
        F.sum("total_transactions")).first()[0] == rows.count()
    assert incremental.country_stats(spark, root).agg(
        F.sum("fraud_count")).first()[0] == rows.where("is_fraud_predicted").count()


# ---- manifest ------------------------------------------------------------------------

def put(spark, root, view, run, n, part="p"):
    path = f"{view}/run_id={run}"
    spark.range(n).write.parquet(f"{root}/{path}")
    return {(view, part): path}


def age(root, hours: int) -> None:
    """Make all files look older."""
    then = (datetime.now() - timedelta(hours=hours)).timestamp()
    for path in Path(root).rglob("*"):
        if path.is_file():
            os.utime(path, (then, then))


def test_commits_swap_all_views_at_once(spark, tmp_path):
    root = str(tmp_path)
    assert manifest.read(spark, root) == manifest.Manifest(0, {})
    both = put(spark, root, "a", "1", 1) | put(spark, root, "b", "1", 1)
    assert manifest.commit(spark, root, both, AT) == 1
    old = manifest.read(spark, root)
    manifest.commit(spark, root, put(spark, root, "a", "2", 2) | {("b", "p"): None}, AT)
    new = manifest.read(spark, root)
    assert old.of("a") == {"p": "a/run_id=1"} and old.of("b") == {"p": "b/run_id=1"}
    assert new.of("a") == {"p": "a/run_id=2"} and new.of("b") == {}
    assert manifest.read(spark, root, 1) == old


def test_an_open_reader_keeps_its_files(spark, tmp_path):
    root, now = str(tmp_path), datetime.now(timezone.utc).replace(tzinfo=None)
    manifest.commit(spark, root, put(spark, root, "a", "1", 5), now - timedelta(hours=9))
    reader = spark.read.parquet(f"{root}/{manifest.read(spark, root).of('a')['p']}")
    manifest.commit(spark, root, put(spark, root, "a", "2", 6), now - timedelta(hours=1))
    unfinished = put(spark, root, "a", "3", 7)  # of a run that has not committed yet
    age(f"{root}/a/run_id=1", 9)
    assert manifest.collect(spark, root, ["a"], now, timedelta(hours=2)) == []
    assert reader.count() == 5
    assert manifest.collect(spark, root, ["a"], now, timedelta(minutes=30)) == ["a/run_id=1"]
    assert files.folders(spark, f"{root}/a") == ["run_id=2", "run_id=3"]
    manifest.commit(spark, root, unfinished, now)
    # A run that failed leaves a folder that no commit names; it goes once it is old.
    put(spark, root, "a", "4", 1)
    age(f"{root}/a/run_id=4", 5)
    assert manifest.collect(spark, root, ["a"], now, timedelta(hours=2)) == ["a/run_id=4"]


def test_replaced_days_are_deleted(spark, landing, tmp_path):
    root, now = str(tmp_path / "views"), datetime.now(timezone.utc).replace(tzinfo=None)
    for hours in (9, 6):
        incremental.run_days(spark, landing, root, FIRST, date(2024, 1, 4),
                             now - timedelta(hours=hours))
    size = files.measure(spark, root)[0]
    rows = incremental.read_days(spark, root, "fraud_results").count()
    age(root, 7)
    gone = incremental.collect(spark, root, now, timedelta(hours=5))
    assert gone and all("run_id" in path for path in gone)
    assert files.measure(spark, root)[0] < 0.6 * size
    assert incremental.read_days(spark, root, "fraud_results").count() == rows
    assert incremental.collect(spark, root, now, timedelta(hours=5)) == []


# ---- micro-batches -------------------------------------------------------------------

def batches(spark, root, ids, n=10, table="t"):
    for i in ids:
        sinks.write_batch(spark.range(n).withColumn("b", F.lit(i)), root, table, i)


def test_the_number_of_files_stays_bounded(spark, tmp_path):
    """Many rounds of batches, compaction and removal."""
    root, most, now = str(tmp_path), 0, datetime.now(timezone.utc).replace(tzinfo=None)
    for round_ in range(12):
        batches(spark, root, range(5 * round_, 5 * round_ + 5))
        microbatches.compact(spark, root, "t", now + timedelta(hours=round_), 10_000)
        microbatches.collect(spark, root, ["t"], now + timedelta(hours=round_ + 2),
                             timedelta(hours=1))
        age(root, 48)
        most = max(most, len(microbatches.batch_ids(spark, root, "t")))
        rows = sinks.read_batches(spark, root, "t")
        assert rows.count() == 10 * 5 * (round_ + 1)
        assert rows.where("b <> batch_id").isEmpty()
    assert most <= 6 and files.measure(spark, f"{root}/t")[1] <= 24
    size, count, _ = files.measure(spark, f"{root}/t_packed")
    # Packs at least half the target, one that still grows, one that was just replaced.
    assert count <= size / 5_000 + 2


def test_packing_is_seen_at_once_and_survives_replays(spark, tmp_path):
    root = str(tmp_path)
    batches(spark, root, range(4))
    assert microbatches.compact(spark, root, "t", AT) == 3
    assert microbatches.compact(spark, root, "t", AT) == 0
    batches(spark, root, [3], 4)  # the newest batch, written once more after a restart
    rows = sinks.read_batches(spark, root, "t")
    assert {r.batch_id: r["count"] for r in rows.groupBy("batch_id").count().collect()} == {
        0: 10, 1: 10, 2: 10, 3: 4}
    assert microbatches.batch_ids(spark, root, "t") == [0, 1, 2, 3]
    assert microbatches.collect(spark, root, ["t"], AT, timedelta(hours=1)) == []
    gone = microbatches.collect(spark, root, ["t"], AT + timedelta(hours=2), timedelta(hours=1))
    assert gone == ["t/batch_id=0", "t/batch_id=1", "t/batch_id=2"]
    assert sinks.read_batches(spark, root, "t").count() == 34


def test_columns_that_came_later_are_null_in_older_packs(spark, tmp_path):
    root = str(tmp_path)
    batches(spark, root, range(2))
    microbatches.compact(spark, root, "t", AT)
    sinks.write_batch(spark.range(1).selectExpr("id", "7 AS b", "'x' AS extra"), root, "t", 2)
    spark.sql("SET spark.sql.parquet.mergeSchema=true")
    try:
        rows = sinks.read_batches(spark, root, "t")
        assert rows.where("extra IS NULL").count() == 20
    finally:
        spark.sql("RESET spark.sql.parquet.mergeSchema")


def test_maintenance_of_the_speed_layer(spark, tmp_path):
    root, now = str(tmp_path), datetime(2024, 1, 31)
    live = spark.range(10).select(*[
        (F.lit("2024-01-31 00:00:00") if c == "processing_time" else F.lit(None)).cast(
            "timestamp" if c in ("processing_time", "event_timestamp") else "string").alias(c)
        for c in serve.REALTIME_COLUMNS])
    for i in range(4):
        sinks.write_batch(live if i else live.withColumn(
            "processing_time", F.lit("2023-01-01 00:00:00").cast("timestamp")),
            root, "realtime_views", i)
        for table in ("fraud_alerts", "dashboard_stats"):
            batches(spark, root, [i], 3, table)
    done = serve.maintain(spark, root, now)
    assert done == {"rows_dropped": 10, "batches_packed": 6, "folders_deleted": 0}
    assert serve.realtime_view(spark, root).count() == 30
    later = serve.maintain(spark, root, now + timedelta(hours=2))
    assert later["folders_deleted"] == 9
    assert serve.realtime_view(spark, root).count() == 30
    assert sinks.read_batches(spark, root, "fraud_alerts").count() == 12


# ---- plans as tables -----------------------------------------------------------------

def test_plan_table(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    df = items.where("l_quantity > 10").join(
        orders, items.l_orderkey == orders.o_orderkey).groupBy("o_orderpriority").count()
    rows = {r.id: r for r in explain.plan_table(df).collect()}
    scan = rows[1]
    assert (scan.operator, scan.detail) == ("Scan", "parquet")
    assert "GreaterThan(l_quantity,10.0)" in scan.pushed
    assert scan.columns == "struct<l_orderkey:bigint,l_quantity:double>"
    (join,) = [r for r in rows.values() if r.operator.endswith("Join")]
    assert join.keys == "l_orderkey" and join.detail.startswith("Inner")
    assert explain.count(df, "Exchange") == 1 and explain.count(df, "HashAggregate") == 2
    assert explain.plan_rows(df) == explain.plan_rows(df)
