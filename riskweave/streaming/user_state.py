"""Current risk of every user as keyed state that expires.

The state holds one record per user: score, time and id of the newest transaction. A timer
per user fires once the watermark has passed the user's last transaction by the idle time; the
record is removed then, so that state is bounded by the users active within that time. Expiry
follows event time: a replay gives the same rows as the first run, which a time to live on the
clock of the machine would not.

Copies of a transaction and their order do not change the record, so no deduplication runs
before. Of the rows that a task reads together only the newest of each user goes on: an older one
can change neither the record nor the watermark. The state lives in RocksDB (``session.rocksdb_state``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskweave.settings import DEFAULTS, Settings
from riskweave.streaming import sinks

RECORD = "risk_score double, scored_us bigint, transaction_id string"
# ``expired``: the user has been idle and the state has gone; the score is null then.
UPDATE = "user_id string, risk_score double, scored_us bigint, expired boolean"


class CurrentRisk(StatefulProcessor):
    """Newest score of one user, until the user has been idle for ``idle_ms``."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.record = handle.getValueState("record", RECORD)

    def _due(self, scored_us: int) -> int:
        return scored_us // 1000 + self.idle_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        old = self.record.get() if self.record.exists() else None
        newest = None if old is None else (old[1], old[2], old[0])
        for frame in rows:
            frame = frame.sort_values(["scored_us", "transaction_id"])
            last = frame.iloc[-1]
            seen = (int(last.scored_us), last.transaction_id, float(last.risk_score))
            if newest is None or seen[:2] > newest[:2]:
                newest = seen
        if old is not None and (old[1], old[2]) == newest[:2]:
            return
        if old is not None:
            self.handle.deleteTimer(self._due(old[1]))
        self.record.update((newest[2], newest[0], newest[1]))
        self.handle.registerTimer(self._due(newest[0]))
        yield self._row(key, newest[2], newest[0], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.record.exists():
            return
        _, scored_us, _ = self.record.get()
        if self._due(scored_us) <= expiredTimerInfo.getExpiryTimeInMs():
            self.record.clear()
            yield self._row(key, None, scored_us, True)

    @staticmethod
    def _row(key, score: float | None, scored_us: int, expired: bool) -> pd.DataFrame:
        return pd.DataFrame({"user_id": [key[0]], "risk_score": pd.array([score], "Float64"),
                             "scored_us": [scored_us], "expired": [expired]})

    def close(self) -> None:
        pass


def newest_of_each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The newest row of each user within every frame."""
    for frame in frames:
        yield frame.sort_values(["scored_us", "transaction_id"]).drop_duplicates(
            "user_id", keep="last")


def current_user_risk(scored: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Updates of the users' current risk: user_id, risk_score, scored_at, expired. Rows
    without a user or a time have no place in it."""
    rows = scored.where("user_id IS NOT NULL AND event_timestamp IS NOT NULL").select(
        "user_id", "transaction_id", F.col("fraud_score").alias("risk_score"),
        F.unix_micros("event_timestamp").alias("scored_us"))
    rows = rows.mapInPandas(newest_of_each, rows.schema).withColumn(
        "event_timestamp", F.timestamp_micros("scored_us")).withWatermark(
        "event_timestamp", s.watermark_delay)
    updates = rows.groupBy("user_id").transformWithStateInPandas(
        CurrentRisk(s.user_idle_seconds * 1000), UPDATE, "Update", "EventTime")
    return updates.select("user_id", "risk_score",
                          F.timestamp_micros("scored_us").alias("scored_at"), "expired")


def active(updates: DataFrame) -> DataFrame:
    """user_id, risk_score, scored_at of the users whose state is there, from written
    update batches."""
    return sinks.newest_per_user(updates).where("NOT expired").drop("expired")
