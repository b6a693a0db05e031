"""Tables that a stream writes as one folder per micro-batch, and their compaction.

A stream adds a folder every few seconds. ``compact`` packs all but the newest, which may still
be written, into files of a target size and commits them to the manifest; what was packed
before and is still small is packed again with them. So a table has as many files as its bytes
need, besides the batches since the last compaction, however many batches there were.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.sources import files, manifest
from riskweave.times import moment, naive_utc

TARGET_BYTES = 128 * 1024 * 1024


def _range(part: str) -> tuple[int, int]:
    first, last = part.removeprefix("batches=").split("-")
    return int(first), int(last)


def _overlap(a: tuple[int, int], b: tuple[int, int]) -> bool:
    return a[0] <= b[1] and b[0] <= a[1]


def is_packed(batch: int, parts) -> bool:
    return any(first <= batch <= last for first, last in map(_range, parts))


def _packed(parts) -> Column:
    """The same for the rows of a table."""
    return reduce(lambda a, b: a | b, [F.col("batch_id").between(*_range(p)) for p in parts],
                  F.lit(False))


def waiting(spark: SparkSession, root: str, table: str, parts) -> list[int]:
    """Batches before the newest that are not packed."""
    found = batch_ids(spark, root, table)
    return [i for i in found[:-1] if not is_packed(i, parts)]


def batch_ids(spark: SparkSession, root: str, table: str) -> list[int]:
    return sorted(int(name.removeprefix("batch_id=")) for name in files.folders(
        spark, f"{root}/{table}") if name.startswith("batch_id="))


def _plain(rows: DataFrame) -> DataFrame:
    return rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def read(spark: SparkSession, root: str, table: str, upto: int | None = None,
         parts: dict[str, str] | None = None) -> DataFrame:
    """All rows of a table with their ``batch_id``; each batch from where it lives now."""
    parts = manifest.read(spark, root).of(table) if parts is None else parts
    rows = _plain(spark.read.parquet(f"{root}/{table}").where(~_packed(parts)))
    for path in parts.values():
        rows = rows.unionByName(spark.read.parquet(f"{root}/{path}"), allowMissingColumns=True)
    return rows if upto is None else rows.where(F.col("batch_id") <= upto)


def _write(rows: DataFrame, root: str, table: str, at: datetime, size: int, target: int) -> str:
    path = f"{table}_packed/run_id={at:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
    # Not coalesced: few files must not mean that few tasks read and filter all rows.
    rows.repartition(max(1, ceil(size / target))).write.parquet(f"{root}/{path}")
    return path


def compact(spark: SparkSession, root: str, table: str, at: datetime,
            target: int = TARGET_BYTES, kept: Callable[[DataFrame], DataFrame] | None = None
            ) -> int:
    """Pack the batches before the newest; returns how many. With ``kept`` all packed rows
    are read again and only what it keeps is written."""
    parts = manifest.read(spark, root).of(table)
    todo = waiting(spark, root, table, parts)
    if not todo:
        return 0
    sizes = {part: files.measure(spark, f"{root}/{path}")[0] for part, path in parts.items()}
    span, again = (todo[0], todo[-1]), set()
    # The newest parts while they are small, and whatever lies between the batches.
    for part in sorted(parts, key=_range, reverse=True):
        first, last = _range(part)
        if kept is None and sizes[part] >= target // 2 and not _overlap((first, last), span):
            break
        again.add(part)
        span = min(first, span[0]), max(last, span[1])
    size = sum(sizes[p] for p in again) + sum(
        files.measure(spark, f"{root}/{table}/batch_id={i}")[0] for i in todo)
    rows = _plain(spark.read.parquet(f"{root}/{table}").where(F.col("batch_id").isin(todo)))
    for part in again:
        rows = rows.unionByName(spark.read.parquet(f"{root}/{parts[part]}"),
                                allowMissingColumns=True)
    path = _write(rows if kept is None else kept(rows), root, table, at, size, target)
    changes: dict[tuple[str, str], str | None] = {(table, p): None for p in again}
    manifest.commit(spark, root, changes | {(table, f"batches={span[0]}-{span[1]}"): path}, at)
    return len(todo)


def replace(spark: SparkSession, root: str, tables: dict[str, DataFrame], first: int, last: int,
            at: datetime, target: int = TARGET_BYTES) -> int:
    """Put other rows (with ``batch_id``) in the place of some batches, in all tables with one
    commit; returns its version. Parts that hold other batches too are written anew."""
    changes: dict[tuple[str, str], str | None] = {}
    for table, rows in tables.items():
        parts = manifest.read(spark, root).of(table)
        span = first, last
        size = sum(files.measure(spark, f"{root}/{table}/batch_id={i}")[0]
                   for i in range(first, last + 1))
        for part, path in parts.items():
            if _overlap(_range(part), (first, last)):
                rows = rows.unionByName(spark.read.parquet(f"{root}/{path}").where(
                    ~F.col("batch_id").between(first, last)), allowMissingColumns=True)
                size += files.measure(spark, f"{root}/{path}")[0]
                changes[table, part] = None
                span = min(span[0], _range(part)[0]), max(span[1], _range(part)[1])
        path = _write(_plain(rows), root, table, at, size, target)
        changes[table, f"batches={span[0]}-{span[1]}"] = path
    return manifest.commit(spark, root, changes, at)


def collect(spark: SparkSession, root: str, tables: list[str], now: datetime,
            keep: timedelta) -> list[str]:
    """Delete packed batches and replaced packs that no reader of the last ``keep`` can have
    open; returns their paths."""
    live = manifest.read(spark, root)
    since = naive_utc(now) - keep
    old = manifest.entries(spark, root).where(F.col("at") <= moment(since)).where(
        "path IS NOT NULL").select("view", "part").distinct().collect()
    gone = []
    for table in tables:
        # A batch is dead once a pack that holds it has been live for ``keep``.
        settled = [r.part for r in old if r.view == table]
        for batch in batch_ids(spark, root, table):
            if is_packed(batch, settled) and is_packed(batch, live.of(table)):
                files.delete(spark, f"{root}/{table}/batch_id={batch}")
                gone.append(f"{table}/batch_id={batch}")
    return gone + manifest.collect(spark, root, [f"{t}_packed" for t in tables], now, keep)
