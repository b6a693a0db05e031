"""Which folders of a store are live: an append-only list of parts and their folders.

A part is what one writer replaces as a whole, such as a day of a view. Its data is written to
a folder that nobody reads yet; one append to the manifest makes all folders of a commit live
together and the ones they replace dead. Readers take their folders from one read of the
manifest, so an answer never mixes two commits. Dead folders stay for a while, for readers that
have begun, and are then deleted by ``collect``.

The manifest has a row per part and commit, a small number beside the rows of the parts. Each
store has one writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.sources import files
from riskweave.times import moment, naive_utc

# ``path`` is relative to the store, null where a commit removes a part.
SCHEMA = "version bigint, view string, part string, path string, at timestamp"


def entries(spark: SparkSession, root: str) -> DataFrame:
    """All commits; empty before the first."""
    if "manifest" in files.folders(spark, root):
        return spark.read.schema(SCHEMA).parquet(f"{root}/manifest")
    # Without rows from Python, for which workers would have to start.
    return spark.range(0).select(F.inline(F.array(F.from_json(F.lit("{}"), SCHEMA))))


@dataclass(frozen=True)
class Manifest:
    """Live folders at one version: view -> part -> path. Version 0 is the empty store."""

    version: int
    parts: dict[str, dict[str, str]]

    def of(self, view: str) -> dict[str, str]:
        return self.parts.get(view, {})


def read(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The newest manifest, or an older one by its version."""
    seen = entries(spark, root)
    if version is not None:
        seen = seen.where(F.col("version") <= version)
    rows = seen.groupBy("view", "part").agg(
        F.max_by("path", "version").alias("path"), F.max("version").alias("version")).collect()
    parts: dict[str, dict[str, str]] = {}
    for r in rows:
        if r.path is not None:
            parts.setdefault(r.view, {})[r.part] = r.path
    return Manifest(max((r.version for r in rows), default=0), parts)


def commit(spark: SparkSession, root: str, changes: dict[tuple[str, str], str | None],
           at: datetime) -> int:
    """Make folders live, or parts empty (None), in one step; returns the new version."""
    version = read(spark, root).version + 1
    rows = [(version, view, part, path) for (view, part), path in changes.items()]
    spark.createDataFrame(rows, "version bigint, view string, part string, path string").coalesce(
        1).withColumn("at", moment(at)).write.mode("append").parquet(f"{root}/manifest")
    return version


def referenced(spark: SparkSession, root: str, since: datetime) -> set[str]:
    """Folders that are live or were at any time after ``since``."""
    rows = sorted(entries(spark, root).select(
        "version", "view", "part", "path", F.col("at").cast("string").alias("at")).collect(),
        key=lambda r: r.version)
    live: dict[tuple[str, str], str | None] = {}
    kept: set[str] = set()
    for r in rows:
        before = live.get((r.view, r.part))
        if before and datetime.fromisoformat(r.at) > naive_utc(since):
            kept.add(before)  # replaced after ``since``
        live[r.view, r.part] = r.path
    return kept | {path for path in live.values() if path}


def collect(spark: SparkSession, root: str, views: list[str], now: datetime,
            keep: timedelta) -> list[str]:
    """Delete the folders of views that no reader can want any more; returns their paths.

    A folder goes if no commit of the last ``keep`` had it live and nothing was written to it
    since, so neither an open reader nor a run that has not committed yet loses anything.
    ``keep`` must exceed the longest run and the longest read.
    """
    since = naive_utc(now) - keep
    wanted = referenced(spark, root, since)
    gone = []
    for view in views:
        for run in files.folders(spark, f"{root}/{view}"):
            if not run.startswith("run_id="):
                continue
            path = f"{view}/{run}"
            inner = [f"{path}/{part}" for part in files.folders(spark, f"{root}/{path}")]
            for folder in [*inner, path]:
                if any(w == folder or w.startswith(f"{folder}/") for w in wanted) or (
                        path in wanted):
                    continue
                written = files.measure(spark, f"{root}/{folder}")[2]
                if written is None or written < since:
                    files.delete(spark, f"{root}/{folder}")
                    gone.append(folder)
    return gone
