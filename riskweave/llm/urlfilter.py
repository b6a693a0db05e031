"""URL filters in a sorted array of digests.

A list of keys (host and path prefix, each with a verdict) is turned into files: XXH64
digests in order, the offsets and bytes of the full strings, and the verdicts. Spark sorts
the list and hands it over row by row; no step holds it whole. The files go to every
executor with ``SparkContext.addFile`` and are memory-mapped, so that the workers of a
machine share one copy. A batch of URLs is turned into all keys that could match, which are
searched at once by binary search; a digest that is found counts only if the stored string
is the same.

A key fits its host and all subdomains, if the path starts with the key's path; the longest
key wins, of equal ones the first in order. A key without a path fits every path.

Null URLs and URLs without "://" have empty host and path and match no key. An empty list
matches nothing; repeated keys count once; an empty table gives no rows.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import arrow_of

SEED = 42
PARTS = ("digests", "offsets", "strings", "verdicts")
# Upper-case to lower-case ASCII letters, nothing else.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class KeyFiles(NamedTuple):
    """Names of the distributed files, and the lengths of path that occur in the list."""
    name: str
    path_lengths: tuple[int, ...]


def publish(spark: SparkSession, keys: DataFrame) -> KeyFiles:
    """Sort ``key`` (string), ``verdict`` (string) and give the files to all executors.

    The driver's memory is bounded by one partition of the list at a time.
    """
    distinct = keys.where("key IS NOT NULL").groupBy("key").agg(F.min("verdict").alias("v"))
    lengths = distinct.select((F.length("key") - F.length(F.substring_index("key", "/", 1)))
                              .alias("n")).distinct().collect()
    name = f"keys-{uuid.uuid4().hex}"
    folder = tempfile.mkdtemp(prefix="keys-")
    paths = {p: os.path.join(folder, f"{name}.{p}") for p in PARTS}
    ordered = distinct.select("key", "v", F.xxhash64("key").alias("d")).orderBy("d", "key")
    with (open(paths["digests"], "wb") as digests, open(paths["offsets"], "wb") as offsets,
          open(paths["strings"], "wb") as strings, open(paths["verdicts"], "wb") as verdicts):
        end = 0
        offsets.write(np.int64(0).tobytes())
        for row in ordered.toLocalIterator():
            digests.write(np.int64(row.d).tobytes())
            data = row.key.encode()
            strings.write(data)
            end += len(data)
            offsets.write(np.int64(end).tobytes())
            verdicts.write(b"1" if row.v == "block" else b"0")
    for path in paths.values():
        spark.sparkContext.addFile(path)
    return KeyFiles(name, tuple(sorted(r.n for r in lengths)))


class KeyArray:
    """The mapped files of one list."""

    def __init__(self, files: dict[str, str]):
        def mapped(part, kind):
            path = files[part]
            return np.memmap(path, kind, "r") if os.path.getsize(path) else np.empty(0, kind)

        self.digests, self.offsets = mapped("digests", np.int64), mapped("offsets", np.int64)
        self.strings, self.verdicts = mapped("strings", np.uint8), mapped("verdicts", np.uint8)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Position of every key in the list, -1 if it is not there."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.digests) or not keys:
            return out
        wanted = np.fromiter((xxhash.xxh64_intdigest(k, SEED) for k in keys), np.uint64,
                             len(keys)).view(np.int64)
        at = np.searchsorted(self.digests, wanted)
        inside = np.minimum(at, len(self.digests) - 1)
        for i in np.flatnonzero((at < len(self.digests)) & (self.digests[inside] == wanted)):
            place = int(at[i])
            while place < len(self.digests) and self.digests[place] == wanted[i]:
                if self.string(place) == keys[i]:
                    out[i] = place
                    break
                place += 1
        return out

    def string(self, place: int) -> bytes:
        return self.strings[self.offsets[place]:self.offsets[place + 1]].tobytes()

    def blocks(self, place: int) -> bool:
        return self.verdicts[place] == ord("1")


@lru_cache(maxsize=4)
def mapped_keys(name: str) -> KeyArray:
    return KeyArray({p: SparkFiles.get(f"{name}.{p}") for p in PARTS})


def candidates(host: str, path: str, lengths: tuple[int, ...]) -> list[bytes]:
    """All keys that fit, longest first."""
    if not host:
        return []
    labels = host.split(".")
    hosts = [".".join(labels[i:]) for i in range(len(labels))]
    keys = {h + path[:n] for h in hosts for n in lengths if n <= len(path)}
    return [k.encode() for k in sorted(keys, key=lambda k: (-len(k), k))]


def parse(pages: DataFrame) -> DataFrame:
    """page_id, host, path of every page."""
    def part(i):
        found = F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)([^?#]*)", i)
        return F.coalesce(found, F.lit(""))

    return pages.select("page_id", F.translate(part(1), UPPER, LOWER).alias("host"),
                        part(2).alias("path"))


def look_up(parsed: DataFrame, files: KeyFiles, prefix: str) -> DataFrame:
    """Adds ``{prefix}_key`` (longest key that fits, or null) and ``{prefix}_blocks``."""
    spark = parsed.sparkSession
    schema = f"{spark_ddl(parsed)}, {prefix}_key string, {prefix}_blocks boolean"
    arrow_schema = arrow_of(spark, schema)
    at = parsed.columns.index("host"), parsed.columns.index("path")

    def run(batches):
        for batch in batches:
            found = mapped_keys(files.name)
            groups = [candidates(h, p, files.path_lengths) for h, p in zip(
                *(batch.column(i).to_pylist() for i in at))]
            distinct = {k: i for i, k in enumerate(dict.fromkeys(
                k for group in groups for k in group))}
            places = found.find(list(distinct))
            best = [next((p for k in group if (p := places[distinct[k]]) >= 0), None)
                    for group in groups]
            added = [pa.array([None if p is None else found.string(p).decode() for p in best],
                              pa.string()),
                     pa.array([None if p is None else found.blocks(p) for p in best],
                              pa.bool_())]
            columns = [c.cast(f.type) for c, f in zip([*batch.columns, *added], arrow_schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema)

    return parsed.mapInArrow(run, schema)


def spark_ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def judge(pages: DataFrame, rules: DataFrame, blocked: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict. The longest rule decides; without one the page is
    blocked if a key of the block list fits, else allowed.

    ``rules`` has key and verdict, ``blocked`` has key. Both may have any size.
    """
    spark = pages.sparkSession
    by_rule = look_up(parse(pages), publish(spark, rules), "rule")
    listed = publish(spark, blocked.select("key", F.lit("block").alias("verdict")))
    both = look_up(by_rule, listed, "list")
    blocks = F.coalesce("rule_blocks", "list_blocks", F.lit(False))
    return both.select("page_id", "host", "path", F.col("rule_key").alias("rule"),
                       F.when(blocks, "block").otherwise("allow").alias("verdict"))
