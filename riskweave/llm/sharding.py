"""Shards of nearly equal bytes: minimax contiguous partition of atomic groups.

Documents with equal texts form a group that is never cut. Groups are ordered by the
SHA-256 of their text and cut into at most ``shards`` contiguous stretches. The smallest
capacity for which a greedy walk needs no more stretches is found by binary search; within
that capacity each cut is placed next to an equal share of what is left.

The walk never sees all groups. It knows sums for ranges of digests (hexadecimal prefixes);
a range into which a cut falls, and which holds more than one group, is split 256-fold by a
filtered aggregation, until every cut lies between known groups. The driver holds at most
256 sums plus 256 for each such range and round. Only DataFrame functions touch the rows.

Null texts form one group of size 8 (no bytes) each row, with CRC 0; empty texts another.
Repeated rows are documents of their own, with slots next to each other. An empty table gives no rows. A group larger than
an equal share fills its shard alone, as it cannot be cut.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import written

OVERHEAD = 8
SPLIT = 2  # hexadecimal digits by which a range is split
CELLS = 1024  # rows of a shard are numbered in so many cells
BURST = 10_000  # copies of one row that one task makes at a time
NULL_DIGEST = "0" * 64


class Range(NamedTuple):
    """Groups whose digest starts with a prefix; ``single`` if it is one group."""
    first: str
    prefix: str
    size: int
    single: bool


def ranges(items: DataFrame, digits: int, inside: list[str] | None = None) -> list[Range]:
    chosen = items if inside is None else items.where(
        F.substring("digest", 1, digits - SPLIT).isin(inside))
    prefix = F.substring("digest", 1, digits)
    rows = chosen.groupBy(prefix.alias("prefix")).agg(
        F.sum("size").alias("size"), F.min("digest").alias("first"),
        F.max("digest").alias("last")).collect()
    return [Range(r["first"], r["prefix"], r["size"], r["first"] == r["last"]) for r in rows]


class Line:
    """The ranges in order, as positions on a line of bytes."""

    def __init__(self, parts: list[Range]):
        self.parts = sorted(parts)
        self.ends: list[int] = []
        for part in self.parts:
            self.ends.append((self.ends[-1] if self.ends else 0) + part.size)
        self.total = self.ends[-1] if self.ends else 0
        self.unclear: set[str] = set()

    def around(self, x: int) -> tuple[int, int]:
        """Known boundaries at or next to x; a range that hides nearer ones is noted."""
        if x <= 0:
            return 0, 0
        if x >= self.total:
            return self.total, self.total
        i = bisect_left(self.ends, x)
        if self.ends[i] == x:
            return x, x
        if not self.parts[i].single:
            self.unclear.add(self.parts[i].prefix)
        return self.ends[i] - self.parts[i].size, self.ends[i]

    def reach(self, x: int, divisible: bool) -> int:
        """Furthest cut at or before x; inside a range if those count as divisible."""
        low, high = self.around(x)
        if divisible and low < x < high and not self.parts[bisect_left(self.ends, x)].single:
            return x
        return low

    def feasible(self, capacity: int, shards: int, divisible: bool) -> bool:
        at = 0
        for _ in range(shards):
            if at + capacity >= self.total:
                return True
            at = self.reach(at + capacity, divisible)
        return False

    def capacity(self, shards: int, divisible: bool) -> int:
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            if self.feasible(middle, shards, divisible):
                high = middle
            else:
                low = middle + 1
        return low

    def cuts(self, shards: int, capacity: int) -> list[int]:
        """Positions of the cuts, each stretch within the capacity."""
        least = [self.total]  # where j shards must have begun to hold the rest
        for _ in range(shards):
            least.append(self.around(least[-1] - capacity)[1])
        out, at = [], 0
        for left in range(shards, 1, -1):
            share = at + (self.total - at) // left
            low, high = self.around(share)
            near = low if share - low <= high - share and low > at else high
            at = max(min(near, self.reach(at + capacity, False)), least[left - 1])
            out.append(at)
        return out


def solve(items: DataFrame, shards: int) -> tuple[int, list[str]]:
    """Smallest capacity, and the first digest behind every cut that has one."""
    digits = SPLIT
    known = ranges(items, digits)
    while True:
        line = Line(known)
        low, high = (line.capacity(shards, divisible) for divisible in (True, False))
        line.unclear.clear()
        line.feasible(low, shards, True)
        line.feasible(high, shards, False)
        cuts = line.cuts(shards, high)
        if not line.unclear:
            break
        known = [r for r in known if r.prefix not in line.unclear]
        for length in {len(p) for p in line.unclear}:
            known += ranges(items, length + SPLIT,
                            [p for p in line.unclear if len(p) == length])
    behind = [bisect_right(line.ends, c) for c in cuts]
    return high, [line.parts[i].first if i < len(line.parts) else "g" for i in behind]


def shard_of(digest: Column, firsts: list[str]) -> Column:
    """Number of cuts at or before a digest ("g" sorts behind all digests)."""
    cuts = F.array(*[F.lit(f) for f in firsts]) if firsts else F.array().cast("array<string>")
    return F.size(F.filter(cuts, lambda cut: cut <= digest))


def by_bytes(docs: DataFrame, shards: int = 24) -> DataFrame:
    """One row per document: size, text_crc32, shard, slot (from 0 within the shard)."""
    items = written(docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long")
        .alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.coalesce(F.sha2("text", 256), F.lit(NULL_DIGEST)).alias("digest")), "sizes")
    _, firsts = solve(items, shards)
    # Equal rows are numbered as one group with their count.
    groups = items.groupBy("doc_id", "digest", "size", "text_crc32").agg(
        F.count("*").alias("copies"))
    placed = groups.withColumns({
        "shard": shard_of(F.col("digest"), firsts),
        "cell": F.pmod(F.xxhash64("doc_id", "digest"), F.lit(CELLS)).cast("int")})
    # At most shards x CELLS rows, whatever the size of the input.
    counts = placed.groupBy("shard", "cell").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select("shard", "cell",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    earlier = Window.partitionBy("shard", "cell").orderBy(
        "doc_id", "text_crc32", "size", "digest").rowsBetween(Window.unboundedPreceding, -1)
    numbered = written(placed.withColumn(
        "at", F.coalesce(F.sum("copies").over(earlier), F.lit(0))).join(
        F.broadcast(starts), ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", "shard", "digest", "copies",
        (F.col("start") + F.col("at")).alias("first")), "numbered")
    # A group of very many copies is dealt out before its rows are made.
    bursts = numbered.where(F.col("copies") > BURST).withColumn("burst", F.explode(
        F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / BURST)))).repartition(
        "doc_id", "digest", "burst")
    dealt = numbered.where(F.col("copies") <= BURST).withColumn(
        "burst", F.lit(0).cast("bigint")).unionByName(bursts)
    begin, end = F.col("burst") * BURST, (F.col("burst") + 1) * BURST
    return dealt.select("doc_id", "size", "text_crc32", "shard", F.explode(F.sequence(
        F.col("first") + begin, F.col("first") + F.least(end, F.col("copies")) - 1))
        .alias("slot"))
