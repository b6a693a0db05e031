"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: see ``fingerprint``. Two of them are linked if at most ``RADIUS`` bits
differ. Bit i carries a code m(i), a non-zero vector of RADIUS + 1 bits; table v, for every
non-zero v, keeps the bits with odd parity of m(i) & v. For any RADIUS differing bits there
is a v that is orthogonal to all their codes, so that both fingerprints look alike in table
v: no linked pair is missed.

Documents with the same fingerprint are one node. Small buckets compare their members. In
the others every member names the values at distance 0 and 1 of itself within the bits that
the table hides, and members that name the same value are linked: these are exactly the
pairs within distance 2, without comparing all members. Nodes have at most 2,080 partners.

Null and empty texts have fingerprint zero and are linked like any other. Repeated rows and
ties need no care: a component carries its smallest doc_id. Components of an empty table
are empty.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import free_name, map_rows, written

RADIUS = 2
BITS = 64
SHINGLE = 3
SEED = 42
# Buckets of up to so many fingerprints compare their members one by one.
SMALL_BUCKET = 12
BLOCK = 1 << 16


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def masks() -> list[int]:
    """Bits kept by each table."""
    tables = range(1, 1 << (RADIUS + 1))
    codes = [1 + i % len(tables) for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(codes) if (m & v).bit_count() % 2)
            for v in tables]


def fingerprint(text: str | None) -> int:
    """Majority of each bit over the XXH64 of the 3-word shingles, repeats included.

    A-Z are lower-cased, words are runs without ASCII white space; with fewer than three
    words the whole sequence is one shingle, without words the fingerprint is zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        slices = [joined]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[:-SHINGLE + 1].tolist()
        slices = [joined[a:b] for a, b in zip(starts, ends[SHINGLE - 1:].tolist())]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(slices), BLOCK):
        part = slices[at:at + BLOCK]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(SEED)), np.uint64,
                             len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(slices), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long)."""
    return map_rows(docs.select("doc_id", "text"),
                    lambda doc_id, text: (doc_id, signed(fingerprint(text))),
                    "doc_id bigint, fp bigint")


def near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= RADIUS


def links(nodes: DataFrame, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """Pairs a < b of linked fingerprints from distinct ``fp``; enough of them to connect
    whatever is linked, each within the radius. Fewer than all pairs in large buckets."""
    tables = masks()
    keyed = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(v).alias("v"), F.lit(signed(m)).alias("mask"),
                 F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
        for v, m in enumerate(tables)])).alias("t")).select("fp", "t.*")
    sizes = keyed.groupBy("v", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(keyed.join(sizes, ["v", "key"]), "buckets", len(tables) * nodes.count())

    few = shared.where(F.col("n") <= small_bucket).groupBy("v", "key").agg(
        F.array_sort(F.collect_list("fp")).alias("fps"))
    compared = few.select(F.explode(F.flatten(F.transform("fps", lambda a: F.transform(
        F.filter("fps", lambda b: (b > a) & near(a, b)),
        lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("e")).select("e.*")

    flips = F.array(F.lit(0).cast("long"), *[F.lit(signed(1 << i)) for i in range(BITS)])
    named = shared.where(F.col("n") > small_bucket).select(
        "fp", "v", F.explode(F.filter(flips, lambda bit: bit.bitwiseAND(F.col("mask")) == 0))
        .alias("bit")).select("fp", "v", F.col("fp").bitwiseXOR(F.col("bit")).alias("value"))
    # At most BITS + 1 fingerprints can name one value.
    met = named.groupBy("v", "value").agg(
        F.array_sort(F.collect_set("fp")).alias("fps")).where(F.size("fps") > 1)
    starred = met.select(F.col("fps")[0].alias("a"), F.explode(
        F.slice("fps", 2, F.size("fps"))).alias("b"))
    return compared.union(starred).distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """fp, root: the smallest fp that can be reached, for all ends of edges.

    Each round takes the smallest root among the neighbours and then follows that root's
    own root, so long chains shrink by halves. Rounds are written to the shared folder.
    """
    both = written(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                   "links")
    size = both.count()
    roots = written(both.groupBy(F.col("a").alias("fp")).agg(
        F.least(F.first("a"), F.min("b")).alias("root")), "roots", size)
    for _ in range(max_rounds):
        seen = both.join(roots, both.b == roots.fp).groupBy("a").agg(
            F.min("root").alias("least"))
        nearer = roots.join(seen, roots.fp == seen.a).select(
            "fp", "root", F.least("root", "least").alias("next"))
        target = roots.select(F.col("fp").alias("next"), F.col("root").alias("beyond"))
        moved = written(nearer.join(target, "next").select(
            "fp", F.col("root").alias("old"), F.least("next", "beyond").alias("root")),
            "roots", size)
        roots = moved.select("fp", "root")
        if moved.where("root <> old").isEmpty():
            return roots
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: fp, fingerprint (16 hex digits), component_id."""
    hashed = written(fingerprints(docs), "fingerprints")
    nodes = written(hashed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = components(links(nodes.select("fp")))
    rooted = nodes.join(roots, "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = written(rooted.join(least, "root").select("fp", "component_id"), "classes")
    return hashed.join(named, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each component, that of the smallest id; all columns unchanged.

    A doc_id that is repeated stays once per row. Null ids are kept as they are.
    """
    classes = near_duplicates(docs.where("doc_id IS NOT NULL"))
    name = free_name(docs, "gone")
    gone = classes.where("doc_id <> component_id").select(F.col("doc_id").alias(name))
    return docs.join(gone.distinct(), docs["doc_id"] == F.col(name), "left_anti")
