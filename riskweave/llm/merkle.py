"""Merkle manifest of a data set by lag and lead windows.

Every row is a leaf. Within a group, leaves ascend by id; every ``ARITY`` consecutive nodes
become one parent until one node, the group's subroot, remains. The subroots, in order of
their groups, become the root in the same way.

A level is one window pass: lag and lead columns at the fixed offsets 1 to ARITY - 1 bring a
node its neighbours, masked to those of its own run by its slot and the run's length. The
masked columns are the node's siblings; at a run's first child, node and leads together are
the parent's input. Windows run over stretches of ``STRETCH`` consecutive nodes, a multiple
of the run length, so no group, however large, meets in one task. Positions come from a range
partitioning and the row counts of its partitions.

Null fields are hashed as ``-``, which no value can be. Rows without an id come first, rows
with equal ids follow their digest; rows that are equal throughout are leaves of their own,
and which of them takes which place cannot be told. A missing group is a group and the first
one. A group of one leaf has that leaf as subroot; an empty table has no rows. Texts of any
length are hashed as a whole; other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import written

ARITY = 16
# Nodes that share a window partition; a multiple of ARITY.
STRETCH = 256
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:binary,right:binary>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Binary SHA-256 of texts put together."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def as_text(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def field(value: Column) -> Column:
    """A value with its length in bytes in front, so that fields cannot run together."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text),
                      F.lit("-"))


def leaf_digest(fields: dict[str, Column]) -> Column:
    return digest(*[field(fields[name]) for name in FIELDS])


def tampered_text(docs_text: Column, doc_id: Column) -> Column:
    """Null where nothing is tampered with; else the text with A-Z in lower case."""
    chosen = F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, F.translate(docs_text, UPPER, LOWER))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, grp (the source as a key that sorts nulls first), leaf, altered (the leaf of
    the text after tampering, else null)."""
    fields = {name: docs[name] for name in FIELDS}
    other = tampered_text(docs["text"], docs["doc_id"])
    return docs.select(
        docs["doc_id"], F.coalesce(F.concat(F.lit("s"), docs["source"].cast("string")),
                                   F.lit("-")).alias("grp"),
        leaf_digest(fields).alias("leaf"),
        F.when(other.isNotNull(), leaf_digest(fields | {"text": other})).alias("altered"))


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Written rows with ``pos``, their place from 0 within ``grp``, and the group's ``n``.

    Sorted by range; a row's place is its index in its partition plus the rows of its group
    in earlier partitions. The counts have one row per group and partition.
    """
    # Equal rows must not all fall into one range.
    apart = rows.withColumn("tie", F.monotonically_increasing_id())
    keys = ["grp", *order, "tie"]
    placed = written(apart.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns({
        "part": F.spark_partition_id(),
        "idx": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    }).drop("tie"), f"{name}-sorted")
    counts = placed.groupBy("grp", "part").agg(
        F.count("*").alias("rows"), F.min("idx").alias("first"))
    group = Window.partitionBy("grp")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "grp", "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first"))
        .alias("shift"), F.sum("rows").over(group).alias("n"))
    return written(placed.join(starts, ["grp", "part"]).withColumn(
        "pos", F.col("idx") + F.col("shift")).drop("part", "idx", "shift"), f"{name}-placed")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes (grp, n, pos, digest, …) with run, left and right: the digests of the run's
    other nodes before and after them."""
    window = Window.partitionBy("grp", "stretch").orderBy("pos")
    slot, run = F.col("pos") % ARITY, F.floor(F.col("pos") / ARITY)
    length = F.least(F.lit(ARITY), F.col("n") - run * ARITY)
    empty = F.lit(b"")
    before = [F.when(slot >= k, F.lag("digest", k).over(window)) for k in range(ARITY - 1, 0, -1)]
    after = [F.when(slot + k < length, F.lead("digest", k).over(window))
             for k in range(1, ARITY)]
    return nodes.withColumn("stretch", F.floor(F.col("pos") / STRETCH)).withColumns({
        "run": run, "left": F.concat(*[F.coalesce(c, empty) for c in before]),
        "right": F.concat(*[F.coalesce(c, empty) for c in after]),
    }).drop("stretch")


def parents(nodes: DataFrame) -> DataFrame:
    """The level above: first children hash themselves and the nodes after them."""
    first = with_siblings(nodes.select("grp", "n", "pos", "digest")).where(
        F.col("pos") % ARITY == 0)
    return first.select("grp", F.ceil(F.col("n") / ARITY).alias("n"), F.col("run").alias("pos"),
                        digest(as_text(F.col("digest")), as_text(F.col("right"))).alias("digest"))


def levels(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Levels from the leaves up; a group's last node has n = 1 and is carried no further."""
    found = [nodes]
    while not (several := found[-1].where("n > 1")).isEmpty():
        found.append(written(parents(several), f"{name}-level"))
    return found


def tops(found: list[DataFrame]) -> DataFrame:
    """grp, digest of the node that remains of each group."""
    return reduce(DataFrame.union, [level.where("n = 1").select("grp", "digest")
                                    for level in found])


def paths(found: list[DataFrame], top_path: DataFrame, name: str) -> DataFrame:
    """Leaves with ``path``: siblings of each level, from the leaf to the root. ``top_path``
    (grp, path) holds what follows above the groups' last nodes."""
    above = None
    for i in range(len(found) - 1, -1, -1):
        level = found[i]
        step = F.array(F.struct("left", "right")).cast(PATH)
        last = level.where("n = 1").join(top_path, "grp")
        if above is not None:
            inner = with_siblings(level.where("n > 1")).join(
                above.select("grp", F.col("pos").alias("run"), F.col("path").alias("up")),
                ["grp", "run"])
            here = inner.withColumn("path", F.concat(step, "up")).select(*level.columns, "path")
            last = here.unionByName(last.select(*level.columns, "path"))
        above = last if i == 0 else written(last.select("grp", "pos", "path"), f"{name}-path")
    return above


def folded(leaf: Column, path: Column) -> Column:
    """Root that follows from a leaf and its siblings, as text."""
    return F.aggregate(path, as_text(leaf), lambda acc, x: F.sha2(
        F.concat(as_text(x["left"]), acc, as_text(x["right"])).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(
        as_text(x["left"]), as_text(x["right"]))), "").cast("binary"), 256)


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, source group, leaf, altered, subroot, root (binary) and
    path, the proof that the leaf belongs to the root."""
    # Written, as sorting by range reads its input twice, and texts are read once.
    placed = ranked(written(leaves(docs), "leaves"), ["doc_id", "leaf"], "leaves").withColumnRenamed(
        "leaf", "digest")
    found = levels(placed, "group")
    subroots = written(tops(found), "subroots")
    trees = ranked(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest"),
                   ["of"], "subroots")
    above = levels(trees, "top")
    none = F.array().cast(PATH)
    root = tops(above).withColumnRenamed("digest", "root")
    path = paths(above, root.select("grp", none.alias("path")), "top")
    groups = written(path.join(root, "grp").select(
        F.col("of").alias("grp"), F.col("digest").alias("subroot"), "root", "path"), "groups")
    proven = paths(found, groups.select("grp", "path"), "group")
    return proven.join(groups.drop("path"), "grp").select(
        "doc_id", "grp", F.col("digest").alias("leaf"), "altered", "subroot", "root", "path")


def verify(proofs: DataFrame) -> DataFrame:
    """Digest columns and the check of every leaf, after tampering, against the root."""
    found = folded(F.coalesce("altered", "leaf"), F.col("path"))
    return proofs.select(
        "doc_id", as_text(F.col("leaf")).alias("leaf"),
        as_text(F.col("subroot")).alias("subroot"), as_text(F.col("root")).alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"), found.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
