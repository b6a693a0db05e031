"""Spelling variants of the words of a corpus, by a trie that lives in tables.

Two words are near if one inserted, deleted or replaced code point makes one the other. The
vocabulary's trie is a table of edges (node, letter, what may follow). A frontier of states
(word, position, node, edits) is joined with the edges of one depth after the other; a state
whose word and path end together after one edit names a neighbour.

A word and its neighbour agree before or behind the edit, so states need not branch at the
crowded nodes near the root: in a trie of the words from left to right only edits in the
second half are tried, and in one of the reversed words those in the first half. Both live in
the same tables; nodes are named by a mark of their direction and the letters so far. A
replacement is tried towards the greater letter only and a deletion is the other side's
insertion, so most pairs are found once; what remains twice is merged. An edge tells by a
bit mask which letters follow its node, so a state that would fail at the next letter is not
written.

States are at most positions times letters a word, whatever the other words are; words that
share a node are dealt out again by the join. Words longer than ``LONGEST`` would take as many
rounds as they have letters: for them the hashes of all texts with one letter deleted are
joined, a fixed number of rounds with the same result.

Null texts have no words, texts are read whole. Repeated rows count each time; a null id is
written as empty text. Of near words with equal counts the smaller in code-point order wins.
Further columns are not looked at; a table without words gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import arrow_of, small_batches, written

LEAST_LETTERS, LEAST_COUNT = 5, 3
# One run in so many loses a letter before it is counted (see ``misspelt``).
DROP_EVERY = 97
# Words up to this length go through the trie.
LONGEST = 24
# Different words that a worker counts before it hands them on.
COUNTED = 200_000
MODULUS, BASE = (1 << 127) - 1, 0x1F3D5B79A8C6E4F2


def _letters() -> bytes:
    """Latin-1 table: letters, A-Z in lower case, everything else a space."""
    kept = {*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)}
    lower = [b + 32 if ord("A") <= b <= ord("Z") else b for b in range(256)]
    return bytes(b if b in kept else 32 for b in lower)


LETTERS = _letters()


def runs(text: str | None) -> list[bytes]:
    """Runs of letters as Latin-1; characters beyond it are no letters."""
    return (text or "").encode("latin-1", "replace").translate(LETTERS).split()


def misspelt(run: bytes, prefix: int) -> bytes:
    """The run, without one letter where DROP_EVERY divides its hash. ``prefix`` is the crc32
    of the document's id and a colon."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % DROP_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def words_of(doc_id: int | None, text: str | None) -> Counter:
    """Words of a document with their counts; equal runs of it change alike."""
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter = Counter()
    for run, n in Counter(runs(text)).items():
        if len(run) >= LEAST_LETTERS:
            word = misspelt(run, prefix)
            if len(word) >= LEAST_LETTERS:
                found[word] += n
    return found


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n of all words with LEAST_COUNT occurrences; counted in the tasks first."""
    schema = "word string, n bigint"
    arrow_schema = arrow_of(docs.sparkSession, schema)

    def batch_of(counts: Counter) -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in counts]
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())],
            schema=arrow_schema)

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                counts.update(words_of(doc_id, text))
                if len(counts) > COUNTED:
                    yield batch_of(counts)
                    counts.clear()
        yield batch_of(counts)

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, schema).groupBy("word").agg(
        F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# ---- the trie ------------------------------------------------------------------------

def letter(word: Column, at: Column) -> Column:
    """The letter at a position from 0, empty behind the end."""
    return word.substr(at + 1, F.lit(1))


def bit_of(char: Column) -> Column:
    """Bit of a letter in a mask; some letters beyond z share one."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.ascii(char) % 61)


def oriented(words: DataFrame) -> DataFrame:
    """Each word in both directions: mark, word, n, size, half (where branching begins)."""
    size = F.length("word")
    middle = F.floor(size / 2)
    both = F.array(F.struct(F.lit(">").alias("mark"), "word", middle.alias("half")),
                   F.struct(F.lit("<").alias("mark"), F.reverse("word").alias("word"),
                            (size - middle).alias("half")))
    return words.select("n", size.alias("size"), F.explode(both).alias("w")).select(
        "w.mark", "w.word", "n", "size", F.col("w.half").cast("int").alias("half"))


def node(depth: int) -> Column:
    return F.concat("mark", F.substring("word", 1, depth))


def edges(sides: DataFrame, depth: int) -> DataFrame:
    """Edges that leave the nodes of a depth: node, letter, follow (mask of the letters behind
    it), end (count of the word that ends there, else null)."""
    after = letter(F.col("word"), F.lit(depth + 1))
    return sides.where(F.col("size").between(depth + 1, LONGEST + 1)).select(
        node(depth).alias("node"), letter(F.col("word"), F.lit(depth)).alias("letter"),
        F.when(after != "", bit_of(after)).otherwise(0).alias("bit"),
        F.when(F.col("size") == depth + 1, F.col("n")).alias("end"),
    ).groupBy("node", "letter").agg(F.bit_or("bit").alias("follow"), F.max("end").alias("end"))


def step(frontier: DataFrame, sides: DataFrame, depth: int) -> DataFrame:
    """States (word, n, position, node, end) of the next depth; ``end`` is set where a word
    and its path have ended together, which makes them neighbours.

    ``frontier`` holds states with their edit behind them. Words whose branching part has
    begun join them with none: up to here they follow their own path.
    """
    fresh = sides.where((F.col("half") <= depth) & (F.col("size").between(depth, LONGEST)))
    states = fresh.select("word", "n", F.lit(depth).alias("position"),
                          node(depth).alias("node"), F.lit(0).alias("edits"))
    if frontier is not None:
        states = states.union(frontier.where("end IS NULL").select(
            "word", "n", "position", "node", F.lit(1).alias("edits")))
    here = letter(F.col("word"), F.col("position"))
    edited, same = F.col("edits") == 1, F.col("letter") == here
    replaces = (F.col("letter") > here) & (here != "")
    # A letter inserted before its equal is the same word as behind it.
    moves = (F.when(edited & same, F.array(F.lit(1)))
             .when(edited | same, F.array().cast("array<int>"))
             .when(replaces, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    moved = states.join(edges(sides, depth), "node").select(
        "word", "n", F.explode(moves).alias("move"), "position",
        F.concat("node", "letter").alias("node"), "follow", "end",
    ).withColumn("position", F.col("position") + F.col("move"))
    ahead = letter(F.col("word"), F.col("position"))
    return moved.where(
        F.when(ahead == "", F.col("end").isNotNull())
        .otherwise(F.col("follow").bitwiseAND(bit_of(ahead)) != 0)
    ).select("word", "n", "position", "node", F.when(ahead == "", F.col("end")).alias("end"))


def trie_pairs(words: DataFrame) -> DataFrame:
    """a, n_a, b, n_b of near words of which one has at most LONGEST letters; once or twice."""
    sides = written(oriented(words.where(F.length("word") <= LONGEST + 1)), "sides")
    longest = sides.agg(F.max("size")).first()[0] or 0
    found, frontier = [], None
    for depth in range(LEAST_LETTERS // 2, min(longest, LONGEST + 1)):
        frontier = written(step(frontier, sides, depth), "frontier")
        found.append(frontier.where("end IS NOT NULL"))
    if not found:
        return words.sparkSession.createDataFrame(
            [], "a string, n_a bigint, b string, n_b bigint")
    ends = reduce(DataFrame.union, found)
    forward = F.substring("node", 1, 1) == ">"
    path = F.substring("node", 2, LONGEST + 1)
    return ends.select(
        F.when(forward, F.col("word")).otherwise(F.reverse("word")).alias("a"),
        F.col("n").alias("n_a"),
        F.when(forward, path).otherwise(F.reverse(path)).alias("b"), F.col("end").alias("n_b"))


# ---- long words ----------------------------------------------------------------------

def shortened(word: bytes):
    """Hash of the word, then of the word without its letter i for every i."""
    powers, sums = [1], [0]
    for c in word:
        sums.append((sums[-1] * BASE + c + 1) % MODULUS)
        powers.append(powers[-1] * BASE % MODULUS)
    yield sums[-1]
    for i in range(len(word)):
        yield (sums[-1] - (sums[i + 1] - sums[i]) * powers[len(word) - 1 - i]) % MODULUS


def long_pairs(words: DataFrame) -> DataFrame:
    """Near words of more than LONGEST letters each. A replacement leaves the same text
    without one place, an insertion leaves the shorter word. At most one word per letter
    shares a place and a text, so no group is large."""
    long = written(words.where(F.length("word") > LONGEST), "long-words")
    schema = "id binary, place int, rest binary"
    arrow_schema = arrow_of(words.sparkSession, schema)

    def run(batches):
        for batch in batches:
            for word in batch.column(0).to_pylist():
                hashes = shortened(word.encode("latin-1"))
                own, rows = next(hashes).to_bytes(16), []
                rows.append((own, -1, own))
                for place, value in enumerate(hashes):
                    rows.append((own, place, value.to_bytes(16)))
                    if len(rows) >= 10_000:
                        yield rows_batch(rows)
                        rows = []
                yield rows_batch(rows)

    def rows_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in
             zip(zip(*rows) if rows else [()] * 3, arrow_schema)], schema=arrow_schema)

    small_batches(words.sparkSession)
    rests = written(long.select("word").mapInArrow(run, schema), "long-rests")
    whole, cut = rests.where("place = -1"), rests.where("place >= 0")
    other = cut.select(F.col("id").alias("other"), "place", "rest")
    replaced = cut.join(other, ["place", "rest"]).where("id < other").select("id", "other")
    inserted = whole.join(cut.select(F.col("id").alias("other"), "rest"), "rest").select(
        "id", "other")
    ids = long.join(written(long.select("word").mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([next(shortened(w.encode("latin-1"))).to_bytes(16)
                                    for w in b.column(0).to_pylist()], pa.binary())],
            names=["word", "id"]) for b in batches), "word string, id binary"), "long-ids"),
        "word")
    first = ids.select("id", F.col("word").alias("a"), F.col("n").alias("n_a"))
    second = ids.select(F.col("id").alias("other"), F.col("word").alias("b"),
                        F.col("n").alias("n_b"))
    return replaced.union(inserted).distinct().join(first, "id").join(second, "other").select(
        "a", "n_a", "b", "n_b")


# ---- forms ---------------------------------------------------------------------------

def near_pairs(words: DataFrame) -> DataFrame:
    """word, near, near_n: every near word of every word, both ways."""
    pairs = trie_pairs(words)
    if not words.where(F.length("word") > LONGEST).isEmpty():
        pairs = pairs.union(long_pairs(words))
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("n")))
    return pairs.select(F.explode(both).alias("p")).groupBy("p.word", "p.near").agg(
        F.max("p.n").alias("near_n"))


def followed(forms: DataFrame) -> DataFrame:
    """word, root of (word, form): the last form that can be reached. Forms at least double
    in count, so chains are short and end; every round doubles the steps taken."""
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        beyond = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(roots.join(beyond, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "roots")
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return roots


def variants(docs: DataFrame) -> DataFrame:
    """One row per word: word, n, n_near, form and form_n (null without), root."""
    words = written(vocabulary(docs), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near"))
    near = near_pairs(words).groupBy("word").agg(
        F.count("*").alias("n_near"), best.alias("best"))
    chosen = -F.col("best.n") >= 2 * F.col("n")
    judged = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(chosen, F.col("best.near")).alias("form"),
        F.when(chosen, -F.col("best.n")).alias("form_n")), "forms")
    roots = followed(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
