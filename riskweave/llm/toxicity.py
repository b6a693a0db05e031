"""Toxicity scores of texts restored by a noisy channel.

Writers hide words by digits and signs for letters, by spreading a word over separators and
by repeating letters. Such a stretch is a lattice: every character may stand for itself, for
the letters it looks like, for a repeat of the letter before, or, if it is a separator, for
nothing or for a word's end. Viterbi decoding finds the cheapest path under a character
model of four letters, counted over all texts, plus the cost of each disguise. Plain words
have a single path and stay.

Letters with accents count as their base letters throughout. Tokens of any length are decoded.

Restored words (plain ones where there is no disguise) and their beginnings are then scored: a feature's weight is the lower end
of a confidence interval of its log odds among labelled texts, a text's score the base odds
times the odds of its strongest feature. Weights are learned from at most ``TRAINING_ROWS``
labelled rows, chosen by a hash of their id; equal texts count once.

Null and empty texts get the base rate, as do texts without a known feature; without labels
the base rate is 0. Labels without a document teach nothing. Repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import arrow_of, bucket_of, hash_sample, small_batches, to_batch, written

TRAINING_ROWS = 20_000
FOLDS, HELD_OUT = 5, 0
# Letters a to z; 0 is a word's edge.
LETTERS = 27
ORDER = 4
SMOOTHING = 5.0
CONFIDENCE = 2.0
LEAST_TEXTS = 4  # with a feature, among the toxic ones
PREFIXES = range(3, 9)
ODD_FACTORS = (2654435761, 2246822519)
SKETCHES = len(ODD_FACTORS)
LONG_WORD = 6
COMMONEST_SHARE = 0.5  # of a beginning's toxic texts that one word may have
EVERY_TEXT = ""  # a feature that every text has
MEMO_TOKENS = 500_000
BLOCK = 1 << 22

# Letters that digits and signs stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c",
}
SEPARATORS = " .-_*·"
DISGUISE, REPEAT, SEPARATOR, ODD = 1.0, 0.4, 0.2, 6.0

OUTER = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "@$|+(!")
OUTER += "«»“”‘’…–—¿¡"
SIGNS_AT_END = re.compile(r"[@$|+(!]{2,}$|!+$|^[@$|+(!]{3,}")
PLAIN = re.compile(r"[^\W\d_]+")
LONG_RUN = re.compile(r"([^\W\d_])\1\1")
SPREAD = re.compile(r"[a-z0-9@$!|+](?:[.\-_*·][a-z0-9@$!|+]){2,}")
SPACED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|+])(?: (?:[^\W_]|[@$!|+])){2,}(?!\S)")
HAS_LETTER = re.compile(r"[a-z]")


# ---- character model -----------------------------------------------------------------

def letter_codes() -> np.ndarray:
    """Latin-1 byte to letter code: base letters to 1-26, anything else to 0."""
    base = [chr(BASE_LETTERS[b]).lower() for b in range(256)]
    return np.array([ord(c) - 96 if "a" <= c <= "z" else 0 for c in base], np.int32)


def count_grams(texts: list[bytes]) -> np.ndarray:
    """Counts of four letters in a row; what lies before a word's edge is forgotten."""
    total = np.zeros(LETTERS ** ORDER, np.int64)
    codes_of = letter_codes()
    for text in texts:
        for at in range(0, len(text), BLOCK):
            part = codes_of[np.frombuffer(text[at:at + BLOCK], np.uint8)]
            c = np.concatenate(([0], part, [0]))
            c = c[np.concatenate(([True], (c[1:] != 0) | (c[:-1] != 0)))]
            if len(c) < 2:
                continue
            c = np.concatenate(([0, 0], c))
            first, second, third, fourth = c[:-3], c[1:-2], c[2:-1], c[3:]
            second = np.where(third == 0, 0, second)
            first = np.where(second == 0, 0, first)
            total += np.bincount(((first * LETTERS + second) * LETTERS + third) * LETTERS
                                 + fourth, minlength=len(total))
    return total


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a letter after three others, from all texts.

    The driver gets at most LETTERS ** ORDER counts, whatever the size of the input.
    """
    schema = "gram int, n bigint"
    arrow_schema = arrow_of(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS ** ORDER, np.int64)
        for batch in batches:
            joined, size = [], 0
            for text in batch.column(0).to_pylist():
                joined.append((text or "").encode("latin-1", "replace"))
                size += len(joined[-1])
                if size > BLOCK:
                    total += count_grams([b" ".join(joined)])
                    joined, size = [], 0
            total += count_grams([b" ".join(joined)])
        grams = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(grams, pa.int32()), pa.array(total[grams], pa.int64())],
            schema=arrow_schema)

    small_batches(docs.sparkSession)
    rows = docs.select("text").mapInArrow(run, schema).groupBy("gram").agg(
        F.sum("n").alias("n")).collect()
    counts = np.zeros(LETTERS ** ORDER)
    for row in rows:
        counts[row.gram] = row.n
    return log_probabilities(counts)


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Each order is smoothed by the next lower one."""
    lower = np.full(LETTERS, 1 / LETTERS)
    for order in range(1, ORDER + 1):
        shape = (LETTERS,) * ORDER
        own = counts.reshape(shape).sum(axis=tuple(range(ORDER - order)))
        lower = (own + SMOOTHING * lower) / (own.sum(axis=-1, keepdims=True) + SMOOTHING)
    return np.log(lower).astype(np.float32).ravel()


# ---- decoding ------------------------------------------------------------------------

def folded(text: str) -> str:
    """The text with accented Latin letters as their base letters."""
    return text if text.isascii() else text.translate(BASE_LETTERS)


class BaseLetters(dict):
    """Code point -> base letter, or itself; found when first asked for."""

    def __missing__(self, code: int) -> int:
        base = unicodedata.normalize("NFD", chr(code))[0].lower()
        self[code] = ord(base) if "a" <= base <= "z" else code
        return self[code]


BASE_LETTERS = BaseLetters()

def decode(disguised: str, model) -> str:
    """Cheapest words, separated by spaces, behind a stretch of lower-case text.

    A path is a chain of (path before, letter), so time and memory grow with the length only.
    """
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    context = LETTERS ** (ORDER - 1)
    for c in disguised:
        reached: dict[int, tuple[float, tuple | None]] = {}

        def offer(state: int, cost: float, out: tuple | None) -> None:
            if state not in reached or cost < reached[state][0]:
                reached[state] = cost, out

        options = ([(c, 0.0)] if "a" <= c <= "z" else []) + [(x, DISGUISE) for x in LOOKS_LIKE.get(c, "")]
        separates = c in SEPARATORS
        for state, (cost, out) in states.items():
            for letter, extra in options:
                code = ord(letter) - 96
                if state % LETTERS == code:
                    offer(state, cost + extra + REPEAT, out)
                offer((state * LETTERS + code) % context,
                      cost + extra - model[state * LETTERS + code], (out, letter))
            if separates:
                offer(state, cost + SEPARATOR, out)
            if separates or not options:
                edge = cost - model[state * LETTERS] + (SEPARATOR if separates else ODD)
                offer(0, edge, (out, " "))
        states = reached
    at = min(states.items(), key=lambda s: s[1][0] - model[s[0] * LETTERS])[1][1]
    letters = []
    while at is not None:
        at, letter = at
        letters.append(letter)
    return "".join(reversed(letters))


def core_of(token: str) -> str:
    return SIGNS_AT_END.sub("", token.strip(OUTER)).strip(OUTER)


def disguised(core: str) -> bool:
    """Whether a token of lower-case base letters may hide words."""
    return bool(HAS_LETTER.search(core)) and bool(
        SPREAD.fullmatch(core) or any(c in LOOKS_LIKE for c in core) or LONG_RUN.search(core))


def words_of(token: str, model) -> list[str]:
    """Words behind a token without white space, in lower-case base letters."""
    core = core_of(folded(token))
    return decode(core, model).split() if disguised(core) else PLAIN.findall(core)


def restore_text(text: str | None, model) -> str | None:
    """The text with every disguised stretch replaced by what it stands for."""
    if text is None:
        return None

    def token(found):
        core = core_of(folded(found[0].lower()))
        restored = decode(core, model) if disguised(core) else ""
        return restored or found[0]

    spaced = SPACED.sub(lambda m: decode(folded(m[0].lower()), model), text)
    return re.sub(r"\S+", token, spaced)


def restore_documents(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """All columns, disguised stretches of ``text`` restored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema, at = docs.schema, docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = [restore_text(t, shared.value) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, pa.string()))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)


# ---- features and weights ------------------------------------------------------------

def features_of(words: Iterable[str]) -> set[str]:
    """Whole words, marked by $, and the beginnings of words."""
    out = {w + "$" for w in words}
    for w in words:
        out.update(w[:n] for n in PREFIXES if n <= len(w))
    return out


def tokens_of(text: str, model) -> Iterator[tuple[str, list[str] | None]]:
    """Distinct tokens; those spread over single characters come with their words."""
    lowered = text.lower()
    for token in set(lowered.split()):
        yield token, None
    for found in SPACED.finditer(lowered):
        stretch = folded(found[0])
        if HAS_LETTER.search(stretch):
            yield stretch, decode(stretch, model).split()


def least_hashes(words: Iterable[str]) -> list[int]:
    """SKETCHES numbers that near copies of a text mostly share: the least hash of its long
    words under several hash functions, each marked by its function."""
    hashes = [crc32(w.encode()) for w in words if len(w) >= LONG_WORD] or [
        crc32(w.encode()) for w in words] or [0]
    return [min((h * odd) & 0xFFFFFFFF for h in hashes) * SKETCHES + i
            for i, odd in enumerate(ODD_FACTORS)]


def sketch_count(own: int):
    return F.size(F.filter("toxic", lambda h: h % SKETCHES == own))


def learn(docs: DataFrame, labels: DataFrame, model, rows: int = TRAINING_ROWS
          ) -> tuple[float, dict[str, float]]:
    """Base log odds, and the weights of all features that speak for label 1."""
    spark = docs.sparkSession
    chosen = hash_sample(labels.where("toxic IS NOT NULL").where(
        bucket_of(F.col("doc_id"), FOLDS) != HELD_OUT).select("doc_id", "toxic"), rows,
        ["doc_id", "toxic"])
    # Bounded by ``rows`` narrow rows.
    sample = written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn(
        "hash", F.xxhash64("text")).dropDuplicates(["hash", "toxic"]).select("text", "toxic"),
        "labelled")
    schema = "feature string, toxic array<bigint>, clean bigint"
    arrow_schema = arrow_of(spark, schema)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            clean, toxic = Counter(), {}
            for text, label in zip(*(c.to_pylist() for c in batch.columns)):
                found: set[str] = set()
                for token, words in tokens_of(text or "", shared.value):
                    found.update(words_of(token, shared.value) if words is None else words)
                features = features_of(found) | {EVERY_TEXT}
                if label:
                    sketch = least_hashes(found)
                    for feature in features:
                        toxic.setdefault(feature, set()).update(sketch)
                else:
                    clean.update(features)
            yield to_batch([(f, sorted(toxic.get(f, ())), clean[f])
                            for f in clean.keys() | toxic.keys()], arrow_schema)

    totals = {bool(r.toxic): r["n"] for r in sample.groupBy(
        (F.col("toxic") != 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = totals.get(True, 0), totals.get(False, 0)
    if not n_toxic:
        return -math.inf, {}
    small_batches(spark)
    # Copies of one text have few sketches, so they count as few texts. All bounded by
    # the sample.
    sketches = F.array_distinct(F.flatten(F.collect_list("toxic")))
    counted = written(sample.mapInArrow(run, schema).groupBy("feature").agg(
        sketches.alias("toxic"), F.sum("clean").alias("c")).select("feature", "c", F.greatest(*[
            sketch_count(own) for own in range(SKETCHES)]).alias("t")).where(f"t >= {LEAST_TEXTS}"), "features")
    # The texts that features are counted among, in the same unit.
    among = counted.where(F.col("feature") == EVERY_TEXT).first()
    if among is None:
        return math.log((n_toxic + 0.5) / (n_clean + 0.5)), {}
    # A beginning counts for itself only if many words share it.
    shared_most = counted.where("feature LIKE '%$'").select("t", F.explode(F.array(*[
        F.when(F.length("feature") > n, F.substring("feature", 1, n)) for n in PREFIXES]))
        .alias("feature")).groupBy("feature").agg(F.max("t").alias("most"))
    counted = counted.join(shared_most, "feature", "left").where(
        f"feature LIKE '%$' OR coalesce(most, 0) <= {COMMONEST_SHARE} * t")
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    weight = (F.log(t / (among.t + 1)) - F.log(c / (among.c + 1))
              - CONFIDENCE * F.sqrt(1 / t + 1 / c))
    weighted = counted.where(F.col("feature") != EVERY_TEXT).select(
        "feature", weight.alias("weight")).where("weight > 0.5").collect()
    return (math.log((n_toxic + 0.5) / (n_clean + 0.5)),
            {r.feature: r.weight for r in weighted})


# ---- scores --------------------------------------------------------------------------

def score_documents(docs: DataFrame, model, base: float, weights: dict[str, float]
                    ) -> DataFrame:
    """doc_id, score, predicted, evidence (the strongest feature, null if there is none)."""
    schema = "doc_id bigint, score double, predicted int, evidence string"
    arrow_schema = arrow_of(docs.sparkSession, schema)
    shared = docs.sparkSession.sparkContext.broadcast((model, base, weights))
    nothing = (0.0, None)

    def run(batches):
        own_model, own_base, own_weights = shared.value
        memo: dict[str, tuple[float, str | None]] = {}

        def strongest(words: list[str]) -> tuple[float, str | None]:
            hits = [(own_weights[f], f) for f in features_of(words) if f in own_weights]
            return max(hits, default=nothing)

        def of(token, words):
            known = memo.get(token)
            if known is None:
                if len(memo) >= MEMO_TOKENS:
                    memo.clear()
                known = strongest(words_of(token, own_model) if words is None else words)
                if words is None and len(token) <= 64:
                    memo[token] = known
            return known

        def one(doc_id, text):
            weight, feature = max((of(*t) for t in tokens_of(text or "", own_model)),
                                  key=lambda hit: (hit[0], hit[1] or ""), default=nothing)
            odds = own_base + weight
            score = 0.0 if odds == -math.inf else 1 / (1 + math.exp(-odds))
            return doc_id, score, int(score >= 0.5), feature

        for batch in batches:
            yield to_batch([one(*row) for row in zip(*(c.to_pylist() for c in batch.columns))],
                           arrow_schema)

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: held_out, score, predicted, evidence."""
    model = character_model(docs)
    base, weights = learn(docs, labels, model)
    return score_documents(docs, model, base, weights).select(
        "doc_id", (bucket_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        "predicted", "evidence")
