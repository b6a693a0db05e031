"""Quality rules as a short-circuit cascade.

Every rule rejects a text or lets it pass, and a text is kept if no rule rejects it, so the
verdict does not depend on the order of the rules; only the time does. On a bounded sample
(``SAMPLE_ROWS`` documents, chosen by a hash of their id) each rule is timed and the texts
it rejects are noted. The cascade then takes, again and again, the rule that rejects most of
the still unrejected sample per second, and over the whole table a text leaves at the first
rule that rejects it.

Null and empty texts have no words and are rejected. Ties between rules keep their listed
order. A table without rows gives a cascade in listed order. Repeated rows are judged alike.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import cached_property
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import arrow_of, hash_sample, map_rows, small_batches, to_batch

SAMPLE_ROWS = 1000
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
EMPHASIS = b"!?"


class Text:
    """One text with its measures, each computed when first asked for.

    Words are maximal runs without ASCII white space, which is how bytes.split() cuts.
    """

    def __init__(self, text: str | None):
        self.data = (text or "").encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(b"".join(self.words).decode())

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    @cached_property
    def n_emphasis(self) -> int:
        return len(self.data) - len(self.data.translate(None, EMPHASIS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.data.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_stutters(self) -> int:
        """Words equal to the word before."""
        return sum(map(eq, self.words, self.words[1:]))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words, WINDOW)


def repeated_words(words: list[bytes], width: int) -> int:
    """Words inside a window of ``width`` words that occurs at least twice.

    Windows are numbered exactly, by doubling: equal pairs of numbers get one number.
    """
    if len(words) <= width:
        return 0
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    codes = np.array([number(w, i) for i, w in enumerate(words)], np.int64)
    span = 1
    while span < width:
        step = min(span, width - span)
        pairs = codes[:-step] * (codes.max() + 1) + codes[step:]
        _, codes, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if counts.max() == 1:
            return 0
        span += step
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(counts[codes] > 1)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges) > 0).sum())


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Text], bool]


# The first two are the base rules; the others judge marks, lines and the length of words.
RULES = (
    Rule("few_words", lambda t: t.n_words < 20),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 30 * t.n_words),
    Rule("symbols", lambda t: 10 * t.n_symbols > 3 * t.n_words),
    Rule("emphasis", lambda t: 10 * t.n_emphasis > 3 * t.n_words),
    Rule("duplicate_lines", lambda t: 10 * (t.n_dup_lines - 1) > 3 * len(t.lines)),
    Rule("stutter", lambda t: 10 * t.n_stutters > 3 * t.n_words),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 20 * t.n_words),
)
BASE_RULES = RULES[:2]


def rejected(text: str | None, rules=RULES) -> bool:
    measured = Text(text)
    return any(rule.rejects(measured) for rule in rules)


def profile(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rejections and seconds on the sample: one row per set of rejecting rules (``mask``,
    a bit per rule) with its number of texts, and the summed seconds of each rule."""
    schema = "mask bigint, texts bigint, seconds array<double>"
    arrow_schema = arrow_of(docs.sparkSession, schema)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, list] = {}
            for text in batch.column(0).to_pylist():
                mask, seconds = 0, []
                for i, rule in enumerate(rules):
                    fresh = Text(text)  # what rules share is charged to each
                    began = time.perf_counter()
                    mask |= bool(rule.rejects(fresh)) << i
                    seconds.append(time.perf_counter() - began)
                row = found.setdefault(mask, [0, np.zeros(len(rules))])
                row[0] += 1
                row[1] += seconds
            yield to_batch([(m, n, s.tolist()) for m, (n, s) in found.items()], arrow_schema)

    small_batches(docs.sparkSession)
    sample = hash_sample(docs.select("doc_id", "text"), sample_rows, ["doc_id"]).select("text")
    parts = sample.mapInArrow(measure, schema)
    return parts.groupBy("mask").agg(F.sum("texts").alias("texts"), F.array(*[
        F.sum(F.col("seconds")[i]) for i in range(len(rules))]).alias("seconds"))


def order_rules(measured: list, rules=RULES) -> tuple[Rule, ...]:
    """Greedy order by rejections per second among the texts that earlier rules pass."""
    cost = [sum(row.seconds[i] for row in measured) + 1e-9 for i in range(len(rules))]
    left, chosen = {row.mask: row.texts for row in measured}, []
    while len(chosen) < len(rules):
        gain = {i: sum(n for mask, n in left.items() if mask >> i & 1) / cost[i]
                for i in range(len(rules)) if i not in chosen}
        best = max(gain, key=lambda i: (gain[i], -i))
        chosen.append(best)
        left = {mask: n for mask, n in left.items() if not mask >> best & 1}
    return tuple(rules[i] for i in chosen)


def plan_cascade(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> tuple:
    """The rules in the order that the sample suggests; runs one small job.

    The driver gets at most one row per set of rules that reject a text of the sample.
    """
    return order_rules(profile(docs, rules, sample_rows).collect(), rules)


def keep_good(docs: DataFrame, rules=RULES) -> DataFrame:
    """The documents that no rule rejects, all columns unchanged."""
    ordered = plan_cascade(docs, rules)
    schema = docs.schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [not rejected(t, ordered) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def assess(docs: DataFrame, rules=RULES) -> DataFrame:
    """One row per document: base counts, base verdict, verdict of the cascade."""
    ordered = plan_cascade(docs, rules)

    def each(doc_id, text):
        t = Text(text)
        base_failed = any(rule.rejects(t) for rule in BASE_RULES)
        kept = not base_failed and not any(rule.rejects(t) for rule in ordered)
        return (doc_id, t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines,
                t.n_repeat_words, base_failed, kept)

    return map_rows(docs.select("doc_id", "text"), each, (
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
        "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean"))
