"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of ``DIMENSIONS`` signs, drawn from its code point.
A trigram's vector is the product of its letters' vectors, the first rotated by two places,
the second by one. A document's vector is the sum of its trigram vectors, a language's
prototype the sum of the unit vectors of its training documents, and a document gets the
language whose prototype has the largest cosine with it. Runs of other characters count as
one boundary letter.

Prototypes are summed in whole numbers, so results do not depend on the order of rows. The
driver holds one vector per language.

Null texts and texts without letters are ``und`` with score 0, and teach nothing; so do rows
with a null language. Ties go to the first language in order. Without training rows every
document is ``und``. Repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import arrow_of, bucket_of, small_batches, to_batch

DIMENSIONS = 512
SEED = 20240131
UNIT = 1 << 20  # whole numbers per unit length
REMEMBERED = 60_000  # trigram vectors that a worker keeps at most
BITS = 21  # of a code point
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2


@cache
def letters() -> np.ndarray:
    """For every code point: itself if it is a letter, else 0."""
    points = np.arange(0x110000, dtype=np.int64)
    is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return np.where(is_letter, points, 0)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter trigrams of the lower-cased text, with their counts."""
    raw = (text or "").lower().encode("utf-32-le", "surrogatepass")
    codes = letters()[np.frombuffer(raw, np.uint32)]
    if not codes.any():
        return codes[:0], codes[:0]
    codes = np.concatenate(([0], codes, [0]))
    codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
    joined = (codes[:-2] << 2 * BITS) | (codes[1:-1] << BITS) | codes[2:]
    return np.unique(joined, return_counts=True)


class TrigramVectors:
    """Vectors of trigrams, computed when first needed."""

    def __init__(self):
        self.rows: dict[int, int] = {}
        self.table = np.empty((1024, DIMENSIONS), np.float32)
        self.letters: dict[int, np.ndarray] = {}

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            raw = np.random.PCG64([SEED, code]).random_raw(DIMENSIONS // 64)
            bits = np.unpackbits(raw.view(np.uint8)).astype(np.int8)
            self.letters[code] = 2 * bits - 1
        return self.letters[code]

    def bound(self, trigram: int) -> np.ndarray:
        mask = (1 << BITS) - 1
        a, b, c = trigram >> 2 * BITS, trigram >> BITS & mask, trigram & mask
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def bundle(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the trigram vectors; trigrams beyond the table's bound are added apart."""
        out = np.zeros(DIMENSIONS, np.float32)
        keys, rows = found.tolist(), self.rows
        at = [rows.get(k, -1) for k in keys]
        if -1 in at:
            for i, (key, place) in enumerate(zip(keys, at)):
                if place >= 0:
                    continue
                if len(rows) < REMEMBERED:
                    if len(rows) == len(self.table):
                        self.table = np.concatenate((self.table, np.empty_like(self.table)))
                    at[i] = rows[key] = len(rows)
                    self.table[at[i]] = self.bound(key)
                else:
                    out += counts[i] * self.bound(key)
            places = np.array(at)
            known = places >= 0
            return out + counts[known].astype(np.float32) @ self.table[places[known]]
        return counts.astype(np.float32) @ self.table[at]


@cache
def vectors() -> TrigramVectors:
    return TrigramVectors()


def profile(text: str | None) -> np.ndarray | None:
    """Unit vector of a text, None if it has no letters."""
    found, counts = trigrams(text)
    if not len(found):
        return None
    out = vectors().bundle(found, counts)
    length = np.sqrt(np.dot(out, out))
    return out / length if length else out


def learn(rows: DataFrame) -> dict[str, np.ndarray]:
    """Unit prototype per non-null ``lang`` of the rows, from all their texts."""
    schema = "lang string, total array<bigint>"
    arrow_schema = arrow_of(rows.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                vector = profile(text)
                if vector is not None:
                    total = totals.setdefault(lang, np.zeros(DIMENSIONS, np.int64))
                    total += np.rint(vector * UNIT).astype(np.int64)
        yield to_batch([(k, v.tolist()) for k, v in totals.items()], arrow_schema)

    small_batches(rows.sparkSession)
    partial = rows.where("lang IS NOT NULL").select("text", "lang").mapInArrow(run, schema)
    summed = partial.select("lang", F.posexplode("total")).groupBy("lang", "pos").agg(
        F.sum("col").alias("total")).groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("pos", "total"))).alias("totals"))
    out = {}
    for row in summed.select("lang", "totals.total").collect():
        vector = np.array(row.total, np.float64)
        out[row.lang] = vector / (np.linalg.norm(vector) or 1.0)
    return out


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score (largest cosine, at least 0)."""
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] for n in names]).reshape(len(names), DIMENSIONS)
    schema = "doc_id bigint, lang_pred string, score double"
    arrow_schema = arrow_of(docs.sparkSession, schema)

    def one(doc_id, text):
        vector = profile(text)
        if vector is None or not names:
            return doc_id, UNKNOWN, 0.0
        cosines = matrix @ vector
        best = int(cosines.argmax())
        return doc_id, names[best], float(min(1.0, max(0.0, cosines[best])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield to_batch([one(*row) for row in zip(*(c.to_pylist() for c in batch.columns))],
                           arrow_schema)

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: held_out, lang_pred, score; learns from the other folds."""
    held_out = bucket_of(F.col("doc_id"), FOLDS) == HELD_OUT
    prototypes = learn(docs.where(~held_out).select("text", "lang"))
    return predict(docs, prototypes).select("doc_id", held_out.alias("held_out"), "lang_pred",
                                            "score")
