"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are the queries, the passages of all documents (windows of ``WINDOW_BLOCKS``
blocks of ``BLOCK`` words, one at every block) the searched rows. Items of more than
``LONGEST_PIECE`` words are cut into pieces of at most a window, each a query row of its own, as
no window could hold half of such an item. Words are weighted by their inverse document
frequency over all documents.

Two latent spaces are made by randomised SVD; the power iterations are aggregations over the
passages, the driver only orthogonalises a matrix with one row per term. That of the corpus is
fitted to the weighted passages of all documents: every word has one of ``SLOTS`` terms by its
hash, so that none is left out, and words that occur together come close. That of the items is
fitted to their pieces, with the words of the items as terms, and has a dimension for each piece,
so that no copy is lost among the corpus' few dimensions. Every passage of every document is
compared with every piece by its cosine in the items' space. Passages above ``LEAST_COSINE``
are checked, and those above ``LEAST_SHARED`` that are about the same by their cosine in the
corpus' space (``LEAST_LATENT``): the longest common subsequence of words of the whole item and
the region around decides, together with the item's last words, its answer, if the rest was
rephrased.

Items are taken in blocks of ``ITEMS_PER_PASS`` pieces, each a pass over the documents (the
corpus' space is fitted once for all of them), so memory does not grow with the benchmark (one item is never divided between passes). Items with fewer than ``LEAST_WORDS`` words are too short
for a rephrased form to tell; they match where their words stand next to each other in order,
looked up by their first word in the same pass. Items without words never match. Null and empty texts match nothing; repeated rows give repeated
pairs; ties between passages keep the first.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import arrow_of, small_batches, to_batch, written

BLOCK = 16
WINDOW_BLOCKS = 3
# Items share few rare words, so a space of fewer dimensions than items would lose some.
RANK, OVERSAMPLED, POWER_ITERATIONS = 256, 272, 1
SLOTS, CORPUS_RANK = 1 << 15, 64  # terms and dimensions of the corpus' space
SEED = 7
ITEMS_PER_PASS = 256  # pieces of items; most items are one piece
LONGEST_PIECE = 60  # half of its words, each followed by another one, still fill LEAST_LENGTH
LEAST_WORDS = 8
LEAST_COSINE = 0.45
# Cosines in the items' and the corpus' space that are enough together.
LEAST_SHARED, LEAST_LATENT = 0.35, 0.8
LEAST_LENGTH = 0.4  # of a passage's vector, as a share of the piece's
# Shares of an item's words, in order, that make a match; the lower one needs the answer.
COPIED, REPHRASED = 0.8, 0.5
ANSWER_WORDS, ANSWER_SHARE = 8, 0.85
CHUNK_WORDS = 1 << 16
MANY = 32  # words of one term, from which a product is faster than adding one by one

# ASCII letters and digits and all bytes of other characters make up words.
WORD_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(WORD_BYTES).split()


class Index(NamedTuple):
    """What a pass over the documents needs; all of it is bounded by ITEMS_PER_PASS."""
    item_ids: list[int]
    item_words: list[list[bytes]]
    terms: dict[bytes, int]
    weighted: np.ndarray  # latent vector of each term times its weight; last row: no term
    pieces: list[tuple[int, int, int]]  # place of the item, first word, end of every piece
    piece_vectors: np.ndarray  # unit latent vectors of the pieces
    piece_lengths: np.ndarray  # of the vectors before that
    short: dict[bytes, list[tuple[int, list[bytes]]]]  # first word -> id and words of an item
    corpus: np.ndarray  # latent vector of each slot times its weight; last row: no word
    piece_corpus: np.ndarray  # unit latent vectors of the pieces in the corpus' space


def pieces_of(n: int) -> list[tuple[int, int]]:
    """First word and end of the nearly equal pieces of an item of n words."""
    count = 1 if n <= LONGEST_PIECE else -(-n // (WINDOW_BLOCKS * BLOCK))
    ends = [n * i // count for i in range(count + 1)]
    return list(zip(ends, ends[1:]))


def term_numbers(words: list[bytes], terms: dict[bytes, int]) -> np.ndarray:
    return np.fromiter(map(terms.get, words, repeat(len(terms))), np.int64, len(words))


def slots_of(words: list[bytes]) -> np.ndarray:
    """Terms of the words in the corpus' space."""
    return (np.fromiter(map(crc32, words), np.int64, len(words)) % SLOTS).astype(np.int32)


def in_blocks(numbers: np.ndarray, none: int, spare: int = 0) -> np.ndarray:
    """Term numbers in rows of a block, with some empty blocks after them."""
    out = np.full((-(-len(numbers) // BLOCK) + spare, BLOCK), none, np.int32)
    out.ravel()[:len(numbers)] = numbers
    return out


def block_sums(blocks: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Sum of the vectors of each block's words."""
    out = vectors[blocks[:, 0]]
    part = np.empty_like(out)
    for i in range(1, BLOCK):
        np.take(vectors, blocks[:, i], axis=0, out=part, mode="clip")
        out += part
    return out


def windows_from(sums: np.ndarray) -> np.ndarray:
    """Sum over the window that starts at each block."""
    out = sums.copy()
    for i in range(1, min(WINDOW_BLOCKS, len(sums))):
        out[:-i] += sums[i:]
    return out


def window_sums(numbers: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Sum of the words' vectors in the window that starts at each block."""
    return windows_from(block_sums(in_blocks(numbers, len(vectors) - 1), vectors))


def chunks(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Long texts in overlapping parts, so that memory stays bounded."""
    overlap = (WINDOW_BLOCKS - 1) * BLOCK
    for at in range(0, len(numbers), CHUNK_WORDS):
        yield at, numbers[at:at + CHUNK_WORDS + overlap]


# ---- statistics and decomposition ----------------------------------------------------

def document_frequencies(docs: DataFrame, terms: dict[bytes, int]) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each term; over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def found_in(texts: list[str | None]) -> Iterator[list[int]]:
        known = shared.value
        words = frozenset(known)
        return ([known[w] for w in words.intersection(words_of(text))] for text in texts)

    return counted(docs.select("text"), found_in, len(terms))


def slot_frequencies(numbered: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each slot; over all documents."""
    return counted(numbered, lambda rows: (
        np.unique(np.frombuffer(r, np.int32).astype(np.uint16)) for r in rows), SLOTS)


def counted(docs: DataFrame, found_in, n_terms: int) -> tuple[int, np.ndarray]:
    schema = "term int, n bigint"
    arrow_schema = arrow_of(docs.sparkSession, schema)

    def run(batches):
        total = np.zeros(n_terms + 1, np.int64)
        for batch in batches:
            for found in found_in(batch.column(0).to_pylist()):
                total[-1] += 1
                if len(found):
                    total[found] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()),
                                          pa.array(total[at], pa.int64())],
                                         schema=arrow_schema)

    small_batches(docs.sparkSession)
    out = np.zeros(n_terms + 1, np.int64)
    for row in docs.mapInArrow(run, schema).groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row.term] = row.n
    return int(out[-1]), out[:-1]


def side_by_side(texts: Iterator[np.ndarray], none: int) -> Iterator[np.ndarray]:
    """Blocks of many texts, with empty ones after each text."""
    parts, size = [], 0
    for text in texts:
        for _, numbers in chunks(text):
            parts.append(in_blocks(numbers, none, WINDOW_BLOCKS - 1))
            size += parts[-1].size
            if size >= CHUNK_WORDS:
                yield np.concatenate(parts)
                parts, size = [], 0
    if parts:
        yield np.concatenate(parts)


def add_by_term(out: np.ndarray, blocks: np.ndarray, sums: np.ndarray) -> None:
    """Add to the row of each word's term what its block has; the last row is not kept.

    Terms with few words by rounds, each with one word of a term, the others by a product."""
    numbers = blocks.ravel()
    order = np.argsort(numbers.astype(np.uint16) if len(out) <= 1 << 16 else numbers,
                       kind="stable")
    first, starts, counts = np.unique(numbers[order], return_index=True, return_counts=True)
    few = counts <= MANY
    terms, at, left = first[few], starts[few], counts[few]
    for k in range(MANY):
        more = left > k
        terms, at, left = terms[more], at[more], left[more]
        out[terms] += sums[order[at + k] // BLOCK]
    many = first[~few & (first < len(out) - 1)]
    if len(many):
        place = np.full(len(out), -1, np.int64)
        place[many] = np.arange(len(many))
        place = place[blocks]
        rows, _ = inside = np.nonzero(place >= 0)
        held = np.bincount(rows * len(many) + place[inside], minlength=len(blocks) * len(many))
        out[many] += held.reshape(len(blocks), -1).astype(sums.dtype).T @ sums


def applied(numbered: DataFrame, weights: np.ndarray, basis: np.ndarray,
            gram: bool) -> np.ndarray:
    """A'A times the basis, or the basis' image times itself, A being the weighted passages of
    the texts, whose term numbers are given.

    Partial sums are added by Spark; the result has one row per term or basis vector.
    """
    schema = "place int, vector binary"
    arrow_schema = arrow_of(numbered.sparkSession, schema)
    shared = numbered.sparkSession.sparkContext.broadcast((weights, basis))

    def run(batches):
        weight, vectors = shared.value
        scaled = np.vstack([vectors * weight[:, None], np.zeros(vectors.shape[1])]).astype(
            vectors.dtype)
        side, none = vectors.shape[1], len(vectors)
        out = np.zeros((side, side)) if gram else np.zeros_like(scaled)
        texts = (np.frombuffer(raw, np.int32) for batch in batches
                 for raw in batch.column(0).to_pylist())
        for blocks in side_by_side(texts, none):
            sums = windows_from(block_sums(blocks, scaled))
            sums[blocks[:, 0] == none] = 0
            if gram:
                out += sums.T @ sums
                continue
            back = sums.copy()  # summed over the windows that hold a block
            for i in range(1, min(WINDOW_BLOCKS, len(sums))):
                back[i:] += sums[:-i]
            add_by_term(out, blocks, back)
        rows = out if gram else out[:-1] * weight[:, None].astype(out.dtype)
        at = np.flatnonzero(np.abs(rows).sum(axis=1))
        yield to_batch([(int(i), rows[i].tobytes()) for i in at], arrow_schema)

    kind = np.dtype(np.float64) if gram else basis.dtype

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, raw in zip(*(c.to_pylist() for c in batch.columns)):
                total[place] = total.get(place, 0) + np.frombuffer(raw, kind)
        yield to_batch([(k, v.tobytes()) for k, v in total.items()], arrow_schema)

    small_batches(numbered.sparkSession)
    side = basis.shape[1]
    out = np.zeros((side if gram else len(basis), side), kind)
    partial = numbered.mapInArrow(run, schema)
    for row in partial.repartition("place").mapInArrow(add, schema).collect():
        out[row.place] = np.frombuffer(row.vector, kind)
    return out


def term_vectors(numbered: DataFrame, weights: np.ndarray, rank: int = RANK,
                 kind: type = np.float64) -> np.ndarray:
    """Right singular vectors of the weighted passages, one row per term."""
    wide = min(rank + OVERSAMPLED - RANK, len(weights))
    basis = np.random.default_rng(SEED).standard_normal((len(weights), wide), kind)
    for _ in range(POWER_ITERATIONS):
        basis = np.linalg.qr(applied(numbered, weights, basis, gram=False))[0]
    values, turned = np.linalg.eigh(applied(numbered, weights, basis, gram=True))
    best = np.argsort(values)[::-1][:rank]
    return basis @ turned[:, best].astype(kind)


def inverse_frequency(n: int, found: np.ndarray) -> np.ndarray:
    return 1 + np.log((n + 1) / (found + 1))


def corpus_space(docs: DataFrame) -> np.ndarray:
    """Latent vector of each slot, by the passages of all documents, times the slot's weight."""
    schema = "numbers binary"
    arrow_schema = arrow_of(docs.sparkSession, schema)

    def number(batches):
        for batch in batches:
            yield to_batch([(slots_of(words_of(t)).tobytes(),) for t in
                            batch.column(0).to_pylist()], arrow_schema)

    small_batches(docs.sparkSession)
    # Every task that sums passages gives a row per term, so these are few and large.
    numbered = written(docs.select("text").mapInArrow(number, schema), "numbers", docs.count())
    weights = inverse_frequency(*slot_frequencies(numbered)).astype(np.float32)
    latent = term_vectors(numbered, weights, CORPUS_RANK, np.float32)
    return with_none(latent * weights[:, None])


def with_none(vectors: np.ndarray) -> np.ndarray:
    """Vectors, and one of zeros for what has none."""
    return np.vstack([vectors, np.zeros(vectors.shape[1])]).astype(np.float32)


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one (or zero), and the lengths before."""
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(lengths > 0, lengths, 1), lengths[:, 0]


def build(docs: DataFrame, items: list, corpus: np.ndarray | None) -> Index | None:
    """Index of some items, with the corpus' space; None if none of them has words."""
    worded = [(r.item_id, w) for r in items if (w := words_of(r.text))]
    if not worded:
        return None
    kept = [(i, w) for i, w in worded if len(w) >= LEAST_WORDS]
    short: dict[bytes, list[tuple[int, list[bytes]]]] = {}
    for i, w in worded:
        if len(w) < LEAST_WORDS:
            short.setdefault(w[0], []).append((i, w))
    if not kept:
        none = np.zeros((0, 0), np.float32)
        return Index([], [], {}, none, [], none, none, short, none, none)
    terms = {w: i for i, w in enumerate(sorted({w for _, ws in kept for w in ws}))}
    weights = inverse_frequency(*document_frequencies(docs, terms))
    spark = docs.sparkSession
    pieces = [(i, a, b) for i, (_, w) in enumerate(kept) for a, b in pieces_of(len(w))]
    texts = [kept[i][1][a:b] for i, a, b in pieces]
    numbers = [term_numbers(w, terms) for w in texts]
    passages = written(spark.createDataFrame(
        [(n.astype(np.int32).tobytes(),) for n in numbers], "numbers binary"), "passages")
    # An item longer than a whole block needs a dimension for each of its pieces.
    latent = term_vectors(passages, weights, max(RANK, len(pieces)))
    weighted = with_none(latent * weights[:, None])
    vectors, lengths = unit(np.array([weighted[n].sum(axis=0) for n in numbers]))
    return Index([i for i, _ in kept], [w for _, w in kept], terms, weighted, pieces,
                 vectors, lengths, short, corpus,
                 unit(np.array([corpus[slots_of(w)].sum(axis=0) for w in texts]))[0])


# ---- search and checks ---------------------------------------------------------------

def common_subsequence(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, all of a's places in one number."""
    places: dict[bytes, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for word in b:
        if word in places:
            hit = places[word] & row
            row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def verdict(item: list[bytes], region: list[bytes]) -> tuple[float, bool, bool]:
    """Share of the item in order, whether its answer is there, whether it is a match."""
    share = common_subsequence(item, region) / len(item)
    if share < REPHRASED:
        return share, False, False
    answer = item[-ANSWER_WORDS:]
    answered = common_subsequence(answer, region) >= ANSWER_SHARE * len(answer)
    return share, answered, share >= COPIED or share >= REPHRASED and answered


def possible(item: list[bytes], region: list[bytes]) -> bool:
    """Whether enough of the item's words are there, in any order, for a match."""
    there = set(region).__contains__
    share = sum(map(there, item)) / len(item)
    if share < REPHRASED:
        return False
    answer = item[-ANSWER_WORDS:]
    return share >= COPIED or sum(map(there, answer)) >= ANSWER_SHARE * len(answer)


def short_matches(words: list[bytes], short: dict) -> list[tuple[int, float, float, bool]]:
    """Short items whose words stand next to each other, once each."""
    firsts = short.keys() & set(words)
    if not firsts:
        return []
    left = {w: short[w] for w in firsts}
    out = []
    for at, word in enumerate(words):
        if word in left:
            still = []
            for item_id, own in left[word]:
                if words[at:at + len(own)] == own:
                    out.append((item_id, 1.0, 1.0, True))
                else:
                    still.append((item_id, own))
            left[word] = still
    return out


def matches(text: str | None, index: Index) -> list[tuple[int, float, float, bool]]:
    """(item_id, cosine, share, answered) of every item found in the text."""
    words = words_of(text)
    if not words:
        return []
    whole = short_matches(words, index.short)
    if not index.pieces:
        return whole
    best: dict[int, tuple[float, float, bool]] = {}
    for at, numbers in chunks(term_numbers(words, index.terms)):
        sums = window_sums(numbers, index.weighted)
        lengths = np.sqrt(np.einsum("ij,ij->i", sums, sums))
        # A passage that holds half a piece is at least that long in latent space.
        able = np.flatnonzero(lengths >= LEAST_LENGTH * index.piece_lengths.min())
        if not len(able):
            continue
        lengths = lengths[able]
        cosines = sums[able] @ index.piece_vectors.T
        windows, pieces = np.nonzero(
            (cosines > LEAST_SHARED * lengths[:, None])
            & (lengths[:, None] >= LEAST_LENGTH * index.piece_lengths))
        near = cosines[windows, pieces] > LEAST_COSINE * lengths[windows]
        if not near.all():
            # After the others, so that of equal matches the nearer one is kept.
            far = np.flatnonzero(~near)
            about, _ = unit(window_sums(slots_of(words[at:at + len(numbers)]), index.corpus))
            alike = np.einsum("ij,ij->i", about[able[windows[far]]],
                              index.piece_corpus[pieces[far]]) > LEAST_LATENT
            taken = np.concatenate([np.flatnonzero(near), far[alike]])
            windows, pieces = windows[taken], pieces[taken]
        for window, piece in zip(windows.tolist(), pieces.tolist()):
            item, first, end = index.pieces[piece]
            if item in best and best[item][1] == 1.0:
                continue
            own = index.item_words[item]
            start = at + int(able[window]) * BLOCK
            # The whole item around its piece; the other pieces may have grown by a quarter.
            spare = (len(own) - (end - first)) // 4
            region = words[max(0, start - BLOCK - first - spare):
                           start + WINDOW_BLOCKS * BLOCK + len(own) - first + spare]
            if not possible(own, region):
                continue
            share, answered, match = verdict(own, region)
            if match and share > best.get(item, (0.0, -1.0, False))[1]:
                cosine = float(cosines[window, piece] / lengths[window])
                best[item] = min(1.0, cosine), share, answered
    return whole + [(index.item_ids[i], *b) for i, b in sorted(best.items())]


def blocks_of(benchmark: DataFrame) -> Iterator[list]:
    """Items in blocks of few pieces; the driver holds one block at a time."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL").orderBy(
            "item_id", "text").toLocalIterator():
        own = len(pieces_of(len(words_of(row.text))))
        if block and size + own > ITEMS_PER_PASS:
            yield block
            block, size = [], 0
        block.append(row)
        size += own
    if block:
        yield block


def indexes(docs: DataFrame, benchmark: DataFrame) -> Iterator[Index]:
    """Index of every block of items that has words."""
    corpus = None
    for block in blocks_of(benchmark):
        if corpus is None and any(len(words_of(r.text)) >= LEAST_WORDS for r in block):
            corpus = corpus_space(docs)
        index = build(docs, block, corpus)
        if index:
            yield index


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that it contains: cosine, lcs_share, has_answer."""
    schema = ("doc_id bigint, item_id bigint, cosine double, lcs_share double, "
              "has_answer boolean")
    spark = docs.sparkSession
    out = spark.createDataFrame([], schema)
    for index in indexes(docs, benchmark):
        out = out.union(search(docs, index, schema))
    return out


def search(docs: DataFrame, index: Index, schema: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def each(doc_id, text):
        return [(doc_id, *m) for m in matches(text, shared.value)]

    return flat(docs.select("doc_id", "text"), each, schema)


def flat(df: DataFrame, each, schema: str) -> DataFrame:
    """All rows that ``each`` gives for every row."""
    arrow_schema = arrow_of(df.sparkSession, schema)

    def run(batches):
        for batch in batches:
            yield to_batch([r for row in zip(*(c.to_pylist() for c in batch.columns))
                            for r in each(*row)], arrow_schema)

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any item, all columns unchanged."""
    out = docs
    for index in indexes(docs, benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        at = docs.columns.index("text")

        def run(batches, shared=shared):
            for batch in batches:
                keep = [not matches(t, shared.value) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        small_batches(docs.sparkSession)
        out = out.mapInArrow(run, docs.schema)
    return out
