"""Quality cascade, toxicity and language identification."""

from __future__ import annotations

import math
from collections import Counter, defaultdict, namedtuple
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from riskweave.llm import langid, quality, queries, toxicity

ROW_COUNT = 15


def window_words(words, width=8):
    counts = Counter(tuple(words[i:i + width]) for i in range(len(words) - width + 1))
    hit = {j for i in range(len(words) - width + 1)
           if counts[tuple(words[i:i + width])] > 1 for j in range(i, i + width)}
    return len(hit)


@pytest.mark.parametrize("seed", range(30))
def test_repeated_words_against_brute_force(seed):
    rng = np.random.default_rng(seed)
    words = [b"%d" % w for w in rng.integers(0, 2 + seed % 4, rng.integers(0, 60))]
    words += words[:rng.integers(0, 20)]
    assert quality.repeated_words(words, 8) == window_words(words)


def test_quality_query_on_the_test_table(spark, sf_dir):
    df = queries.op1_quality_rules(spark, sf_dir)
    assert differences(df, connect(sf_dir), queries.all_oracles()["op1_quality_rules"]) == []


def test_quality_edges(edge_docs, no_docs):
    rows = quality.assess(edge_docs).collect()
    assert len(rows) == ROW_COUNT
    found = {r.doc_id: r for r in rows}
    assert all(found[i].n_words == 0 and found[i].base_failed for i in (0, 1, 2))
    assert found[9].n_words == 4000 == found[9].n_repeat_words and not found[9].kept
    assert found[11].n_dup_lines == 2
    assert quality.assess(no_docs).count() == 0
    assert quality.keep_good(no_docs).columns == no_docs.columns


def test_keeping_agrees_with_assessing(documents):
    kept = {r.doc_id for r in quality.assess(documents).where("kept").collect()}
    assert {r.doc_id for r in quality.keep_good(documents).collect()} == kept
    assert 0 < len(kept) < documents.count()


def test_order_of_rules_is_by_rejections_per_second():
    row = namedtuple("row", "mask texts seconds")
    rules = quality.RULES[:3]
    measured = [row(0b001, 10, [1.0, 4.0, 1.0]), row(0b011, 5, [1.0, 4.0, 1.0]),
                row(0b100, 12, [1.0, 4.0, 1.0]), row(0b000, 70, [0.0, 0.0, 0.0])]
    # Rule 0 rejects 15 at cost 3, rule 2 12 at cost 3; rule 1 adds nothing after rule 0.
    assert quality.order_rules(measured, rules) == (rules[0], rules[2], rules[1])
    assert quality.order_rules([], rules) == rules


@pytest.fixture(scope="module")
def model(documents):
    extra = documents.select(F.lit(
        "idiot idiots idiotic stupid stupidity moron scum clown loser trash " * 40).alias("text"))
    return toxicity.character_model(documents.select("text").union(extra))


@pytest.mark.parametrize("disguised", [
    "1d10t", "!diot", "id10t", "i.d.i.o.t", "i-d-i-o-t", "iiidiiiot", "idioooot", "1d1ot,"])
def test_disguises_are_decoded(model, disguised):
    assert "idiot" in toxicity.words_of(disguised, model)


def test_spaced_letters_and_plain_words(model):
    assert toxicity.restore_text("you i d i o t", model) == "you idiot"
    assert toxicity.restore_text("Plain words, 2.0 stay.", model).startswith("Plain words,")
    assert toxicity.words_of("hello", model) == ["hello"]
    assert toxicity.restore_text(None, model) is None


def test_long_and_accented_disguises(model):
    assert toxicity.words_of("i" + "d" * 70 + "iot", model) == ["idiot"]
    assert toxicity.words_of("_".join(["1d10t"] * 40), model) == ["idiot"] * 40
    assert toxicity.words_of("ïdí0t", model) == ["idiot"]
    assert toxicity.words_of("Ïdiót".lower(), model) == ["idiot"]
    spaced = " ".join("stupid" * 40)  # far longer than any window
    assert [w for _, words in toxicity.tokens_of(spaced, model) if words for w in words] == [
        "stupid"] * 40
    assert toxicity.words_of("ab1c2" * 20_000, model)  # linear in its length


def test_disguised_pieces_are_replaced_by_what_they_hide(model):
    assert toxicity.words_of("l0ser", model) == ["loser"]
    assert toxicity.words_of("stupid/clown", model) == ["stupid", "clown"]


def plain_judgement(docs: list[tuple], labels: list[tuple]) -> dict:
    """Learning and scoring in plain Python; only the decoder and its features are shared."""
    texts = [t or "" for _, t in docs]
    model = toxicity.log_probabilities(toxicity.count_grams(
        [t.encode("latin-1", "replace") for t in texts]).astype(float))

    def words(text):
        found = set()
        for token, restored in toxicity.tokens_of(text, model):
            found.update(toxicity.words_of(token, model) if restored is None else restored)
        return found

    by_id = defaultdict(list)
    for doc_id, text in docs:
        by_id[doc_id].append(text)
    rows = {(text, label) for doc_id, label in labels
            if label is not None and crc32(str(doc_id).encode()) % 5 for text in by_id[doc_id]}
    clean, toxic = Counter(), defaultdict(set)
    for text, label in rows:
        found = words(text or "")
        for feature in toxicity.features_of(found) | {None}:
            if label:
                toxic[feature].update(toxicity.least_hashes(found))
            else:
                clean[feature] += 1
    times = {f: max(sum(h % toxicity.SKETCHES == i for h in hashes)
                    for i in range(toxicity.SKETCHES)) for f, hashes in toxic.items()}
    n_toxic = sum(1 for _, label in rows if label)
    base = math.log((n_toxic + 0.5) / (len(rows) - n_toxic + 0.5))
    often = {f: t for f, t in times.items() if t >= toxicity.LEAST_TEXTS}
    most = Counter()
    for f, t in often.items():
        if f and f.endswith("$"):
            for n in toxicity.PREFIXES:
                if len(f) > n:
                    most[f[:n]] = max(most[f[:n]], t)
    weights = {}
    for f, t in often.items():
        if f and (f.endswith("$") or most[f] <= toxicity.COMMONEST_SHARE * t):
            a, b = t + 0.5, clean[f] + 0.5
            weights[f] = (math.log(a / (times[None] + 1)) - math.log(b / (clean[None] + 1))
                          - toxicity.CONFIDENCE * math.sqrt(1 / a + 1 / b))
    weights = {f: w for f, w in weights.items() if w > 0.5}
    return {doc_id: 1 / (1 + math.exp(-base - max(
        (weights.get(f, 0.0) for f in toxicity.features_of(words(text or ""))), default=0.0)))
        for doc_id, text in docs}


def test_whole_query_against_plain_python(spark, toxic_docs):
    docs, labels = toxic_docs
    rows = {r.doc_id: r for r in toxicity.judge(docs, labels).collect()}
    want = plain_judgement([(r.doc_id, r.text) for r in docs.collect()],
                           [(r.doc_id, r.toxic) for r in labels.collect()])
    assert rows.keys() == want.keys()
    for doc_id, score in want.items():
        assert rows[doc_id].score == pytest.approx(score, abs=1e-6)
        assert rows[doc_id].predicted == int(rows[doc_id].score >= 0.5)
        assert rows[doc_id].held_out == (crc32(str(doc_id).encode()) % 5 == 0)


def test_viterbi_against_all_paths(model):
    """The cheapest of all readings of a short token."""
    def cost(word, pieces):
        state, total = 0, pieces
        for c in word:
            total -= model[state * 27 + ord(c) - 96]
            state = (state * 27 + ord(c) - 96) % 27 ** 3
        return total - model[state * 27]

    for token in ("m0r1n", "l0s3r", "5t1p"):
        readings = [("", 0.0)]
        for c in token:
            options = ([(c, 0.0)] if c.isalpha() else []) + [
                (x, toxicity.DISGUISE) for x in toxicity.LOOKS_LIKE.get(c, "")]
            readings = [(w + x, p + e) for w, p in readings for x, e in options]
        best = min(cost(w, p) for w, p in readings)
        got = toxicity.decode(token, model)
        assert any(w == got and abs(cost(w, p) - best) < 1e-3 for w, p in readings)


def test_counts_of_letters_against_brute_force():
    text = "The cat; the HATéx a"
    counts = Counter()
    for word in "the cat the hatex a".split():  # accents fold
        history = [0, 0, 0]
        for code in [*(ord(c) - 96 for c in word), 0]:
            counts[tuple(history + [code])] += 1
            history = history[1:] + [code]
    got = toxicity.count_grams([text.encode("latin-1")]).reshape(27, 27, 27, 27)
    assert {tuple(i): int(got[tuple(i)]) for i in np.argwhere(got)} == dict(counts)


@pytest.fixture(scope="module")
def toxic_docs(spark, make_docs):
    rng = np.random.default_rng(3)
    lexicon = ["idiot", "moron", "scum"]
    syllables = ["ra", "ne", "to", "li", "su", "ko", "mi", "da"]
    texts, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice(syllables, 3)) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            words[7], words[20] = rng.choice(lexicon, 2)
        texts.append(" ".join(words))
        labels.append((i, 1, int(toxic)))
    texts += ["you are 1d10t and sc.um " + texts[1], "i d i o t " + texts[2], None, ""]
    return make_docs(texts), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_on_held_out_and_disguised_rows(toxic_docs):
    docs, labels = toxic_docs
    rows = {r.doc_id: r for r in toxicity.judge(docs, labels).collect()}
    assert len(rows) == 604
    for i, r in rows.items():
        assert r.held_out == (crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    assert all(rows[i].predicted == int(i % 5 == 0) for i in range(600))
    assert rows[600].predicted == rows[601].predicted == 1
    assert rows[602].predicted == rows[603].predicted == 0


def test_toxicity_edges(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = toxicity.judge(edge_docs, none).collect()
    assert len(rows) == ROW_COUNT and {r.score for r in rows} == {0.0}
    odd = spark.createDataFrame([(None, 1, 1), (3, 1, None), (5, 0, 1), (5, 0, 1)], none.schema)
    assert toxicity.judge(edge_docs, odd).count() == ROW_COUNT
    assert toxicity.judge(no_docs, none).count() == 0


def test_language_accuracy_on_held_out_rows(spark, sf_dir, documents):
    truth = {r.doc_id: r.lang for r in documents.collect()}
    rows = queries.op3_hd_language(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_trigram_vectors_are_bound_and_bundled():
    vectors = langid.TrigramVectors()
    a, b, c = (vectors.letter(ord(x)) for x in "abc")
    code = (ord("a") << 42) | (ord("b") << 21) | ord("c")
    assert (vectors.bound(code) == np.roll(a, 2) * np.roll(b, 1) * c).all()
    found, counts = langid.trigrams("ab, AB")
    expected = sum(n * vectors.bound(int(t)) for t, n in zip(found, counts))
    assert np.allclose(vectors.bundle(found, counts), expected)
    assert counts.sum() == 5  # " ab", "ab ", "b a", " ab", "ab "
    langid_rows = langid.REMEMBERED
    try:
        langid.REMEMBERED = 1
        assert np.allclose(langid.TrigramVectors().bundle(found, counts), expected)
    finally:
        langid.REMEMBERED = langid_rows


def test_language_edges(edge_docs, no_docs):
    rows = {r.doc_id: r for r in langid.identify(edge_docs).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (0, 1, 2, 3))
    assert rows[4].lang_pred == "en" and 0 < rows[4].score <= 1
    assert langid.identify(no_docs).count() == 0
    assert {r.lang_pred for r in langid.identify(
        edge_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
