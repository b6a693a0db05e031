"""SimHash components, repeats, decontamination, URL filters."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from compare import connect, differences
from llm.plans import plan_of
from riskweave.llm import decontam, queries, repeats, simhash, urlfilter

ROW_COUNT = 15


# ---- SimHash -------------------------------------------------------------------------

def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id that is reachable, from {id: fingerprint}."""
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def test_fingerprints_and_components_against_brute_force(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in queries.op10_simhash(spark, sf_dir).collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {i: r.fingerprint for i, r in rows.items()} == {
        i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in rows.items()} == plain_components(prints)


def test_shingle_hash_is_the_engine_function(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a bé c")).alias("h")).first()
    assert row.h == simhash.signed(xxhash.xxh64_intdigest("a bé c".encode(), 42))


def test_masks_cover_every_pair_within_the_radius():
    tables = simhash.masks()
    for i in range(64):
        for j in range(i + 1):
            differing = 1 << i | 1 << j
            assert any(m & differing == 0 for m in tables)


@pytest.mark.parametrize("small_bucket", [0, 3, 1000])
def test_no_link_is_lost_in_any_bucket_size(spark, small_bucket):
    rng = random.Random(small_bucket)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    prints = {s ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for s in seeds
              for _ in range(25)} | set(seeds)
    nodes = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp bigint")
    edges = simhash.links(nodes, small_bucket)
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in edges.collect())
    roots = {r.fp: r.root for r in simhash.components(edges).collect()}
    expected = plain_components({simhash.signed(p): p for p in prints})
    assert {p: roots.get(p, p) for p in expected} == expected


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a bigint, b bigint")
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_simhash_edges(edge_docs, no_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == ROW_COUNT
    zero = {r.doc_id for r in rows if r.fingerprint == "0" * 16}
    assert zero == {0, 1, 2}
    assert {r.component_id for r in rows if r.doc_id in zero} == {0}
    assert {r.component_id for r in rows if r.doc_id in (6, 7)} == {6}
    kept = simhash.keep_first(edge_docs)
    assert kept.columns == edge_docs.columns
    assert {r.doc_id for r in kept.collect()} >= {None, 0, 6} and kept.where(
        "doc_id IN (1, 2, 7)").count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_first(no_docs).count() == 0


# ---- repeats -------------------------------------------------------------------------

def plain_strip(texts, length=200):
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - length + 1):
            if counts[d[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        mask = np.cumsum(gone[:-1]) > 0
        kept = bytes(np.frombuffer(d, np.uint8)[~mask])
        spans = int((mask[1:] & ~mask[:-1]).sum() + mask[:1].sum())
        out.append((len(d), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def overlapping_texts(seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdefghij klm"
    base = "".join(rng.choice(letters) for _ in range(3000))
    out = ["x" * 450, "xy" * 160, base[:199], base[:200], base[100:300]]
    for _ in range(40):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 300)))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, 2700)
            text += base[at:at + rng.randint(150, 420)] + rng.choice(["", "é", "zz"])
        out.append(text)
    return [*out, None, "", out[8], out[8]]


@pytest.mark.parametrize("seed,hot", [(0, 2000), (1, 2000), (2, 0), (3, 2)])
def test_repeats_against_brute_force(make_docs, monkeypatch, seed, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    texts = overlapping_texts(seed)
    rows = sorted(repeats.digests(make_docs(texts)).collect())
    assert [tuple(r)[1:] for r in rows] == plain_strip(texts)


def test_repeats_query_on_the_test_table(spark, sf_dir, texts):
    ids = sorted(texts)
    expected = dict(zip(ids, plain_strip([texts[i] for i in ids])))
    rows = queries.op9_run_length_dedup(spark, sf_dir).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == expected


def test_matching_statistics_against_brute_force():
    rng = random.Random(5)
    for _ in range(40):
        strings = list({bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 60)))
                        for _ in range(rng.randint(1, 8))})
        index = repeats.RunIndex(strings)
        got, best = index.matching_statistics(), []
        starts = [(n, i) for n, s in enumerate(strings) for i in range(len(s))]
        for n, i in starts:
            own = strings[n][i:]
            common = 0
            for m, j in starts:
                if (m, j) != (n, i):
                    other = strings[m][j:]
                    k = next((k for k, (x, y) in enumerate(zip(own, other)) if x != y),
                             min(len(own), len(other)))
                    common = max(common, k)
            best.append(common)
        places = [int(index.starts[n]) + i for n, i in starts]
        assert got[places].tolist() == best
        assert len(index.runs) <= index.size


def test_chunks_of_long_texts_do_not_change_the_result(make_docs, monkeypatch):
    texts = overlapping_texts(4)
    expected = plain_strip(texts)
    monkeypatch.setattr(repeats, "CHUNK", 128)
    repeats.powers.cache_clear()
    data = {t: repeats.stretches(repeats.as_array(t)) for t in texts if t}
    repeats.powers.cache_clear()
    for text, found in data.items():
        windows = max(0, len(text.encode()) - 199)
        assert [i for a, b in zip(found.first, found.last) for i in range(a, b + 1)] == list(
            range(windows))
    assert len(expected) == len(texts)


def test_repeats_edges(edge_docs, no_docs):
    rows = {r.doc_id: r for r in repeats.remove_repeats(edge_docs).collect() if r.doc_id != 6}
    assert rows[0].n_bytes == 0 and rows[0].kept == b""
    assert rows[8].n_removed == 3000 and rows[8].n_spans == 1
    assert rows[9].n_removed == 20000
    assert repeats.digests(edge_docs).count() == ROW_COUNT
    assert repeats.digests(no_docs).count() == 0


# ---- decontamination -----------------------------------------------------------------

def test_common_subsequence_against_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice(b"abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(
                    table[i][j + 1], table[i + 1][j])
        assert decontam.common_subsequence(a, b) == table[-1][-1]


def test_recall_against_brute_force(spark, sf_dir, texts):
    items = {r.item_id: b" ".join(decontam.words_of(r.text)) for r in spark.read.parquet(
        f"{sf_dir}/benchmark.parquet").collect()}
    spaced = {i: b" " + b" ".join(decontam.words_of(t)) + b" " for i, t in texts.items()}
    exact = {(d, i) for d, text in spaced.items() for i, item in items.items()
             if len(item.split()) >= decontam.LEAST_WORDS and b" " + item + b" " in text}
    rows = queries.op4_decontamination(spark, sf_dir).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    assert exact and len(exact & found) >= 0.9 * len(exact)
    for r in rows:
        share = decontam.common_subsequence(items[r.item_id].split(),
                                            decontam.words_of(texts[r.doc_id]))
        assert share >= r.lcs_share * len(items[r.item_id].split()) > 0


ITEM = ("Which river flows through the capital of the northern province before it reaches the "
        "great salt lake near the old border town of Velmora and Quintessa")


def test_copies_and_paraphrases_are_found_and_clean_documents_left(spark, make_docs):
    filler = "quiet hills and green meadows lie around this little village in summer. " * 12
    words = ITEM.split()
    rephrased = " ".join(w for i, w in enumerate(words) if i % 5 != 2)
    docs = make_docs([filler, f"{filler} {ITEM}. {filler}", ITEM.upper(), f"{filler}{rephrased}",
                      " ".join(words[:8]), None, "", filler])
    benchmark = spark.createDataFrame([(7, ITEM), (8, "too short"), (9, None), (None, "")],
                                      "item_id bigint, text string")
    rows = decontam.contaminated(docs, benchmark).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3} and {r.item_id for r in rows} == {7}
    assert {r.doc_id: r.has_answer for r in rows}[1]
    kept = decontam.keep_clean(docs, benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 4, 5, 6, 7]
    assert kept.columns == docs.columns


def test_blocks_of_items_give_the_same_pairs(spark, sf_dir, documents, monkeypatch):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = {(r.doc_id, r.item_id) for r in decontam.contaminated(documents, benchmark).collect()}
    monkeypatch.setattr(decontam, "ITEMS_PER_PASS", -(-benchmark.count() // 2))
    parts = {(r.doc_id, r.item_id) for r in decontam.contaminated(documents, benchmark).collect()}
    assert whole == parts


def long_items(lengths):
    """Items of Zipf words with some of their own, and filler of the same words."""
    rng = random.Random(11)
    common = [f"w{i}" for i in range(3000)]
    draw = lambda n: rng.choices(common, [1 / (i + 1) for i in range(3000)], k=n)
    items = [[w if rng.random() < 0.7 else f"i{k}x{j % 40}" for j, w in enumerate(draw(n))]
             for k, n in enumerate(lengths)]
    return rng, draw, items


def test_long_items_are_found_copied_and_rephrased(spark, make_docs):
    lengths = [61, 97, 150, 250, 400, 700, 1000]
    rng, draw, items = long_items(lengths)
    texts, expected = [], set()
    for k, words in enumerate(items):
        # Copied, one in five words replaced, one in four left out; a third alone is no match.
        answer = words[-8:]
        forms = [words, [w if rng.random() < 0.8 else "other" for w in words[:-8]] + answer,
                 [w for w in words[:-8] if rng.random() < 0.75] + answer]
        for form in forms:
            expected.add((len(texts), k))
            texts.append(" ".join(draw(rng.randint(0, 90)) + form + draw(rng.randint(0, 90))))
        texts.append(" ".join(draw(30) + words[:len(words) // 3] + draw(900)))
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)],
                                      "item_id bigint, text string")
    rows = decontam.contaminated(make_docs(texts), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == expected
    assert all(r.lcs_share == 1.0 for r in rows if r.doc_id % 4 == 0)


def test_short_items_match_as_whole_word_sequences(spark, make_docs, monkeypatch):
    rng = random.Random(3)
    benchmark = [(i, " ".join(rng.choices("abcd", k=n))) for i, n in enumerate([*range(1, 8)] * 2)]
    benchmark += [(20, "What is two plus two?"), (21, "..."), (22, ""), (23, None), (24, ITEM),
                  (25, "é ß")]
    texts = [" ".join(rng.choices("abcd", k=n)) for n in range(0, 60, 4)]
    texts += ["so WHAT is two, plus two", "what is two plus twofold", f"a {ITEM}", "é ß", None]
    expected = set()
    for d, text in enumerate(texts):
        spaced = b" " + b" ".join(decontam.words_of(text)) + b" "
        expected |= {(d, i) for i, t in benchmark if (w := decontam.words_of(t))
                     and b" " + b" ".join(w) + b" " in spaced}
    docs = make_docs(texts)
    items = spark.createDataFrame(benchmark, "item_id bigint, text string")
    rows = decontam.contaminated(docs, items).collect()
    assert len(rows) == len(expected) and {(r.doc_id, r.item_id) for r in rows} == expected
    assert {i for _, i in expected} >= {0, 1, 20, 24, 25}
    monkeypatch.setattr(decontam, "ITEMS_PER_PASS", 4)
    kept = {r.doc_id for r in decontam.keep_clean(docs, items).collect()}
    assert kept == set(range(len(texts))) - {d for d, _ in expected}


def test_pieces_cover_every_item():
    for n in range(1, 2000):
        pieces = decontam.pieces_of(n)
        assert [a for a, _ in pieces] == [0, *(b for _, b in pieces[:-1])]
        assert pieces[-1][1] == n and max(b - a for a, b in pieces) <= decontam.LONGEST_PIECE


def test_rephrasing_in_related_words(spark, make_docs):
    """Items whose rare words are all replaced by others that occur with them in the corpus."""
    rng, docs, items = random.Random(4), [], []
    common = [f"c{i}" for i in range(60)]
    for i in range(40):
        rare, other = ([f"{kind}{i}x{j}" for j in range(16)] for kind in "rs")
        for _ in range(12):
            docs.append(" ".join(rng.choices(rare + other, k=50) + rng.choices(common, k=14)))
        kept = rng.sample(common, 20)
        mixed = [w for pair in zip(rare, kept) for w in pair] + kept[16:] + ["last", *common[:3]]
        items.append((i, " ".join(mixed)))
        swap = dict(zip(rare, other))
        docs.append("rephrased " + " ".join(swap.get(w, w) for w in mixed))
    docs += [" ".join(rng.choices(common, k=64)) for _ in range(400)]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(
        make_docs(docs), benchmark).collect()}
    assert {(13 * i + 12, i) for i in range(40)} <= found


def test_decontamination_edges(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    one = spark.createDataFrame([(1, ITEM)], none.schema)
    assert decontam.contaminated(edge_docs, none).count() == 0
    assert decontam.contaminated(edge_docs, one).count() == 0
    assert decontam.contaminated(no_docs, one).count() == 0
    assert decontam.keep_clean(edge_docs, one).count() == ROW_COUNT


# ---- URL filters ---------------------------------------------------------------------

def test_url_query_on_the_test_table(spark, sf_dir):
    df = queries.op6_url_filters(spark, sf_dir)
    assert differences(df, connect(sf_dir), queries.all_oracles()["op6_url_filters"]) == []
    assert "html" not in plan_of(df)


URLS = [
    (1, "http://a.example.org/es/x", "example.org/es/", "block"),
    (2, "HTTP://EXAMPLE.ORG/en/12?q#f", "example.org/en/1", "block"),
    (3, "https://example.org/en/2", "org/", "allow"),
    (4, "https://notexample.org/es/", "org/", "allow"),
    (5, "https://shop.com/de/", "com/de/", "block"),
    (6, "https://spam-farm.example.com/fr/1", "com/fr/", "allow"),
    (7, "https://x.spam-farm.example.com/en", None, "block"),
    (8, "https://my-spam-farm.example.com/en", None, "allow"),
    (9, None, None, "allow"), (10, "no scheme", None, "allow"), (11, "", None, "allow"),
    (12, "http://org", None, "allow"), (13, "http://org/", "org/", "allow"),
    (13, "http://org/", "org/", "allow"), (None, "http://a://b/c", None, "allow"),
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "host", 1) for i, u, _, _ in URLS],
                                  "page_id bigint, url string, host string, rule int")
    rules = spark.createDataFrame([*queries.URL_RULES, ("org/", "allow")],
                                  "key string, verdict string")
    blocked = spark.createDataFrame([(s,) for s in queries.BLOCKED_SITES], "key string")
    rows = urlfilter.judge(pages, rules, blocked).collect()
    assert Counter((r.page_id, r.rule, r.verdict) for r in rows) == Counter(
        (i, rule, verdict) for i, _, rule, verdict in URLS)
    assert {(r.host, r.path) for r in rows if r.page_id in (9, 10, 11)} == {("", "")}
    assert {(r.host, r.path) for r in rows if r.page_id == 2} == {("example.org", "/en/12")}
    assert urlfilter.judge(pages.limit(0), rules, blocked).count() == 0
    none = urlfilter.judge(pages, rules.limit(0), blocked.limit(0)).collect()
    assert {r.verdict for r in none} == {"allow"}


def test_equal_digests_are_told_apart(tmp_path):
    keys = [b"one.example", b"two.example"]
    digest = np.int64(simhash.signed(xxhash.xxh64_intdigest(keys[1], 42)))
    for part, data in {"digests": np.array([digest, digest]).tobytes(),
                       "offsets": np.array([0, 11, 22], np.int64).tobytes(),
                       "strings": b"".join(keys), "verdicts": b"01"}.items():
        (tmp_path / part).write_bytes(data)
    array = urlfilter.KeyArray({p: str(tmp_path / p) for p in urlfilter.PARTS})
    assert array.find([b"two.example", b"three"]).tolist() == [1, -1]
    assert array.blocks(1) and not array.blocks(0)


@pytest.mark.parametrize("doc_id", ["7", "NULL"])
def test_many_rows_with_one_id_and_text(spark, doc_id):
    """Linear in the rows: all of their bytes repeat, all of them go."""
    rng = np.random.default_rng(2)
    text = "".join(chr(97 + i) for i in rng.integers(0, 26, 900))
    docs = spark.range(20_000, numPartitions=4).select(
        F.expr(f"CAST({doc_id} AS bigint)").alias("doc_id"), F.lit(text).alias("text"))
    rows = repeats.digests(docs).groupBy("n_bytes", "n_removed", "n_spans").count().collect()
    assert [tuple(r) for r in rows] == [(900, 900, 1, 20_000)]
