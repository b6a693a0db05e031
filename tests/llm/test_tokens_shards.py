"""Byte-level BPE, pseudonyms, shards and the pipeline."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from llm.near import near_survivors
from llm.plans import plan_of
from riskweave.llm import bpe, decontam, pii, quality, queries, sharding, simhash

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ROW_COUNT = 15


# ---- byte-level BPE ------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return bpe.vocabulary(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=vocabulary.ranks, special_tokens={})


def digest(ids, data):
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(data).hexdigest())


def test_tokens_are_those_of_the_library(spark, sf_dir, texts, library):
    rows = queries.op5_byte_bpe(spark, sf_dir).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {
        i: digest(library.encode_ordinary(t or ""), (t or "").encode())
        for i, t in texts.items()}


def test_random_texts(vocabulary, library):
    rng = random.Random(1)
    parts = [*map(chr, range(32)), "\x7f", "\x85", "\xa0", "\u2003", "\u200b", "é", "ß", "中",
             "\U0001f600", "a", "th", "the", "!!", "  ", " ", "\n\n", "'s", "1", "23", "²", "Ⅷ"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        ids = library.encode_ordinary(text)
        assert vocabulary.encode(text) == ids
        assert vocabulary.digest(text) == digest(ids, text.encode())
    for _ in range(200):
        text = "".join(rng.choice("aeiothnsr") for _ in range(300))
        assert vocabulary.encode(text) == library.encode_ordinary(text)


def test_appends_and_edits(vocabulary):
    rng = random.Random(2)
    for _ in range(60):
        data = bytes(rng.choice(b"aeiothnsr ") for _ in range(700))
        table = bpe.PrefixTable(vocabulary, data[:400])
        table.append(data[400:])
        assert table.last == bpe.PrefixTable(vocabulary, data).last
        start = rng.randint(0, 600)
        stop, new = start + rng.randint(0, 40), bytes(rng.choice(b"aeio") for _ in range(9))
        computed = table.replace(start, stop, new)
        edited = data[:start] + new + data[stop:]
        assert table.data == edited and table.last == bpe.PrefixTable(vocabulary, edited).last
        assert computed <= len(new) + 3 * vocabulary.longest
        assert vocabulary.decode(table.ids()) == edited


def test_bpe_edges_and_round_trip(edge_docs, no_docs):
    rows = {r.doc_id: r for r in bpe.token_digests(
        edge_docs, PATH, public_tokenizers.PATTERN).collect()}
    assert rows[0].n_tokens == rows[1].n_tokens == 0
    assert rows[0].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    encoded = bpe.encode_documents(edge_docs, PATH, public_tokenizers.PATTERN)
    decoded = bpe.decode_documents(encoded, PATH, public_tokenizers.PATTERN)
    assert sorted((r.text or "") for r in decoded.collect()) == sorted(
        (r.text or "") for r in edge_docs.collect())
    assert bpe.token_digests(no_docs, PATH, public_tokenizers.PATTERN).count() == 0


# ---- pseudonyms ----------------------------------------------------------------------

def hashed(tweak, turn, value):
    text = f"{queries.TEST_KEY}|{tweak}|{turn}|{value}"
    return int(hashlib.sha256(text.encode()).hexdigest()[:15], 16)


def permuted(x, a, b, tweak):
    left, right = divmod(x, b)
    for turn in range(pii.ROUNDS):
        left = (left + hashed(tweak, 2 * turn, right) % a) % a
        right = (right + hashed(tweak, 2 * turn + 1, left) % b) % b
    return left * b + right


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += sum(divmod(int(c) * (2 if i % 2 else 1), 10))
    return total % 10 == 0


def plain_card(digits):
    n = len(digits) - 1
    payload = str(permuted(int(digits[:-1]), 10 ** (n // 2), 10 ** (n - n // 2), "card")).zfill(n)
    return next(payload + d for d in "0123456789" if luhn(payload + d))


PERSONAL = [
    "call +1 (017) 555-7713 or jo.ab.34@mail7.example.com x",
    "4845168114407329 and 9807915762804490 4845-1681-1440-7329",
    "97.51.17.173 256.1.1.1 1.2.3.4.5", "2024-02-29 2023-02-29 12/30/1999 31.12.1999 31/31/2000",
    None, "", "123-45-6789 666-45-6789 4845168114407329@x the.72@mail3.example.com###",
    "no number", "éñ.9@mail1.example.com", "token = \"908038b7daaf91e7\" version 2.0",
]


@pytest.fixture(scope="module")
def replaced(make_docs):
    return pii.pseudonymise(make_docs(PERSONAL), queries.TEST_KEY, kinds="found").orderBy("doc_id").collect()


def test_valid_values_are_replaced_and_others_stay(replaced):
    text = [r.text for r in replaced]
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} or [a-z]{2}\.[a-z]{2}\.\d\d@mail7"
                        r"\.example\.com x", text[0]) and "jo.ab" not in text[0]
    card, invalid, dashed = text[1].replace(" and", "").split()
    assert card == plain_card("4845168114407329") == dashed.replace("-", "")
    assert invalid == "9807915762804490" and luhn(card)
    number = int.from_bytes(bytes([97, 51, 17, 173]))
    expected = permuted(number, 65536, 65536, "ip").to_bytes(4)
    assert text[2] == f"{'.'.join(map(str, expected))} 256.1.1.1 1.2.3.4.5"
    assert text[3].split()[1] == "2023-02-29" and text[3].split()[4] == "31/31/2000"
    assert text[4] is None and text[5] == "" and text[7] == PERSONAL[7]
    assert "666-45-6789" in text[6] and "123-45-6789" not in text[6]
    assert card in text[6] and text[9] == PERSONAL[9] and text[8] != PERSONAL[8]
    assert replaced[3].found == ["iso_date", "month_first", "day_first"]


@pytest.mark.parametrize("number", [
    "+49 170 1234567", "+442071234567", "(555) 123-4567", "555-123-4567", "+1.555.123.4567"])
def test_forms_of_phone_numbers(make_docs, number):
    row = pii.pseudonymise(make_docs([f"at {number}, or later"]), queries.TEST_KEY, kinds="found").first()
    assert row.found == ["phone"] and number not in row.text
    assert re.sub(r"\d", "0", row.text) == re.sub(r"\d", "0", f"at {number}, or later")


ADJACENT = [
    ("4111 1111 1111 1111 12/27", ["card"]), ("4111111111111111 123", ["card"]),
    ("7 4111111111111111", ["card"]), ("4111-1111-1111-1111 123", ["card"]),
    ("4111111111111111 2024-05-01", ["card", "iso_date"]),
    ("555-123-4567 555-987-6543", ["phone"] * 2),
    ("555-123-4567 555-987-6543 555-222-3333", ["phone"] * 3),
    ("555-123-4567 4111111111111111", ["phone", "card"]),
    ("4111 1111 1111 1111 555-123-4567", ["card", "phone"]),
    ("3782 822463 10005 4111 1111 1111 1111", ["card"] * 2),
    ("555-123-4567 12", ["phone"]), ("12 555-123-4567", ["phone"]),
    ("2024/05/01 2024.05.01 2024/13/01", ["year_first"] * 2),
    ("48451 681144 07329", ["card"]), ("4111 1111 1111 1112 12", []),
    ("9807-9157-6280-4490 1", []), ("4111 1111 1111 1112 555-123-4567", ["phone"]),
    ("\uffff 4111 1111 1111 1111 12/27 \uffff", ["card"]),
]


def test_adjacent_values_are_all_found_and_restored(make_docs):
    docs = make_docs([text for text, _ in ADJACENT])
    out = pii.pseudonymise(docs, queries.TEST_KEY, kinds="found").orderBy("doc_id")
    for (text, kinds), row in zip(ADJACENT, out.collect()):
        assert (text, row.found) == (text, kinds)
        assert re.sub(r"\d", "0", row.text) == re.sub(r"\d", "0", text)
        assert (row.text == text) == (not kinds)
    assert [r.text for r in pii.restore(out.drop("found"), queries.TEST_KEY).orderBy("doc_id").collect()] == [
        text for text, _ in ADJACENT]


def test_pseudonyms_can_be_restored(make_docs):
    docs = make_docs(PERSONAL)
    rows = pii.restore(pii.pseudonymise(docs, queries.TEST_KEY), queries.TEST_KEY).orderBy("doc_id").collect()
    assert [r.text for r in rows] == PERSONAL


@pytest.mark.parametrize("a,b", [(1, 7), (10, 10), (189, 773)])
def test_feistel_is_a_permutation(spark, a, b):
    x = spark.range(a * b).select(F.col("id").alias("x"), pii.permuted(
        F.col("id"), F.lit(a).cast("bigint"), F.lit(b).cast("bigint"), queries.TEST_KEY, "t").alias("y"))
    rows = x.collect()
    assert sorted(r.y for r in rows) == list(range(a * b))
    assert all(r.y == permuted(r.x, a, b, "t") for r in rows[:50])


def test_social_security_numbers_keep_their_ranges(spark):
    values = spark.range(3000).select(F.format_string(
        "%03d-%02d-%04d", 1 + F.col("id") % 665, 1 + F.col("id") % 99, 1 + F.col("id")).alias("v"))
    out = values.select("v", pii.ssn(F.col("v"), queries.TEST_KEY, False).alias("p")).select(
        "v", "p", pii.ssn(F.col("p"), queries.TEST_KEY, True).alias("back")).collect()
    assert all(r.v == r.back for r in out) and len({r.p for r in out}) == len(out)
    for r in out:
        area, group, serial = map(int, r.p.split("-"))
        assert 0 < area < 900 and area != 666 and group and serial


def test_pseudonym_query_is_native_and_keeps_clean_texts(spark, sf_dir, texts):
    df = queries.op7_pii_pseudonyms(spark, sf_dir)
    assert not re.search("Python|Pandas|Arrow", plan_of(df))
    counts = [c for c in df.columns if c.startswith("n_")]
    changed = 0
    for r in df.collect():
        if not any(r[c] for c in counts):
            assert r.text == texts[r.doc_id]
        else:
            changed += 1
            for value in re.findall(r"[\w.]+@\S+\.com", texts[r.doc_id]):
                assert value not in r.text
    assert changed


def test_pseudonym_edges(edge_docs, no_docs):
    out = pii.pseudonymise(edge_docs, queries.TEST_KEY)
    assert out.columns == edge_docs.columns and out.count() == ROW_COUNT
    assert pii.pseudonymise(no_docs, queries.TEST_KEY).count() == 0


# ---- shards --------------------------------------------------------------------------

def plain_capacity(sizes, shards):
    def fits(capacity):
        used, filled = 1, 0
        for s in sizes:
            if s > capacity:
                return False
            if filled + s > capacity:
                used, filled = used + 1, 0
            filled += s
        return used <= shards

    low, high = 0, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def check_shards(rows, texts, shards):
    """texts: doc_id -> text, ids distinct."""
    assert len(rows) == len(texts)
    groups, sums, slots = {}, {}, {}
    for r in rows:
        text = texts[r.doc_id]
        data = (text or "").encode()
        assert r.size == len(data) + 8 and r.text_crc32 == zlib.crc32(data)
        assert 0 <= r.shard < shards
        key = "0" * 64 if text is None else hashlib.sha256(data).hexdigest()
        shard, size = groups.get(key, (r.shard, 0))
        assert shard == r.shard
        groups[key] = shard, size + r.size
        sums[r.shard] = sums.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    ordered = sorted(groups)
    assert [groups[k][0] for k in ordered] == sorted(g[0] for g in groups.values())
    assert max(sums.values()) == plain_capacity([groups[k][1] for k in ordered], shards)


def test_shards_of_the_test_table(spark, sf_dir, texts):
    df = queries.op8_minimax_shards(spark, sf_dir)
    assert not re.search("Python|Pandas|Arrow", plan_of(df))
    check_shards(df.collect(), texts, 24)


@pytest.mark.parametrize("seed", range(4))
def test_shards_with_a_hot_group(make_docs, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))
             for _ in range(rng.randint(3, 300))]
    texts += ["hot text " * 3] * (len(texts) // 2) + [None, None, ""]
    rows = sharding.by_bytes(make_docs(texts), 2 + 5 * seed).collect()
    check_shards(rows, dict(enumerate(texts)), 2 + 5 * seed)


def test_shard_edges(edge_docs, no_docs):
    assert sharding.by_bytes(edge_docs).count() == ROW_COUNT
    assert sharding.by_bytes(no_docs).count() == 0


# ---- pipeline ------------------------------------------------------------------------

def test_pipeline_against_its_parts(spark, sf_dir, texts, library):
    """Every stage redone in plain Python on what the stage before kept."""
    kept = {i: t for i, t in texts.items() if not quality.rejected(t)}
    kept = {i: kept[i] for i in near_survivors(kept)}
    items = [decontam.words_of(r.text) for r in spark.read.parquet(
        f"{sf_dir}/benchmark.parquet").collect()]
    spaced = [b" " + b" ".join(w) + b" " for w in items if len(w) >= decontam.LEAST_WORDS]
    kept = {i: t for i, t in kept.items() if not any(
        s in b" " + b" ".join(decontam.words_of(t)) + b" " for s in spaced)}
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(rows) == set(kept)
    personal = re.compile(r"\d.*@|@|\d")
    for i, t in kept.items():
        if not personal.search(t):
            assert tuple(rows[i])[1:] == digest(library.encode_ordinary(t), t.encode())


def test_stages_keep_columns_and_take_odd_tables(spark, sf_dir, edge_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (edge_docs, no_docs):
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, edge_docs, sf_dir).count() == ROW_COUNT


@pytest.mark.parametrize("doc_id", ["5", "NULL"])
def test_shards_of_100_000_equal_rows(spark, make_docs, doc_id):
    """No task numbers them alone; every slot is given once."""
    hot = spark.range(100_000, numPartitions=8).selectExpr(
        f"CAST({doc_id} AS bigint) AS doc_id", "'same text' AS text")
    other = make_docs([(i, f"text {i}") for i in range(300)]).select("doc_id", "text")
    rows = sharding.by_bytes(hot.union(other), 4)
    per_shard = rows.groupBy("shard").agg(
        F.count("*").alias("n"), F.count_distinct("slot").alias("slots"),
        F.max("slot").alias("last"), F.min("slot").alias("first")).collect()
    assert sum(r.n for r in per_shard) == 100_300
    assert all((r.slots, r.first, r["last"]) == (r.n, 0, r.n - 1) for r in per_shard)
    (hot_shard,) = rows.where("size = 17").select("shard").distinct().collect()
    assert rows.where("size = 17").count() == 100_000 and hot_shard.shard is not None


def test_the_key_is_a_setting(spark, make_docs):
    docs = make_docs(["mail anna.schmidt@example.org"])
    with pytest.raises(ValueError):
        pii.session_key(spark)
    spark.conf.set(pii.KEY_SETTING, "another key")
    try:
        key = pii.session_key(spark, queries.TEST_KEY)
    finally:
        spark.conf.unset(pii.KEY_SETTING)
    assert key == "another key" and pii.session_key(spark, "d") == "d"
    texts = {k: pii.pseudonymise(docs, k).first().text for k in (key, queries.TEST_KEY)}
    assert texts[key] != texts[queries.TEST_KEY]
    assert pii.restore(pii.pseudonymise(docs, key), key).first().text == docs.first().text
