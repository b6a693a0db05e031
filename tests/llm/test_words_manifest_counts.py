"""Spelling variants, Merkle manifest and token counts against plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from compare import connect, differences
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskweave.llm import merkle, queries, spelling, tokencache

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# ---- spelling ------------------------------------------------------------------------

def lowered(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def counted(docs) -> Counter:
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            if len(word) >= 5:
                found[word] += 1
    return Counter({w: n for w, n in found.items() if n >= 3})


def variants_of(docs) -> dict:
    words = counted(docs)
    near, holes = defaultdict(set), defaultdict(list)
    for word in words:
        for i in range(len(word)):
            rest = word[:i] + word[i + 1:]
            holes[i, rest].append(word)
            if rest in words:
                near[word].add(rest)
                near[rest].add(word)
    for group in holes.values():
        for word in group:
            near[word] |= set(group) - {word}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=word)
        if words[best] >= 2 * words[word]:
            form[word] = best

    def root(word):
        while word in form:
            word = form[word]
        return word

    return {w: (n, len(near[w]), form.get(w), words.get(form.get(w)), root(w))
            for w, n in words.items()}


def variants(docs) -> dict:
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root)
            for r in spelling.variants(docs).collect()}


def test_variants_of_the_whole_table(spark, sf_dir, texts):
    rows = queries.op11_spelling_variants(spark, sf_dir)
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows.collect()}
    assert got == variants_of(texts.items())


def test_variants_of_every_kind_of_edit(make_docs):
    words = ("letter " * 9 + "leter " * 4 + "lletter " * 3 + "letters " * 3 + "better " * 20
             + "latter " * 4 + "LETTER " + "écrit " * 8 + "ecrit " * 3 + "ècrit " * 4
             + "aaaaaa " * 6 + "aaaaa " * 3 + "aaaaaaa " * 3 + "fours " * 2 + "four " * 9)
    docs = [words, words, None, "", "letter" * 3, "other ones"]
    got = variants(make_docs(docs))
    assert got == variants_of(enumerate(docs))
    assert got["leter"][2] == "letter" and got["latter"][4] == "better"
    assert "four" not in got


def test_words_around_and_beyond_the_longest_of_the_trie(make_docs):
    words = []
    for size in (23, 24, 25, 26, 60, 300):
        base = ("abcdefghij" * 40)[:size]
        words += [base] * 9 + [base + "z"] * 4 + ["x" + base[1:]] * 3 + [base[:-1]] * 3
        words += [base[:9] + base[10:]] * 3 + [base[:5] + "é" + base[5:]] * 3
    docs = [" ".join(words)] * 2
    assert variants(make_docs(docs)) == variants_of(enumerate(docs))


def test_variants_of_odd_documents(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert variants(edge_docs) == variants_of(rows)
    assert variants(no_docs) == {}


def test_many_equal_rows_are_counted_apart(spark):
    docs = spark.range(30_000).select(F.lit(7).alias("doc_id"),
                                      F.lit("simple sample simpler").alias("text"))
    few = variants_of([(7, "simple sample simpler")] * 3)
    assert variants(docs) == {w: (n * 10_000, *more) for w, (n, *more) in few.items()}


# ---- manifest ------------------------------------------------------------------------

def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(r, text) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                       for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def tree_of(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 16]))
                       for i in range(0, len(levels[-1]), 16)])
    return levels


def manifest_of(rows) -> list[tuple]:
    groups = defaultdict(list)
    for r in rows:
        groups[r.source].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        groups[source].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0,
                                           leaf_of(r, r.text)))
        trees[source] = tree_of([leaf_of(r, r.text) for r in groups[source]])
    top = tree_of([trees[s][-1][0] for s in order])
    out = []
    for place, source in enumerate(order):
        for i, r in enumerate(groups[source]):
            node, proof = leaf_of(r, r.text), ""
            if r.doc_id is not None and r.text is not None and zlib.crc32(
                    str(r.doc_id).encode()) % 5 == 0:
                node = leaf_of(r, lowered(r.text))
            for levels, at in ((trees[source], i), (top, place)):
                for level in levels[:-1]:
                    left = "".join(level[at // 16 * 16:at])
                    right = "".join(level[at + 1:at // 16 * 16 + 16])
                    node, proof, at = sha(left + node + right), proof + left + right, at // 16
            out.append((r.doc_id, leaf_of(r, r.text), trees[source][-1][0], top[-1][0],
                        sha(proof), node, node == top[-1][0]))
    return sorted(out, key=str)


def manifest(docs) -> list[tuple]:
    return sorted((tuple(r) for r in merkle.verify(merkle.manifest(docs)).collect()), key=str)


def test_manifest_against_sql(spark, sf_dir):
    rows = queries.op12_merkle_manifest(spark, sf_dir)
    assert differences(rows, connect(sf_dir), queries.merkle_sql()) == []


@pytest.mark.parametrize("sizes", [(1,), (16, 1), (17, 300, 2, None), (256, 257, 15)])
def test_manifest_of_groups_of_any_size(spark, sizes):
    rows = [(100 * i + k, f"Text {k}", "en", None if n is None else f"s{i}", k)
            for i, n in enumerate(sizes) for k in range(5 if n is None else n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, "
                                       "n_chars bigint")
    got = manifest(docs)
    assert got == manifest_of(docs.collect())
    assert any(not r[-1] for r in got) or len(got) < 5


def test_manifest_of_odd_documents(edge_docs, no_docs):
    docs = edge_docs.withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.lit("Ä"))
                                .when(F.col("doc_id") % 2 > 0, F.lit("")))
    assert manifest(docs) == manifest_of(docs.collect())
    assert manifest(no_docs) == []


def test_manifest_of_many_sources_and_stretches(spark, monkeypatch):
    """Windows over short stretches, and a tree of sources with levels of its own."""
    monkeypatch.setattr(merkle, "STRETCH", 32)
    docs = spark.range(700).select(
        F.col("id").alias("doc_id"), F.lit("A").alias("text"), F.lit(None).cast("string").alias(
            "lang"), F.when(F.col("id") < 300, F.col("id").cast("string")).otherwise(
            "one").alias("source"), F.lit(1).alias("n_chars"))
    assert manifest(docs) == manifest_of(docs.collect())


def test_manifest_of_100_000_equal_rows(spark):
    """Equal rows are spread over the tasks; all that they share is right."""
    one = (None, "Same", "en", None, 4)
    docs = spark.range(100_000, numPartitions=8).select(
        F.lit(None).cast("bigint").alias("doc_id"), F.lit("Same").alias("text"),
        F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"),
        F.lit(4).cast("bigint").alias("n_chars"))
    placed = merkle.ranked(merkle.leaves(docs), ["doc_id", "leaf"], "t")
    assert placed.select("pos").distinct().count() == 100_000
    assert placed.agg(F.max("pos")).first()[0] == 99_999
    rows = merkle.verify(merkle.manifest(docs))
    got = rows.agg(F.count("*"), F.count_if("verified"), F.count_distinct("root"),
                   F.min("leaf"), F.count_distinct("proof_sha256")).first()
    leaf = sha("".join("-" if v is None else f"{len(str(v))}:{v}" for v in (
        one[0], one[3], one[2], one[4], one[1])))
    levels = tree_of([leaf] * 100_000)
    assert tuple(got)[:4] == (100_000, 100_000, 1, leaf)
    assert rows.first().root == levels[-1][0]


# ---- token counts --------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(WORD_BPE)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def counts(docs, path=WORD_BPE, cache=None) -> list[tuple]:
    return sorted(map(tuple, tokencache.token_counts(docs, path, cache).collect()), key=str)


def counts_of(docs, library) -> list[tuple]:
    return sorted(((r.doc_id, len((r.text or "").encode()), library(r.text))
                   for r in docs.collect()), key=str)


def test_counts_of_the_whole_table(spark, sf_dir, texts, library):
    rows = queries.op13_token_counts(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = library(texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (
            len((texts[r.doc_id] or "").encode()), n, n > 2048)


ODD = ["á ́b", "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "x\x1cy \x85z q\xa0r",
       "ΣΑΣ ΟΔΟΣ", "İ İ", "'S 's don'T 'll''re", "a" * 5000 + " " + "!" * 3000,
       "中文 \U0001f600‍\U0001f600", "1 2 345\t\n6", "﻿a᠎b", "<|endo ftext|>",
       "a\x00b", " a\r\n\r\nb ", "a  b", "a b", "é ́"]


def test_counts_of_odd_documents(make_docs, edge_docs, no_docs, library):
    docs = edge_docs.union(make_docs([(100 + i, t) for i, t in enumerate(ODD)]))
    assert counts(docs) == counts_of(docs, library)
    assert counts(no_docs) == []


def test_counts_of_a_sentencepiece_model(make_docs):
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_file=PIECES)
    docs = make_docs([None, "", "a  b", "a b", " a\tb ", "Zwei Wörter", *ODD[:3]])
    assert counts(docs, PIECES) == counts_of(docs, lambda t: len(processor.encode(t or "")))


def test_only_misses_are_encoded_and_appended(spark, make_docs, tmp_path, library):
    cache = str(tmp_path / "cache")
    first = make_docs(["one two", "one  two", "one two", "three"])
    assert counts(first, cache=cache) == counts_of(first, library)
    stored = spark.read.parquet(cache)
    # White space folds: two texts, not four.
    assert stored.count() == 2
    # A stored count is taken as it is, so a changed one shows that nothing is encoded anew.
    altered = str(tmp_path / "altered")
    stored.withColumn("n_tokens", F.col("n_tokens") + 100).write.parquet(altered)
    again = counts(make_docs(["one two", "four five six", None]), cache=altered)
    assert again == [(0, 7, 102), (1, 13, 3), (2, 0, 0)]
    assert spark.read.parquet(altered).count() == 4
    # Another tokenizer shares nothing.
    assert counts(make_docs(["three"]), PIECES, altered)[0][2] < 100
    assert spark.read.parquet(altered).select("tokenizer").distinct().count() == 2


def test_doubled_entries_are_read_once(spark, make_docs, tmp_path, library):
    cache = str(tmp_path / "cache")
    docs = make_docs(["one two", "three"])
    counts(docs, cache=cache)
    spark.read.parquet(cache).write.parquet(f"{cache}-2")
    spark.read.parquet(f"{cache}-2").write.mode("append").parquet(cache)
    assert counts(docs, cache=cache) == counts_of(docs, library)


def test_few_and_many_misses_give_the_same(spark, documents, tmp_path):
    found = []
    for few in (0, 10**6):
        cache = str(tmp_path / f"cache-{few}")
        contents = documents.select(tokencache.content_of(documents, WORD_BPE)).distinct()
        tokencache.fill_cache(documents, contents, WORD_BPE, cache, few)
        found.append(sorted(map(tuple, spark.read.parquet(cache).collect())))
    assert found[0] == found[1]


def test_session_names_a_lasting_cache(spark, make_docs, tmp_path):
    spark.conf.set(tokencache.CACHE_SETTING, str(tmp_path / "lasting"))
    try:
        counts(make_docs(["one", "two"]))
        counts(make_docs(["two", "three"]))
        assert spark.read.parquet(str(tmp_path / "lasting")).count() == 3
    finally:
        spark.conf.unset(tokencache.CACHE_SETTING)


def test_remembered_stretches_are_bounded(monkeypatch, library):
    monkeypatch.setattr(tokencache, "REMEMBERED", 3)
    tokencache.counter.cache_clear()
    text = "some few words " * 3 + "x" * 100
    assert tokencache.counter(WORD_BPE)([text] * 3) == [library(text)] * 3
    assert len(tokencache.counter(WORD_BPE).__self__) <= 4
    tokencache.counter.cache_clear()


def test_which_tokenizers_fold_white_space():
    assert tokencache.folds_space(WORD_BPE)
    assert not tokencache.folds_space(PIECES)
    assert not tokencache.folds_space(public_tokenizers.path("byte_bpe_50k.json"))
