from __future__ import annotations

import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """doc_id -> text of the small test table."""
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts or (doc_id, text) pairs, with columns whose names clash."""
    def make(texts):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en", "src0", None if t is None else len(t), "x", 1, "y", 2, "z")
                for i, t in pairs]
        return spark.createDataFrame(rows, (
            f"{COLUMNS}, key string, fp int, root string, kinds int, gone string"))

    return make


# Nulls, empty and blank texts, no letters, equal rows, a long text, odd characters.
EDGE_TEXTS = [
    None, "", " \t\n\x0b\x0c\r", "12345 ... !!!", "one", "one two", "same text here again",
    "same text here again", "A" * 3000, "word " * 4000, "\x00 \x1c null   spaces \U0001f600",
    "line\nline\nline\n\nother", "é ß ñ 中文 слово", (None, "an id that is null"),
    (6, "same text here again"),
]


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(EDGE_TEXTS)]
    return make_docs(pairs)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
