"""Token counts with a digest cache.

The cache is a Parquet table of (content digest, tokenizer digest, count). A text's content
digest is the SHA-256 of its normalised form, the tokenizer digest covers the vocabulary file,
the library's name and version. Texts are joined with the stored counts by digest; the texts
of digests that are missing are encoded once each, however many rows hold them, and appended.
Counts of another tokenizer or version never match.

Normalisation does only what no count can depend on: null is the empty text, and, for
tokenizers that say so (``folds_space``), runs of white space are one space. Every text,
however long, is encoded as a whole.

Equal texts share a count. Rows without an id, repeated ids and further columns are kept as
they are; an empty table gives no rows and adds nothing. An entry that two jobs append at the
same time is stored twice, with the same count, and read once.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from functools import lru_cache
from importlib.metadata import version

import regex
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import map_batches, written
from riskweave.session import work_path

CACHE = "content binary, tokenizer string, n_tokens bigint"
# Name of the session setting for a cache that outlives the job; without it a job has its own.
CACHE_SETTING = "spark.riskweave.tokenCache"
# Up to so many missing digests (32 bytes each) are sent to every task, so that texts that are
# known already are not shuffled.
FEW_MISSES = 100_000
# Stretches of text whose counts one worker remembers at most (then it starts anew), and the
# bytes of the longest of them.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 64


def library_of(path: str) -> str:
    return "tokenizers" if path.endswith(".json") else "sentencepiece"


def tokenizer_digest(path: str) -> str:
    """Of the vocabulary file and the library that reads it."""
    name = library_of(path)
    with open(path, "rb") as file:
        content = hashlib.file_digest(file, "sha256").hexdigest()
    return f"{name}-{version(name)}-{content}"


@lru_cache(maxsize=4)
def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts of a list of texts; one per worker process, which uses one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if library_of(path) == "tokenizers":
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def count(texts: list[str]) -> list[int]:
            return list(map(len, tokenizer.encode_batch_fast(texts, add_special_tokens=False)))

        return Stretches(count).counts if folds_space(path) else count
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_file=path)
    return lambda texts: [len(processor.encode(t, num_threads=1)) for t in texts]


class Stretches(dict):
    """Counts of the stretches between white space, as UTF-8, remembered up to a bound.

    Where the tokenizer treats any white space as one space and no token or special string
    holds a space, a text has as many tokens as its stretches have together.
    """

    def __init__(self, count: Callable[[list[str]], list[int]]):
        self.count = count

    def counts(self, texts: list[str]) -> list[int]:
        if len(self) > REMEMBERED:
            self.clear()
        return [self.of(text.encode().split()) for text in texts]

    def of(self, stretches: list[bytes]) -> int:
        fresh = list({s for s in stretches if s not in self})
        self.update(zip(fresh, self.count([s.decode() for s in fresh])))
        total = sum(map(self.__getitem__, stretches))
        for stretch in fresh:
            if len(stretch) > LONGEST_REMEMBERED:
                del self[stretch]
        return total


def folds_space(path: str) -> bool:
    """Whether the tokenizer turns any run of white space into one space and drops it, so
    that nothing it forms crosses white space. Only the settings named here are known to."""
    if library_of(path) != "tokenizers":
        return False
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    steps = (told["normalizer"] or {}).get("normalizers", [])
    cuts = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        {s["type"] for s in steps} <= {"NFC", "Replace", "Lowercase"}
        and [(s["pattern"], s["content"]) for s in steps if s["type"] == "Replace"]
        == [({"Regex": r"\s+"}, " ")]
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"]
        and not any(s.isspace() for piece in regex.findall(
            cuts[0]["pattern"]["Regex"], "a 'b\t1\n.\r\x0b\x0c 's  !") for s in piece)
        and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
        and not any(s.isspace() or t["lstrip"] or t["rstrip"]
                    for t in told["added_tokens"] for s in t["content"])
        and told["post_processor"] is None
    )


def normalised(text: Column, fold_space: bool) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.regexp_replace(text, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ") if fold_space else text


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """content, n_tokens stored for a tokenizer; empty before the first append."""
    try:
        stored = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE)
    return stored.where(F.col("tokenizer") == tokenizer).groupBy("content").agg(
        F.max("n_tokens").alias("n_tokens"))


def encode_missing(texts: DataFrame, path: str) -> DataFrame:
    """content, n_tokens of (content, text), one row per distinct content."""
    def run(content: list, text: list) -> list[tuple]:
        return list(zip(content, counter(path)(text)))

    return map_batches(texts.select("content", "text"), run, "content binary, n_tokens bigint")


def fill_cache(docs: DataFrame, contents: DataFrame, path: str, cache: str,
               few_misses: int = FEW_MISSES) -> None:
    """Append the counts of all texts of ``docs`` that the cache does not have.

    ``contents`` has the distinct digests of ``docs``. Copies of a text are merged before the
    shuffle, so a text that very many rows hold costs one row per task.
    """
    spark, tokenizer = docs.sparkSession, tokenizer_digest(path)
    known = read_cache(spark, cache, tokenizer)
    missing = written(contents.join(known, "content", "left_anti"), "token-misses")
    n = missing.count()
    if not n:
        return
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), content_of(docs, path))
    if n <= few_misses:
        texts = texts.join(F.broadcast(missing), "content", "left_semi")
    distinct = texts.groupBy("content").agg(F.first("text").alias("text"))
    if n > few_misses:
        distinct = distinct.join(missing, "content", "left_semi")
    encode_missing(distinct, path).select(
        "content", F.lit(tokenizer).alias("tokenizer"), "n_tokens").write.mode(
        "append").parquet(cache)


def content_of(docs: DataFrame, path: str) -> Column:
    return content_digest(normalised(docs["text"], folds_space(path))).alias("content")


def cache_path(spark: SparkSession) -> str:
    """The folder that the session names for a lasting cache, else a fresh one."""
    return spark.conf.get(CACHE_SETTING, None) or work_path(spark, "token-cache")


def token_counts(docs: DataFrame, path: str, cache: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens."""
    spark = docs.sparkSession
    cache = cache or cache_path(spark)
    keyed = written(docs.select(
        docs["doc_id"], F.octet_length(F.coalesce(docs["text"], F.lit(""))).cast("bigint")
        .alias("n_bytes"), content_of(docs, path)), "token-keys")
    contents = written(keyed.select("content").distinct(), "token-contents")
    fill_cache(docs, contents, path, cache)
    # Written, so that the join below has plain tables on both sides and splits hot texts.
    counts = written(contents.join(read_cache(spark, cache, tokenizer_digest(path)), "content"),
                     "token-counts")
    return keyed.join(counts, "content").select("doc_id", "n_bytes", "n_tokens")
