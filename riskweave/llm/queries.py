"""Queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import (
    bpe, decontam, langid, merkle, pii, quality, repeats, sharding, simhash, spelling, tokencache,
    toxicity, urlfilter,
)
from riskweave.llm.common import table

# Rules and block list of the URL query.
URL_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
BLOCKED_SITES = tuple(f"{site}.example.{top}" for top in ("com", "net", "org") for site in (
    "ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"))

TOKEN_LIMIT = 2048
# Key of the pseudonyms of synthetic test tables; real ones come from the session's setting.
TEST_KEY = "riskweave"

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_hd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it contains."""
    return decontam.contaminated(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("byte_bpe_50k.tiktoken"),
                             public_tokenizers.PATTERN)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "key string, verdict string")
    blocked = spark.createDataFrame([(s,) for s in BLOCKED_SITES], "key string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules, blocked)


def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text with pseudonyms, and the number of values replaced by kind."""
    found = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"),
                             pii.session_key(spark, TEST_KEY), kinds="_kinds")
    kinds = {"emails": ["email"], "ips": ["ip"], "phones": ["phone"], "cards": ["card"],
             "ssns": ["ssn"], "dates": ["iso_date", "year_first", "month_first", "day_first"]}

    def count(names: list[str]) -> Column:
        return F.size(F.filter("_kinds", lambda kind: kind.isin(names)))

    return found.select("doc_id", "text", *[count(names).alias(f"n_{kind}")
                                            for kind, names in kinds.items()])


def op8_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards of nearly equal bytes; texts that are equal share a shard."""
    return sharding.by_bytes(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_run_length_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word with its near words, its form and the root of its forms."""
    return spelling.variants(table(spark, sf_dir, "documents")).select(
        "word", "form", "root", "n", "n_near", "form_n")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof, and whether each leaf still verifies after tampering."""
    return merkle.verify(merkle.manifest(table(spark, sf_dir, "documents")))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts, and which texts are longer than a context of TOKEN_LIMIT."""
    return tokencache.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
    ).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


URL_SQL = r"""
WITH cut AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
rules(h, p, rule, verdict) AS (VALUES
  ('org', '/', 'org/', 'allow'), ('example.org', '/es/', 'example.org/es/', 'block'),
  ('example.org', '/en/1', 'example.org/en/1', 'block'), ('com', '/fr/', 'com/fr/', 'allow'),
  ('com', '/de/', 'com/de/', 'block')),
best AS (
  SELECT c.page_id, arg_max(r.rule, length(r.rule)) AS rule,
    arg_max(r.verdict, length(r.rule)) AS verdict
  FROM cut c JOIN rules r ON (c.host = r.h OR ends_with(c.host, '.' || r.h))
    AND starts_with(c.path, r.p)
  GROUP BY c.page_id)
SELECT c.page_id, c.host, c.path, b.rule,
  coalesce(b.verdict, CASE WHEN regexp_matches(c.host,
    '(^|\.)(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.example\.(com|net|org)$')
    THEN 'block' ELSE 'allow' END) AS verdict
FROM cut c LEFT JOIN best b ON c.page_id = b.page_id
"""


QUALITY_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w[i:i + 7] AS win
  FROM cut WHERE len(w) >= 8),
twice AS (
  SELECT doc_id, unnest(list(i)) AS i FROM windows GROUP BY doc_id, win HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 8)) AS j FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM cut)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT c.doc_id, len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(text, '[^!?]', '', 'g'))::BIGINT AS emphasis,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS stutters,
    coalesce(l.dup, 0)::BIGINT AS n_dup_lines, coalesce(l.n, 0) AS n_lines,
    coalesce(v.n, 0)::BIGINT AS n_repeat_words
  FROM cut c LEFT JOIN lines l ON c.doc_id = l.doc_id
  LEFT JOIN covered v ON c.doc_id = v.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > 3 * n_words
    OR 10 * emphasis > 3 * n_words OR 10 * (n_dup_lines - 1) > 3 * n_lines
    OR 10 * stutters > 3 * n_words
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM base
"""


def merkle_sql(group_levels: int = 5, top_levels: int = 3) -> str:
    """The manifest in SQL, for up to 16 to the power of the levels. Levels beyond a group's
    own leave its one node as it is."""
    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform("
           "string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)), lambda a, b: "
           "list_reduce(list_prepend(xor(a, b), range(8)), lambda v, i: "
           "xor(v >> 1, (v & 1) * 3988292384))))")

    def hashed(text: str) -> str:
        fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return "sha256(concat(%s))" % ", ".join(
            f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields)

    def tree(name: str, count: int) -> str:
        parts = []
        for k in range(count):
            around = "OVER (PARTITION BY grp, pos // 16 ORDER BY pos ROWS BETWEEN "
            parts.append(f"""{name}s{k} AS (SELECT grp, pos, n,
  coalesce(string_agg(digest, '') {around} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(digest, '') {around} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k}),
{name}{k + 1} AS (SELECT grp, pos // 16 AS pos, (n + 15) // 16 AS n,
  CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE min(digest) END AS digest
  FROM {name}{k} GROUP BY grp, pos // 16, n)""")
        return ",\n".join(parts)

    steps = [f"g{k}" for k in range(group_levels)] + [f"t{k}" for k in range(top_levels)]
    fold, joins, proof, at = [], [], [], "start"
    for name, step in ((s[0] + "s" + s[1:], s) for s in steps):
        on = (f"{name}.grp = leaf.grp AND {name}.pos = leaf.pos // {16 ** int(step[1:])}"
              if step[0] == "g" else f"{name}.pos = place.pos // {16 ** int(step[1:])}")
        joins.append(f"JOIN {name} ON {on}")
        proof.append(f"{name}.l || {name}.r")
        fold.append(f"CASE WHEN {name}n > 1 THEN sha256({name}l || {at} || {name}r) ELSE {at} END "
                    f"AS x{len(fold)}")
        at = f"x{len(fold) - 1}"
    sides = ", ".join(f"{n}.n AS {n}n, {n}.l AS {n}l, {n}.r AS {n}r"
                      for n in (s[0] + "s" + s[1:] for s in steps))
    folds = "(SELECT * FROM wide)"
    for f in fold:
        folds = f"(SELECT *, {f} FROM {folds})"
    return f"""
WITH leaf AS (
  SELECT doc_id, coalesce('s' || source, '-') AS grp, digest, start,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT doc_id, source, {hashed("text")} AS digest,
    CASE WHEN {crc} % 5 = 0 AND text IS NOT NULL THEN {hashed(
        "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
      ELSE {hashed("text")} END AS start
    FROM documents)),
g0 AS (SELECT grp, pos, n, digest FROM leaf),
{tree("g", group_levels)},
place AS (SELECT grp AS of, digest, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos,
  count(*) OVER () AS n FROM g{group_levels}),
t0 AS (SELECT '' AS grp, pos, n, digest FROM place),
{tree("t", top_levels)},
wide AS (SELECT leaf.doc_id, leaf.digest AS leaf, leaf.start, place.digest AS subroot,
  t{top_levels}.digest AS root, sha256({" || ".join(proof)}) AS proof_sha256, {sides}
  FROM leaf JOIN place ON place.of = leaf.grp {" ".join(joins)} CROSS JOIN t{top_levels})
SELECT doc_id, leaf, subroot, root, proof_sha256, {at} AS folded_root, {at} = root AS verified
FROM {folds}
"""


def all_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_quality_rules, op2_toxicity, op3_hd_language,
                                      op4_decontamination, op5_byte_bpe, op6_url_filters,
                                      op7_pii_pseudonyms, op8_minimax_shards, op9_run_length_dedup,
                                      op10_simhash, op11_spelling_variants,
                                      op12_merkle_manifest, op13_token_counts)}


def all_oracles() -> dict[str, str]:
    return {"op1_quality_rules": QUALITY_SQL, "op6_url_filters": URL_SQL,
            "op12_merkle_manifest": merkle_sql()}
