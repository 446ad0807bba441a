"""The registered ``opN_`` queries of this subpackage and their SQL, where SQL can express them.

A query is thin: it reads the whole table, calls its operator with production parameters and
derives the digest columns from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplebook.llm import chat, decontam, langid, packing, quality, sharding, simhash, substring, toxicity, url_filter
from ripplebook.llm.common import crc_mod, table


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document into one of 16 shards by balanced label propagation; equal texts are links."""
    sharded = sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"), shards=16)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, tokenised whole and packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


#: Bound of the labelled sample that op4 learns from: rows of each label.
TOXIC_PER_CLASS = 3000
#: Bound of the labelled sample that op7 learns from: about so many rows of each language, twice that at most.
LANG_PER_LANGUAGE = 600


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document; learns from rows of crc32(doc_id) mod 5 other than 0."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").filter(crc_mod(F.col("doc_id"), 5) != 0)
    texts, marks, share = toxicity.training_sample(docs, labels, TOXIC_PER_CLASS, doc_id="doc_id", text="text", label="toxic")
    scored = toxicity.score(docs, toxicity.learn(texts, marks, toxic_share=share), keep=["doc_id"])
    held = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; learns from rows of crc32(doc_id) mod 4 other than 2."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    texts, langs = langid.training_sample(docs.filter(crc_mod(F.col("doc_id"), 4) != 2), LANG_PER_LANGUAGE)
    found = langid.identify(docs.select("doc_id", "text"), langid.learn(texts, langs), keep=["doc_id"])
    held = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of every document: 4-word shingles, links at 4 differing bits or fewer."""
    return simhash.near_duplicate_classes(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of every document that a document of smaller id has too."""
    spans = substring.repeated_spans(table(spark, sf_dir, "documents", "doc_id", "text"))
    return spans.select("doc_id", "start", "end", "n_words", "first_doc_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of every document with every benchmark item."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontam.overlaps(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold rules over every document."""
    judged = quality.judge(table(spark, sf_dir, "documents", "doc_id", "text"))
    q = lambda k: F.col(f"quality.{k}")
    base = (q("n_words") < 50) | (100 * q("n_repeat_words") > 50 * q("n_words"))
    return judged.select(
        "doc_id",
        *[q(k).alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base.alias("base_failed"),
        (~base & F.col("kept")).alias("kept"),
    )


def _quality_sql() -> str:
    stops = ", ".join(f"'{w}', '{w.capitalize()}'" for w in dict.fromkeys(quality.STOP_WORDS))
    tests = []
    for r in quality.RULES:
        if r.low is not None:
            tests.append(f"{r.metric} < {r.low}")
        if r.high is not None:
            tests.append(f"{r.metric} > {r.high}")
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
w AS (SELECT doc_id, body, list_filter(regexp_split_to_array(body, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT doc_id, i, concat_ws(' ', ws[i], ws[i + 1], ws[i + 2]) AS gram
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT p) AS rep FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM d) GROUP BY doc_id),
f AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep, 0) AS BIGINT) AS n_repeat_words,
             len(list_filter(ws, lambda x: x IN ({stops}))) AS stops, len(ls) AS n_lines,
             length(body) - length(replace(body, '!', '')) AS shouts
      FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
             CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_ratio,
             CASE WHEN n_words > 0 THEN stops / n_words ELSE 0 END AS stop_ratio,
             CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_ratio,
             CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
             CASE WHEN n_words > 0 THEN shouts / n_words ELSE 0 END AS shout_ratio FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR {" OR ".join(tests)}) AS kept FROM m
"""


#: Fixed by the contract of op1.
URL_RULES = (
    url_filter.HostRule("org", "/", "allow"),
    url_filter.HostRule("example.org", "/es/", "block"),
    url_filter.HostRule("example.org", "/en/1", "block"),
    url_filter.HostRule("com", "/fr/", "allow"),
    url_filter.HostRule("com", "/de/", "block"),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and a URL list over every page.

    The tables hold no URL list; the canonical URLs that some page reaches through a ``ref``
    parameter stand in for one.
    """
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    listed = pages.filter(F.col("url").rlike(r"[?&]ref=")).select(
        url_filter.canonical_url(F.col("url")).alias("canonical_url")
    )
    return url_filter.judge_urls(pages, listed, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "canonical_url", "listed"
    )


_URL_SQL = r"""
WITH a AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
b AS (SELECT page_id, url, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
             regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS asked FROM a),
c AS (SELECT *, regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '') AS h,
             regexp_replace(regexp_replace(path, '/index\.html?$', '/'), '/+$', '') AS p,
             array_to_string(list_sort(list_filter(string_split(asked, '&'), lambda x: x <> '' AND NOT
               regexp_matches(lower(x), '^(ref|fbclid|gclid|utm_[a-z]+|session|sid)(=|$)'))), '&') AS q FROM b),
d AS (SELECT page_id, url, host, path, CASE WHEN h <> '' THEN h || p || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS canonical_url FROM c),
l AS (SELECT DISTINCT canonical_url AS k FROM d WHERE regexp_matches(url, '[?&]ref=') AND canonical_url IS NOT NULL),
e AS (SELECT d.*, k IS NOT NULL AS listed FROM d LEFT JOIN l ON canonical_url = k),
f AS (SELECT *, CASE
  WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
  WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
  WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
  WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
  WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule FROM e)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict, canonical_url, listed FROM f
"""


#: Bound of the sample that op10 counts its probabilities on: conversations.
CHAT_CONVERSATIONS = 2000


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as a raw transcript, its turns and roles recovered and rendered; learns from conversations of
    crc32(conv_id) mod 5 other than 0."""
    conversations = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    model = chat.learn(chat.training_sample(conversations.filter(crc_mod(F.col("conv_id"), 5) != 0), CHAT_CONVERSATIONS))
    held = F.coalesce(crc_mod(F.col("conv_id"), 5) == 0, F.lit(False))
    return chat.parse_transcripts(chat.raw_parts(conversations).drop("role"), model).withColumn("held_out", held)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_sharding": op2_sharding,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_toxicity": op4_toxicity,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_language_id": op7_language_id,
    "op8_decontamination": op8_decontamination,
    "op9_quality_rules": op9_quality_rules,
    "op10_chat_formatting": op10_chat_formatting,
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": _URL_SQL,
    "op9_quality_rules": _quality_sql(),
}
