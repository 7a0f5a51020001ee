"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cobble.llm import (
    alignment,
    chat,
    decontam,
    lcp,
    packing,
    prefix_trie,
    quality,
    secret_scan,
    simhash,
    token_counts,
    tokens,
    toxicity,
    url_filters,
)
from cobble.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_output(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


#: A conversation whose texts hold control strings of the templates.
ODD_CHAT = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(ODD_CHAT, "conv_id bigint, turn bigint, role string, text string")
    return chat.chat_output(rows.unionByName(odd))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lcp.fingerprint_documents(table(spark, sf_dir, "documents"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_apart(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), a, b)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), limit=512)


QUERIES = {
    "op1_tokens": op1_tokens,
    "op2_secrets": op2_secrets,
    "op3_simhash": op3_simhash,
    "op4_chat": op4_chat,
    "op5_decontamination": op5_decontamination,
    "op6_fingerprints": op6_fingerprints,
    "op7_urls": op7_urls,
    "op8_quality": op8_quality,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_alignment": op12_alignment,
    "op13_token_counts": op13_token_counts,
}

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _escaped(column: str) -> str:
    """SQL of a text with its backslashes doubled and the template's control strings broken up."""
    return rf"regexp_replace(replace({column}, '\', '\\'), '(<|\[)(/?s>|/?ROLE\]|/?INST\])', '\1\\\2', 'g')"


ORACLES: dict[str, str] = {
    "op4_chat": f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
),
out AS (
  SELECT *, '<s>[ROLE]' || {_escaped("role")} || '[/ROLE]' ||
    CASE role WHEN 'assistant' THEN ' ' || {_escaped("text")} ELSE '[INST] ' || {_escaped("text")} || ' [/INST]' END
    || '</s>' AS formatted
  FROM rows
),
conv AS (
  SELECT conv_id, count(*) AS n_turns, sum(length(formatted)) AS formatted_chars,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss
  FROM out GROUP BY conv_id
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256,
  CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM conv
""",
    "op5_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, unnest(list_transform(
    range(1, greatest(len(w) - 12, 1) + 1),
    lambda i: array_to_string(w[i:i + 12], ' '))) AS win
  FROM b WHERE len(w) > 0
),
seen AS (
  SELECT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS win,
    unnest(range(1, len(w) - k + 2)) AS i
  FROM d, (SELECT DISTINCT k FROM win) ks WHERE len(w) >= k
),
hits AS (SELECT doc_id, i, k, item_id FROM seen JOIN win USING (win, k)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS joined
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
""",
}
