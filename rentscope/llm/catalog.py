"""Queries ``opN_<name>`` over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import (chat_events, conv_repair, fm_decontam, html_sst, license_scan, line_rules, pack_spf, packing, quality_qda, secret_forest,
               simhash_gray, token_counts, whiten_qdwh)

Job = Callable[[SparkSession, str], DataFrame]


def word_tokenizer() -> str:
    """File of the public word-end BPE tokenizer."""
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def byte_tokenizer() -> str:
    """File of the public byte-level BPE tokenizer."""
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "text")
    return token_counts.suffix_sums(token_counts.length_histogram(docs, word_tokenizer()))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return line_rules.apply_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines_removed")


def op2_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return quality_qda.score_documents(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_sst.extract_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op4_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return simhash_gray.near_dup_groups(docs).select(
        "doc_id", simhash_gray.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return secret_forest.findings(docs, secret_forest.usual_model(spark))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, word_tokenizer())


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    marked = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", marked), (-1, 1, "assistant", marked)],
                                "conv_id bigint, turn bigint, role string, text string")
    log = chat_events.events_of_turns(turns.unionByName(own))
    return chat_events.digests(chat_events.format_conversations(log))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a directory per source, language and 64 ids.  A document of at most
    600 characters stands for a licence file one level up, any other for a text file."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    top = F.concat_ws("/", "source", "lang")
    number = F.col("doc_id").cast("string")
    path = F.when(F.length("text") <= 600, F.concat(top, F.lit("/LICENSE."), number)) \
        .otherwise(F.concat(top, F.lit("/b"), F.floor(F.col("doc_id") / 64).cast("string"), F.lit("/"), number,
                            F.lit(".txt")))
    return license_scan.scan(docs.select("doc_id", path.alias("path"), "text")).select(
        "doc_id", "path", "is_license_file", "own_license", "own_score", "n_statements", "license", "origin",
        "from_directory")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return fm_decontam.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_packing_spf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pack_spf.pack(docs, byte_tokenizer())


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_qdwh.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conv_repair.repair_conversations(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


QUERIES: dict[str, Job] = {f.__name__: f for f in (
    op1_token_counts, op2_quality_qda, op3_html_extraction, op4_simhash_gray, op5_quality_rules, op6_secret_scan, op7_packing,
    op8_chat_formatting, op9_license_scan, op10_decontamination, op11_packing_spf, op12_whitening, op13_conversation_repair)}

# The escaped length: a backslash more for each backslash and each control string.
_CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
         + len(regexp_extract_all(replace(text, '\', '\\'), '</?s>|\[/?INST\]|\[SYS\]|\[/?ROLE\]')) AS n,
         CASE role WHEN 'user' THEN 6 WHEN 'assistant' THEN 7 WHEN 'system' THEN 5
              ELSE 13 + 2 * octet_length(encode(role)) END AS tag
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(7 + tag + n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""".replace("\\\\", "\\").strip()

_LINES = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         string_split(t, chr(10)) AS lines FROM d
), win AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w) x
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM win) x WHERE c > 1
), rep AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(3) r(k) GROUP BY rid
), line AS (
  SELECT rid, x, length(x) AS n, length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) AS sym,
         length(regexp_replace(x, '[^|»›→•·]', '', 'g')) AS sep,
         length(regexp_replace(x, '[^\p{Lu}]', '', 'g')) AS up
  FROM (SELECT rid, unnest(lines) AS x FROM w) y
), judged AS (
  SELECT rid, n, sym,
         sym > 0.05 * n OR (sep >= 3 AND sep >= 0.03 * n)
         OR (n >= 80 AND NOT regexp_matches(x, '[.!?…](?:["''”’»)\]]|[\x20\x09-\x0D]|$)')
             AND NOT regexp_matches(x, '^[\x20\t]*(?:[-*+•‣–—▪●·]|\(?[0-9]{1,3}[.)]|\(?[A-Za-z][.)]|#{1,6})[\x20\t]+[^\x20\t]'))
         OR (n <= 200 AND regexp_matches(x, '{boilerplate}'))
         OR (n >= 20 AND up > 0.4 * n) AS fails
  FROM line
), sums AS (
  SELECT rid, sum(sym) AS n_symbols, count_if(fails) AS removed, sum(n) AS whole,
         coalesce(sum(n) FILTER (NOT fails), 0) AS rest
  FROM judged GROUP BY rid
), base AS (
  SELECT w.rid, doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         CAST(n_symbols AS BIGINT) AS n_symbols,
         len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
         - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, removed AS n_lines_removed, whole, rest
  FROM w JOIN sums USING (rid) LEFT JOIN rep USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND (whole = 0 OR 1 - rest / whole <= 0.4) AS kept,
       CAST(n_lines_removed AS BIGINT) AS n_lines_removed
FROM base
""".replace("\\\\", "\\").replace("{boilerplate}", line_rules.BOILERPLATE).strip()

ORACLE: dict[str, str] = {"op5_quality_rules": _LINES, "op8_chat_formatting": _CHAT}


def queries() -> dict[str, Job]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
