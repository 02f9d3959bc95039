"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import (
    decontaminate, langid, line_templates, mixing, ngram_join, quality, sentence_spans, spelling, suffix_dedup, token_align, token_files, url_filter,
    warc,
)
from riskmart.llm.common import id_out, table
from riskmart.session import scratch_path


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs, "doc_id")
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.with_revisits(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    files = warc.write_warc(records, scratch_path(spark, "warc"))
    return warc.read_warc(files, payload=False).select(
        warc.page_id_of("record_id").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("warc_type").alias("record_type"), warc.page_id_of("refers_to").alias("refers_to"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixing.choose(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return chosen.select(id_out().alias("doc_id"), "size", "source_size", "target",
                         (F.col("size") * F.col("copies")).alias("taken"), mixing.source_out().alias("source"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, (*url_filter.QUERY_RULES, *url_filter.METHOD_RULES))
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


OP6_SQL = r"""
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(h, p, action) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
judged AS (
  SELECT page_id, host, path,
    (SELECT max(struct_pack(n := length(h || p), a := action, r := h || p)) FROM rules
     WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best,
    regexp_matches(host || path, '(^|[^\p{L}\p{N}])(casino|porn|xxx|viagra|torrent|warez|escort|betting)($|[^\p{L}\p{N}])')
      OR regexp_matches(host || path, '/wp-(admin|login)([/.]|$)')
      OR regexp_matches(host || path, '/cgi-bin/')
      OR regexp_matches(host || path, '^ads?[0-9]*\.[^/]+/') AS bad
  FROM parts)
SELECT page_id, host, path, best.r AS rule,
  coalesce(best.a, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict
FROM judged"""


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "kept_chars")


OP7_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
runs AS (SELECT k, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS run, i
  FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
again AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, run) AS n FROM runs) WHERE n > 1),
rep AS (SELECT k, count(DISTINCT i + j) AS n FROM again, (VALUES (0), (1), (2)) v(j) GROUP BY k),
lines AS (SELECT k, i, ls[i] AS line FROM (
  SELECT k, string_split(text, chr(10)) AS ls, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM d)),
marked AS (SELECT k, line, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
  regexp_matches(line, '([|»›·•][^|»›·•]*){3}')
  OR regexp_matches(line, '(?i)all rights reserved|(licensed|released) under|terms of (use|service)|privacy policy|accept (all )?cookies|click here|subscribe to|sign (in|up) to|enable javascript|lorem ipsum')
  OR len(regexp_extract_all(line, '[\p{L}\p{N}][#*$%&<>]{2,}')) >= 3
  OR (NOT regexp_matches(line, '[.!?…。:;]')
      AND len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) BETWEEN 1 AND 7) AS bad
  FROM lines),
l AS (SELECT k, count(*) FILTER (chars > 0) - count(DISTINCT line) FILTER (chars > 0) AS dup,
  coalesce(sum(chars) FILTER (NOT bad), 0)::BIGINT AS kept_chars FROM marked GROUP BY k),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    dup::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, kept_chars
  FROM d JOIN w USING (k) JOIN l USING (k) LEFT JOIN rep USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND 100 * (word_chars - kept_chars) <= 50 * word_chars AS kept, kept_chars
FROM m"""

def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                table(spark, sf_dir, "benchmark"))


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id,
    regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
b AS (SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
dp AS (SELECT k, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5),
bp AS (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM b WHERE len(w) >= 5),
masks(m, off, span) AS (VALUES (0, [0, 1, 2, 4], 5), (1, [0, 3, 4, 5], 6), (2, [0, 1, 3, 6], 7)),
ds AS (SELECT k, i, m, list_transform(off, lambda o: w[i + o]) AS seed FROM dp JOIN masks ON i + span - 1 <= len(w)),
bs AS (SELECT item_id, i, m, list_transform(off, lambda o: w[i + o]) AS seed FROM bp JOIN masks ON i + span - 1 <= len(w)),
laid AS (SELECT DISTINCT k, item_id, ds.i - bs.i AS shift FROM ds JOIN bs USING (m, seed)),
pairs AS (SELECT k, item_id, shift, dw, bw, unnest(range(greatest(1, 1 - shift), least(len(bw), len(dw) - shift) + 1)) AS j,
    least(16, len(bw)) AS width
  FROM (SELECT k, item_id, shift, d.w AS dw, b.w AS bw FROM laid JOIN d USING (k) JOIN b USING (item_id))),
runs AS (SELECT k, item_id, shift, j, width, lead(j, width - 1) OVER o AS last_j,
    sum((dw[j + shift] = bw[j])::INT) OVER (PARTITION BY k, item_id, shift ORDER BY j
      ROWS BETWEEN CURRENT ROW AND width - 1 FOLLOWING) AS same
  FROM pairs WINDOW o AS (PARTITION BY k, item_id, shift ORDER BY j)),
found AS (SELECT k, item_id, max(same) AS matched FROM runs
  WHERE last_j IS NOT NULL AND 100 * same >= CASE WHEN width < 8 THEN 100 ELSE 75 END * width GROUP BY k, item_id),
by_doc AS (SELECT k, count(DISTINCT item_id) AS n, max(matched) AS matched,
    array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids FROM found GROUP BY k)
SELECT doc_id, n IS NOT NULL AS contaminated, coalesce(n, 0)::BIGINT AS n_items, coalesce(ids, '') AS item_ids,
  coalesce(matched, 0)::BIGINT AS matched
FROM d LEFT JOIN by_doc USING (k)"""


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_templates.report(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.length("cleaned").cast("long").alias("kept_chars"),
                        F.md5(F.col("cleaned").cast("binary")).alias("kept_md5"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.document_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _tokenizer(name: str) -> str:
    """Path of a vocabulary file of the public tokenizers, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = token_files.write_tokens(docs, scratch_path(spark, "tokens"), _tokenizer("byte_bpe_50k.json"))
    return token_files.read_tokens(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = token_align.align_documents(docs, _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))
    return aligned.drop("groups")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_warc": op2_warc,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_mixing": op4_mixing,
    "op5_ngram_join": op5_ngram_join,
    "op6_url_filters": op6_url_filters,
    "op7_quality_rules": op7_quality_rules,
    "op8_decontamination": op8_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_files": op12_token_files,
    "op13_token_alignment": op13_token_alignment,
}
ORACLE: dict[str, str] = {"op6_url_filters": OP6_SQL, "op7_quality_rules": OP7_SQL, "op8_decontamination": OP8_SQL}
