"""Registered queries of the text operators: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import (
    decontaminate, edit_embedding, main_text, manifest, mixing, oracle, passages, pii, quality, simhash, spelling, suffixes, urls, warc,
)
from contrail.llm.common import table


def op1_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(table(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages"))


def op5_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_embedding.fingerprints(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve(warc.captures(table(spark, sf_dir, "pages")))
    return found.select("record_id", "url_key", "captured_at", "outcome", "source_id",
                        warc.header_text(F.col("headers")).alias("headers"),
                        F.char_length("body").cast("bigint").alias("n_chars"), F.sha2("body", 256).alias("body_sha256"))


def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_classes(table(spark, sf_dir, "documents"))


def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.proofs(table(spark, sf_dir, "documents"), manifest.tamperings())


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_fuzzy_passages, op2_source_mix, op3_personal_data, op4_main_text, op5_edit_fingerprints, op6_decontaminate,
    op7_revisits, op8_simhash_groups, op9_repeated_bytes, op10_quality, op11_merkle_proofs,
    op12_url_filter, op13_spelling_variants)}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL = {"op7_revisits": r"""
WITH page AS (SELECT page_id, url, coalesce(html, '') AS one, coalesce(html, '') || '<!-- second -->' AS two FROM pages),
record AS (
  SELECT page_id * 8 AS record_id, url, page_id * 60 - 86400 AS captured_at, NULL AS body, md5(one) AS tag
  FROM page WHERE page_id % 11 = 0
  UNION ALL SELECT page_id * 8 + 1, url, page_id * 60, one, md5(one) FROM page
  UNION ALL SELECT page_id * 8 + 2, CASE WHEN contains(url, '#') THEN url WHEN contains(url, '?') THEN url || '&utm_medium=x'
    ELSE url || '?utm_medium=x' END, page_id * 60 + 86400, NULL, md5(one) FROM page
  UNION ALL SELECT page_id * 8 + 3, url, page_id * 60 + 172800, two, md5(two) FROM page WHERE page_id % 5 = 0
  UNION ALL SELECT page_id * 8 + 4, url, page_id * 60 + 259200, NULL,
    CASE WHEN page_id % 5 = 0 AND page_id % 7 <> 0 THEN md5(two) ELSE md5(one) END FROM page),
cut AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_replace(
      regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', '')), ':(80|443)?$', ''), '^www\.', '') AS host,
    regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '#[^\n]*$', '') AS rest FROM record),
part AS (
  SELECT *, regexp_replace(regexp_replace(rest, '\?[^\n]*$', ''), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?([^\n]*)$', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=|$)'))), '&') AS query FROM cut),
keyed AS (SELECT *, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS url_key FROM part),
found AS (
  SELECT *, last_value(CASE WHEN body IS NOT NULL THEN {'id': record_id, 'tag': tag, 'body': body} END IGNORE NULLS) OVER (
    PARTITION BY url_key ORDER BY captured_at, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM keyed)
SELECT record_id, url_key, captured_at,
  CASE WHEN s IS NULL OR url_key IS NULL THEN 'no_response' WHEN s.tag = tag THEN 'resolved' ELSE 'mismatch' END AS outcome,
  CASE WHEN url_key IS NOT NULL THEN s.id END AS source_id,
  CASE WHEN outcome = 'resolved' THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || length(s.body) || chr(10)
    || 'content-type: text/html' || chr(10) || 'date: ' || captured_at || chr(10) || 'etag: W/' || tag END AS headers,
  CASE WHEN outcome = 'resolved' THEN length(s.body) END AS n_chars,
  CASE WHEN outcome = 'resolved' THEN sha256(s.body) END AS body_sha256
FROM found WHERE body IS NULL
""",
    "op11_merkle_proofs": oracle.MERKLE_PROOFS,
    "op12_url_filter": oracle.URL_VERDICTS,
    "op13_spelling_variants": oracle.SPELLING_VARIANTS,
}
