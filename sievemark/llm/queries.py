"""The registered query of each operator, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, line_dedup, lm_scoring, near_dedup, prefix_trie, quality_classifier, quality_rules, secret_scan, simhash_dedup, source_mix, spelling_variants, twins, url_filters, warc


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(_read(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_read(spark, sf_dir, "documents"), with_text=False)


URL_RULES = [url_filters.Rule.of(v, n) for v, n in (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.url_filters(_read(spark, sf_dir, "pages"), URL_RULES)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_classifier.quality_scores(_read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "labels"))
    return scores.select("doc_id", "held_out", "score", "predicted")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"), by_id=True)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.find_contamination(_read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "benchmark"), unnamed=True)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), decontamination.is_contaminated().alias("contaminated"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.read_archives(warc.archive_pages(_read(spark, sf_dir, "pages")))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.secret_spans(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(F.filter("base_spans", _is_kind(k))).cast("long").alias(f"n_{k}") for k in secret_scan.PATTERNS]
    return out.select("doc_id", *counts, F.sha2(secret_scan.span_text(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"), secret_scan.span_text(F.col("spans")).alias("spans"))


def _is_kind(kind: str):
    return lambda x: x["kind"] == kind


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_sources(_read(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_components(_read(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_read(spark, sf_dir, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_lm_scoring, op2_quality_rules, op3_url_filters, op4_quality_classifier, op5_line_dedup, op6_decontamination, op7_warc, op8_near_dedup, op9_secret_scan, op10_source_mix, op11_simhash_dedup, op12_prefix_trie, op13_spelling_variants)}

_SPACE = r"[\x20\x09-\x0D]+"

ORACLES: dict[str, str] = twins.ORACLES | {
    "op5_line_dedup": rf"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line FROM cut),
keyed AS (SELECT *, translate(regexp_replace(line, '^{_SPACE}|{_SPACE}$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
many AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, m.key IS NOT NULL AS gone FROM keyed k LEFT JOIN many m ON k.key = m.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op7_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
q AS (SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest, max(page_id) OVER (PARTITION BY payload) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM q""",
    "op6_decontamination": r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS pos FROM bw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, size, array_to_string(w[pos:pos + size - 1], ' ') AS phrase FROM bs),
sizes AS (SELECT DISTINCT size FROM win),
ds AS (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS pos FROM dw, sizes WHERE len(w) >= size),
found AS (SELECT ds.doc_id, ds.pos, ds.size, win.item_id FROM ds JOIN win ON win.size = ds.size AND win.phrase = array_to_string(ds.w[ds.pos:ds.pos + ds.size - 1], ' ')),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + size)) AS p FROM found) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)""",
}
