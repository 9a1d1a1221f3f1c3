"""Queries of extraction passes, labels, totals, calibration, language lists and small text functions."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..functions import language, markup, text, urls
from ..operators import analysis, calibrate, logscan, passes, state
from ..operators import dataset as d
from .base import Catalog
from .queries_state import _DONE, _STAGE, _done, _stages

C = Catalog()
INSTRUCTION = "List what the company offers."


def _extract(bodies: list[str]) -> list[str]:
    """A stand-in for a model, whose answers take another form from page to page."""
    out = []
    for body in bodies:
        page = int(body.split()[2])
        out.append([
            json.dumps({"products": [f"page {page}", "Careers"]}), json.dumps({"offerings": [{"name": "Zzzz", "description": "arms with grippers"}]}), json.dumps({"offerings": [{"name": "Zzzz", "description": "arms only"}]}),
            "Answer: " + json.dumps({"items": [{"title": "Yyyy", "type": "solutions", "tags": ["a"]}]}), "none", json.dumps({"content": json.dumps({"services": ["Grippers®"]})}),
        ][page % 6])
    return out


def _pending(t):
    k = F.col("page_id") % 4
    body = F.concat(F.lit("# Page "), F.col("page_id").cast("string"), F.lit(" robot arms and grippers at "), F.col("url"))
    return t("pages").select(F.col("page_id").alias("company_id"), "url", F.when(k != 0, "x.md").alias("markdown_path"), F.when(k >= 2, body).otherwise(" ").alias("body"))


@C.query("full_pass", """SELECT page_id AS company_id, url, CASE page_id % 4 WHEN 0 THEN 'llm_full_skipped_no_markdown' WHEN 1 THEN 'llm_full_empty_markdown' ELSE 'llm_full_extracted' END AS status, 1 AS extracted,
  CASE WHEN page_id % 4 >= 2 THEN CASE WHEN page_id % 6 IN (0, 1, 3, 5) THEN 1 ELSE 0 END END AS presence FROM pages""")
def full_pass(t):
    return passes.full_pass(_pending(t), _extract)[0]


@C.query("full_pass_products", """SELECT page_id AS company_id, url, CASE WHEN page_id % 6 IN (3, 5) THEN 'service' ELSE 'product' END AS type, CASE page_id % 6 WHEN 0 THEN 'page ' || page_id WHEN 1 THEN 'Zzzz' WHEN 3 THEN 'Yyyy' ELSE 'Grippers®' END AS name,
  CASE page_id % 6 WHEN 0 THEN 'page ' || page_id WHEN 1 THEN 'arms with grippers' WHEN 3 THEN 'Yyyy' ELSE 'Grippers®' END AS description FROM pages WHERE page_id % 4 >= 2 AND page_id % 6 IN (0, 1, 3, 5)""")
def full_pass_products(t):
    return passes.full_pass(_pending(t), _extract)[1].select("company_id", "url", "type", "name", "description")


_CTX = "CASE WHEN c_custkey % 3 = 0 THEN ' ' WHEN c_custkey % 3 = 1 THEN c_mktsegment END AS label, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_nationkey AS INT) END AS industry, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 9 AS INT) END AS nace"


@C.query("provenance", f"""WITH c AS (SELECT c_custkey, {_CTX} FROM customer) SELECT c_custkey, coalesce(trim(label), '') <> '' OR (industry IS NOT NULL AND nace IS NOT NULL) AS has_context, FALSE AS ctx_is_generic, coalesce(nullif(trim(label), ''), 'unknown') AS industry_label_used,
  coalesce(industry, -1) AS industry_used, coalesce(nace, -1) AS nace_used, 'full' AS llm_mode, 'p' AS llm_provider, sha1('{INSTRUCTION}') AS llm_instruction_sha1 FROM c""")
def provenance(t):
    rows = t("customer").select("c_custkey", *(F.expr(x) for x in _CTX.replace(" AS INT", " AS INT").split(", CASE")[:1]), *(F.expr("CASE" + x) for x in _CTX.split(", CASE")[1:]))
    c = passes.context(F.col("label"), F.col("industry"), F.col("nace"))
    rows = rows.select("c_custkey", passes.has_context(F.col("label"), F.col("industry"), F.col("nace")).alias("has_context"), c.alias("c"))
    return rows.select("c_custkey", "has_context", *(v.alias(k) for k, v in passes.provenance(F.col("c"), "p", INSTRUCTION, "full").items()))


@C.query("resolve_labels", """WITH m AS (SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS industry, CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 9 END AS nace, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment END AS label, CASE c_custkey % 5 WHEN 0 THEN 'industry+nace' WHEN 1 THEN 'lv1' WHEN 2 THEN 'fallback' WHEN 3 THEN 'other' END AS source FROM customer)
SELECT c_custkey, coalesce(CASE WHEN source IN ('industry', 'fallback', 'industry_only', 'lv1') THEN label END, CASE WHEN n_nationkey % 2 = 0 THEN n_name END) AS label_lv1, CASE WHEN source = 'industry+nace' AND nace IS NOT NULL THEN label END AS label_lv2 FROM m LEFT JOIN nation ON n_nationkey = industry""")
def resolve_labels(t):
    k = F.col("c_custkey")
    meta = t("customer").select(
        "c_custkey", F.col("c_nationkey").cast("long").alias("industry"), F.when(k % 3 > 0, k % 9).alias("nace"), F.when(k % 4 > 0, F.col("c_mktsegment")).alias("industry_label"),
        F.expr("CASE c_custkey % 5 WHEN 0 THEN 'industry+nace' WHEN 1 THEN 'lv1' WHEN 2 THEN 'fallback' WHEN 3 THEN 'other' END").alias("industry_label_source"),
    )
    return analysis.resolve_labels(meta, t("nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("long").alias("industry"), F.col("n_name").alias("label"))).select("c_custkey", "label_lv1", "label_lv2")


_SAYS = "CASE c_custkey % 6 WHEN 0 THEN 'gave-up' WHEN 1 THEN 'md_done' WHEN 2 THEN 'pending' WHEN 3 THEN 'Terminal_done' WHEN 4 THEN 'new' END"


@C.query("state_flags", f"""WITH m AS (SELECT c_custkey AS company_id, coalesce({_SAYS}, '') AS s, c_custkey % 10 = 0 AS fin, c_custkey % 4 AS tt, c_custkey % 5 AS md FROM customer), p AS (SELECT o_custkey AS company_id, count(*) AS n FROM orders GROUP BY 1),
x AS (SELECT m.*, coalesce(n, 0) AS n, CASE WHEN tt <= 0 THEN coalesce(n, 0) ELSE tt END AS total FROM m LEFT JOIN p USING (company_id))
SELECT company_id, fin OR s IN ('md_done', 'Terminal_done') OR n > 0 AS crawled, s IN ('gave-up', 'Terminal_done') AS terminal_done, total > 0 AND md >= total AS md_done, total > 0 AND md + 1 >= total AS llm_done FROM x""")
def state_flags(t):
    k = F.col("c_custkey")
    meta = t("customer").select(k.alias("company_id"), F.expr(_SAYS).alias("status"), (k % 10 == 0).alias("crawl_finished"), (k % 4).alias("urls_total"), (k % 5).alias("urls_md"), (k % 5 + 1).alias("urls_llm"))
    return analysis.state_flags(meta, t("orders").select(F.col("o_custkey").alias("company_id")))


@C.query("global_totals", "SELECT count(*) AS companies_total, CAST(7 AS BIGINT) AS urls_total, CAST(sum(o_orderkey % 5) AS BIGINT) AS markdown_saved_total, CAST(sum(o_orderkey % 7) AS BIGINT) AS md_tokens_total, CAST(sum(o_custkey % 3) AS BIGINT) AS llm_output_tokens_total, CAST(sum(o_custkey % 4) AS BIGINT) AS offerings_total, TRUE AS llm_metrics_enabled FROM orders")
def global_totals(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return analysis.global_totals(t("orders").select(F.lit(0).alias("total_urls"), (k % 5).alias("markdown_saved"), (k % 7).alias("md_tokens"), (c % 3).alias("llm_output_tokens"), (c % 4).alias("offerings")), stored_urls=7)


@C.query("saved_counters", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(event_id % 100 AS INT) WHEN 1 THEN 12 ELSE 0 END AS n FROM events")
def saved_counters(t):
    raw = F.when(F.col("event_id") % 4 == 0, (F.col("event_id") % 100).cast("string")).when(F.col("event_id") % 4 == 1, " 12 ").when(F.col("event_id") % 4 == 2, "1.5")
    return t("events").select("event_id", analysis.saved_counter(raw).alias("n"))


@C.query("analysis_dataset", """SELECT c_custkey AS company_id, c_mktsegment AS status, count(o_orderkey) AS urls, CASE WHEN c_custkey % 3 = 0 THEN 'own' WHEN c_custkey % 3 = 1 THEN 'shared' END AS profile FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""")
def analysis_dataset(t):
    c = t("customer").select(F.col("c_custkey").alias("company_id"), F.col("c_mktsegment").alias("status"))
    own, shared = c.where("company_id % 3 = 0").select("company_id", F.lit("own").alias("profile")), c.where("company_id % 3 <> 2").select("company_id", F.lit("shared").alias("profile"))
    return analysis.dataset(c, c, t("orders").select(F.col("o_custkey").alias("company_id")), own, shared)


@C.query("stage_policies", f"{_STAGE} SELECT company_id, status IN ('markdown_done', 'terminal_done', 'llm_not_done', 'llm_done') AS may_extract, urls_md <= 0 AS skip_extraction, status IN ('markdown_done', 'terminal_done', 'llm_not_done', 'llm_done') AS crawl_done FROM s")
def stage_policies(t):
    return state.stage_policies(_stages(t)).select("company_id", "may_extract", "skip_extraction", "crawl_done")


def _calibrated(t):
    old = _stages(t).select("company_id", F.lit("pending").alias("status"), F.lit(1).cast("long").alias("urls_total"), F.lit(0).cast("long").alias("urls_md"), F.lit(0).cast("long").alias("urls_llm"), F.lit(False).alias("crawl_finished"), F.lit("old").alias("name"))
    source = t("customer").select(F.col("c_custkey").cast("string").alias("company_id"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name"))
    meta = t("events").select(F.col("user_id").cast("string").alias("company_id"), (F.col("user_id") % 2 == 0).alias("crawl_finished")).distinct()
    return calibrate.calibrated(old, source, _done(t), meta, ["name"])


@C.query("calibrated_companies", f"{_STAGE} SELECT company_id, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, 'old') AS name, status, greatest(1, urls_total) AS urls_total, crawl_finished FROM s LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = company_id")
def calibrated_companies(t):
    return _calibrated(t)[0].select("company_id", "name", "status", "urls_total", "crawl_finished")


@C.query("calibrated_totals", f"{_STAGE} SELECT count(*) AS n_companies, CAST(sum(greatest(1, urls_total)) AS BIGINT) AS urls_total, CAST(sum(urls_md) AS BIGINT) AS urls_md FROM s")
def calibrated_totals(t):
    return _calibrated(t)[1].select("n_companies", "urls_total", "urls_md")


@C.query("meta_documents", """SELECT company_id, '{"company_id":' || company_id || ',"status":' || CASE WHEN status IS NULL THEN 'null' ELSE '"' || status || '"' END || ',"version":"1"}' AS value FROM (SELECT c_custkey AS company_id, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS status FROM customer)""")
def meta_documents(t):
    return calibrate.meta_documents(t("customer").select(F.col("c_custkey").alias("company_id"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("status")), "1")


@C.query("patched_meta", """SELECT coalesce(a.k, b.k) AS company_id, coalesce(b.name, a.name) AS name, CASE WHEN a.k IS NOT NULL AND a.k % 2 = 0 THEN 'then' ELSE 'now' END AS created_at, 'now' AS updated_at
FROM (SELECT c_custkey AS k, c_name AS name FROM customer) a FULL JOIN (SELECT s_suppkey AS k, s_name AS name FROM supplier) b ON a.k = b.k""")
def patched_meta(t):
    base = t("customer").select(F.col("c_custkey").alias("company_id"), F.create_map(F.lit("name"), F.col("c_name"), F.lit("created_at"), F.when(F.col("c_custkey") % 2 == 0, "then").otherwise(" ")).alias("fields"))
    more = t("supplier").select(F.col("s_suppkey").alias("company_id"), F.create_map(F.lit("name"), F.col("s_name")).alias("fields"))
    return calibrate.patched_meta(base, more, "now").select("company_id", F.col("fields")["name"].alias("name"), F.col("fields")["created_at"].alias("created_at"), F.col("fields")["updated_at"].alias("updated_at"))


_RUNS = "r AS (SELECT c_custkey AS run_id, c_name AS pipeline, c_custkey % 7 AS total_companies, c_mktsegment AS last_company_id FROM customer), s AS (SELECT o_custkey AS run_id, arg_max(o_orderpriority, o_orderkey) AS pipeline, arg_max(o_orderkey, o_orderkey) FILTER (o_orderstatus = 'F') AS total FROM orders GROUP BY 1)"


@C.query("run_upserts", f"WITH {_RUNS} SELECT run_id, coalesce(s.pipeline, r.pipeline) AS pipeline, CAST(coalesce(s.total, r.total_companies, 0) AS BIGINT) AS total_companies, last_company_id FROM r FULL JOIN s USING (run_id)")
def run_upserts(t):
    k = F.col("c_custkey")
    runs = t("customer").select(k.alias("run_id"), F.col("c_name").alias("pipeline"), F.lit("1").alias("version"), F.lit("t0").alias("started_at"), (k % 7).alias("total_companies"), F.lit(0).cast("long").alias("completed_companies"), F.col("c_mktsegment").alias("last_company_id"))
    o = t("orders")
    started = o.select(F.col("o_custkey").alias("run_id"), F.col("o_orderkey").alias("ord"), F.col("o_orderpriority").alias("pipeline"), F.lit("2").alias("version"), F.lit("t1").alias("started_at"))
    updates = o.select(F.col("o_custkey").alias("run_id"), F.col("o_orderkey").alias("ord"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("total_companies"), F.lit(None).cast("long").alias("completed_companies"), F.lit(None).cast("string").alias("last_company_id"))
    return calibrate.run_totals(calibrate.upsert_runs(runs, started), updates).select("run_id", "pipeline", F.col("total_companies").cast("long").alias("total_companies"), "last_company_id")


@C.query("sample_company", f"{_STAGE} SELECT company_id, status, urls_total FROM s ORDER BY company_id LIMIT 1")
def sample_company(t):
    none = t("region").select(F.col("r_name").alias("company_id"))
    return calibrate.sample_company(_stages(t), none, none.distinct()).select("company_id", "status", "urls_total")


@C.query("source_known_only", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def source_known_only(t):
    return calibrate.known_only(t("customer").select(F.col("c_custkey").alias("company_id")), t("orders").select(F.col("o_custkey").alias("company_id"))).select(F.col("company_id").alias("c_custkey"))


@C.query("linked_products", f"""{_DONE.replace('WITH ', 'WITH ', 1)}, n AS (SELECT company_id, url, path, CASE WHEN hash % 2 = 0 THEN '/c/' || company_id || '/' || path ELSE 'product/' || path END AS product_path FROM (SELECT *, length(path) AS hash FROM d WHERE path <> '')),
f AS (SELECT company_id, '/c/' || company_id || CASE WHEN length(path) % 3 = 0 THEN '/moved/' ELSE '/product/' END || path AS p, path AS file FROM d WHERE path <> '')
SELECT DISTINCT f.company_id, f.file, n.url FROM f JOIN n ON n.company_id = f.company_id AND n.path = f.file""")
def linked_products(t):
    rows = _done(t).where("path <> ''")
    odd = F.length("path") % 2 == 0
    entries = rows.select("company_id", "url", F.when(odd, F.concat(F.lit("/c/"), "company_id", F.lit("/"), "path")).otherwise(F.concat(F.lit("product/"), "path")).alias("product_path"), F.lit("m.md").alias("markdown_path"), F.concat(F.lit("/c/"), "company_id").alias("folder"))
    files = rows.select("company_id", F.concat(F.lit("/c/"), "company_id", F.when(F.length("path") % 3 == 0, "/moved/").otherwise("/product/"), "path").alias("path"))
    return passes.link_products(files, entries).select("company_id", "file", "url")


@C.query("original_ids", """WITH k AS (SELECT DISTINCT CASE WHEN c_custkey % 3 = 0 THEN 'Customer/' || c_custkey WHEN c_custkey % 3 = 1 THEN 'Customer_' || c_custkey ELSE 'x' || c_custkey END AS key, c_custkey AS n FROM customer)
SELECT CASE WHEN n % 3 < 2 THEN 'Customer/' || n ELSE key END AS company_id, CASE WHEN n % 3 < 2 THEN 'N' || n ELSE '' END AS name, CASE WHEN n % 3 < 2 THEN 'u' ELSE '' END AS url FROM k""")
def original_ids(t):
    k, word = F.col("c_custkey"), F.col("c_custkey").cast("string")
    keys = t("customer").select(F.when(k % 3 == 0, F.concat(F.lit("Customer/"), word)).when(k % 3 == 1, F.concat(F.lit("Customer_"), word)).otherwise(F.concat(F.lit("x"), word)).alias("key"))
    return logscan.original_ids(keys, t("customer").select(F.concat(F.lit("Customer/"), word).alias("company_id"), F.concat(F.lit("N"), word).alias("name"), F.lit("u").alias("url")))


@C.query("language_terms", """WITH s AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN 'en' WHEN p_partkey % 3 = 1 THEN 'ja' ELSE 'fr' END AS lang, p_brand AS key, p_partkey AS pos, lower(trim(p_type)) AS term FROM part), x AS (SELECT key, term, CASE lang WHEN 'en' THEN 1 ELSE 2 END AS turn, pos FROM s WHERE lang IN ('en', 'ja') AND term <> '')
SELECT key, turn, pos, term FROM (SELECT *, row_number() OVER (PARTITION BY key, term ORDER BY turn, pos) AS k FROM x) WHERE k = 1""")
def language_terms(t):
    k = F.col("p_partkey")
    specs = t("part").select(F.when(k % 3 == 0, "en").when(k % 3 == 1, "ja").otherwise("fr").alias("lang"), F.col("p_brand").alias("key"), k.alias("pos"), F.col("p_type").alias("term"))
    return language.terms(specs, language.effective("ja", ["ja", "fr"]))


@C.query("host_terms", """SELECT DISTINCT p_type AS key, lower(trim(p_brand)) AS term FROM part""")
def host_terms(t):
    specs = t("part").select(F.lit("en").alias("lang"), F.col("p_type").alias("key"), F.lit(0).alias("pos"), F.concat(F.lit(" .."), "p_brand").alias("term"))
    return language.host_terms(specs, ("en",))


@C.query("head_documents", r"""WITH p AS (SELECT page_id, regexp_replace(trim(regexp_extract(coalesce(html, ''), '(?is)<title[^>]*>(.*?)</title>', 1)), '\s+', ' ', 'g') AS title FROM pages)
SELECT page_id, trim(CASE WHEN title <> '' THEN title || ' ' || title || ' ' || title || '  ' ELSE '' END || 'About ' || page_id || ' About ' || page_id || '  a, b About ' || page_id || ' a, b z') AS doc FROM p""")
def head_documents(t):
    metas = F.concat(F.lit('<META name="Description" content="old">\n<meta  content="a, b" name=\'keywords\'><meta name="x" content=" "><meta name="description" content="About\t'), F.col("page_id").cast("string"), F.lit('"><meta property="og" content="no"><meta name="z" content="z">'))
    return t("pages").select("page_id", markup.head_document(F.concat(F.coalesce("html", F.lit("")), metas)).alias("doc"))


@C.query("profile_sentences", r"""WITH s AS (SELECT conv_id, turn, unnest(regexp_split_to_array(regexp_replace(trim(text || ' - One. ONE. • two'), '\s+', ' ', 'g'), '(?:\n|\r|•|\*|- )+')) AS c, text FROM conversations),
u AS (SELECT conv_id, turn, trim(unnest(string_split(regexp_replace(trim(c), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)))) AS s FROM s)
SELECT conv_id, turn, count(DISTINCT lower(s)) AS n, CAST(sum(length(s)) AS BIGINT) AS chars FROM (SELECT DISTINCT conv_id, turn, lower(s) AS s FROM u WHERE s <> '') GROUP BY 1, 2""")
def profile_sentences(t):
    rows = t("conversations").select("conv_id", "turn", F.explode(text.profile_sentences(F.concat("text", F.lit(" - One. ONE. • two")))).alias("s"))
    return rows.groupBy("conv_id", "turn").agg(F.count_distinct(F.lower("s")).alias("n"), F.sum(F.length(F.lower("s"))).alias("chars"))


@C.query("worker_shares", "SELECT c_custkey, CAST(ntile(7) OVER (ORDER BY c_custkey) AS BIGINT) AS worker FROM customer")
def worker_shares(t):
    return d.even_shares(t("customer"), "c_custkey", 7, "worker").select("c_custkey", "worker")


@C.query("table_schema", """SELECT * FROM (VALUES ('n_nationkey', 'int'), ('n_name', 'string'), ('n_regionkey', 'int')) v("column", type)""")
def table_schema(t):
    return d.schema_of(t("nation").select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name", F.col("n_regionkey").cast("int").alias("n_regionkey")))


@C.query("id_lists", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand || ',' || p_type WHEN 1 THEN p_type ELSE '' END AS ids FROM part")
def id_lists(t):
    brand, kind = F.col("p_brand"), F.col("p_type")
    raw = F.when(F.col("p_partkey") % 3 == 0, F.array(F.concat(F.lit(" "), brand), kind, F.lit(""), F.concat(brand, F.lit(" ")))).when(F.col("p_partkey") % 3 == 1, F.array(kind, F.lit(None).cast("string"))).otherwise(F.array(F.lit(" ")))
    return t("part").select("p_partkey", F.array_join(text.id_list(raw), ",").alias("ids"))


@C.query("artifact_names", r"""SELECT page_id, substr(regexp_replace(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1)) || regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '[^A-Za-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80) || '-' || substr(sha1(url), 1, 8) AS name FROM pages""")
def artifact_names(t):
    return t("pages").select("page_id", urls.artifact_name(F.col("url")).alias("name"))
