"""Queries of URL functions, ingestion, URL filters, gating and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import errors, gating, language, text, urls, vectors
from ..operators import ingest, urlfilter
from .base import Catalog

C = Catalog()
LANGUAGES = ("en", "fr", "de", "es")
_HOST = "lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1))"


def _registrable(h: str, suffixes: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{s}'" for s in suffixes)
    a = f"string_split({h}, '.')"
    return f"CASE WHEN len({a}) < 2 THEN {h} WHEN len({a}) >= 3 AND array_to_string({a}[-2:], '.') IN ({listed}) THEN array_to_string({a}[-3:], '.') ELSE array_to_string({a}[-2:], '.') END"


_SITE = f"CASE WHEN url IS NULL OR lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) NOT IN ('http', 'https') THEN '(non-http)' WHEN {_HOST} = '' THEN '(no-host)' ELSE {_registrable(_HOST, urls.ANALYSIS_SUFFIXES)} END"


@C.query("url_top_domains", f"SELECT site, count(*) AS n FROM (SELECT {_SITE} AS site FROM pages) GROUP BY site ORDER BY n DESC, site LIMIT 20")
def url_top_domains(t):
    return t("pages").groupBy(urls.site_key(F.col("url")).alias("site")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "site").limit(20)


_DROP = " OR ".join([f"lower(string_split(p, '=')[1]) IN ({', '.join(repr(x) for x in urls.TRACKING)})", *(f"starts_with(lower(string_split(p, '=')[1]), '{x}')" for x in urls.TRACKING_PREFIXES)])
_CANON = f"""WITH p AS (SELECT page_id, url, lower(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1)) AS scheme, regexp_replace({_HOST}, '^www\\.(.)', '\\1') AS host,
  regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) AS query FROM pages),
q AS (SELECT *, array_to_string(list_transform(list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT ({_DROP})), lambda p: CASE WHEN contains(p, '=') THEN p ELSE p || '=' END), '&') AS kept,
  CASE WHEN lower(path) IN ('', '/', '/index.html', '/index.htm', '/home', '/home/') THEN '/' ELSE regexp_replace(path, '(.)/$', '\\1') END AS shown FROM p),
c AS (SELECT page_id, host, scheme || '://' || host || shown || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END AS canonical FROM q)"""


@C.query("url_canonical", f"{_CANON} SELECT page_id, canonical, {_registrable('host', urls.INGEST_SUFFIXES)} AS domain FROM c")
def url_canonical(t):
    return t("pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical"), urls.registrable(urls.host(F.col("url"))).alias("domain"))


_COMPANIES = f"""{_CANON}, r AS (SELECT p.page_id AS ord, 'c' || (p.page_id % 40) AS company_id, 'Company ' || (p.page_id % 25) AS name, regexp_extract(canonical, '^([a-z]+://[^/]*)', 1) || '/' AS root_url, host,
  CASE WHEN p.page_id % 3 = 0 THEN NULL ELSE CAST(p.page_id % 5 AS INT) END AS industry, CASE WHEN p.page_id % 4 = 0 THEN NULL ELSE CAST(p.page_id % 7 AS INT) END AS nace FROM pages p JOIN c ON p.page_id = c.page_id)"""


def _companies(t):
    rows = t("pages").select("page_id", F.concat(F.lit("c"), F.col("page_id") % 40).alias("id"), F.concat(F.lit("Company "), F.col("page_id") % 25).alias("name"), F.concat(F.regexp_extract("url", "^([a-z]+://[^/]*)", 1), F.lit("/")).alias("url"))
    out = ingest.companies(rows, "page_id")
    return out.withColumn("industry", F.when(F.col("ord") % 3 != 0, (F.col("ord") % 5).cast("int"))).withColumn("nace", F.when(F.col("ord") % 4 != 0, (F.col("ord") % 7).cast("int"))).withColumn("industry_label", F.lit(None).cast("string"))


@C.query("ingest_companies", f"{_COMPANIES} SELECT ord, company_id, name, root_url FROM r")
def ingest_companies(t):
    return _companies(t).select("ord", "company_id", "name", "root_url")


@C.query("ingest_first_records", f"{_COMPANIES} SELECT min(ord) AS ord, lower(company_id) AS company_id, lower(root_url) AS root_url FROM r GROUP BY 2, 3")
def ingest_first_records(t):
    return ingest.first_records(_companies(t)).select("ord", F.lower("company_id").alias("company_id"), F.lower("root_url").alias("root_url"))


@C.query(
    "ingest_merge_by_url",
    f"""{_COMPANIES}, ids AS (SELECT root_url, string_agg(company_id, '|' ORDER BY o) AS company_id FROM (SELECT root_url, company_id, min(ord) AS o FROM r GROUP BY 1, 2) GROUP BY 1),
nms AS (SELECT root_url, string_agg(name, ' | ' ORDER BY o) AS name FROM (SELECT root_url, name, min(ord) AS o FROM r GROUP BY 1, 2) GROUP BY 1)
SELECT root_url, ids.company_id, nms.name, count(*) AS agg_count, arg_min(r.company_id, ord) AS primary_id, arg_min(industry, ord) FILTER (industry IS NOT NULL) AS industry, arg_min(nace, ord) FILTER (nace IS NOT NULL) AS nace
FROM r JOIN ids USING (root_url) JOIN nms USING (root_url) GROUP BY root_url, ids.company_id, nms.name""",
)
def ingest_merge_by_url(t):
    return ingest.merge_by_url(_companies(t)).select("root_url", "company_id", "name", "agg_count", "primary_id", "industry", "nace")


@C.query("ingest_interleave", f"{_COMPANIES}, d AS (SELECT ord, {_registrable('host', urls.INGEST_SUFFIXES)} AS domain FROM r) SELECT ord, domain, CAST(row_number() OVER (PARTITION BY domain ORDER BY ord) AS INT) AS turn FROM d")
def ingest_interleave(t):
    return ingest.interleave(_companies(t)).select("ord", "domain", "turn")


@C.query(
    "ingest_enrich",
    """WITH c AS (SELECT c_custkey, CAST(c_nationkey % 6 AS INT) AS industry, CAST(c_custkey % 9 AS INT) AS nace FROM customer),
n AS (SELECT n_nationkey, n_name AS label FROM nation),
p AS (SELECT CAST(n_nationkey % 6 AS INT) AS industry, CAST(n_nationkey % 9 AS INT) AS nace, arg_min(label, n_nationkey) AS label FROM n GROUP BY 1, 2),
a AS (SELECT CAST(n_nationkey % 4 AS INT) AS nace, arg_min(label, n_nationkey) AS label FROM n GROUP BY 1),
i AS (SELECT CAST(r_regionkey AS INT) AS industry, r_name AS label FROM region)
SELECT c_custkey, coalesce(p.label, a.label, i.label) AS industry_label, CASE WHEN p.label IS NOT NULL THEN 'industry+nace' WHEN a.label IS NOT NULL THEN 'nace' WHEN i.label IS NOT NULL THEN 'industry' ELSE 'unknown' END AS industry_label_source
FROM c LEFT JOIN p ON c.industry = p.industry AND c.nace = p.nace LEFT JOIN a ON c.nace = a.nace LEFT JOIN i ON c.industry = i.industry""",
)
def ingest_enrich(t):
    rows = t("customer").select("c_custkey", (F.col("c_nationkey") % 6).cast("int").alias("industry"), (F.col("c_custkey") % 9).cast("int").alias("nace"))
    n = t("nation").select("n_nationkey", F.col("n_name").alias("label"), (F.col("n_nationkey") % 6).cast("int").alias("industry"))
    pairs = ingest.lookup(n.withColumn("nace", (F.col("n_nationkey") % 9).cast("int")), ["industry", "nace"], "n_nationkey")
    naces = ingest.lookup(n.withColumn("nace", (F.col("n_nationkey") % 4).cast("int")), ["nace"], "n_nationkey")
    industries = ingest.lookup(t("region").select(F.col("r_regionkey").cast("int").alias("industry"), F.col("r_name").alias("label")), ["industry"], "industry")
    return ingest.enrich_industry(rows, pairs, naces, industries).select("c_custkey", "industry_label", "industry_label_source")


_INFRA = " OR ".join(f"contains(h, '{w}')" for w in urlfilter.INFRASTRUCTURE)
_FUNC = ", ".join(f"'{w}'" for w in urlfilter.FUNCTIONAL)
_UNIV = ", ".join(f"'{w}'" for w in urlfilter.UNIVERSAL)
_ENDS = ", ".join(f"'{w}'" for w in urlfilter.REJECTED)


@C.query(
    "url_filter_chain",
    f"""WITH u AS (SELECT page_id, url, regexp_replace({_HOST}, '^www\\.(.)', '\\1') AS h, row_number() OVER (PARTITION BY url ORDER BY page_id) AS k,
  list_filter(string_split(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS segs FROM pages),
v AS (SELECT *, {_registrable('h', urls.INGEST_SUFFIXES)} AS dom, list_filter(list_transform(segs, lambda s: lower(s)), lambda s: s IN ('en', 'fr', 'de', 'es')) AS lang FROM u)
SELECT page_id, CASE WHEN len(segs) > 0 AND lower(regexp_extract(segs[-1], '\\.([A-Za-z0-9]+)$', 1)) IN ({_ENDS}) THEN 'extension' WHEN k > 1 THEN 'seen'
  WHEN dom <> 'example.com' AND dom = 'example.net' THEN 'dataset'
  WHEN dom <> 'example.com' AND (regexp_matches(h, '(^|\\.)(gov|mil)$') OR dom IN ({_UNIV}) OR (len(string_split(h, '.')) >= 3 AND string_split(h, '.')[1] IN ({_FUNC})) OR {_INFRA}) THEN 'universal'
  WHEN len(lang) > 0 AND lang[1] NOT IN ('en') THEN 'language' END AS reject_reason FROM v""",
)
def url_filter_chain(t):
    known = t("region").sparkSession.createDataFrame([("example.net",)], "domain string")
    return urlfilter.filter_chain(t("pages").select("page_id", "url"), "url", "page_id", F.lit("example.com"), LANGUAGES, ("en",), known).select("page_id", "reject_reason")


@C.query("url_external_domains", f"SELECT DISTINCT p || dom AS domain FROM (SELECT {_registrable('h', urls.INGEST_SUFFIXES)} AS dom FROM (SELECT regexp_replace({_HOST}, '^www\\.(.)', '\\1') AS h FROM pages)), (VALUES (''), ('www.')) x(p) WHERE dom <> ''")
def url_external_domains(t):
    return ingest.external_domains(t("pages"), "url")


@C.query("url_safe_ids", r"""SELECT page_id, substr(regexp_replace(regexp_replace(regexp_replace(trim(url), '[<>:"/\\|?*\x00-\x1F\s]+', '_', 'g'), '_+', '_', 'g'), '^[._ ]+|[._ ]+$', '', 'g'), 1, 100) AS safe FROM pages""")
def url_safe_ids(t):
    return t("pages").select("page_id", urls.safe_id(F.col("url")).alias("safe"))


@C.query("token_counts", r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[\p{L}\p{M}\p{N}\p{Pc}]+|[^\p{L}\p{M}\p{N}\p{Pc}\s]')) AS INT) AS tokens, CAST(len(regexp_extract_all(text, '(?i)[a-z0-9’'']+')) AS INT) AS md_words FROM documents")
def token_counts(t):
    return t("documents").select("doc_id", text.token_count(F.col("text")).alias("tokens"), text.markdown_word_count(F.col("text")).alias("md_words"))


@C.query("sentences", r"""WITH b AS (SELECT doc_id, unnest(regexp_split_to_array(regexp_replace(text, '\r\n?', chr(10), 'g'), '\n\s*\n')) AS block FROM documents),
s AS (SELECT doc_id, unnest(string_split(regexp_replace(trim(regexp_replace(block, '\s+', ' ', 'g')), '([.!?])\s+([A-Z0-9"''])', '\1' || chr(1) || '\2', 'g'), chr(1))) AS s FROM b)
SELECT doc_id, count(*) AS n, sum(length(trim(s)))::BIGINT AS chars FROM s WHERE trim(s) <> '' GROUP BY doc_id""")
def sentences(t):
    return t("documents").select("doc_id", F.explode(text.sentences(F.col("text"))).alias("s")).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("s")).alias("chars"))


@C.query("llm_chunks", r"""WITH w AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(trim(text), '\s+'), lambda x: x <> '') AS w FROM conversations),
k AS (SELECT conv_id, turn, w, unnest(range(0, CAST(greatest(ceil((len(w) - 80) / 72.0), 0) AS BIGINT) + 1)) AS k FROM w WHERE len(w) > 0)
SELECT conv_id, turn, k, array_to_string(w[k * 72 + 1:k * 72 + 80], ' ') AS chunk FROM k""")
def llm_chunks(t):
    rows = t("conversations").select("conv_id", "turn", F.posexplode(text.chunks(F.col("text"), threshold=100)).alias("k", "chunk"))
    return rows.select("conv_id", "turn", F.col("k").cast("long").alias("k"), "chunk")


#: Pieces that are put before and after a text, by its id, so that each reason to suppress a page comes up.
_NOTICES = ("", "We use cookies. Accept all cookies or change your cookie settings, see our cookie policy. ", "Terms of use, privacy policy, license, warranty, jurisdiction, perpetual, royalty-free. ", "Are you over 18? Age verification. ", "Please sign in. Members only, log in. ")
_NOTICE_SQL = f"repeat([{', '.join(repr(x) for x in _NOTICES)}][1 + doc_id % 5], 1 + doc_id % 37)"
_LONG_AGO = lambda pattern: pattern.replace("(?iU)", "(?i)").replace("'", "''")
_DOMINANT = " ".join(f"WHEN total >= {gating.LEAST_TOTAL} AND len(regexp_extract_all(t, '{_LONG_AGO(p)}')) >= {hits} AND len(regexp_extract_all(t, '{_LONG_AGO(p)}')) / total::DOUBLE >= {share} THEN '{reason}'" for _, reason, p, hits, share, _ in gating.DOMINANT)


@C.query("md_gate", rf"""WITH d AS (SELECT doc_id, regexp_replace({_NOTICE_SQL} || text, '^\s+|\s+$', '', 'g') AS t FROM documents), w AS (SELECT *, len(regexp_extract_all(t, '(?i)[a-z0-9’'']+')) AS n, len(regexp_extract_all(t, '[\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}]+')) AS total,
  regexp_matches(t, '(?m)^\s*#{{1,6}}\s+\S') OR regexp_matches(t, '(?m)^\s*[-*+]\s+\S') AS shaped FROM d)
SELECT doc_id, CASE WHEN r = 'ok' THEN 'save' ELSE 'suppress' END AS action, r AS reason FROM (SELECT doc_id, CASE WHEN t = '' THEN 'empty' WHEN NOT shaped AND n < 30 THEN 'no-structure' WHEN n < 30 THEN 'too-short' {_DOMINANT} ELSE 'ok' END AS r FROM w)""")
def md_gate(t):
    notice = F.repeat(F.element_at(F.array(*map(F.lit, _NOTICES)), (F.col("doc_id") % 5 + 1).cast("int")), (1 + F.col("doc_id") % 37).cast("int"))
    return t("documents").select("doc_id", gating.gate(F.concat(notice, F.col("text"))).alias("g")).select("doc_id", "g.action", "g.reason")


_SPECS = [("en", r"\bplease\b", 0), ("en", r"\bthe\b", 1), ("de", r"\bund\b", 0), ("de", r"\bein(e|en)?\b", 1), ("fr", r"\bles?\b", 0)]


@C.query("gate_statistics", rf"""WITH l AS (SELECT DISTINCT lang FROM documents), d AS (SELECT doc_id, lang, regexp_replace({_NOTICE_SQL} || text, '^\s+|\s+$', '', 'g') AS t FROM documents),
w AS (SELECT *, len(regexp_extract_all(t, '(?i)[a-z0-9’'']+')) AS n, len(regexp_extract_all(t, '[\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}]+')) AS total, regexp_matches(t, '(?m)^\s*#{{1,6}}\s+\S') OR regexp_matches(t, '(?m)^\s*[-*+]\s+\S') AS shaped FROM d),
r AS (SELECT doc_id, total, n, CASE WHEN t = '' THEN 'empty' WHEN NOT shaped AND n < 30 THEN 'no-structure' WHEN n < 30 THEN 'too-short' {_DOMINANT} ELSE 'ok' END AS reason,
  len(list_filter(regexp_extract_all(lower(t), '[\p{{L}}\p{{M}}\p{{N}}\p{{Pc}}]+'), lambda x: x IN ('please', 'the') OR lang = 'de' AND x IN ('und', 'ein', 'eine', 'einen'))) AS unknown FROM w WHERE lang IN ('en', 'de'))
SELECT doc_id, reason, CASE WHEN reason IN ('empty', 'no-structure', 'too-short') THEN n ELSE total END::DOUBLE AS total_words, CASE reason WHEN 'cookie-dominant' THEN 1 WHEN 'legal-dominant' THEN 2 WHEN 'age-dominant' THEN 3 WHEN 'login-required' THEN 4 WHEN 'ok' THEN 0 END::DOUBLE AS kind,
  CASE WHEN reason = 'ok' AND total >= 80 THEN unknown END::DOUBLE AS unknown_hits FROM r""")
def gate_statistics(t):
    notice = F.repeat(F.element_at(F.array(*map(F.lit, _NOTICES)), (F.col("doc_id") % 5 + 1).cast("int")), (1 + F.col("doc_id") % 37).cast("int"))
    docs = t("documents")
    specs = docs.sparkSession.createDataFrame([(lang, "INTERSTITIAL_PATTERNS", pos, term) for lang, term, pos in _SPECS], "lang string, key string, pos int, term string")
    parts = []
    for lang in ("en", "de"):
        pattern = language.interstitial_pattern(specs, language.effective(lang, ["de", "fr"]))
        parts.append(docs.where(F.col("lang") == lang).select("doc_id", gating.gate_statistics(F.concat(notice, F.col("text")), pattern).alias("g")))
    return parts[0].unionByName(parts[1]).select("doc_id", "g.reason", F.col("g.stats")["total_words"].alias("total_words"), F.col("g.stats")["interstitial_kind"].alias("kind"), F.col("g.stats")["unknown_hits"].alias("unknown_hits"))


_BM = """WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+|[぀-ゟ]+|[゠-ヿ]+|[一-鿿]+') AS w FROM documents),
s AS (SELECT doc_id, len(w) AS n, {terms} FROM d) SELECT doc_id, round(0.7 * (1 - exp(-({pos}))) + 0.3 * exp(-({neg})), 6) AS score FROM s"""
_TF = lambda k: f"CASE WHEN t{k} > 0 THEN ln(2.0::DOUBLE / (t{k} + 0.5) + 1) * t{k} * 2.2 / greatest(t{k} + 1.2 * (0.25 + 0.75 * n / 1000.0), 1e-9) ELSE 0.0 END"
_TERMS = ("the", "and", "for", "that")


@C.query("bm25_score", _BM.format(terms=", ".join(f"len(list_filter(w, lambda x: x = '{w}'))::DOUBLE AS t{k}" for k, w in enumerate(_TERMS)), pos=f"{_TF(0)} + {_TF(1)}", neg=f"{_TF(2)} + {_TF(3)}"))
def bm25_score(t):
    return t("documents").select("doc_id", F.round(vectors.dual_score(text.bm25_tokens(F.col("text")), _TERMS[:2], _TERMS[2:]), 6).alias("score"))


_GOOD, _BAD = ("the", "of", "de", "la"), ("and", "fr", "es")


def _weight(tokens: str, words: tuple[str, ...]) -> str:
    tf = lambda w: f"len(list_filter({tokens}, lambda x: x = '{w}'))::DOUBLE"
    return " + ".join(f"CASE WHEN {tf(w)} > 0 THEN ln(2.0::DOUBLE / ({tf(w)} + 0.5) + 1) * {tf(w)} * 2.2 / greatest({tf(w)} + 1.2 * (0.25 + 0.75 * len({tokens}) / 1000.0), 1e-9) ELSE 0.0 END" for w in words)


_CAPPED = rf"""h AS (SELECT page_id, url, {_registrable(_HOST, urls.INGEST_SUFFIXES)} AS company_id, page_id % 3 = 0 AS has_markdown, CASE WHEN page_id % 4 > 0 THEN html END AS html FROM pages WHERE page_id % 3 = 0 OR page_id % 4 > 0 AND html IS NOT NULL),
k AS (SELECT *, trim(regexp_replace(regexp_extract(coalesce(html, ''), '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) AS title FROM h),
w AS (SELECT *, regexp_extract_all(lower(title || ' ' || title || ' ' || title), '[a-z0-9]+|[぀-ゟ]+|[゠-ヿ]+|[一-鿿]+') AS t, regexp_extract_all(lower(url), '[a-z0-9]+|[぀-ゟ]+|[゠-ヿ]+|[一-鿿]+') AS u FROM k),
r AS (SELECT page_id, company_id, url, has_markdown, t, {_weight('t', _GOOD)} AS tg, {_weight('t', _BAD)} AS tb, {_weight('u', _GOOD)} AS ug, {_weight('u', _BAD)} AS ub FROM w),
s AS (SELECT *, CASE WHEN tg <= 0 AND tb <= 0 AND ub > 0 THEN 0 ELSE greatest(CASE WHEN len(t) = 0 THEN 0 ELSE 0.7 * (1 - exp(-tg)) + 0.3 * exp(-tb) END, 0.7 * (1 - exp(-ug)) + 0.3 * exp(-ub)) END AS score FROM r),
z AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY round(score, 9) DESC, url) <= 7 AS kept FROM s)"""


def _capped(t):
    from ..operators.state import cap_by_relevance

    k = F.col("page_id")
    rows = t("pages").select("page_id", urls.registrable(urls.host(F.col("url"), False)).alias("company_id"), "url", F.when(k % 4 > 0, F.col("html")).alias("html"), (k % 3 == 0).alias("has_markdown"))
    return cap_by_relevance(rows, 7, _GOOD, _BAD)


@C.query("page_cap_relevance", f"WITH {_CAPPED} SELECT page_id, company_id, round(score, 6) AS score, kept, CASE WHEN NOT kept THEN 'max_pages' END AS suppressed_reason FROM z")
def page_cap_relevance(t):
    return _capped(t).select("page_id", "company_id", F.round("score", 6).alias("score"), "kept", "suppressed_reason")


@C.query("page_cap_report", f"WITH {_CAPPED} SELECT company_id, count(*) AS candidates, count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS overflow, count(*) FILTER (kept AND has_markdown) AS markdown_saved, count(*) > 7 AS hard_max_pages_hit FROM z GROUP BY 1")
def page_cap_report(t):
    from ..operators.state import cap_report

    return cap_report(_capped(t), 7)


@C.query("page_cap", f"""WITH u AS (SELECT page_id, {_registrable(_HOST, urls.INGEST_SUFFIXES)} AS company_id, length(html) AS score, url FROM pages) SELECT page_id, company_id, row_number() OVER (PARTITION BY company_id ORDER BY score DESC, url) <= 30 AS kept FROM u""")
def page_cap(t):
    from ..operators.state import cap_pages

    rows = t("pages").select("page_id", urls.registrable(urls.host(F.col("url"), False)).alias("company_id"), F.length("html").alias("score"), "url")
    return cap_pages(rows, 30, [F.desc("score"), F.col("url")]).select("page_id", "company_id", "kept")


_ERRS = "CASE event_type WHEN 'error' THEN 'Connection refused by peer' WHEN 'click' THEN 'HTTP ' || CAST(400 + event_id % 200 AS VARCHAR) WHEN 'view' THEN 'Gateway timeout' ELSE 'odd thing ' || CAST(event_id % 3 AS VARCHAR) END"


@C.query("error_signature", f"""SELECT event_id, CASE WHEN regexp_matches(e, '(?i)\\b(timeout)\\b') THEN 'TIMEOUT' WHEN regexp_matches(e, '(?i)connection refused') THEN 'CONNECTION' WHEN regexp_matches(e, '\\b429\\b') THEN 'HTTP_429' WHEN regexp_matches(e, '\\b403\\b') THEN 'HTTP_403'
  WHEN regexp_matches(e, '\\b404\\b') THEN 'HTTP_404' WHEN regexp_matches(e, '\\b5\\d\\d\\b') THEN 'HTTP_5XX' WHEN length(e) <= 15 THEN upper(e) ELSE rtrim(substr(upper(e), 1, 14)) || '…' END AS signature FROM (SELECT event_id, {_ERRS} AS e FROM events)""")
def error_signature(t):
    return t("events").select("event_id", errors.signature(F.expr(_ERRS.replace("VARCHAR", "STRING"))).alias("signature"))
