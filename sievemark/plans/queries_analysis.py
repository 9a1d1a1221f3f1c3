"""Queries of metrics, views, distributions and histograms. Customers stand for companies, nations for industries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls
from ..operators import analysis as a
from .base import Catalog
from .queries_web import _HOST, _SITE

C = Catalog()


@C.query(
    "dist_summary",
    "SELECT o_orderstatus, count(o_totalprice) AS n, round(avg(o_totalprice), 6) AS mean, "
    + ", ".join(f"round(quantile_cont(o_totalprice, {q}), 6) AS {n}" for q, n in zip(a.PERCENTILES, ("median", "p75", "p80", "p90", "p95", "p97", "p99"), strict=True))
    + ", round(min(o_totalprice), 6) AS min, round(max(o_totalprice), 6) AS max FROM orders GROUP BY 1",
)
def dist_summary(t):
    return a.summarize(t("orders"), "o_totalprice", ["o_orderstatus"])


@C.query("hist_adaptive", """WITH v AS (SELECT CAST(n_chars AS BIGINT) AS v FROM documents WHERE n_chars >= 0), m AS (SELECT max(v) AS top, greatest(1, CAST(round_even(max(v) / 20.0::DOUBLE, 0) AS BIGINT)) AS raw FROM v),
w AS (SELECT top, CASE WHEN top > 5000 AND raw < 50 THEN 50 WHEN top > 500 AND raw < 10 THEN 10 ELSE raw END AS w FROM m), b AS (SELECT top, w, v // w AS b, count(*) AS n FROM v, w GROUP BY ALL),
l AS (SELECT CAST(b * w AS BIGINT) AS lo, CAST(CASE WHEN b = top // w THEN greatest((b + 1) * w - 1, top) ELSE (b + 1) * w - 1 END AS BIGINT) AS hi, n FROM b) SELECT lo, hi, CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || '–' || hi END AS label, n FROM l""")
def hist_adaptive(t):
    return a.histogram(t("documents"), "n_chars")


@C.query("hist_edges", """WITH v AS (SELECT CAST(p_size AS BIGINT) AS v FROM part), e AS (SELECT min(v) AS lo, greatest(1, CAST(ceil((max(v) - min(v)) / 30.0) AS BIGINT)) AS w, max(v) AS hi FROM v),
g AS (SELECT lo, w, unnest(range(0, (hi - lo) // w + 1)) AS b FROM e), c AS (SELECT (v - lo) // w AS b, count(*) AS n FROM v, e GROUP BY 1) SELECT lo + g.b * w AS lo, lo + (g.b + 1) * w AS hi, coalesce(n, 0) AS n FROM g LEFT JOIN c ON g.b = c.b""")
def hist_edges(t):
    return a.histogram_edges(t("part"), "p_size")


_URLS = f"""u AS (SELECT page_id % 30 AS company_id, CASE WHEN page_id % 2 = 0 THEN 'https://a.example.com/' ELSE 'https://www.example.net' END AS root_url, url, {_SITE} AS site FROM pages), k AS (SELECT *, CASE WHEN starts_with(root_url, 'https://a') THEN 'example.com' ELSE 'example.net' END AS root FROM u)"""


def _urls(t):
    return t("pages").select((F.col("page_id") % 30).alias("company_id"), F.when(F.col("page_id") % 2 == 0, "https://a.example.com/").otherwise("https://www.example.net").alias("root_url"), "url")


@C.query("domain_metrics", f"WITH {_URLS}, c AS (SELECT company_id, count(*) FILTER (site = root) AS onsite, count(*) FILTER (site <> root) AS offsite FROM k WHERE NOT starts_with(site, '(') GROUP BY 1) SELECT *, round(offsite * 100.0::DOUBLE / (onsite + offsite), 4) AS offsite_pct FROM c")
def domain_metrics(t):
    return a.domain_metrics(_urls(t))


@C.query("offsite_domains", f"WITH {_URLS} SELECT company_id, site AS domain, count(*) AS n FROM k WHERE NOT starts_with(site, '(') AND site <> root GROUP BY 1, 2")
def offsite_domains(t):
    return a.offsite_domains(_urls(t))


@C.query("top_sites_per_language", f"""WITH u AS (SELECT lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]*)', 1)) AS lang, {_HOST} AS host FROM pages), c AS (SELECT lang, host, count(*) AS n FROM u GROUP BY 1, 2)
SELECT lang, host, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, host) AS k FROM c) WHERE k <= 5""")
def top_sites_per_language(t):
    rows = t("pages").select(F.lower(F.regexp_extract("url", "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]*)", 1)).alias("lang"), urls.fast_host(F.col("url")).alias("host"))
    return a.top_k(rows, "host", 5, ["lang"])


@C.query("error_counts", """WITH e AS (SELECT DISTINCT user_id AS company_id, CASE WHEN event_type = 'error' THEN 'read timeout ' || CAST(event_id % 5 AS VARCHAR) WHEN event_type = 'click' THEN 'HTTP ' || CAST(400 + event_id % 5 AS VARCHAR) END AS error FROM events)
SELECT company_id, CASE WHEN error LIKE 'read%' THEN 'TIMEOUT' WHEN error LIKE '%403' THEN 'HTTP_403' WHEN error LIKE '%404' THEN 'HTTP_404' ELSE upper(error) END AS signature, count(*) AS n FROM e WHERE error IS NOT NULL GROUP BY 1, 2""")
def error_counts(t):
    err = F.when(F.col("event_type") == "error", F.concat(F.lit("read timeout "), F.col("event_id") % 5)).when(F.col("event_type") == "click", F.concat(F.lit("HTTP "), 400 + F.col("event_id") % 5))
    return a.error_metrics(t("events").select(F.col("user_id").alias("company_id"), err.alias("error")))


_COMP = "c AS (SELECT c_custkey AS company_id, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_nationkey % 5 AS INT) END AS industry, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_nationkey AS INT) END AS nace FROM customer)"


def _companies(t):
    k = F.col("c_custkey")
    return t("customer").select(k.alias("company_id"), F.when(k % 11 != 0, (F.col("c_nationkey") % 5).cast("int")).alias("industry"), F.when(k % 7 != 0, F.col("c_nationkey").cast("int")).alias("nace"))


_VIEWS = f"WITH {_COMP}, v AS (SELECT 'global' AS view_key, company_id FROM c UNION ALL SELECT 'industry:' || coalesce(CAST(industry AS VARCHAR), 'unknown'), company_id FROM c UNION ALL SELECT 'industry+nace:' || industry || ':' || nace, company_id FROM c WHERE industry IS NOT NULL AND nace IS NOT NULL)"


@C.query("industry_views", f"{_VIEWS} SELECT view_key, count(*) AS n FROM v GROUP BY 1")
def industry_views(t):
    return a.views(_companies(t)).groupBy("view_key").agg(F.count("*").alias("n"))


@C.query("view_sums", f"{_VIEWS}, m AS (SELECT o_custkey AS company_id, count(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT view_key, count(*) AS companies, CAST(sum(coalesce(orders, 0)) AS BIGINT) AS orders FROM v LEFT JOIN m USING (company_id) GROUP BY 1")
def view_sums(t):
    m = t("orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("company_id")).agg(F.count("*").alias("orders"))
    return a.view_sums(a.views(_companies(t)), m, ["orders"])


@C.query("view_distributions", f"""{_VIEWS} SELECT view_key, count(o_totalprice) AS n, round(avg(o_totalprice), 6) AS mean, round(quantile_cont(o_totalprice, 0.5), 6) AS median, round(quantile_cont(o_totalprice, 0.9), 6) AS p90, round(min(o_totalprice), 6) AS min, round(max(o_totalprice), 6) AS max
FROM v JOIN orders ON o_custkey = company_id GROUP BY 1""")
def view_distributions(t):
    pages = t("orders").select(F.col("o_custkey").alias("company_id"), "o_totalprice")
    return a.view_distributions(a.views(_companies(t)), pages, "o_totalprice").select("view_key", "n", "mean", "median", "p90", "min", "max")


@C.query("view_ordering", f"{_VIEWS}, d AS (SELECT DISTINCT view_key, CASE WHEN view_key = 'global' THEN 0 WHEN view_key LIKE '%:unknown' THEN 3 ELSE 1 END AS g, coalesce(TRY_CAST(regexp_extract(view_key, '^industry(?:\\+nace)?:([0-9]+)', 1) AS INT), 0) AS k FROM v) SELECT view_key, CAST(row_number() OVER (ORDER BY g, k, view_key) AS INT) AS pos FROM d")
def view_ordering(t):
    from pyspark.sql import Window

    keys = a.views(_companies(t)).select("view_key").distinct()
    return keys.select("view_key", F.row_number().over(Window.orderBy(a.view_order(F.col("view_key")))).alias("pos"))


_OFF = "o AS (SELECT l_suppkey % 200 AS company_id, CASE WHEN l_linenumber % 2 = 0 THEN 'product' ELSE 'service' END AS type, CASE WHEN l_returnflag = 'A' THEN ' Alpha' ELSE lower(l_returnflag) END AS name FROM lineitem)"


def _offerings(t):
    return t("lineitem").select((F.col("l_suppkey") % 200).alias("company_id"), F.when(F.col("l_linenumber") % 2 == 0, "product").otherwise("service").alias("type"), F.when(F.col("l_returnflag") == "A", " Alpha").otherwise(F.lower("l_returnflag")).alias("name"))


@C.query("offering_metrics", f"WITH {_OFF} SELECT company_id, count(*) FILTER (type = 'product') AS products, count(*) FILTER (type = 'service') AS services, count(*) AS total, count(DISTINCT type || '|' || lower(trim(name))) AS unique_offerings FROM o GROUP BY 1")
def offering_metrics(t):
    return a.offering_metrics(_offerings(t))


@C.query("offerings_by_industry", f"WITH {_OFF}, {_COMP}, m AS (SELECT company_id, count(*) FILTER (type = 'product') AS p, count(*) FILTER (type = 'service') AS s, count(*) AS n FROM o GROUP BY 1) SELECT coalesce(CAST(industry AS VARCHAR), 'unknown') AS industry, CAST(sum(coalesce(p, 0)) AS BIGINT) AS products, CAST(sum(coalesce(s, 0)) AS BIGINT) AS services, CAST(sum(coalesce(n, 0)) AS BIGINT) AS total FROM c LEFT JOIN m USING (company_id) GROUP BY 1")
def offerings_by_industry(t):
    return a.industry_rollup(_offerings(t), _companies(t))


@C.query("url_slices", """WITH e AS (SELECT user_id AS company_id, event_type AS status, value > 50 AS sup, CASE WHEN value > 80 THEN 'short' END AS reason FROM events) SELECT company_id, CASE WHEN sup THEN 'suppressed: ' || coalesce(reason, 'unknown') ELSE status END AS slice, count(*) AS n FROM e GROUP BY 1, 2""")
def url_slices(t):
    return a.slice_counts(t("events").select(F.col("user_id").alias("company_id"), F.col("event_type").alias("status"), (F.col("value") > 50).alias("suppressed"), F.when(F.col("value") > 80, "short").alias("reason")))


@C.query("running_usage", "SELECT round(avg(value), 6) AS mean, max(value) AS peak, round(arg_max(value, event_id) - arg_min(value, event_id), 6) AS delta FROM events")
def running_usage(t):
    out = a.running_usage(t("events").select(F.col("event_id").alias("ts"), F.col("value").alias("used")))
    return out.select(F.round("mean", 6).alias("mean"), "peak", F.round("delta", 6).alias("delta"))
