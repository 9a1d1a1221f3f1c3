"""Metrics by company, views of companies, and what reports show of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.errors import signature
from ..functions.urls import comparable_site, site_key

PERCENTILES = (0.5, 0.75, 0.80, 0.90, 0.95, 0.97, 0.99)


def url_metrics(entries: DataFrame) -> DataFrame:
    """By company: urls, md, llm, suppressed. entries: company_id, md_done, llm_done, suppressed."""
    return entries.groupBy("company_id").agg(F.count("*").alias("urls"), F.count_if("md_done").alias("md"), F.count_if("llm_done").alias("llm"), F.count_if("suppressed").alias("suppressed"))


def slice_counts(entries: DataFrame, status: str = "status") -> DataFrame:
    """company_id, slice, n: entries by status, suppressed ones by reason."""
    name = F.when(F.col("suppressed"), F.concat(F.lit("suppressed: "), F.coalesce("reason", F.lit("unknown")))).otherwise(F.coalesce(status, F.lit("unknown")))
    return entries.groupBy("company_id", name.alias("slice")).agg(F.count("*").alias("n"))


def domain_metrics(urls: DataFrame) -> DataFrame:
    """By company: onsite, offsite, offsite_pct (4 digits). urls: company_id, root_url, url. URLs without a site count for neither."""
    key, root = comparable_site(F.col("url")), comparable_site(F.col("root_url"))
    rows = urls.select("company_id", key.alias("key"), root.alias("root")).where("key <> ''")
    out = rows.groupBy("company_id").agg(F.count_if(F.col("key") == F.col("root")).alias("onsite"), F.count_if(F.col("key") != F.col("root")).alias("offsite"))
    return out.withColumn("offsite_pct", F.round(F.col("offsite") * 100.0 / (F.col("onsite") + F.col("offsite")), 4))


def offsite_domains(urls: DataFrame) -> DataFrame:
    """company_id, domain, n of the URLs off the company's own site."""
    rows = urls.withColumn("domain", site_key(F.col("url"))).where((comparable_site(F.col("url")) != "") & (comparable_site(F.col("url")) != comparable_site(F.col("root_url"))))
    return rows.groupBy("company_id", "domain").agg(F.count("*").alias("n"))


def error_metrics(texts: DataFrame) -> DataFrame:
    """company_id, signature, n over a company's distinct error texts. texts: company_id, error."""
    rows = texts.where(F.coalesce(F.trim("error"), F.lit("")) != "").select("company_id", F.trim("error").alias("error")).distinct()
    return rows.groupBy("company_id", signature(F.col("error")).alias("signature")).agg(F.count("*").alias("n"))


def offering_metrics(offerings: DataFrame) -> DataFrame:
    """By company: products, services, total and distinct (type, name). offerings: company_id, type, name."""
    return offerings.groupBy("company_id").agg(F.count_if(F.col("type") == "product").alias("products"), F.count_if(F.col("type") == "service").alias("services"), F.count("*").alias("total"), F.count_distinct("type", F.lower(F.trim("name"))).alias("unique_offerings"))


def views(companies: DataFrame) -> DataFrame:
    """view_key, company_id of the global view, each industry (null: unknown) and each industry with a NACE code."""
    one = F.concat(F.lit("industry:"), F.coalesce(F.col("industry").cast("string"), F.lit("unknown")))
    two = F.when(F.col("industry").isNotNull() & F.col("nace").isNotNull(), F.concat(F.lit("industry+nace:"), F.col("industry").cast("string"), F.lit(":"), F.col("nace").cast("string")))
    return companies.select(F.explode(F.array_compact(F.array(F.lit("global"), one, two))).alias("view_key"), "company_id")


def view_sums(members: DataFrame, metrics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """view_key, companies and sums; a company without metrics counts as zeros."""
    rows = members.join(metrics, "company_id", "left").na.fill(0, list(columns))
    return rows.groupBy("view_key").agg(F.count("*").alias("companies"), *(F.sum(c).alias(c) for c in columns))


def view_distributions(members: DataFrame, pages: DataFrame, value: str) -> DataFrame:
    """view_key and ``summarize`` of the values of the pages (company_id, value) of its companies, exactly. A company without pages adds none."""
    return summarize(members.join(pages.select("company_id", value), "company_id"), value, ["view_key"])


def view_sketches(members: DataFrame, pages: DataFrame, value: str, k: int = 400) -> DataFrame:
    """As ``view_distributions``, from one KLL sketch a company that its views merge, so that no page row is copied to each view.

    A quantile's rank is off by about ``2.3 / k`` at the most in 99 of 100 cases, under one in a hundred with the default. n, min and max are exact.
    """
    by_company = pages.where(F.col(value).isNotNull()).groupBy("company_id").agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("_s"), F.count("*").alias("_n"), F.min(value).alias("_min"), F.max(value).alias("_max"))
    merged = members.join(by_company, "company_id").groupBy("view_key").agg(F.sum("_n").alias("n"), F.kll_merge_agg_double("_s", F.lit(k)).alias("_s"), F.min("_min").alias("min"), F.max("_max").alias("max"))
    names = ["median", *(f"p{round(q * 100)}" for q in PERCENTILES[1:])]
    return merged.select("view_key", "n", *(F.kll_sketch_get_quantile_double("_s", F.lit(q)).alias(c) for q, c in zip(PERCENTILES, names, strict=True)), "min", "max")


def view_order(key: Column) -> Column:
    """Sort key of views: the global one, numbered industries by number, others by name, the unknown last."""
    number = F.regexp_extract(key, r"^industry(?:\+nace)?:(\d+)", 1).try_cast("int")
    group = F.when(key == "global", 0).when(key.endswith(":unknown"), 3).when(number.isNotNull(), 1).otherwise(2)
    return F.struct(group.alias("group"), F.coalesce(number, F.lit(0)).alias("number"), key.alias("key"))


def summarize(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """n, mean, median, p75 to p99, min and max, interpolated exactly; zeros where there is no value."""
    p = F.percentile(value, F.array(*map(F.lit, PERCENTILES)))
    rows = df.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), p.alias("p"), F.min(value).alias("min"), F.max(value).alias("max"))
    names = ["median", *(f"p{round(q * 100)}" for q in PERCENTILES[1:])]
    cell = lambda c: F.round(F.coalesce(c, F.lit(0.0)).cast("double"), 6)
    return rows.select(*by, "n", cell(F.col("mean")).alias("mean"), *(cell(F.get("p", F.lit(k))).alias(n) for k, n in enumerate(names)), cell(F.col("min")).alias("min"), cell(F.col("max")).alias("max"))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """lo, hi, label, n of the filled bins of whole numbers from 0: bins are a ``bins``-th of the maximum wide, 10 at least above 500 and 50 above 5000."""
    vals = df.select(F.col(value).cast("long").alias("v")).where("v >= 0")
    top = vals.agg(F.max("v").alias("top"))
    raw = F.greatest(F.lit(1), F.bround(F.col("top") / bins, 0).cast("long"))
    wide = F.when((F.col("top") > 5000) & (raw < 50), 50).when((F.col("top") > 500) & (raw < 10), 10).otherwise(raw)
    rows = vals.join(F.broadcast(top.select("top", wide.alias("w"))), F.lit(True)).groupBy("top", "w", F.floor(F.col("v") / F.col("w")).alias("b")).agg(F.count("*").alias("n"))
    lo, hi = F.col("b") * F.col("w"), (F.col("b") + 1) * F.col("w") - 1
    hi = F.when(F.col("top") <= 0, 0).when(F.col("b") == F.floor(F.col("top") / F.col("w")), F.greatest(hi, F.col("top"))).otherwise(hi)
    rows = rows.select(lo.alias("lo"), hi.cast("long").alias("hi"), "n")
    return rows.select("lo", "hi", F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat_ws("–", F.col("lo").cast("string"), F.col("hi").cast("string"))).alias("label"), "n")


def histogram_edges(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """lo, hi (the next edge), n of equal bins from the least value on, empty ones too."""
    vals = df.select(F.col(value).cast("long").alias("v")).where("v IS NOT NULL")
    ends = vals.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo IS NOT NULL").withColumn("w", F.greatest(F.lit(1), F.ceil((F.col("hi") - F.col("lo")) / bins)).cast("long"))
    found = vals.join(F.broadcast(ends), F.lit(True)).groupBy(F.floor((F.col("v") - F.col("lo")) / F.col("w")).cast("long").alias("b")).agg(F.count("*").alias("n"))
    grid = ends.select("lo", "w", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("hi") - F.col("lo")) / F.col("w")).cast("long"))).alias("b"))
    return grid.join(found, "b", "left").select((F.col("lo") + F.col("b") * F.col("w")).alias("lo"), (F.col("lo") + (F.col("b") + 1) * F.col("w")).alias("hi"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def top_k(df: DataFrame, key: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """by, key, n: the ``k`` most frequent keys, ties in the order of keys, for each group of ``by``."""
    counts = df.groupBy(*by, key).agg(F.count("*").alias("n"))
    if not by:
        return counts.orderBy(F.desc("n"), key).limit(k)
    return counts.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), key))).where(F.col("_n") <= k).drop("_n")


def industry_rollup(offerings: DataFrame, companies: DataFrame) -> DataFrame:
    """industry, products, services, total; companies without an industry are ``unknown``, and count without offerings too."""
    rows = companies.select("company_id", F.coalesce(F.col("industry").cast("string"), F.lit("unknown")).alias("industry")).join(offering_metrics(offerings), "company_id", "left").na.fill(0, ["products", "services", "total"])
    return rows.groupBy("industry").agg(F.sum("products").alias("products"), F.sum("services").alias("services"), F.sum("total").alias("total"))


def running_usage(samples: DataFrame) -> DataFrame:
    """mean, peak and delta of ``used`` over samples (ts, used)."""
    return samples.agg(F.avg("used").alias("mean"), F.max("used").alias("peak"), (F.max_by("used", "ts") - F.min_by("used", "ts")).alias("delta"))


# Fixed values.
TERMINAL_STATUS = r"(?i)(terminal|doomed|dead|permanent|gave[_\s-]?up|abandon|skip)"
CRAWLED_STATUS = r"(?i)(crawled|md_done|llm_done|done|finished|completed)"
LEVEL_ONE_SOURCES = ("industry", "fallback", "industry_only", "lv1")


def state_flags(meta: DataFrame, pages: DataFrame) -> DataFrame:
    """company_id, crawled, terminal_done, md_done, llm_done. meta: company_id, status, crawl_finished, urls_total, urls_md, urls_llm; pages: company_id by page."""
    n = pages.groupBy("company_id").agg(F.count("*").alias("_pages"))
    rows = meta.join(n, "company_id", "left").withColumn("_pages", F.coalesce("_pages", F.lit(0)))
    status, total = F.coalesce("status", F.lit("")), F.coalesce("urls_total", F.lit(0))
    total = F.when(total <= 0, F.col("_pages")).otherwise(total)
    done = lambda c: (total > 0) & (F.coalesce(c, F.lit(0)) >= total)
    crawled = F.coalesce("crawl_finished", F.lit(False)) | status.rlike(CRAWLED_STATUS) | (F.col("_pages") > 0)
    return rows.select("company_id", crawled.alias("crawled"), status.rlike(TERMINAL_STATUS).alias("terminal_done"), done("urls_md").alias("md_done"), done("urls_llm").alias("llm_done"))


def resolve_labels(meta: DataFrame, industries: DataFrame) -> DataFrame:
    """``meta`` (industry, nace, industry_label, industry_label_source) with label_lv1 and label_lv2.

    The label is of level two if its source is ``industry+nace`` and there is a code; of level one if the source says so, else the code's in
    ``industries`` (industry, label; one row each).
    """
    label, source = F.nullif(F.trim("industry_label"), F.lit("")), F.trim("industry_label_source")
    rows = meta.join(industries.select("industry", F.nullif(F.trim("label"), F.lit("")).alias("_known")), "industry", "left")
    two = F.when((source == "industry+nace") & F.col("nace").isNotNull(), label)
    one = F.coalesce(F.when(source.isin(*LEVEL_ONE_SOURCES), label), F.col("_known"))
    return rows.withColumns({"label_lv1": one, "label_lv2": two}).drop("_known")


def global_totals(metrics: DataFrame, stored_urls: int = 0, with_llm: bool = True) -> DataFrame:
    """One row of sums over companies (total_urls, markdown_saved, md_tokens, llm_output_tokens, offerings); ``stored_urls`` counts where no URL does."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    paid = lambda c: total(c) if with_llm else F.lit(0).cast("long")
    urls = total("total_urls")
    return metrics.agg(
        F.count("*").alias("companies_total"), F.when(urls > 0, urls).otherwise(F.lit(stored_urls).cast("long")).alias("urls_total"), total("markdown_saved").alias("markdown_saved_total"), total("md_tokens").alias("md_tokens_total"),
        paid("llm_output_tokens").alias("llm_output_tokens_total"), paid("offerings").alias("offerings_total"), F.lit(with_llm).alias("llm_metrics_enabled"),
    )


def saved_counter(c: Column) -> Column:
    """A counter written as a whole number or as digits; 0 for anything else."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(r"^\d+\z"), text.try_cast("int")).otherwise(0)


def dataset(companies: DataFrame, meta: DataFrame, entries: DataFrame, profiles: DataFrame, shared: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """A row per company: its meta columns, ``urls``, and ``profile``, its own or else the shared one.

    companies: company_id. meta: company_id and more. entries: company_id by URL. profiles: company_id, profile; shared: the same, for companies without
    one. ``most`` takes the companies with the least ids, which a report on a few asks for.
    """
    ids = companies.select("company_id").distinct()
    ids = ids.orderBy("company_id").limit(most) if most is not None else ids
    urls = entries.groupBy("company_id").agg(F.count("*").alias("urls"))
    rows = ids.join(meta, "company_id", "left").join(urls, "company_id", "left").withColumn("urls", F.coalesce("urls", F.lit(0)))
    rows = rows.join(profiles.select("company_id", "profile"), "company_id", "left")
    if shared is None:
        return rows
    return rows.join(shared.select("company_id", F.col("profile").alias("_shared")), "company_id", "left").withColumn("profile", F.coalesce("profile", "_shared")).drop("_shared")
