"""Company state from URL indexes: change logs are folded to entries, entries to stages, stages to totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import DERIVE_RANK, percent, rank
from ..functions.coerce import status as known_status
from ..functions.markup import head_document
from ..functions.text import bm25_tokens
from ..functions.vectors import page_relevance


def fold_log(log: DataFrame, keys: Sequence[str], order: str, fields: Sequence[str]) -> DataFrame:
    """One row per key from a log of sparse patches: of each field the last value that is not null, by ``order``."""
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in fields]
    return log.groupBy(*keys).agg(*last)


def completed(status: Column, md_flag: Column, llm_flag: Column, md_path: Column, llm_path: Column) -> Column:
    """Struct (md_done, llm_done) of an entry: a flag, an artifact's path or the status says so, and a done extraction implies a done page."""
    no = F.lit(False)
    llm = F.coalesce(llm_flag, no) | F.coalesce(llm_path != "", no) | F.coalesce(status == "llm_done", no)
    md = F.coalesce(md_flag, no) | F.coalesce(md_path != "", no) | F.coalesce(status == "markdown_done", no) | llm
    return F.struct(md.alias("md_done"), llm.alias("llm_done"))


def stage(finished: Column, total: Column, md: Column, llm: Column) -> Column:
    """Status of a company from its counters."""
    return (
        F.when(total == 0, "pending")
        .when(~finished & (md == 0), "pending")
        .when(md < total, "markdown_not_done")
        .when(llm >= total, "llm_done")
        .when(llm > 0, "llm_not_done")
        .when(finished, "markdown_done")
        .otherwise("llm_not_done")
    )


def company_stage(entries: DataFrame, meta: DataFrame) -> DataFrame:
    """company_id, urls_total, urls_md, urls_llm, crawl_finished, status.

    entries: company_id, md_done, llm_done. meta: company_id, crawl_finished. A company without entries is pending.
    """
    counts = entries.groupBy("company_id").agg(F.count("*").alias("urls_total"), F.count_if("md_done").alias("urls_md"), F.count_if("llm_done").alias("urls_llm"))
    rows = meta.select("company_id", F.coalesce("crawl_finished", F.lit(False)).alias("crawl_finished")).join(counts, "company_id", "full_outer")
    rows = rows.na.fill(0, ["urls_total", "urls_md", "urls_llm"]).na.fill(False, ["crawl_finished"])
    return rows.withColumn("status", stage(F.col("crawl_finished"), F.col("urls_total"), F.col("urls_md"), F.col("urls_llm")))


def normalize_counters(df: DataFrame) -> DataFrame:
    """Counters that agree: total is the most, extraction implies pages, and ``llm_done`` means all of both."""
    total = F.greatest("urls_total", "urls_md", "urls_llm")
    done = F.col("status") == "llm_done"
    llm = F.when(done, total).otherwise(F.greatest("urls_llm", F.lit(0)))
    md = F.when(done, total).otherwise(F.greatest("urls_md", llm))
    return df.withColumns({"urls_total": total, "urls_md": md, "urls_llm": llm})


def recompute(old: DataFrame, derived: DataFrame) -> DataFrame:
    """Old rows raised to what their index shows: statuses and counters never go down; ``crawl_finished`` is either's."""
    d = derived.select("company_id", *(F.col(c).alias(f"_{c}") for c in ("status", "urls_total", "urls_md", "urls_llm", "crawl_finished")))
    rows = old.join(d, "company_id", "left")
    up = F.coalesce(rank(F.col("_status"), DERIVE_RANK), F.lit(-1)) > rank(F.col("status"), DERIVE_RANK)
    new = {c: F.greatest(c, F.coalesce(f"_{c}", c)) for c in ("urls_total", "urls_md", "urls_llm")}
    new |= {"status": F.when(up, F.col("_status")).otherwise(F.col("status")), "crawl_finished": F.col("crawl_finished") | F.coalesce("_crawl_finished", F.lit(False))}
    return rows.withColumns(new).select(*old.columns)


def global_state(companies: DataFrame) -> DataFrame:
    """One row: companies by status, sums, percentages, and how many are done with and without extraction."""
    s = known_status(F.col("status"))
    n = F.count("*")
    done = [F.count_if(s == x).alias(f"n_{x}") for x in DERIVE_RANK]
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("urls_total", "urls_md", "urls_llm")]
    out = companies.agg(n.alias("n_companies"), *done, *sums)
    return out.withColumn("pct_md", percent(F.col("urls_md"), F.col("urls_total"))).withColumn("pct_llm", percent(F.col("urls_llm"), F.col("urls_total"))).withColumn("pct_done", percent(F.col("n_llm_done") + F.col("n_terminal_done"), F.col("n_companies")))


def progress(companies: DataFrame, llm: bool = True) -> DataFrame:
    """done, total: with extraction ``llm_done`` and ``terminal_done`` are done, without it ``markdown_done`` too."""
    done = ("llm_done", "terminal_done") if llm else ("markdown_done", "llm_not_done", "llm_done", "terminal_done")
    return companies.agg(F.count_if(F.col("status").isin(*done)).alias("done"), F.count("*").alias("total"))


def runnable(status: Column, llm: bool) -> Column:
    return status != "llm_done" if llm else ~status.isin("markdown_done", "terminal_done")


def pending(entries: DataFrame, what: str) -> DataFrame:
    """Entries that a pass has yet to do: pages without Markdown, or Markdown without extraction."""
    return entries.where(~F.col("md_done")) if what == "markdown" else entries.where(F.col("md_done") & ~F.col("llm_done"))


def worklist(ids: DataFrame, retry: DataFrame, mode: str = "all") -> DataFrame:
    """Ids restricted by the retry table: all, skip-retry or only-retry."""
    return ids if mode == "all" else ids.join(retry.select("company_id").distinct(), "company_id", {"skip-retry": "left_anti", "only-retry": "left_semi"}[mode])


def page_summary(pages: DataFrame) -> DataFrame:
    """By company: pages, saved, suppressed, timeouts, memory, ratio of timeouts, and the last error, in which strong ones go before weak ones.

    pages: company_id, ord, action, error_kind, error.
    """
    strong = F.col("error_kind").isin("memory", "timeout")
    return pages.groupBy("company_id").agg(
        F.count("*").alias("pages"), F.count_if(F.col("action") == "save").alias("saved"), F.count_if(F.col("action") == "suppress").alias("suppressed"), F.count_if(F.col("error_kind") == "timeout").alias("timeouts"),
        F.count_if(F.col("error_kind") == "memory").alias("memory"), F.max_by("error", F.when(F.col("error").isNotNull(), F.struct(F.coalesce(strong, F.lit(False)), F.col("ord")))).alias("last_error"),
    ).withColumn("timeout_share", F.round(F.col("timeouts") / F.col("pages"), 6))


def page_decision(summary: DataFrame) -> DataFrame:
    """``summary`` with ``decision``: mem for any memory page, none without pages, stall where 60 % or more timed out, else ok."""
    return summary.withColumn("decision", F.when(F.col("memory") > 0, "mem").when(F.col("pages") == 0, "none").when(F.col("timeouts") >= 0.6 * F.col("pages"), "stall").otherwise("ok"))


def cap_pages(pages: DataFrame, cap: int, order: Sequence[Column]) -> DataFrame:
    """``pages`` with ``kept``: the first ``cap`` of each company in the given order."""
    return pages.withColumn("kept", F.row_number().over(Window.partitionBy("company_id").orderBy(*order)) <= cap)


def cap_by_relevance(pages: DataFrame, cap: int, positive: tuple[str, ...], negative: tuple[str, ...], stopwords: tuple[str, ...] = ()) -> DataFrame:
    """Pages that have Markdown or HTML (company_id, url, html, has_markdown, more) with score, kept and suppressed_reason.

    A company keeps its ``cap`` most relevant pages, by head document and URL, ties by URL; the others are suppressed for ``max_pages``. Where its kept pages end is found
    from the first ``cap`` of each task, so no task ranks all pages of a large company.
    """
    head = bm25_tokens(head_document(F.col("html")), stopwords)
    score = page_relevance(head, bm25_tokens(F.col("url"), stopwords), positive, negative)
    scored = pages.where(F.col("has_markdown") | F.col("html").isNotNull()).withColumn("score", score)
    key = F.struct((-F.col("score")).alias("low"), F.col("url").alias("url"))
    ranked = scored.select("company_id", key.alias("key")).withColumn("turn", F.row_number().over(Window.partitionBy("company_id").orderBy("key")))
    ends = ranked.where(F.col("turn") <= cap).groupBy("company_id").agg(F.max("key").alias("end"))
    kept = scored.join(ends, "company_id").withColumn("kept", key <= F.col("end")).drop("end")
    return kept.withColumn("suppressed_reason", F.when(~F.col("kept"), "max_pages"))


def cap_report(capped: DataFrame, cap: int) -> DataFrame:
    """By company: candidates, kept, overflow, markdown_saved (kept pages with Markdown) and hard_max_pages_hit."""
    return capped.groupBy("company_id").agg(
        F.count("*").alias("candidates"), F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("overflow"), F.count_if(F.col("kept") & F.col("has_markdown")).alias("markdown_saved"), (F.count("*") > cap).alias("hard_max_pages_hit"),
    )


def next_attempts(attempts: DataFrame, run_id: str) -> DataFrame:
    """company_id, attempt_no: one more than the greatest of a run."""
    return attempts.where(F.col("run_id") == run_id).groupBy("company_id").agg((F.max("attempt_no") + 1).alias("attempt_no"))


def snapshot(ids: DataFrame, companies: DataFrame) -> DataFrame:
    """The companies' rows for ``ids``; one that is missing is pending with zero counters."""
    rows = ids.join(companies, "company_id", "left")
    return rows.na.fill("pending", ["status"]).na.fill(0, ["urls_total", "urls_md", "urls_llm"]).na.fill(False, ["crawl_finished"])


def recrawl(companies: DataFrame, forced: bool, old_cap: int, new_cap: int) -> DataFrame:
    """Companies to open again: all if forced, or those that stopped at a cap that is now higher; terminal ones stay."""
    open_ = F.col("status").isin("markdown_done", "llm_not_done", "llm_done") & (F.lit(forced) | (F.lit(new_cap > old_cap) & (F.col("urls_total") == old_cap)))
    return companies.withColumns({"reopened": open_, "status": F.when(open_, "markdown_not_done").otherwise(F.col("status"))})


#: A crawl has ended in these, well or not.
ENDED = ("markdown_done", "terminal_done", "llm_not_done", "llm_done")


def stage_policies(companies: DataFrame, llm_requested: bool = True) -> DataFrame:
    """``companies`` (status, urls_md) with may_extract, skip_extraction (nothing to read) and crawl_done."""
    ended = F.col("status").isin(*ENDED)
    empty = F.lit(llm_requested) & (F.coalesce("urls_md", F.lit(0)) <= 0)
    return companies.withColumns({"may_extract": ended, "skip_extraction": empty, "crawl_done": ended})
