"""Checks and repairs of stored state."""

from __future__ import annotations

import json
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import truthy
from . import state


def json_health(text: Column) -> Column:
    """Why a JSON document is unusable: empty, nul-prefix, whitespace, parse-error or not-object; null for an object."""
    whole = F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit("}")))  # a parse of the text alone would not see what follows the first value
    parsed = F.schema_of_variant(F.try_parse_json(text))
    return (
        F.when(text.isNull(), "unreadable")
        .when(text == "", "empty")
        .when(text.startswith("\u0000"), "nul-prefix")
        .when(text.rlike(r"^\s+\z"), "whitespace")
        .when(F.try_parse_json(text).isNull() | whole.isNull(), "parse-error")
        .when(~parsed.startswith("OBJECT"), "not-object")
    )


def _is_json(text: Column) -> Column:
    def check(t: str | None) -> bool:
        try:
            json.loads(t)
        except (TypeError, ValueError, RecursionError):
            return False
        return True

    @F.pandas_udf("boolean")
    def checked(texts: pd.Series) -> pd.Series:
        return texts.map(check).astype(bool)

    return checked(text)


def bytes_health(content: Column) -> Column:
    """Why the bytes of a JSON file are unusable: unreadable, empty, nul_bytes_prefix_or_early, non_utf8_bytes, whitespace_only, json_parse_error or
    json_not_dict; null for an object. What the engine's parser does not take, such as a key given twice, is read again in Python before it counts as an error.
    """
    text = content.cast("string")
    early = F.hex(F.substring(content, 1, 256)).rlike("^(?:09|0A|0D|20)*00")
    fine = F.is_valid_utf8(text)
    blank = text.rlike(r"^[\s\x1C-\x1F\x85\p{Z}]*\z")
    whole = F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit("}"))).isNotNull() & F.try_parse_json(text).isNotNull()
    asked = F.when(fine & ~blank & ~whole, text)  # null elsewhere, so that Python gets few texts
    return (
        F.when(content.isNull(), "unreadable").when(F.octet_length(content) == 0, "empty").when(early, "nul_bytes_prefix_or_early").when(~fine, "non_utf8_bytes").when(blank, "whitespace_only")
        .when(~whole & ~_is_json(asked), "json_parse_error").when(~text.rlike(r"^\s*\{"), "json_not_dict")
    )


def corrupt_files(files: DataFrame, company: Column, listed: DataFrame | None = None) -> DataFrame:
    """company_id, path, size_bytes, reason, head_bytes_hex, head_text_preview of unusable JSON files, of rows as ``spark.read.format("binaryFile")`` gives them.

    That scan has no row for a file of no bytes; ``listed`` (path) names the files that are there, and those without a row are empty.
    """
    if listed is not None:
        files = files.select("path", "content").unionByName(listed.select("path").join(files.select("path"), "path", "left_anti").withColumn("content", F.lit(b"")))
    head = F.make_valid_utf8(F.substring("content", 1, 200).cast("string"))
    for mark, shown in (("\r", "\\r"), ("\n", "\\n"), ("\t", "\\t")):
        head = F.replace(head, F.lit(mark), F.lit(shown))
    rows = files.select(company.alias("company_id"), "path", F.coalesce(F.octet_length("content"), F.lit(0)).cast("long").alias("size_bytes"), bytes_health(F.col("content")).alias("reason"), F.lower(F.hex(F.substring("content", 1, 80))).alias("head_bytes_hex"), head.alias("head_text_preview"))
    return rows.where(F.col("reason").isNotNull())


def corruption_fix(corrupt: DataFrame, companies: DataFrame, runs: DataFrame, done: DataFrame, tag: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What mends the companies of ``corrupt`` files: (renames, companies, done, report).

    renames: path and the path to which it is put aside. companies: those affected are pending with zero counters and last_error ``corrupt_url_index_json``. done
    (run_id, company_id): without them in the latest run (of ``runs``: run_id, started_at), so that they are crawled again. report: one row of counts. Files of unknown companies stay.
    """
    known = corrupt.join(companies.select("company_id"), "company_id", "left_semi")
    ids = known.select("company_id").distinct()
    renames = known.select("path", F.concat("path", F.lit(f".corrupt.{tag}")).alias("aside"))
    hit = ids.withColumn("_hit", F.lit(True))
    error = companies.join(hit, "company_id", "left").withColumn("last_error", F.when(F.col("_hit"), "corrupt_url_index_json").otherwise(F.col("last_error") if "last_error" in companies.columns else F.lit(None).cast("string"))).drop("_hit")
    latest = runs.agg(F.max_by("run_id", "started_at").alias("run_id"))
    unmarked = done.join(F.broadcast(latest), "run_id", "left_semi").join(ids, "company_id", "left_semi").select("run_id", "company_id")
    counts = [known.select(F.lit("quarantined_files").alias("k"), F.lit(1).alias("n")), ids.select(F.lit("affected_companies"), F.lit(1)), unmarked.select(F.lit("run_done_unmarked"), F.lit(1)), companies.select(F.lit("scanned_companies"), F.lit(1))]
    every = counts[0].union(counts[1]).union(counts[2]).union(counts[3])
    report = every.agg(*(F.coalesce(F.sum(F.when(F.col("k") == k, F.col("n"))), F.lit(0)).alias(k) for k in ("scanned_companies", "affected_companies", "quarantined_files", "run_done_unmarked")))
    return renames, reset_rows(error, ids), done.join(unmarked, ["run_id", "company_id"], "left_anti"), report


def suppressed(action: Column, reason: Column, status: Column) -> Column:
    """An entry that gating dropped, under any of its spellings."""
    return F.coalesce(F.lower(action).isin("suppress", "suppressed"), F.lit(False)) | F.coalesce(F.lower(status).rlike("suppress"), F.lit(False)) | (F.coalesce(truthy(reason), F.lit(False)) & F.coalesce(~F.lower(reason).isin("ok"), F.lit(False)) & (F.coalesce(F.lower(action), F.lit("")) != "save"))


def index_meta(entries: DataFrame) -> DataFrame:
    """By company: total_pages, markdown_saved, markdown_suppressed, timeout_pages, memory_pressure_pages.

    entries: company_id, status, gating_action, gating_reason, md_done.
    """
    hidden = suppressed(F.col("gating_action"), F.col("gating_reason"), F.col("status"))
    return entries.groupBy("company_id").agg(
        F.count("*").alias("total_pages"), F.count_if(F.col("md_done") & ~hidden).alias("markdown_saved"), F.count_if(hidden).alias("markdown_suppressed"),
        F.count_if(F.coalesce(F.lower("status").rlike("timeout"), F.lit(False))).alias("timeout_pages"), F.count_if(F.coalesce(F.lower("status").rlike("memory"), F.lit(False))).alias("memory_pressure_pages"),
    )


def empty_index(meta: DataFrame) -> Column:
    """No meta, or four counters that are all 0."""
    total = F.lit(0)
    for c in ("total_pages", "markdown_saved", "markdown_suppressed", "timeout_pages"):
        total = total + F.coalesce(meta[c], F.lit(0))
    return total == 0


def reconcile(companies: DataFrame) -> DataFrame:
    """``companies`` with ``problem`` and ``status`` mended.

    A terminal row without a reason is an error; an unfinished one with a reason becomes terminal.
    """
    reason = F.coalesce(F.trim("done_reason"), F.lit("")) != ""
    terminal = F.col("status") == "terminal_done"
    unfinished = F.col("status").isin("pending", "in_progress", "markdown_not_done")
    return companies.withColumn("problem", F.when(terminal & ~reason, "terminal-without-reason").when(unfinished & reason, "reason-without-terminal")).withColumn("status", F.when(unfinished & reason, "terminal_done").otherwise(F.col("status")))


def reset_candidates(companies: DataFrame, targets: Mapping[str, Column], include: DataFrame | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """Companies that any target condition selects, with the names of those that do; included ids are added, excluded ones go last."""
    why = F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in targets.items())))
    rows = companies.withColumn("reasons", why)
    if include is not None:
        known = include.select(F.col("company_id").alias("_i")).distinct()
        rows = rows.join(known, F.col("company_id") == F.col("_i"), "left").withColumn("reasons", F.when(F.col("_i").isNotNull(), F.array_append("reasons", F.lit("included"))).otherwise(F.col("reasons"))).drop("_i")
    rows = rows.where(F.size("reasons") > 0)
    return rows if exclude is None else rows.join(exclude.select("company_id").distinct(), "company_id", "left_anti")


def reset_rows(companies: DataFrame, chosen: DataFrame) -> DataFrame:
    """``companies`` in which chosen ones are pending with zero counters and no reason."""
    known = chosen.select(F.col("company_id").alias("_c")).distinct()
    rows = companies.join(known, F.col("company_id") == F.col("_c"), "left")
    hit = F.col("_c").isNotNull()
    new = {c: F.when(hit, 0).otherwise(F.col(c)) for c in ("urls_total", "urls_md", "urls_llm") if c in companies.columns}
    new["status"] = F.when(hit, "pending").otherwise(F.col("status"))
    if "done_reason" in companies.columns:
        new["done_reason"] = F.when(~hit, F.col("done_reason"))
    return rows.withColumns(new).select(*companies.columns)


def purge(df: DataFrame, ids: DataFrame, key: str = "company_id") -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_anti")


def max_pages(args: Column) -> Column:
    """The page cap in an arguments text: ``max_pages=`` or JSON."""
    plain = F.nullif(F.regexp_extract(args, r"max[_-]pages[\"']?\s*[=:]\s*(\d+)", 1), F.lit(""))
    return F.coalesce(plain, F.get_json_object(args, "$.max_pages")).try_cast("int")


def legacy_columns(df: DataFrame, wanted: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """Columns of an older layout under their new names: the first alternative that is there and filled."""
    out = []
    for name, alternatives in wanted.items():
        there = [F.col(c) for c in alternatives if c in df.columns]
        out.append((F.coalesce(*there) if there else F.lit(None).cast("string")).alias(name))
    return df.select(*out)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, r"[/\\]"), -1)


def known_only(source: DataFrame, companies: DataFrame) -> DataFrame:
    """Source rows of companies that the state has."""
    return source.join(companies.select("company_id").distinct(), "company_id", "left_semi")


def enriched(companies: DataFrame, source: DataFrame, columns: list[str]) -> DataFrame:
    """``companies`` with what the source says in ``columns``, where it says something."""
    facts = known_only(source, companies).select("company_id", *(F.col(c).alias(f"_{c}") for c in columns))
    rows = companies.join(facts, "company_id", "left")
    return rows.withColumns({c: F.coalesce(f"_{c}", c) for c in columns}).drop(*(f"_{c}" for c in columns))


def calibrated(companies: DataFrame, source: DataFrame, entries: DataFrame, meta: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Companies after enrichment from ``source`` and recomputation from the index, and the global state that follows.

    entries: company_id, url, md_done, llm_done; meta: company_id, crawl_finished. A company without pages keeps its state.
    """
    rows = enriched(companies, source, columns)
    fresh = state.company_stage(entries, meta)
    moved = state.recompute(rows.select("company_id", "status", "urls_total", "urls_md", "urls_llm", "crawl_finished"), fresh)
    out = rows.drop("status", "urls_total", "urls_md", "urls_llm", "crawl_finished").join(moved, "company_id")
    return out, state.global_state(out)


def meta_documents(companies: DataFrame, version: str) -> DataFrame:
    """company_id, value: each company's columns as one JSON document, null ones too, with the version that wrote it."""
    fields = [F.col(c) for c in companies.columns]
    return companies.select("company_id", F.to_json(F.struct(*fields, F.lit(version).alias("version")), {"ignoreNullFields": "false"}).alias("value"))


def patched_meta(base: DataFrame, patches: DataFrame, now: str) -> DataFrame:
    """company_id, fields (map): documents with a patch's fields over their own; ``created_at`` where there was none, and ``updated_at``.

    base, patches: company_id, fields (map of texts; one row each).
    """
    rows = base.join(patches.select("company_id", F.col("fields").alias("_more")), "company_id", "full")
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    old, new = F.coalesce("fields", empty), F.coalesce("_more", empty)
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k)), new)
    blank = lambda k: F.coalesce(F.trim(merged[k]), F.lit("")) == ""
    stamps = F.map_filter(F.create_map(F.lit("company_id"), F.col("company_id").cast("string"), F.lit("created_at"), F.lit(now), F.lit("updated_at"), F.lit(now)), lambda k, v: (k == "updated_at") | ((k == "company_id") & blank("company_id")) | ((k == "created_at") & blank("created_at")))
    return rows.select("company_id", F.map_concat(F.map_filter(merged, lambda k, v: ~F.map_contains_key(stamps, k)), stamps).alias("fields"))


def upsert_runs(runs: DataFrame, started: DataFrame) -> DataFrame:
    """Runs after starts (run_id, ord, pipeline, version, started_at): a known id gets the last start's columns and keeps its counts, a new one begins at 0."""
    last = started.groupBy("run_id").agg(F.max_by(F.struct("pipeline", "version", "started_at"), "ord").alias("s"))
    rows = runs.join(last, "run_id", "full")
    pick = lambda c: F.when(F.col("s").isNotNull(), F.col(f"s.{c}")).otherwise(F.col(c)).alias(c)
    return rows.select("run_id", pick("pipeline"), pick("version"), pick("started_at"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total_companies", "completed_companies")), F.col("last_company_id"))


def run_totals(runs: DataFrame, updates: DataFrame) -> DataFrame:
    """Runs after updates (run_id, ord, total_companies, completed_companies, last_company_id): of each column the last value that is not null."""
    names = ("total_companies", "completed_companies", "last_company_id")
    last = updates.groupBy("run_id").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ord"))).alias(f"_{c}") for c in names))
    return runs.join(last, "run_id", "left").withColumns({c: F.coalesce(f"_{c}", c) for c in names}).drop(*(f"_{c}" for c in names))


def sample_company(companies: DataFrame, meta: DataFrame, index_meta: DataFrame, company_id: str | None = None) -> DataFrame:
    """One company's state beside its documents: the one asked for, else that with the least id."""
    one = companies.where(F.col("company_id") == company_id) if company_id else companies.orderBy("company_id").limit(1)
    return one.join(meta, "company_id", "left").join(index_meta, "company_id", "left")
