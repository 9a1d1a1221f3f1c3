"""The full extraction pass, and what is written down of how it was made."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import table
from . import payload


def has_context(label: Column, industry: Column, nace: Column) -> Column:
    """A label, or both codes."""
    return (F.coalesce(F.trim(label), F.lit("")) != "") | (industry.isNotNull() & nace.isNotNull())


def context(label: Column, industry: Column, nace: Column) -> Column:
    """Struct (label, industry, nace); what is not known is ``unknown`` or -1."""
    return F.struct(F.coalesce(F.nullif(F.trim(label), F.lit("")), F.lit("unknown")).alias("label"), F.coalesce(industry, F.lit(-1)).alias("industry"), F.coalesce(nace, F.lit(-1)).alias("nace"))


def requested(mode: str, has_model: bool, finalize_only: bool = False) -> bool:
    """Whether a run asks a model at all."""
    return not finalize_only and mode in ("presence", "full") and has_model


def provenance(c: Column | None, provider: str, instruction: str, mode: str) -> dict[str, Column]:
    """Columns on what an answer rests on: the context (``context``; None: none), the provider and the instruction's SHA-1."""
    if not provider.strip() or not instruction.strip():
        raise ValueError("provider and instruction must have a text")
    label = F.lit("") if c is None else F.trim(c["label"])
    return {
        "ctx_is_generic": F.lit(True) if c is None else label == "", "industry_label_used": label,
        "industry_used": F.lit(None).cast("int") if c is None else c["industry"], "nace_used": F.lit(None).cast("int") if c is None else c["nace"],
        "llm_mode": F.lit(mode), "llm_provider": F.lit(provider), "llm_instruction_sha1": F.lit(hashlib.sha1(instruction.encode("utf-8", "ignore")).hexdigest()),
    }


def full_pass(pending: DataFrame, extract: Callable[[list[str]], list[str]]) -> tuple[DataFrame, DataFrame]:
    """Patches of the URL index and product records of pending pages (company_id, url, markdown_path, body).

    patches: company_id, url, status, extracted, presence (null where no model was asked). Only pages with text reach the model. products: company_id,
    url, type, name, description, tags of offerings that the page supports. A page whose offerings all go has presence 0. The model is asked when this
    is called, once a page; its answers, not the pages, are kept in the shared folder. A lost task asks again for its pages alone.
    """
    path, text = F.coalesce(F.trim("markdown_path"), F.lit("")), F.coalesce(F.trim("body"), F.lit(""))
    why = F.when(path == "", "llm_full_skipped_no_markdown").when(text == "", "llm_full_empty_markdown")
    rows = pending.select("company_id", "url", "body", why.alias("status"))
    kind = dict(rows.dtypes)["company_id"]

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(raw=extract(pdf["body"].tolist()))

    asked = rows.where(F.col("status").isNull()).select("company_id", "url", "body").mapInPandas(part, f"company_id {kind}, url string, body string, raw string")
    stays = payload.supported(payload.offering_list(F.col("json")), F.col("body"))
    # written once, so that each page is asked once, and patches and products rest on the same answer
    answers = table(payload.salvage(asked, "raw").select("company_id", "url", stays.alias("offerings")), "full-answers")
    products = answers.select("company_id", "url", F.explode("offerings").alias("o")).select("company_id", "url", "o.*")
    patches = rows.where(F.col("status").isNotNull()).select("company_id", "url", "status", F.lit(1).alias("extracted"), F.lit(None).cast("int").alias("presence"))
    done = answers.select("company_id", "url", F.lit("llm_full_extracted").alias("status"), F.lit(1).alias("extracted"), (F.size("offerings") > 0).cast("int").alias("presence"))
    return patches.unionByName(done), products


def link_products(files: DataFrame, entries: DataFrame) -> DataFrame:
    """company_id, file, url, markdown_path of product files that an index entry names; others go.

    files: company_id, path (whole). entries: company_id, url, product_path, markdown_path, and folder, the company's, for paths that are not whole. A file goes with
    the last entry of its whole path, else with the first (by URL) of its name.
    """
    whole = F.when(F.col("product_path").startswith("/"), F.col("product_path")).otherwise(F.concat_ws("/", F.rtrim("folder"), "product_path"))
    rows = entries.where(F.coalesce(F.trim("product_path"), F.lit("")) != "").select("company_id", "url", "markdown_path", whole.alias("path"), F.element_at(F.split("product_path", "/"), -1).alias("file"))
    by_path = rows.groupBy("company_id", "path").agg(F.max(F.struct("url", "markdown_path")).alias("p"))
    by_name = rows.groupBy("company_id", "file").agg(F.min(F.struct("url", "markdown_path")).alias("n"))
    named = files.withColumn("file", F.element_at(F.split("path", "/"), -1))
    linked = named.join(by_path, ["company_id", "path"], "left").join(by_name, ["company_id", "file"], "left").withColumn("e", F.coalesce("p", "n"))
    return linked.where(F.col("e").isNotNull()).select("company_id", "file", "e.url", "e.markdown_path")
