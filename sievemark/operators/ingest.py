"""Company rows from source tables: keys, canonical URLs, merging, order, industry labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import blank_to_null, lenient_int, resolve_column
from ..functions.urls import canonical_url, host, registrable

# Fixed values.
ID_KEYS = ("bvdid", "hojin_id", "id")
NAME_KEYS = ("name", "company_name", "company")
URL_KEYS = ("url", "website", "homepage", "home_page")


def _first(df: DataFrame, keys: tuple[str, ...]) -> Column:
    found = [c for c in (resolve_column(df, [k]) for k in keys) if c]
    return F.coalesce(*(blank_to_null(F.col(c)) for c in found)) if found else F.lit(None).cast("string")


def companies(df: DataFrame, order: str) -> DataFrame:
    """ord, company_id, name, root_url, metadata of the rows that have an id, a name and a usable URL; the rest goes.

    Each key is the first filled one of its candidates; other columns go to ``metadata`` as trimmed text.
    """
    chosen = {resolve_column(df, keys) for keys in (ID_KEYS, NAME_KEYS, URL_KEYS)}
    rest = [c for c in df.columns if c not in chosen and c != order]
    shown = lambda c: F.when(F.lit(c.lower() in ("industry", "nace")), F.coalesce(lenient_int(F.col(c)).cast("string"), F.trim(F.col(c).cast("string")))).otherwise(F.trim(F.col(c).cast("string")))
    meta = F.create_map(*(x for c in rest for x in (F.lit(c), F.coalesce(shown(c), F.lit(""))))) if rest else F.create_map().cast("map<string,string>")
    raw = _first(df, URL_KEYS)
    rows = df.select(F.col(order).alias("ord"), _first(df, ID_KEYS).alias("company_id"), _first(df, NAME_KEYS).alias("name"), raw.alias("url_raw"), canonical_url(raw).alias("root_url"), meta.alias("metadata"))
    return rows.where(F.col("company_id").isNotNull() & F.col("name").isNotNull() & (F.coalesce("root_url", F.lit("")) != ""))


def first_records(df: DataFrame) -> DataFrame:
    """The first row of each id and URL in lower case, by ``ord``."""
    key = [F.lower(F.trim("company_id")), F.lower(F.trim("root_url"))]
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy("ord"))).where("_n = 1").drop("_n")


def _seen_order(value: str) -> Column:
    """Distinct non-empty values in the order of their first row."""
    rows = F.array_sort(F.collect_list(F.when(F.coalesce(F.col(value), F.lit("")) != "", F.struct("ord", value))))
    return F.array_distinct(F.transform(rows, lambda x: x[value]))


def merge_by_url(df: DataFrame) -> DataFrame:
    """One row per canonical URL (ord, company_id, name, root_url, industry, nace, industry_label): ids and names joined, first known codes."""
    known = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ord"))).alias(c)
    out = df.where(F.col("root_url") != "").groupBy("root_url").agg(
        F.min("ord").alias("ord"), F.array_join(_seen_order("company_id"), "|").alias("company_id"), F.array_join(_seen_order("name"), " | ").alias("name"),
        F.min_by("company_id", "ord").alias("primary_id"), F.min_by("name", "ord").alias("primary_name"), F.count("*").alias("agg_count"), known("industry"), known("nace"), known("industry_label"),
    )
    return out


def interleave(df: DataFrame) -> DataFrame:
    """``df`` (ord, root_url) with ``turn`` and ``domain``; sorted by them, domains take turns, each in its own order."""
    named = df.withColumn("domain", registrable(host(F.col("root_url"), collapse_www=False)))
    return named.withColumn("turn", F.row_number().over(Window.partitionBy("domain").orderBy("ord")))


def lookup(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """A dimension with one label per key: the first by ``order``. Rows without a label or a key are left out."""
    ok = blank_to_null(F.col("label")).isNotNull()
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return df.where(ok).groupBy(*keys).agg(F.min_by("label", order).alias("label"))


def enrich_industry(df: DataFrame, pairs: DataFrame, naces: DataFrame, industries: DataFrame) -> DataFrame:
    """Label from (industry, nace), else from nace, else from industry, with where it came from.

    The dimensions are ``lookup`` results; Spark broadcasts those that it knows to be small.
    """
    p = pairs.select(F.col("industry").alias("_pi"), F.col("nace").alias("_pn"), F.col("label").alias("_pl"))
    n = naces.select(F.col("nace").alias("_nn"), F.col("label").alias("_nl"))
    i = industries.select(F.col("industry").alias("_ii"), F.col("label").alias("_il"))
    rows = df.join(p, (F.col("industry") == F.col("_pi")) & (F.col("nace") == F.col("_pn")), "left").join(n, F.col("nace") == F.col("_nn"), "left").join(i, F.col("industry") == F.col("_ii"), "left")
    source = F.when(F.col("_pl").isNotNull(), "industry+nace").when(F.col("_nl").isNotNull(), "nace").when(F.col("_il").isNotNull(), "industry").otherwise("unknown")
    return rows.select(*df.columns, F.coalesce("_pl", "_nl", "_il").alias("industry_label"), source.alias("industry_label_source"))


def external_domains(df: DataFrame, url: str = "root_url") -> DataFrame:
    """Distinct registrable domains of a dataset's companies, bare and with ``www.``."""
    bare = df.select(registrable(host(F.col(url))).alias("domain")).where("domain <> ''").distinct()
    return bare.select(F.explode(F.array(F.col("domain"), F.concat(F.lit("www."), F.col("domain")))).alias("domain"))


def load(df: DataFrame, order: str, pairs: DataFrame | None = None, naces: DataFrame | None = None, industries: DataFrame | None = None, merge: bool = True, turns: bool = True) -> DataFrame:
    """Companies of a source table in one go: valid rows, first records, one row a URL, domains in turn, industry labels.

    The dimensions are ``lookup`` results; without them no label is looked up. ``turn`` and ``domain`` order the rows.
    """
    rows = first_records(companies(df, order))
    code = lambda k: lenient_int(F.coalesce(*(F.col("metadata")[x] for x in (k, k.upper(), k.title())))).alias(k)
    rows = rows.select("*", code("industry"), code("nace"), F.lit(None).cast("string").alias("industry_label"))
    rows = merge_by_url(rows) if merge else rows
    rows = interleave(rows) if turns else rows
    if pairs is None or naces is None or industries is None:
        return rows
    return enrich_industry(rows.drop("industry_label"), pairs, naces, industries)


def from_files(rows: DataFrame) -> DataFrame:
    """Rows of ``read_folder`` with ``ord``, by file and then by place in it, in place of ``source_path``."""
    return rows.select(F.struct("source_path", F.monotonically_increasing_id().alias("at")).alias("ord"), *(f"`{c}`" for c in rows.columns if c != "source_path"))
