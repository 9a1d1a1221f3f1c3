"""URL filters: each is a reason column, null where the URL passes; a chain takes the first reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import fast_host, has_suffix, is_government, path_segments, registrable

#: File endings that hold no page.
REJECTED = ("jpg", "jpeg", "png", "gif", "svg", "webp", "ico", "bmp", "css", "js", "json", "xml", "rss", "pdf", "zip", "gz", "tar", "rar", "7z", "exe", "dmg", "apk", "mp3", "mp4", "avi", "mov", "webm", "wav", "woff", "woff2", "ttf", "doc", "docx", "xls", "xlsx", "ppt", "pptx", "csv")
#: A short default; a deployment passes its own list.
UNIVERSAL = ("google.com", "facebook.com", "twitter.com", "x.com", "linkedin.com", "youtube.com", "instagram.com", "github.com", "wikipedia.org", "amazon.com", "apple.com", "microsoft.com", "stripe.com", "paypal.com", "w3.org")
# Fixed values.
FUNCTIONAL = ("community", "status", "learning", "learn", "docs", "developer", "developers", "help", "support", "kb", "academy", "login", "signin", "auth", "accounts", "news", "press", "media")
INFRASTRUCTURE = ("cdn", "analytics", "telemetry", "metrics", "tracking", "tracker", "tagmanager", "tagsrv", "pixel", "adsrv", "adservice", "statcounter", "stats.", "trk.", ".trk", "redirect", "logx", "logs.", "click", "short", "lnk")


def html_reason(url: Column, endings: Sequence[str] = REJECTED) -> Column:
    scheme = F.lower(F.regexp_extract(F.trim(url), r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    end = F.lower(F.regexp_extract(F.element_at(path_segments(url), -1), r"\.([A-Za-z0-9]+)$", 1))
    return F.when(~scheme.isin("", "http", "https"), "scheme").when((F.size(path_segments(url)) > 0) & end.isin(*endings), "extension")


def host_class(h: Column, company: Column, in_dataset: Column, universal: Sequence[str] = UNIVERSAL) -> Column:
    """company, dataset, universal or other. ``company``: a registrable domain; ``in_dataset``: whether the host's domain is another company's."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(h), r"^\.+|\.+$", ""), r"^www\.(?=.)", "")
    domain = registrable(bare)
    infra = F.lit(False)
    for word in INFRASTRUCTURE:
        infra = infra | F.contains(bare, F.lit(word))
    functional = (F.size(F.split(bare, r"\.")) >= 3) & F.split(bare, r"\.")[0].isin(*FUNCTIONAL)
    return (
        F.when(bare == "", "other")
        .when((domain != "") & (domain == company), "company")
        .when(F.coalesce(in_dataset, F.lit(False)), "dataset")
        .when(is_government(bare) | domain.isin(*universal) | functional | infra, "universal")
        .otherwise("other")
    )


def language_reason(url: Column, languages: Sequence[str], allowed: Sequence[str] = ("en",), blocked_hosts: Sequence[str] = (), allowed_hosts: Sequence[str] = (), blocked_tlds: Sequence[str] = (), allowed_tlds: Sequence[str] = ()) -> Column:
    """Host suffixes, then the last label, then the first path segment that is a language; an empty or host-less URL has the reason ``invalid``."""
    h = fast_host(url)
    tld = F.element_at(F.split(h, r"\."), -1)
    named = F.filter(F.transform(path_segments(url), lambda s: F.lower(s)), lambda s: s.isin(*languages))
    listed = lambda names: F.exists(F.array(*map(F.lit, names)), lambda s: (h == s) | F.endswith(h, F.concat(F.lit("."), s))) if names else F.lit(False)
    out = F.when((F.trim(url) == "") | (h == ""), "invalid").when(listed(blocked_hosts), "host")
    if allowed_hosts:
        out = out.when(~listed(allowed_hosts), "host")
    out = out.when(tld.isin(*blocked_tlds) if blocked_tlds else F.lit(False), "tld")
    if allowed_tlds:
        out = out.when(~tld.isin(*allowed_tlds), "tld")
    return out.when((F.size(named) > 0) & ~F.element_at(F.concat(named, F.array(F.lit(""))), 1).isin(*allowed), "language")


def first_seen(df: DataFrame, url: str, order: str) -> DataFrame:
    """``df`` with ``first``: whether the row is the first with its exact URL."""
    return df.withColumn("first", F.row_number().over(Window.partitionBy(url).orderBy(order)) == 1)


def filter_chain(df: DataFrame, url: str, order: str, company_domain: Column, languages: Sequence[str], allowed: Sequence[str] = ("en",), dataset: DataFrame | None = None) -> DataFrame:
    """``df`` with ``reject_reason``: of the page filter, repeats, outer hosts and language, the first that rejects; null passes.

    dataset: the column ``domain`` with other companies' domains.
    """
    rows = first_seen(df, url, order).withColumn("_domain", registrable(F.regexp_replace(fast_host(F.col(url)), r"^www\.(?=.)", "")))
    if dataset is not None:
        known = dataset.select(F.col("domain").alias("_d")).distinct()
        rows = rows.join(known, F.col("_domain") == F.col("_d"), "left")
        inside = F.col("_d").isNotNull()
    else:
        rows, inside = rows.withColumn("_d", F.lit(None).cast("string")), F.lit(False)
    kind = host_class(fast_host(F.col(url)), company_domain, inside)
    reason = F.coalesce(html_reason(F.col(url)), F.when(~F.col("first"), "seen"), F.when(~kind.isin("company", "other"), kind), language_reason(F.col(url), languages, allowed))
    return rows.select(*df.columns, reason.alias("reject_reason"))


def denied(c: Column, parts: Sequence[str]) -> Column:
    """The text has one of the parts, in either case."""
    return F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains(F.lower(c), F.lower(p))) if parts else F.lit(False)


def suffix_listed(h: Column, suffixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for s in suffixes:
        out = out | has_suffix(h, s)
    return out
