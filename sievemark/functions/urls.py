"""URL functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes of two labels under which names are registered.
INGEST_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "com.cn", "com.sg", "com.br")
ANALYSIS_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "co.kr", "com.br", "com.cn", "com.tw")
TRACKING = ("gclid", "fbclid", "igshid", "mc_cid", "mc_eid", "msclkid", "smid", "oly_anon_id", "oly_enc_id", "vero_conv", "vero_id", "ref", "referrer", "utm_id")
TRACKING_PREFIXES = ("utm_", "mtm_", "pk_")

_URL = r"^([a-z][a-z0-9+.\-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^?#]*)(?:\?([^#]*))?"


def with_scheme(url: Column, default: str = "https") -> Column:
    u = F.trim(url)
    return F.when(u.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*://"), u).otherwise(F.concat(F.lit(f"{default}://"), F.regexp_replace(u, r"^/+", "")))


def _part(url: Column, k: int) -> Column:
    return F.regexp_extract(url, "(?i)" + _URL, k)


def host(url: Column, collapse_www: bool = True) -> Column:
    """Lower-case host without outer dots and, if asked, a leading ``www.``."""
    h = F.regexp_replace(F.lower(_part(with_scheme(url), 2)), r"^\.+|\.+$", "")
    return F.regexp_replace(h, r"^www\.(?=.)", "") if collapse_www else h


def kept_query(query: Column) -> Column:
    """The query without tracking parameters; parameters without ``=`` get one, empty pieces go."""
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    name = lambda p: F.lower(F.split(p, "=")[0])
    drop = lambda p: name(p).isin(*TRACKING) | name(p).rlike("^(" + "|".join(TRACKING_PREFIXES) + ")")
    return F.array_join(F.transform(F.filter(pairs, lambda p: ~drop(p)), lambda p: F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("=")))), "&")


def canonical_url(url: Column) -> Column:
    """One spelling of a URL: scheme, host without ``www.``, no default port, no home page name, no slash at the end, no tracking.

    Empty for an empty or host-less URL, null for a null one and for a port out of range. Non-ASCII hosts and percent-escapes stay as they are.
    """
    u = with_scheme(url)
    scheme, h, port, path = F.lower(_part(u, 1)), host(url), _part(u, 3), F.trim(_part(u, 4))
    number = port.try_cast("int")
    netloc = F.when((port == "") | ((scheme == "http") & (number == 80)) | ((scheme == "https") & (number == 443)), h).otherwise(F.concat(h, F.lit(":"), number.cast("string")))
    home = F.lower(path).isin("", "/", "/index.html", "/index.htm", "/home", "/home/")
    shown = F.when(home, "/").otherwise(F.regexp_replace(path, r"(?<=.)/$", ""))
    query = kept_query(_part(u, 5))
    whole = F.concat(scheme, F.lit("://"), netloc, shown, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when((F.trim(url) == "") | (h == ""), "").when((port != "") & (number.isNull() | (number > 65535)), F.lit(None).cast("string")).otherwise(whole)


def registrable(h: Column, suffixes: tuple[str, ...] = INGEST_SUFFIXES) -> Column:
    """The last two labels of a host, or three under a suffix of two labels."""
    clean = F.regexp_replace(F.lower(h), r"^\.+|\.+$", "")
    labels = F.split(clean, r"\.")
    n = F.size(labels)
    last = lambda k: F.array_join(F.slice(labels, -k, k), ".")
    return F.when(n < 2, clean).when((n >= 3) & last(2).isin(*suffixes), last(3)).otherwise(last(2))


def site_key(url: Column) -> Column:
    """Registrable domain for analysis, or why there is none."""
    scheme = F.lower(F.regexp_extract(F.trim(url), r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    h = F.regexp_replace(F.lower(_part(F.trim(url), 2)), r"^\.+|\.+$", "")
    return F.when(url.isNull() | ~scheme.isin("http", "https"), "(non-http)").when(h == "", "(no-host)").otherwise(registrable(h, ANALYSIS_SUFFIXES))


def comparable_site(url: Column) -> Column:
    """``site_key`` for comparing two URLs: empty where there is none."""
    k = site_key(url)
    return F.when(k.startswith("("), "").otherwise(k)


def fast_host(url: Column) -> Column:
    """Host of ``//h``, ``h/p``, ``h:port`` or a full URL, in lower case."""
    return F.lower(F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)", 1))


def has_suffix(h: Column, suffix: str) -> Column:
    """The host is the suffix or ends in it at a label's start."""
    return (h == suffix) | h.endswith("." + suffix)


def is_government(h: Column) -> Column:
    """A government name: ``gov`` or ``mil`` last, or a government label before a country code."""
    return h.rlike(r"(^|\.)(gov|mil)$") | h.rlike(r"(^|\.)(gov|gouv|go|govt)\.[a-z]{2}$")


def path_segments(url: Column) -> Column:
    return F.filter(F.split(_part(with_scheme(url), 4), "/"), lambda x: x != "")


def safe_id(c: Column) -> Column:
    """An id as a file name: reserved characters and white space become ``_``, runs collapse, at most 100 characters."""
    s = F.regexp_replace(F.trim(c), r'[<>:"/\\|?*\x00-\x1F\s]+', "_")
    return F.substring(F.regexp_replace(F.regexp_replace(s, "_+", "_"), r"^[._ ]+|[._ ]+$", ""), 1, 100)


def artifact_name(url: Column) -> Column:
    """Host and path as a slug, and eight hex digits of the URL's SHA-1."""
    slug = F.regexp_replace(F.regexp_replace(F.concat(fast_host(url), _part(with_scheme(url), 4)), r"[^A-Za-z0-9]+", "-"), r"^-+|-+$", "")
    return F.concat(F.substring(slug, 1, 80), F.lit("-"), F.substring(F.sha1(url.cast("binary")), 1, 8))
