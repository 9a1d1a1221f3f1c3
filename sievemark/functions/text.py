"""Text functions as column expressions. ``(?U)`` gives word characters their Unicode meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

MARK = "\u0001"


def clean_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def norm_name(c: Column) -> Column:
    """Lower case, single spaces, no punctuation at the end."""
    return F.regexp_replace(F.lower(clean_ws(c)), r"[\s.,;:!?\-–—]+$", "")


def norm_type(c: Column) -> Column:
    t = F.lower(clean_ws(c))
    return F.when(t.isin("product", "products"), "product").when(t.isin("service", "services"), "service").otherwise("unknown")


# What is taken out of Markdown, in this order, and what comes in its place.
MARKDOWN = (
    (r"(?s)```.*?```", " "), (r"!\[[^\]]*\]\([^)]+\)", " "), (r"\[([^\]]+)\]\([^)]+\)", "$1"), (r"`([^`]+)`", "$1"), (r"(?m)^\s{0,3}#+\s+", ""), (r"(?m)^\s{0,3}[-*+]\s+", ""), (r"(?m)^\s{0,3}\d+\.\s+", ""), (r"<[^>]+>", " "),
    (r"[ \t]+", " "), (r"\n{3,}", "\n\n"),
)


def markdown_text(c: Column) -> Column:
    """Plain text of Markdown: no fences, images, link targets, code marks, tags, or marks of headings, bullets and numbers at up to three spaces."""
    t = c
    for pattern, to in MARKDOWN:
        t = F.regexp_replace(t, pattern, to)
    return F.btrim(t, F.lit(" \t\n\x0b\x0c\r"))


def sentences(c: Column) -> Column:
    """Sentences: blank lines part blocks, and blocks part after ``.!?`` before a capital, digit or quote."""
    t = F.regexp_replace(c, r"\r\n?", "\n")
    blocks = F.split(t, r"\n\s*\n")
    cut = F.flatten(F.transform(blocks, lambda b: F.split(F.trim(F.regexp_replace(b, r"\s+", " ")), r"(?<=[.!?])\s+(?=[A-Z0-9\"'])")))
    return F.filter(F.transform(cut, lambda s: F.trim(s)), lambda s: s != "")


def token_count(c: Column) -> Column:
    """Words and single marks."""
    return F.coalesce(F.regexp_count(c, F.lit(r"(?U)\w+|[^\w\s]")), F.lit(0))


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(r"(?U)\w+")), F.lit(0))


def markdown_word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(r"[A-Za-z0-9’']+")), F.lit(0))


def ascii_words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"[a-z0-9]+"), F.lit(0))


# Fixed values.
COOKIE_MARKERS = ("consent", "preferences", "privacy", "policy", "settings", "accept", "decline", "analytics", "tracking", "gdpr")


def cookie_boilerplate(c: Column) -> Column:
    words = ascii_words(c)
    return F.arrays_overlap(words, F.array(F.lit("cookie"), F.lit("cookies"))) & F.arrays_overlap(words, F.array(*map(F.lit, COOKIE_MARKERS)))


def bm25_tokens(c: Column, stopwords: tuple[str, ...] = ()) -> Column:
    """Runs of ASCII letters and digits, hiragana, katakana or kanji, in lower case, without stop words."""
    found = F.regexp_extract_all(F.lower(c), F.lit(r"[a-z0-9]+|[぀-ゟ]+|[゠-ヿ]+|[一-鿿]+"), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(*stopwords)) if stopwords else found


def chunks(c: Column, threshold: int = 2200, overlap: float = 0.10) -> Column:
    """Chunks of ``max(80, 0.75 * threshold)`` words, each sharing a part of at most a half with the one before."""
    size = max(80, int(threshold * 0.75))
    step = max(1, size - int(size * min(max(overlap, 0.0), 0.5)))
    words = F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != "")
    n = F.size(words)
    starts = F.sequence(F.lit(0), F.greatest(F.ceil((n - size) / step), F.lit(0)).cast("int"))
    return F.when(n <= 0, F.array().cast("array<string>")).otherwise(F.transform(starts, lambda k: F.array_join(F.slice(words, k * step + 1, size), " ")))


def text_list(c: Column, most: int = 10) -> Column:
    """A list written with ``|``, else ``;``, else ``,``: trimmed, without repeats in either case, cut at ``most``."""
    sep = F.when(F.contains(c, F.lit("|")), r"\|").when(F.contains(c, F.lit(";")), ";").otherwise(",")
    items = F.filter(F.transform(F.split(c, sep), lambda x: F.trim(x)), lambda x: x != "")
    lower = F.transform(items, lambda x: F.lower(x))
    return F.slice(F.transform(F.filter(F.transform(items, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: F.array_position(lower, F.lower(s["x"])) == s["i"] + 1), lambda s: s["x"]), 1, most)


def has_evidence(body: Column, name: Column, description: Column) -> Column:
    """The body has the name, two of its first eight longer words, the description's start, or three of its longer words."""
    low = F.lower(body)
    tokens = lambda c: F.array_distinct(F.filter(ascii_words(c), lambda t: F.length(t) >= 3))
    count = lambda c: F.size(F.filter(F.slice(tokens(c), 1, 8), lambda t: F.contains(low, t)))
    phrase = F.lower(F.substring(clean_ws(description), 1, 60))
    return ((F.trim(name) != "") & F.contains(low, F.lower(F.trim(name)))) | (count(name) >= 2) | ((F.length(phrase) >= 12) & F.contains(low, phrase)) | (count(description) >= 3)


def descriptiveness(c: Column) -> Column:
    """Sort key of a name: length up to 80, words, and capitals and digits."""
    return F.struct(F.least(F.length(c), F.lit(80)).alias("length"), F.size(ascii_words(c)).alias("words"), (c.rlike("[A-Z]").cast("int") + c.rlike("[0-9]").cast("int")).alias("shapes"))


def truncate(c: Column, most: int) -> Column:
    t = F.trim(c)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(F.rtrim(F.substring(t, 1, most - 1)), F.lit("…")))


def main_content(c: Column) -> Column:
    """From the first line that starts a top heading; the whole text if none does."""
    cut = F.regexp_extract(c, r"(?ms)^(# .*)\z", 1)
    return F.when(cut != "", cut).otherwise(c)


def alias_pattern(alias: Column) -> Column:
    """Regular expression for an alias: its words with any other characters between, at word borders, in either case."""
    return F.concat(F.lit(r"(?i)(?<![a-z0-9])"), F.array_join(ascii_words(alias), "[^a-z0-9]+"), F.lit(r"(?![a-z0-9])"))


def profile_sentences(c: Column) -> Column:
    """Sentences of a profile: bullets and marks of lists part chunks, which part after ``.!?``; of two that differ in case alone the first stays."""
    chunks_of = F.split(clean_ws(c), r"(?:\n|\r|•|\*|- )+")
    cut = F.flatten(F.transform(chunks_of, lambda x: F.split(F.trim(x), r"(?<=[.!?])\s+")))
    kept = F.filter(F.transform(cut, lambda s: F.trim(s)), lambda s: s != "")

    def first(items: Column) -> Column:
        return let(F.transform(items, lambda s: F.lower(s)), lambda low: F.transform(F.array_distinct(low), lambda s: F.element_at(items, F.array_position(low, s).cast("int"))))

    return let(kept, first)


def id_list(c: Column) -> Column:
    """The distinct ids of an array of texts, in order, without blanks."""
    return F.array_distinct(F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: F.coalesce(x, F.lit("")) != ""))
