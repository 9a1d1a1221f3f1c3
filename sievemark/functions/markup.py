"""HTML as text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

# Fixed values.
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
META = r"(?is)<meta\s+[^>]*>"
NAME = r"""(?is)\bname\s*=\s*["']([^"']+)["']"""
CONTENT = r"""(?is)\bcontent\s*=\s*["']([^"']*)["']"""


def _clean(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def head_document(html: Column) -> Column:
    """What a page says of itself: its title three times, its description twice, its keywords, then all meta contents.

    Of a name that is given twice the last content counts, in the place of the first.
    """

    def made(tags: Column) -> Column:
        pairs = F.transform(tags, lambda x: F.struct(F.lower(F.trim(F.regexp_extract(x, NAME, 1))).alias("k"), _clean(F.regexp_extract(x, CONTENT, 1)).alias("v")))

        def joined(kept: Column) -> Column:
            last = lambda k: F.element_at(F.filter(kept, lambda x: x["k"] == k), -1)["v"]
            names = F.array_distinct(F.transform(kept, lambda x: x["k"]))
            of = lambda name: F.when(F.array_contains(names, F.lit(name)), last(F.lit(name)))
            title = F.nullif(_clean(F.regexp_extract(html, TITLE, 1)), F.lit(""))
            twice = F.repeat(F.concat(of("description"), F.lit(" ")), F.lit(2))
            every = F.nullif(F.array_join(F.transform(names, last), " "), F.lit(""))
            return F.trim(F.concat_ws(" ", F.repeat(F.concat(title, F.lit(" ")), F.lit(3)), twice, of("keywords"), every))

        return let(F.filter(pairs, lambda x: (x["k"] != "") & (x["v"] != "")), joined)

    return let(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(META), F.lit(0)), made)
