"""Word lists by language, as rows of a table: lang, key, pos, term. The lists themselves are data that the user brings.

A language adds to English, so the lists in force are those of English and of the target, in this order.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = "en"
NOTHING = r"(?!x)x"


def effective(target: str, known: Iterable[str]) -> tuple[str, ...]:
    """English and the target; an unknown target raises."""
    code = target.strip().lower() or BASE
    if code not in {BASE, *known}:
        raise ValueError(f"no language {target!r}")
    return (BASE,) if code == BASE else (BASE, code)


def terms(specs: DataFrame, langs: Sequence[str]) -> DataFrame:
    """key, pos, term: lists of the languages one after the other, trimmed and in lower case, each term at its first place."""
    turn = F.array_position(F.array(*map(F.lit, langs)), F.col("lang"))
    rows = specs.where(F.col("lang").isin(*langs)).select("key", turn.alias("turn"), "pos", F.lower(F.trim("term")).alias("term")).where("term <> ''")
    return rows.groupBy("key", "term").agg(F.min(F.struct("turn", "pos")).alias("at")).select("key", F.col("at.turn").alias("turn"), F.col("at.pos").alias("pos"), "term")


def host_terms(specs: DataFrame, langs: Sequence[str]) -> DataFrame:
    """key, term of lists of host endings, without dots at the start."""
    return specs.where(F.col("lang").isin(*langs)).select("key", F.regexp_replace(F.lower(F.trim("term")), r"^\.+", "").alias("term")).where("term <> ''").distinct()


def any_of(patterns: Iterable[str]) -> str:
    """One pattern that fits where one of ``patterns`` does; none fits nowhere."""
    kept = [p for p in patterns if p.strip()]
    for p in kept:
        re.compile(p)
    return "|".join(f"(?:{p})" for p in kept) or NOTHING


def interstitial_pattern(specs: DataFrame, langs: Sequence[str], key: str = "INTERSTITIAL_PATTERNS") -> str:
    """The patterns of ``key`` of the languages in force as one, worked out when it is called, as the languages can change; tens of rows at most.

    specs: lang, key, pos, term. Patterns keep their case; one that does not compile raises.
    """
    order = F.array_position(F.array(*map(F.lit, langs)), F.col("lang"))
    rows = specs.where((F.col("key") == key) & F.col("lang").isin(*langs)).orderBy(order, "pos").select("term")
    return any_of(r.term.strip() for r in rows.collect() if r.term)
