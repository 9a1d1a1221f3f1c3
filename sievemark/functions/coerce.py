"""Typed values from loosely typed text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
STATUSES = ("pending", "markdown_not_done", "markdown_done", "llm_not_done", "llm_done", "terminal_done")
#: Order of progress when a status is derived from an index.
DERIVE_RANK = {"pending": 0, "markdown_not_done": 1, "terminal_done": 2, "markdown_done": 2, "llm_not_done": 3, "llm_done": 4}
#: Order of progress when two run roots are merged.
MERGE_RANK = {"pending": 0, "markdown_not_done": 1, "markdown_done": 2, "llm_not_done": 3, "llm_done": 4, "terminal_done": 5}
NULL_WORDS = ("nan", "na", "n/a", "none", "null", "")


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first candidate that names a column, ignoring case and outer spaces."""
    known = {c.strip().lower(): c for c in reversed(df.columns)}
    return next((known[c] for c in candidates if c in known), None)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def lenient_int(c: Column) -> Column:
    """Whole number of a numeral, truncated; anything else is null."""
    s = F.trim(c.cast("string"))
    ok = s.rlike(r"^-?\d+(\.\d+)?$") & ~F.lower(s).isin(*NULL_WORDS)
    return F.when(ok, s.try_cast("double").cast("int"))


def strict_int(c: Column) -> Column:
    """As ``lenient_int``, but a value that is neither a number nor a null sentinel raises."""
    s = F.trim(c.cast("string"))
    return F.when(s.isNull() | s.isin("__NA__", "nan", "NaN", "NAN", ""), F.lit(None).cast("int")).otherwise(s.cast("double").cast("int"))


def lenient_float(c: Column) -> Column:
    d = F.trim(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(d), d)


def flag(c: Column) -> Column:
    """True for 1, true, yes, y and t in either case."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("1", "true", "yes", "y", "t"), F.lit(False))


def truthy(c: Column) -> Column:
    """True for any text but 0, false, no, none, null, n/a and the empty one: looser than ``flag``."""
    s = F.lower(F.trim(c.cast("string")))
    return F.coalesce(~s.isin("0", "false", "no", "none", "null", "n/a", ""), F.lit(False))


def status(c: Column) -> Column:
    """A known status; anything else is pending."""
    s = F.lower(F.trim(c))
    return F.when(s.isin(*STATUSES), s).otherwise("pending")


def rank(c: Column, table: dict[str, int]) -> Column:
    out = F.lit(0)
    for name, value in table.items():
        out = F.when(c == name, value).otherwise(out)
    return out


def epoch_seconds(c: Column) -> Column:
    """Seconds since 1970 of a number or an ISO time (UTC where it names no zone); 0 for anything else."""
    s = F.trim(c.cast("string"))
    return F.coalesce(s.try_cast("double"), F.unix_micros(F.try_to_timestamp(s)) / 1e6, F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.when(whole > 0, F.round(part * 100.0 / whole, digits)).otherwise(0.0)
