"""Whether a page's Markdown is worth keeping, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from .language import NOTHING
from .text import markdown_word_count

# Fixed values.
COOKIE = (
    r"(?iU)\b(cookie\s?(notice|policy|preferences|settings|consent|choices?)|we\suse\s(cookies|tracking)|accept\s(all|cookies?)|agree\s(to\s(cookies|terms))|your\sprivacy\s(choice|preferences?)"
    r"|do\snot\ssell\smy\s(personal\s)?data|gdpr|ccpa|cmp|one(trust)?|quantcast|trustarc|cookiebot|didomi|cookieyes|iubenda)\b"
)
LEGAL = (
    r"(?iU)\b(terms(\s+and\s+conditions)?|terms\s+of\s+(use|service)|user(\s+generated)?\s+content|ugc|privacy\s+policy|license|licensed|sub-?licens(e|able)|royalty[-\s]?free|perpetual|irrevoc(able|ably)"
    r"|indemnif(y|ication)|warrant(y|ies?)|governed\s+by|jurisdiction|publicity\s+and\s+privacy|right\s+to\s+use|grant\s+(us|you)\s+the\s+right)\b"
)
AGE = r"(?iU)\b(age\s+(gate|verification|check)|are\syou\s(over|older\s+than)\s+(18|19|21)|enter\syour\s(date\s+of\s+birth|dob)|i\s(am|confirm)\s(over|older)|you\smust\sbe\s(at\s+least)?\s*(18|19|21))\b"
LOGIN = r"(?iU)\b(sign\s?in|log\s?in|account\s+required|please\s+sign\s+in|members?\sonly|subscription\s+required|subscribe\s+to\s+continue|paywall|premium\s+content)\b"


#: Kind, reason, pattern, least hits and least share of words of each kind of page that is not worth keeping, and words of which every match has one.
DOMINANT = (
    ("cookie", "cookie-dominant", COOKIE, 4, 0.02, ("tracking", "accept", "agree", "privacy", "sell", "gdpr", "ccpa", "cmp", "one", "onetrust", "quantcast", "trustarc", "didomi", "iubenda")),
    ("legal", "legal-dominant", LEGAL, 12, 0.015, ("terms", "content", "ugc", "privacy", "license", "licensed", "licensable", "sublicense", "sublicensable", "royalty", "royaltyfree", "perpetual", "irrevocable", "irrevocably",
        "indemnify", "indemnification", "warranty", "warrantie", "warranties", "governed", "jurisdiction", "publicity", "right")),
    ("age", "age-dominant", AGE, 2, 0.003, ("age", "over", "older", "enter", "must")),
    ("login", "login-required", LOGIN, 3, 0.004, ("sign", "signin", "log", "login", "account", "member", "members", "subscription", "subscribe", "paywall", "premium")),
)
#: A word that begins so is one of the first kind.
COOKIE_START = "cookie"
#: Codes of kinds in statistics. The kind ``unknown`` is counted but suppresses nothing.
KIND_CODES = {"none": 0, "cookie": 1, "legal": 2, "age": 3, "login": 4}
LEAST_TOTAL = 80
HEADING, BULLET = r"(?m)^\s*#{1,6}\s+\S", r"(?m)^\s*[-*+]\s+\S"


STATS = ("total_words", *(f"{k}_{x}" for k in ("cookie", "legal", "age", "login", "unknown") for x in ("hits", "share")), "interstitial_kind")


def _counted(low: Column) -> Column:
    """Struct (low, words, marked) of a lower-case text: how many words it has, and those that can belong to a match. ASCII is read by the simpler classes."""
    cut = F.when(F.octet_length(low) == F.char_length(low), F.split(low, r"\W+")).otherwise(F.split(low, r"(?U)\W+"))
    every = sorted({m for *_, marks in DOMINANT for m in marks})
    blank = lambda w: (w == "").cast("int")
    counted = lambda c: F.size(c) - blank(c[0]) - F.when(F.size(c) > 1, blank(F.element_at(c, -1))).otherwise(0)
    return let(cut, lambda c: F.struct(low.alias("low"), counted(c).alias("words"), F.filter(c, lambda w: w.isin(*every) | w.startswith(COOKIE_START)).alias("marked")))


def _folded(t: Column) -> Column:
    """Lower case; letters whose other case is an ASCII letter count as that, so patterns need not try both cases."""
    odd = F.contains(t, F.lit("İ")) | F.contains(t, F.lit("ſ")) | F.contains(t, F.lit("ı"))
    return F.when(odd, F.translate(F.lower(F.translate(t, "İ", "i")), "ſı", "si")).otherwise(F.lower(t))


def _marks(words: Column, marks: tuple[str, ...], cookie: bool) -> Column:
    """How many words are such that a match can have them: at least as many as there are matches."""
    return F.size(F.filter(words, lambda w: w.isin(*marks) | w.startswith(COOKIE_START) if cookie else w.isin(*marks)))


def _trimmed(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))


def _shape_reason(t: Column, words: Column, least: int, structure: bool) -> Column:
    """Why a text is too short to be judged further; null if it is not."""
    short = F.when(~(t.rlike(HEADING) | t.rlike(BULLET)), "no-structure").otherwise("too-short") if structure else F.lit("too-short")
    return F.when(words < least, short)


def gate(text: Column, min_words: int = 30, cookie_cap: float = 0.02, structure: bool = True) -> Column:
    """Struct (action, reason): save/ok, or suppress with why.

    A kind's pattern is tried only where enough words can belong to a match, as most texts have too few.
    """
    least = max(5, min_words)

    def dominant(t: Column) -> Column:
        def tried(x: Column) -> Column:
            total, out = x["words"], F.lit("ok")
            for kind, reason, pattern, hits, share, marks in reversed(DOMINANT):
                share = min(share, max(0.001, cookie_cap)) if kind == "cookie" else share
                enough = lambda n, hits=hits, share=share: (n >= hits) & (n / F.greatest(total, F.lit(1)) >= share)
                n = F.regexp_count(x["low"], F.lit(pattern.replace("(?iU)", "(?U)")))
                out = F.when(F.when(let(_marks(x["marked"], marks, kind == "cookie"), enough), let(n, enough)).otherwise(False), reason).otherwise(out)
            return F.when(total >= LEAST_TOTAL, out).otherwise("ok")

        return let(let(_folded(t), _counted), tried)

    def reason(t: Column) -> Column:
        judged = let(markdown_word_count(t), lambda words: F.coalesce(_shape_reason(t, words, least, structure), dominant(t)))
        return F.when(t == "", "empty").otherwise(judged)

    return let(let(_trimmed(text), reason), lambda r: F.struct(F.when(r == "ok", "save").otherwise("suppress").alias("action"), r.alias("reason")))


def gate_statistics(text: Column, interstitial: str = NOTHING, min_words: int = 30, cookie_cap: float = 0.02, structure: bool = True) -> Column:
    """Struct (action, reason, stats): ``gate`` with counts of what it rests on, as map of double.

    ``total_words`` is all that an empty, short or shapeless text has; from 80 words on each kind has ``_hits`` and ``_share``, and so has ``unknown``, the
    language-derived pattern ``interstitial`` (``language.interstitial_pattern``), up to the first kind that dominates. ``interstitial_kind`` is its code, 0 for none. Unknown hits suppress nothing.
    """
    least = max(5, min_words)
    number = lambda c: c.cast("double")

    def read(t: Column) -> Column:
        def counted(x: Column) -> Column:
            total = F.greatest(x["words"], F.lit(1))
            count = lambda pattern: F.regexp_count(x["low"], F.lit(pattern.replace("(?iU)", "(?U)")))
            known = [F.when(_marks(x["marked"], marks, kind == "cookie") > 0, count(pattern)).otherwise(0).alias(kind) for kind, _, pattern, _, _, marks in DOMINANT]
            return F.struct(x["words"].alias("words"), total.alias("total"), *known, F.regexp_count(t, F.lit(f"(?iU){interstitial}")).alias("unknown"))

        def told(n: Column) -> Column:
            why, code = F.lit("ok"), F.lit(0)
            for kind, reason, _, hits, share, _ in reversed(DOMINANT):
                share = min(share, max(0.001, cookie_cap)) if kind == "cookie" else share
                holds = (n["words"] >= LEAST_TOTAL) & (n[kind] >= hits) & (n[kind] / n["total"] >= share)
                why, code = F.when(holds, reason).otherwise(why), F.when(holds, KIND_CODES[kind]).otherwise(code)
            entries = [F.lit("total_words"), number(n["words"]), F.lit("interstitial_kind"), number(code)]
            kinds = [x for k in ("cookie", "legal", "age", "login") for x in (F.lit(f"{k}_hits"), number(n[k]), F.lit(f"{k}_share"), n[k] / n["total"])]
            unknown = [F.lit("unknown_hits"), number(n["unknown"]), F.lit("unknown_share"), n["unknown"] / n["total"]]
            stats = F.when(n["words"] < LEAST_TOTAL, F.create_map(*entries)).when(code > 0, F.create_map(*entries, *kinds)).otherwise(F.create_map(*entries, *kinds, *unknown))
            return F.struct(F.when(why == "ok", "save").otherwise("suppress").alias("action"), why.alias("reason"), stats.alias("stats"))

        def judged(words: Column) -> Column:
            early = lambda why: F.struct(F.lit("suppress").alias("action"), why.alias("reason"), F.create_map(F.lit("total_words"), number(words)).alias("stats"))
            full = let(let(let(_folded(t), _counted), counted), told)
            return let(_shape_reason(t, words, least, structure), lambda why: F.when(t == "", early(F.lit("empty"))).when(why.isNotNull(), early(why)).otherwise(full))

        return let(markdown_word_count(t), judged)

    return let(_trimmed(text), read)
