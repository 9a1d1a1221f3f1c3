"""Secrets in texts, as code point spans. DataFrame functions alone, row by row, without a shuffle.

Three fixed patterns give the base spans. The entropy detector adds strings that no pattern names: over each candidate
string of one character class slides a window whose character counts change by the character that comes in and the
one that goes out, and with them the sum of c log2 c, so a step's entropy needs no recount. The counts are
fields of five bits, twelve to a long, so a step changes two fields. Known harmless strings are suppressed by an allow-list.

Spark finds no match positions, but ``split`` and ``regexp_extract_all`` over one pattern give the pieces between matches and the
matches, whose running sum of lengths has the positions. The sum goes by blocks, and what a base span covers is masked in place
before candidates are looked for, so the cost is near to linear in a text's length and in its matches.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, need, packed

#: kind: (pattern, group whose length counts, least length), in the order of kinds.
PATTERNS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    # a longer least run finds the same maximal runs as one character and a check of the length
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
KINDS = [*PATTERNS, "entropy"]
#: What a span covers becomes this private-use character; one that a text has itself is read as U+0001, which no pattern knows.
MASK = "\uf8ff"
#: A whole run of the alphabet that touches no mask.
CANDIDATE = rf"(?<![A-Za-z0-9+/_={MASK}-])[A-Za-z0-9+/_=-]{{20,}}+(?!{MASK})"
#: class: (all characters are of, least bits in a window). A window of 20 characters has log2(20) = 4.32 bits at most.
#: Letters alone are words as a rule, in which 20 characters in a row seldom reach 4 bits. Digits alone have no class: 16 in a
#: row are a base span, of kind hex, whatever their entropy.
CLASSES = {
    "hex": (r"^[0-9A-Fa-f]+\z", 3.0),
    "letters": (r"^[A-Za-z+/_=-]+\z", 4.05),
    "lower": (r"^[a-z0-9_-]+\z", 3.7),
    "mixed": (r"^[A-Za-z0-9+/_=-]+\z", 3.9),
}
#: Harmless candidates: UUIDs, placeholders, dates and times, the alphabet, paths and chains of words. Each is one pass without backtracking.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\z",
    r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|test[_-]|lorem",
    r"^\d{4}-?\d{2}-?\d{2}(?!\d{13})",
    r"(?i)abcdefghij",
    r"^[A-Za-z/][A-Za-z]*+[/_-][A-Za-z/_-]*+\d{0,4}/?\z",
)
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
WINDOW = 20
BLOCK = 256
_BITS, _PER_LONG = 5, 12


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, and not again at each use inside another function."""
    return F.transform(F.array(value), body)[0]


def _starts(lengths: Column) -> Column:
    """Sum of the lengths before each place: within blocks, then over the blocks' sums."""

    def running(values: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(values, zero, lambda a, x: F.struct((a["at"] + x).alias("at"), F.array_append(a["out"], a["at"]).alias("out")))

    cut = lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int")), lambda b: running(F.slice(x, b * BLOCK + 1, BLOCK)))
    return _let(_let(lengths, cut), lambda blocks: F.flatten(F.zip_with(blocks, running(F.transform(blocks, lambda b: b["at"]))["out"], lambda b, at: F.transform(b["out"], lambda x: x + at))))


def _at(text: Column, pattern: str, group: int) -> Column:
    """Array of (part, found, value): the pieces and the leftmost non-overlapping matches by turns; ``value`` is the group's text. Null without a match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    steps = F.arrays_zip(F.split(text, pattern, -1).alias("part"), found.alias("found"), value.alias("value"))
    return F.when(text.rlike(pattern), steps)


def _spans(steps: Column, kind: str, least: int) -> Column:
    """Spans of a kind whose value is long enough."""
    starts = _starts(F.transform(steps, lambda x: F.length(x["part"]) + F.coalesce(F.length(x["found"]), F.lit(0))))
    placed = F.zip_with(steps, starts, lambda x, at: F.struct((at + F.length(x["part"])).alias("start"), (at + F.length(x["part"]) + F.length(x["found"])).alias("end"), F.length(x["value"]).alias("n")))
    return F.transform(F.filter(placed, lambda x: F.coalesce(x["n"] >= least, F.lit(False))), lambda x: _span(kind, x["start"], x["end"]))


def _masked(text: Column, steps: Column, least: int) -> Column:
    """The text with the matches that are long enough masked, character by character."""
    pieces = F.transform(steps, lambda x: F.concat(x["part"], F.when(F.length(x["value"]) >= least, F.repeat(F.lit(MASK), F.length(x["found"]))).otherwise(F.coalesce(x["found"], F.lit("")))))
    return F.when(steps.isNull(), text).otherwise(F.array_join(pieces, ""))


def window_entropy(value: Column, least: Column) -> Column:
    """Struct (start, end): from the first to the last window of ``WINDOW`` characters with ``least`` bits; end 0 if none has."""
    codes = F.transform(F.filter(F.split(value, ""), lambda c: c != ""), lambda c: F.position(c, F.lit(ALPHABET)) - 1)
    return _let(F.struct(codes.alias("codes"), least.cast("double").alias("least")), lambda x: _windows(x["codes"], x["least"]))


def _windows(codes: Column, least: Column) -> Column:
    table = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)))
    f = lambda c: F.element_at(table, c + 1)
    zero = F.struct(F.array_repeat(F.lit(0).cast("long"), -(-len(ALPHABET) // _PER_LONG)).alias("n"), F.lit(0.0).alias("s"), F.lit(0).alias("i"), F.lit(0).alias("start"), F.lit(0).alias("end"))
    gone = F.concat(F.array_repeat(F.lit(-1), WINDOW), codes)  # what leaves as each character comes
    field = lambda code: (code % _PER_LONG) * _BITS
    place = lambda code: (code / _PER_LONG).cast("int")
    # shifts by a column have no Python form of their own
    one = lambda by: F.call_function("shiftleft", F.lit(1).cast("long"), by)
    count = lambda n, at, by: F.call_function("shiftright", F.element_at(n, at), by).bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")
    none = F.lit(0).cast("long")

    def move(a: Column, b: Column) -> Column:
        back = F.greatest(b, F.lit(0))
        return F.struct(
            (a == b).alias("same"), (b >= 0).alias("full"), (place(a) + 1).alias("cp"), field(a).alias("cf"), one(field(a)).alias("add"),
            (place(back) + 1).alias("gp"), field(back).alias("gf"), F.when(b >= 0, one(field(back))).otherwise(none).alias("sub"),
        )

    def step(acc: Column, x: Column) -> Column:
        more, less = count(acc["n"], x["cp"], x["cf"]), count(acc["n"], x["gp"], x["gf"])
        s = F.when(x["same"], acc["s"]).otherwise(acc["s"] + f(more + 1) - f(more) + F.when(x["full"], f(less - 1) - f(less)).otherwise(0.0))
        n = F.when(x["same"], acc["n"]).otherwise(F.transform(acc["n"], lambda c, k: c + F.when(k + 1 == x["cp"], x["add"]).otherwise(none) - F.when(k + 1 == x["gp"], x["sub"]).otherwise(none)))
        i = acc["i"] + 1
        high = (i >= WINDOW) & (math.log2(WINDOW) - s / WINDOW >= least)
        return F.struct(n.alias("n"), s.alias("s"), i.alias("i"), F.when(high & (acc["end"] == 0), i - WINDOW).otherwise(acc["start"]).alias("start"), F.when(high, i).otherwise(acc["end"]).alias("end"))

    steps = F.zip_with(codes, F.slice(gone, F.lit(1), F.size(codes)), move)
    return F.aggregate(steps, zero, step, lambda acc: F.struct(acc["start"].alias("start"), acc["end"].alias("end")))


def _least(value: Column) -> Column:
    out = F.lit(9.0)
    for pattern, bits in reversed(CLASSES.values()):
        out = F.when(value.rlike(pattern), bits).otherwise(out)
    return out


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _scanned(docs: DataFrame, *replaced: str) -> DataFrame:
    """row (the columns of ``docs`` but for ``replaced``), base_spans, spans, masked (base spans masked) and held (candidates that were scored)."""
    need(docs, "text")
    text = F.coalesce(column("text"), F.lit(""))
    text = F.when(F.contains(text, F.lit(MASK)), F.translate(text, MASK, "\x01")).otherwise(text)
    rows = docs.select(packed(docs, *replaced), text.alias("text"))
    rows = rows.select("row", "text", *(_at(F.col("text"), p, g).alias(k) for k, (p, g, _) in PATTERNS.items()))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    base = F.concat(*(F.coalesce(_spans(F.col(k), k, n), empty) for k, (_, _, n) in PATTERNS.items()))
    # base spans come from the text as it is; of each kind what the kinds before have left is masked
    rows = rows.select("row", F.array_sort(base).alias("base_spans"), _masked(F.col("text"), F.col("assign"), PATTERNS["assign"][2]).alias("masked"))
    for kind in ("access", "hex"):
        pattern = PATTERNS[kind][0]
        rows = rows.select("row", "base_spans", "masked", _at(F.col("masked"), pattern, 0).alias("found")).select("row", "base_spans", _masked(F.col("masked"), F.col("found"), 0).alias("masked"))
    rows = rows.select("row", "base_spans", "masked", _at(F.col("masked"), CANDIDATE, 0).alias("found"))
    harmless = lambda v: reduce(lambda a, b: a | b, (v.rlike(p) for p in ALLOWED))
    scored = F.transform("found", lambda x: F.struct(x["part"].alias("part"), x["found"].alias("found"), F.when(x["found"].isNotNull() & ~harmless(x["found"]), window_entropy(x["found"], _least(x["found"]))).alias("w")))
    return rows.select("row", "base_spans", "masked", scored.alias("held"))


def _entropy_spans(held: Column) -> Column:
    starts = _starts(F.transform(held, lambda x: F.length(x["part"]) + F.coalesce(F.length(x["found"]), F.lit(0))))
    placed = F.zip_with(held, starts, lambda x, at: F.struct((at + F.length(x["part"])).alias("at"), x["w"].alias("w")))
    return F.transform(F.filter(placed, lambda x: F.coalesce(x["w"]["end"] > 0, F.lit(False))), lambda x: _span("entropy", x["at"] + x["w"]["start"], x["at"] + x["w"]["end"]))


def secret_spans(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` (text), with ``base_spans`` and ``spans``, arrays of (start, rank, end, kind).

    Spans are ordered by start, then kind; ends are exclusive. A candidate that meets a base span is
    left out. A null text is empty and has none. Rows are judged one by one, also where they repeat; an empty table
    gives no rows. Columns named ``base_spans`` or ``spans`` are replaced, all others stay.
    """
    rows = _scanned(docs, "base_spans", "spans")
    spans = F.when(F.col("held").isNull(), F.col("base_spans")).otherwise(F.array_sort(F.concat("base_spans", _entropy_spans(F.col("held")))))
    return rows.select("row.*", "base_spans", spans.alias("spans"))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``; spans that overlap or touch are replaced together. All else stays as it is.

    A text that has the character with which spans are masked on the way is put together from its own code points.
    """
    rows = _scanned(docs)
    cut = lambda x: F.concat(F.substr(x["found"], F.lit(1), x["w"]["start"]), F.repeat(F.lit(MASK), x["w"]["end"] - x["w"]["start"]), F.substr(x["found"], x["w"]["end"] + 1))
    pieces = F.transform("held", lambda x: F.concat(x["part"], F.when(F.coalesce(x["w"]["end"] > 0, F.lit(False)), cut(x)).otherwise(F.coalesce(x["found"], F.lit("")))))
    masked = F.when(F.col("held").isNull(), F.col("masked")).otherwise(F.array_join(pieces, ""))
    rows = rows.select("row", masked.alias("masked"))
    own = F.col("row.text")
    points = lambda c: F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))
    both = F.zip_with(points(own), points(F.col("masked")), lambda o, m: F.struct(o.alias("own"), (m == MASK).alias("gone")))
    kept = _let(both, lambda b: F.transform(b, lambda x, i: F.when(~x["gone"], x["own"]).when((i > 0) & b[F.greatest(i - 1, F.lit(0))]["gone"], "").otherwise(mark)))
    plain = F.regexp_replace("masked", f"{MASK}+", F.lit(re.sub(r"([\\$])", r"\\\1", mark)))
    text = F.when(~F.contains("masked", F.lit(MASK)), own).when(F.contains(own, F.lit(MASK)), F.array_join(kept, "")).otherwise(plain)
    return rows.select(*(text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))
