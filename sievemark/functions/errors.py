"""Classes and signatures of error texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import truncate

# Patterns in the order in which they are tried.
SIGNATURES = (
    ("TIMEOUT", r"(?i)\b(timeout|timed out|read timeout|connect timeout)\b"),
    ("DNS", r"(?i)\b(nxdomain|name or service not known|dns|nodename nor servname)\b"),
    ("SSL", r"(?i)\b(ssl|tls|certificate verify failed|handshake)\b"),
    ("CONNECTION", r"(?i)\b(connection (reset|refused)|econnreset|econnrefused|socket hang up)\b"),
    ("HTTP_429", r"(?i)\b(429|too many requests|rate limit)\b"),
    ("HTTP_403", r"(?i)\b(403|forbidden)\b"),
    ("HTTP_404", r"(?i)\b(404|not found)\b"),
    ("HTTP_5XX", r"(?i)\b(5\d\d|server error|bad gateway|service unavailable|gateway timeout)\b"),
)
TIMEOUTS = r"(?i)\btimeout\s+\d+\s*ms\s+exceeded\b|\bnavigation\s+timeout\s+of\s+\d+\s*ms\s+exceeded\b|\btimed\s+out\b|\btimeouterror\b"
MEMORY = r"(?i)requeued due to critical memory pressure|\bcritical\s+memory\s+pressure\b|\bmemory\s+pressure\b|\bout\s+of\s+memory\b|\boomed\b|\boom\b"
TRANSPORT = (
    r"(?i)\b(nxdomain|name or service not known|temporary failure in name resolution|no address associated with hostname|getaddrinfo|name resolution"
    r"|connection refused|connection reset|connection aborted|network is unreachable|no route to host|host is down|broken pipe|socket hang up|server disconnected)\b|\b(ssl|tls)\b.*\bhandshake\b"
)
GOTO_TIMEOUT = r"(?i)page\.goto: timeout|timeout \d+ms exceeded"
UNREACHABLE = ("name or service not known", "nxdomain", "temporary failure in name resolution", "nodename nor servname provided", "no address associated with hostname")
RATE_LIMITED = ("rate limit", "too many requests", "quota", "overloaded", "try again later")
GATEWAY_CODES = (502, 503, 504, 520, 521, 522, 523, 524)
GATEWAY = ("connection refused", "connection reset", "network is unreachable", "no route to host", "server disconnected", "socket hang up", "broken pipe", "timed out", "read timeout", "connect timeout", "dns", "nxdomain", "name resolution")
CUT_MARKERS = r"(?s)\n(Call log|Code context|Stack trace):.*\z"
BACKOFF = {"net": (20, 60, 300), "stall": (60, 300, 1200, 3600), "stall_fast": (30, 120), "mem": (300, 1800, 7200, 21600, 86400), "other": (60, 300, 1800, 7200, 21600, 86400)}


def signature(c: Column) -> Column:
    """A coarse label of an error text; an unknown one gives its own start in capitals."""
    t = F.trim(c)
    rest = truncate(F.regexp_replace(F.regexp_replace(F.upper(t), r"\s+", " "), r"[^A-Z0-9 _:/.\-]", ""), 15)
    out = rest
    for name, pattern in reversed(SIGNATURES):
        out = F.when(t.rlike(pattern), name).otherwise(out)
    return F.when(F.coalesce(t, F.lit("")) == "", "").otherwise(out)


def compact(c: Column, most: int = 600) -> Column:
    """One line without logs and traces, at most ``most`` characters."""
    t = F.trim(F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), CUT_MARKERS, "")), r"\s+", " "))
    return F.when(F.length(t) > most, F.concat(F.substring(t, 1, most - 3), F.lit("..."))).otherwise(t)


def any_of(c: Column, needles: tuple[str, ...]) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    out = F.lit(False)
    for n in needles:
        out = out | F.contains(low, F.lit(n))
    return out


def is_goto(stage: Column, error: Column) -> Column:
    return F.concat(F.coalesce(stage, F.lit("")), F.lit(": "), error).rlike(GOTO_TIMEOUT)


def retry_class(hint: Column, error: Column, stage: Column, code: Column) -> Column:
    """permanent, mem, net, stall or other."""
    h = F.lower(F.trim(F.coalesce(hint, F.lit(""))))
    rate = F.coalesce(code == 429, F.lit(False)) | any_of(error, RATE_LIMITED)
    gate = F.coalesce(code.isin(*GATEWAY_CODES), F.lit(False)) | any_of(error, GATEWAY)
    return F.when(is_goto(stage, error), "stall").when(h == "permanent", "permanent").when(h.isin("mem", "mem_heavy"), "mem").when(rate, "stall").when(gate, "net").when(h == "", "other").otherwise(h)


def stall_kind(hint: Column, error: Column, stage: Column, code: Column) -> Column:
    """goto, no_yield, rate_limit or unknown."""
    s = F.lower(F.coalesce(stage, F.lit("")))
    idle = F.contains(s, F.lit("scheduler")) | F.contains(s, F.lit("inactivity")) | any_of(error, ("no_yield", "no yield"))
    rate = F.coalesce(code == 429, F.lit(False)) | any_of(error, RATE_LIMITED)
    return F.when(is_goto(stage, error), "goto").when(hint.isNotNull(), F.lower(F.trim(hint))).when(idle, "no_yield").when(any_of(error, ("goto", "navigation")) | F.contains(s, F.lit("goto")), "goto").when(rate, "rate_limit").otherwise("unknown")


def retry_signature(cls: Column, kind: Column, nxdomain: Column, error: Column, stage: Column, code: Column) -> Column:
    """What makes two failures the same: a name, or the text with numbers and hex runs replaced, at most 240 characters."""
    text = F.concat(cls, F.lit(":"), kind, F.lit(":"), F.coalesce(code.cast("string"), F.lit("")), F.lit(":"), stage, F.lit(":"), error)
    low = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), r"\b[0-9a-f]{8,}\b", "<hex>"), r"\d+", "<n>"), r"\s+", " ")
    return F.when(is_goto(stage, error), "goto_timeout").when(nxdomain, "nxdomain").when((cls == "stall") & (kind == "rate_limit"), "rate_limit").when(cls == "mem", "mem_pressure").otherwise(F.substring(low, 1, 240))


def backoff_seconds(attempts: Column, cls: Column, kind: Column) -> Column:
    """Seconds to wait after so many attempts, without jitter; the last step of a schedule repeats."""

    def pick(name: str) -> Column:
        steps = BACKOFF[name]
        return F.element_at(F.array(*map(F.lit, steps)), F.least(F.greatest(attempts, F.lit(1)), F.lit(len(steps))).cast("int")).cast("double")

    return F.when(cls == "net", pick("net")).when((cls == "stall") & kind.isin("goto", "no_yield"), pick("stall_fast")).when(cls == "stall", pick("stall")).when(cls == "mem", pick("mem")).otherwise(pick("other"))


def page_error(c: Column) -> Column:
    """memory, timeout, transport or other; null without an error."""
    return F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(None).cast("string")).when(c.rlike(MEMORY), "memory").when(c.rlike(TIMEOUTS), "timeout").when(c.rlike(TRANSPORT), "transport").otherwise("other")
