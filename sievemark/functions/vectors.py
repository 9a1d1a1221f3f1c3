"""Vector and relevance arithmetic on arrays, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine in double precision; 0 for empty arrays, unequal lengths and zero vectors."""
    product = norm(a) * norm(b)
    return F.when((F.size(a) == 0) | (F.size(a) != F.size(b)) | (product == 0), 0.0).otherwise(dot(a, b) / product)


def _weighed(held: Column, n: Column, query: tuple[str, ...], k1: float, b: float, avg_len: float) -> Column:
    out = F.lit(0.0)
    for t in dict.fromkeys(query):
        tf = F.size(held) - F.size(F.array_remove(held, F.lit(t)))
        tf = tf.cast("double")
        weight = F.ln(2.0 / (tf + 0.5) + 1.0) * tf * (k1 + 1) / F.greatest(tf + k1 * (1 - b + b * n / avg_len), F.lit(1e-9))
        out = out + F.when(tf > 0, weight).otherwise(0.0)
    return out


def _terms(tokens: Column, terms: tuple[str, ...], body: Callable[[Column, Column], Column]) -> Column:
    """``body`` of the tokens that are terms and of the number of all: one pass over a text's tokens, however many terms."""
    return let(tokens, lambda t: let(F.struct(F.filter(t, lambda x: x.isin(*terms)).alias("held"), F.size(t).alias("n")), lambda s: body(s["held"], s["n"])))


def bm25(tokens: Column, query: tuple[str, ...], k1: float = 1.2, b: float = 0.75, avg_len: float = 1000.0) -> Column:
    """Sum over the query's distinct terms with tf > 0 of ``ln(2 / (tf + 0.5) + 1) * tf * (k1 + 1) / (tf + k1 (1 - b + b * len / avg))``."""
    return _terms(tokens, query, lambda held, n: _weighed(held, n, query, k1, b, avg_len))


def dual_score(tokens: Column, positive: tuple[str, ...], negative: tuple[str, ...], alpha: float = 0.7) -> Column:
    """Relevance to the positive terms and distance from the negative ones, from 0 to 1."""
    squash = lambda raw: 1.0 - F.exp(-raw)
    return _terms(tokens, (*positive, *negative), lambda held, n: alpha * squash(_weighed(held, n, positive, 1.2, 0.75, 1000.0)) + (1 - alpha) * (1.0 - squash(_weighed(held, n, negative, 1.2, 0.75, 1000.0))))


def page_relevance(head: Column, url: Column, positive: tuple[str, ...], negative: tuple[str, ...], alpha: float = 0.7) -> Column:
    """Relevance of a page, from 0 to 1, by the tokens of its head document and of its URL: the better of the two, but 0 if the head says
    neither good nor bad and the URL has a negative term. A head without tokens counts 0.
    """
    terms = (*positive, *negative)

    def scores(tokens: Column) -> Column:
        raw = lambda held, n, q: _weighed(held, n, q, 1.2, 0.75, 1000.0)
        both = _terms(tokens, terms, lambda held, n: F.struct(raw(held, n, positive).alias("good"), raw(held, n, negative).alias("bad")))
        return let(both, lambda b: F.struct(b["good"].alias("good"), b["bad"].alias("bad"), (alpha * (1.0 - F.exp(-b["good"])) + (1 - alpha) * F.exp(-b["bad"])).alias("both")))

    def fused(s: Column) -> Column:
        neutral = (s["head"]["good"] <= 0) & (s["head"]["bad"] <= 0)
        return F.when(neutral & (s["url"]["bad"] > 0), 0.0).otherwise(F.greatest(F.when(s["empty"], 0.0).otherwise(s["head"]["both"]), s["url"]["both"]))

    return let(F.struct(scores(head).alias("head"), scores(url).alias("url"), (F.size(head) == 0).alias("empty")), fused)
