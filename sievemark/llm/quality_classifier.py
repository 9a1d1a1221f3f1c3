"""Quality scores by a generalised additive model with pairwise interactions.

Every feature of a text falls into one of a few quantile bins. Cyclic boosting visits the features in turn; each visit
fits a shallow tree over that feature's bins to the gradient and adds its leaves to the feature's lookup table.
Then the pairs with the most left to explain get two-dimensional tables, by trees that cut each axis once. A
score is the sum of the table entries of a text's bins, so scoring is a few vectorised lookups by row.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, need, packed, remainder, words_of

FEATURES = ("log_words", "word_length", "symbols", "upper", "digits", "punctuation", "distinct", "top_word", "repeated_lines", "line_words", "pipes", "short_words", "odd_ends", "repeated_pairs")
_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_LETTER = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_PUNCT = b".,;:!?'\"()-"
#: What a word ends in as a rule.
_USUAL = frozenset(_LETTER + _DIGIT + b".,;:)\"'?")


def _number(raw: bytes, kinds: bytes) -> int:
    """How many bytes are of some kinds; nothing is held for each of them."""
    return len(raw) - len(raw.translate(None, kinds))


def features(text: str | None) -> list[float]:
    """Values in the order of ``FEATURES``; all 0 for a text without words."""
    words = words_of(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    count = Counter(words)
    number = {w: k for k, w in enumerate(count)}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    letters = max(1, _number(raw, _LETTER))
    lines = [x for x in text.split("\n") if x]
    pairs = len(np.unique(ids[:-1] * len(count) + ids[1:]))
    size = sum(map(len, words))
    return [
        math.log1p(n),
        size / n,
        _number(raw, b"#*$%&<>") / n,
        _number(raw, _UPPER) / letters,
        _number(raw, _DIGIT) / size,
        _number(raw, _PUNCT) / n,
        len(count) / n**0.85,
        max(count.values()) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        n / max(1, len(lines)),
        raw.count(b"|") / n,
        sum(len(w) <= 3 for w in words) / n,
        sum(w[-1] not in _USUAL for w in count) / len(count),
        1 - pairs / max(1, n - 1),
    ]


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, l2: float) -> tuple[np.ndarray, float]:
    """Steps by bin of a tree of at most ``leaves`` over ordered bins with gradient and curvature sums, and its gain."""
    spans, gain = [(0, len(g))], 0.0
    cg, ch = np.concatenate(([0], np.cumsum(g))), np.concatenate(([0], np.cumsum(h)))
    value = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + l2)
    for _ in range(leaves - 1):
        found = [(value(a, k) + value(k, b) - value(a, b), a, k, b) for a, b in spans for k in range(a + 1, b)]
        best = max(found, default=(0,))
        if best[0] <= 1e-9:
            break
        spans = [s for s in spans if s != (best[1], best[3])] + [(best[1], best[2]), (best[2], best[3])]
        gain += best[0]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = -(cg[b] - cg[a]) / (ch[b] - ch[a] + l2)
    return out, gain


def _square(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[np.ndarray, float]:
    """Steps and gain of the best tree that cuts each axis of a grid of sums once."""
    best, cut = -1.0, (1, 1)
    cg, ch = np.zeros((g.shape[0] + 1, g.shape[1] + 1)), np.zeros((g.shape[0] + 1, g.shape[1] + 1))
    cg[1:, 1:], ch[1:, 1:] = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    quarters = lambda c, i, j: (c[i, j], c[i, -1] - c[i, j], c[-1, j] - c[i, j], c[-1, -1] - c[i, -1] - c[-1, j] + c[i, j])
    i, j = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")
    if i.size:
        total = sum(a**2 / (b + l2) for a, b in zip(quarters(cg, i, j), quarters(ch, i, j), strict=True))
        k = int(total.argmax())
        best, cut = float(total.flat[k]), (int(i.flat[k]), int(j.flat[k]))
    out = np.zeros(g.shape)
    steps = [-a / (b + l2) for a, b in zip(quarters(cg, *cut), quarters(ch, *cut), strict=True)]
    out[: cut[0], : cut[1]], out[: cut[0], cut[1] :], out[cut[0] :, : cut[1]], out[cut[0] :, cut[1] :] = steps
    return out, best - cg[-1, -1] ** 2 / (ch[-1, -1] + l2)


@dataclass(frozen=True)
class AdditiveModel:
    """base + one table by feature + one table by chosen pair, in log odds."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    grids: list[np.ndarray]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)])

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        at = self.bins(x)
        odds = self.base + sum(t[at[:, k]] for k, t in enumerate(self.tables)) + sum((g[at[:, i], at[:, j]] for (i, j), g in zip(self.pairs, self.grids, strict=True)), np.zeros(len(x)))
        return 1 / (1 + np.exp(-odds))


def fit(x: np.ndarray, y: np.ndarray, n_bins: int = 24, rounds: int = 150, n_pairs: int = 6, pair_rounds: int = 60, rate: float = 0.1, leaves: int = 3, l2: float = 5.0) -> AdditiveModel:
    """Learn the tables. Without rows of both labels, every score is the share of label 1 (one half without rows)."""
    share = float(y.mean()) if len(y) else 0.5
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, n_bins + 1)[1:-1])) if len(x) else np.zeros(0) for k in range(len(FEATURES))]
    model = AdditiveModel(math.log((share + 1e-6) / (1 - share + 1e-6)), edges, [np.zeros(len(e) + 1) for e in edges], [], [])
    if not 0 < share < 1:
        return model
    at, odds = model.bins(x), np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-odds))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for k, t in enumerate(model.tables):
            g, h = slopes()
            step, _ = _tree(np.bincount(at[:, k], g, len(t)), np.bincount(at[:, k], h, len(t)), leaves, l2)
            t += rate * step
            odds += rate * step[at[:, k]]
    g, h = slopes()

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        shape = len(model.tables[i]), len(model.tables[j])
        return np.bincount(at[:, i] * shape[1] + at[:, j], v, shape[0] * shape[1]).reshape(shape)

    gains = sorted(((_square(grid(i, j, g), grid(i, j, h), l2)[1], i, j) for i, j in combinations(range(len(FEATURES)), 2)), reverse=True)
    model.pairs.extend((i, j) for _, i, j in gains[:n_pairs])
    model.grids.extend(np.zeros((len(model.tables[i]), len(model.tables[j]))) for i, j in model.pairs)
    for _ in range(pair_rounds):
        for (i, j), t in zip(model.pairs, model.grids, strict=True):
            g, h = slopes()
            step, _ = _square(grid(i, j, g), grid(i, j, h), l2)
            t += rate * step
            odds += rate * step[at[:, i], at[:, j]]
    return model


def _arrow(docs: DataFrame, text: Callable[[pa.RecordBatch], pa.Array], made: Callable[[list[list[float]]], pa.Array], name: str, kind: str, drop: Sequence[str] = ()) -> DataFrame:
    """``docs`` but for ``drop``, with the column ``name`` made of the features of a batch's texts."""
    keep = [c for c in docs.columns if c not in drop]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), made([features(t.as_py()) for t in text(batch)])], [*keep, name])

    schema = T.StructType([*docs.select(*keep).schema.fields, *T.StructType.fromDDL(f"{name} {kind}").fields])
    return docs.mapInArrow(part, schema)


def train(docs: DataFrame, labels: DataFrame, held_out_mod: int = 3, sample: int = 16_000) -> AdditiveModel:
    """Fit on labelled rows that are not held out.

    At most ``sample`` labelled ids are used, those with the least hash: the one bound on what is learned from. Null
    labels and ids teach nothing; an id with several labels has their mean, cut at one half. An id teaches once: of
    several texts, the one whose features come first in order. So the model depends on the rows, not on their order.
    """
    need(docs, "doc_id", "text")
    need(labels, "doc_id", "quality")
    labels = labels.select(column("doc_id").alias("doc_id"), column("quality").alias("quality"))
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (remainder(F.col("doc_id"), held_out_mod) != 1))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(column("doc_id").alias("doc_id"), column("text").alias("text")).join(F.broadcast(known), "doc_id")
    rows = _arrow(rows, lambda batch: batch.column("text"), lambda x: pa.array(x, pa.list_(pa.float64())), "x", "array<double>", ["text"])
    got = sorted((r.doc_id, r.quality, tuple(r.x)) for r in rows.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).collect())  # one row by id of the sample
    return fit(np.array([r[2] for r in got]).reshape(-1, len(FEATURES)), np.array([r[1] for r in got], float))


def _scored(docs: DataFrame, model: AdditiveModel, held_out_mod: int, *replaced: str) -> DataFrame:
    """row (the columns of ``docs`` but for ``replaced``), held_out, score, predicted."""
    need(docs, "doc_id", "text")
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(packed(docs, *replaced), (remainder(column("doc_id"), held_out_mod) == 1).alias("held_out"))
    made = lambda x: pa.array(held.value.score(np.array(x).reshape(-1, len(FEATURES))))
    out = _arrow(rows, lambda batch: batch.column("row").field("text"), made, "score", "double")
    return out.select("row", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def score_quality(docs: DataFrame, model: AdditiveModel, held_out_mod: int = 3) -> DataFrame:
    """The columns of ``docs`` (doc_id, text), with held_out, score and predicted for every row.

    A null text is empty. A null id counts as the empty text for the split. Repeated rows are rows of their own.
    Columns named as one of the three results are replaced, all others stay; an empty table gives no rows.
    """
    results = ("held_out", "score", "predicted")
    return _scored(docs, model, held_out_mod, *results).select("row.*", *results)


def quality_scores(docs: DataFrame, labels: DataFrame, held_out_mod: int = 3, sample: int = 16_000) -> DataFrame:
    """Train on ``labels`` and score every row of ``docs``."""
    return score_quality(docs, train(docs, labels, held_out_mod, sample), held_out_mod)


def keep_good(docs: DataFrame, labels: DataFrame, held_out_mod: int = 3, sample: int = 16_000) -> DataFrame:
    """The rows of ``docs`` that the model trained on ``labels`` predicts to be good; all their columns stay."""
    return _scored(docs, train(docs, labels, held_out_mod, sample), held_out_mod).where("predicted = 1").select("row.*")
