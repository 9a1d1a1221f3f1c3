"""Language-model scores of whole texts by a log-bilinear neural model.

Word counts of the training rows are a Spark aggregation over all of them. The most frequent words get a
class each, the other frequent ones share classes by frequency, and all the rest share one class. The
network predicts the next class from the two before it: a context (u, v) and a class w score
``A[u].R[w] + B[v].R[w] + b[w]``. It is trained in numpy with noise-contrastive estimation, one partition
at a time from common parameters, over every training row; the parameters' rows are averaged by Spark,
weighted by how often a partition updated each. Because the score is bilinear, the normaliser of all
pairs of contexts is one matrix product, ``exp(A R') diag(exp b) exp(B R')'``, so probabilities are exact.

Within a class a word has its share of smoothed counts, so the model is a distribution over the same
words as the unigram base: all words seen in training and one unseen word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, need, remainder, row_key, table

END = b"\n"  # no word holds a newline
DIM = 16
LOG10 = np.log(10.0)


@dataclass(frozen=True)
class Vocabulary:
    """Bounded: at most ``frequent`` words. Classes: single words, bands of words, the rest, in this order."""

    words: list[bytes]
    counts: np.ndarray  # by word
    classes: np.ndarray  # class by word
    n_tokens: int
    n_types: int
    n_classes: int  # the last is the rest
    mass: np.ndarray  # sum of count + 0.5 by class

    @property
    def rest(self) -> int:
        return self.n_classes - 1

    @property
    def total(self) -> float:
        return self.n_tokens + 0.5 * (self.n_types + 1)


@dataclass(frozen=True, eq=False)
class Network:
    """Parameters; the last row of ``first`` and ``second`` stands for the start of a text."""

    target: np.ndarray
    bias: np.ndarray
    first: np.ndarray  # by the class just before
    second: np.ndarray  # by the class before that


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case, then the end."""
    out = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    out.append(END)
    return out


def count_words(texts: DataFrame, flush: int = 400_000) -> DataFrame:
    """token, c over the column ``text``. Each task sums what it reads before anything is shuffled."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], ["token", "c"])
            seen.clear()
            return made

        for batch in batches:
            for text in batch.column(0):
                seen.update(tokens(text.as_py()))
                if len(seen) > flush:
                    yield out()
        if seen:
            yield out()

    return texts.select("text").mapInArrow(part, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, single: int, frequent: int) -> Vocabulary:
    """The frequent words and the classes, from the table of counts.

    A histogram over count octaves finds the least count that at most ``frequent`` words reach, so no more
    than that many words come to the driver, whatever the corpus.
    """
    steps = counts.groupBy(F.floor(F.log2("c") * 16).alias("step")).agg(F.count("*").alias("n"), F.sum("c").alias("c"), F.min("c").alias("least")).orderBy(F.desc("step")).collect()
    n_tokens, n_types = sum(r.c for r in steps), sum(r.n for r in steps)
    held, least = 0, None
    for r in steps:
        if (held := held + r.n) > frequent:
            break
        least = r.least
    rows = [] if least is None else counts.where(F.col("c") >= least).collect()
    rows = sorted(((r.token.encode("utf-8"), r.c) for r in rows), key=lambda x: (-x[1], x[0]))
    c = np.array([x[1] for x in rows], np.int64)
    classes = np.arange(len(rows))
    band = np.floor(np.log2(np.maximum(c[single:], 1))).astype(int)
    if len(band):
        classes[single:] = single + np.unique(-band, return_inverse=True)[1]
    n = int(classes.max()) + 2 if len(rows) else 1
    mass = np.bincount(classes, c + 0.5, minlength=n).astype(float)
    total = n_tokens + 0.5 * (n_types + 1)
    mass[n - 1] = max(total - mass[: n - 1].sum(), 0.5)
    return Vocabulary([x[0] for x in rows], c, classes, n_tokens, n_types, n, mass)


def initial(v: Vocabulary, seed: int) -> Network:
    rng = np.random.default_rng(seed)
    made = lambda n: rng.normal(0, 0.1, (n, DIM)).astype(np.float32)
    return Network(made(v.n_classes), np.log(v.mass / v.mass.sum()).astype(np.float32), made(v.n_classes + 1), made(v.n_classes + 1))


def _by_row(ids: np.ndarray, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids, the sum of their gradients and their number."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    at = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    return ids[at], np.add.reduceat(grads[order], at, axis=0), np.diff(np.append(at, len(ids)))


class Trainer:
    """Noise-contrastive estimation, with Adagrad's step sizes.

    A batch shares ``drawn`` noise classes, taken at even steps of the noise distribution from a random start, each of
    which stands for ``k / drawn`` samples. That keeps the noise term's variance small.
    """

    def __init__(self, net: Network, noise: np.ndarray, seed: int, batch: int = 8192, k: int = 32, drawn: int = 96, rate: float = 0.05):
        self.par = [np.hstack([net.target, net.bias[:, None]]).astype(np.float32), net.first.copy(), net.second.copy()]
        self.sq = [np.ones_like(p) for p in self.par]
        self.n = [np.zeros(len(p), np.int64) for p in self.par]
        self.rng, self.batch, self.k, self.drawn, self.rate = np.random.default_rng(seed), batch, k, drawn, rate
        self.cum = np.cumsum(noise / noise.sum())
        self.log_kp = np.log(k * noise / noise.sum()).astype(np.float32)

    def fit(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> None:
        order = self.rng.permutation(len(w))
        for at in range(0, len(w), self.batch):
            pick = order[at : at + self.batch]
            self.step(u[pick], v[pick], w[pick])

    def step(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> None:
        target, first, second = self.par
        q = first[u] + second[v]
        x = np.minimum(np.searchsorted(self.cum, (np.arange(self.drawn) + self.rng.random()) / self.drawn), len(target) - 1)
        rw, rx = target[w], target[x]
        with np.errstate(over="ignore"):
            gp = 1 / (1 + np.exp(self.log_kp[w] - np.einsum("ij,ij->i", q, rw[:, :-1]) - rw[:, -1])) - 1
            gn = np.float32(self.k / self.drawn) / (1 + np.exp(self.log_kp[x] - q @ rx[:, :-1].T - rx[:, -1]))
        gq = gp[:, None] * rw[:, :-1] + gn @ rx[:, :-1]
        own = np.empty_like(rw)
        np.multiply(gp[:, None], q, out=own[:, :-1])
        own[:, -1] = gp
        noisy = np.hstack([gn.T @ q, gn.sum(0)[:, None]])
        self.update(0, np.concatenate([w, x]), np.vstack([own, noisy]))
        self.update(1, u, gq)
        self.update(2, v, gq)

    def update(self, k: int, ids: np.ndarray, grads: np.ndarray) -> None:
        ids, g, n = _by_row(ids, grads)
        self.sq[k][ids] += g * g
        self.par[k][ids] -= self.rate * g / np.sqrt(self.sq[k][ids])
        self.n[k][ids] += n


def _contexts(ids: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes before, before that, and predicted, over texts laid end to end."""
    ends = np.cumsum([len(x) for x in ids])
    w = np.concatenate(ids)
    at = np.concatenate(([0], ends[:-1]))
    u, v = np.concatenate(([start], w[:-1])), np.concatenate(([start, start], w[:-2]))[: len(w)]
    u[at] = start
    v[at] = start
    after = at + 1
    v[after[after < ends]] = start
    return u, v, w


def train_round(texts: DataFrame, vocab, net, seed: int, buffer: int = 1_000_000) -> Network:
    """One pass over ``texts``: every partition trains from ``net``, and Spark averages the rows' results.

    vocab, net: broadcasts.
    """
    names = [f"x{i}" for i in range(DIM + 1)]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = vocab.value
        own, held, n = Trainer(net.value, v.mass, seed), [], 0
        get, rest, start = _lookup(vocab), len(v.words), v.n_classes
        classes = np.append(v.classes, v.rest).astype(np.int32)
        for batch in batches:
            for text in batch.column(0):
                own_ids = classes[np.fromiter((get(t, rest) for t in tokens(text.as_py())), np.int32)]
                held.append(own_ids)
                n += len(own_ids)
                if n >= buffer:
                    own.fit(*_contexts(held, start))
                    held, n = [], 0
        if held:
            own.fit(*_contexts(held, start))
        for k, (par, count) in enumerate(zip(own.par, own.n, strict=True)):
            rows = np.flatnonzero(count)
            if len(rows):
                full = par[rows] if k == 0 else np.hstack([par[rows], np.zeros((len(rows), 1), np.float32)])
                arrays = [pa.array(np.full(len(rows), k, np.int32)), pa.array(rows.astype(np.int32)), pa.array(count[rows].astype(float)), *(pa.array(full[:, i].astype(float)) for i in range(DIM + 1))]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "row", "n", *names])

    made = texts.select("text").mapInArrow(part, "part int, row int, n double, " + ", ".join(f"{x} double" for x in names))
    made = made.groupBy("part", "row").agg(F.sum("n").alias("n"), *(F.sum(F.col(x) * F.col("n")).alias(x) for x in names))
    old = net.value
    par = [np.hstack([old.target, old.bias[:, None]]), old.first.copy(), old.second.copy()]
    for r in made.collect():  # as many rows as the bounded vocabulary has classes, three times
        mean = np.array(r[3:], np.float64) / r.n
        par[r.part][r.row] = mean[: par[r.part].shape[1]]
    return Network(par[0][:, :-1].astype(np.float32), par[0][:, -1].astype(np.float32), par[1].astype(np.float32), par[2].astype(np.float32))


_lookups: dict = {}


def _lookup(vocab):
    """The dictionary's ``get``; a worker keeps the last one."""
    if vocab.value is not _lookups.get("of"):
        _lookups.update(of=vocab.value, get={w: i for i, w in enumerate(vocab.value.words)}.get)
    return _lookups["get"]


@lru_cache(maxsize=1)
def _tables(net: Network) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores by (class before, class), by (class before that, class), and log normalisers by both contexts."""
    a, b = net.first @ net.target.T, net.second @ net.target.T
    a += net.bias
    top_a, top_b = a.max(1, keepdims=True), b.max(1, keepdims=True)
    z = np.exp(a - top_a) @ np.exp(b - top_b).T
    return a, b, np.log(np.maximum(z, 1e-37)) + top_a + top_b.T


def score_texts(docs: DataFrame, vocab, net, counts: DataFrame) -> DataFrame:
    """doc_id, text, held_out -> the contract's columns.

    Frequent words need the bounded vocabulary alone. The others leave a row for each distinct word of a
    text, and the counts meet them in a join by word. These rows are the main cost: about twice the input is shuffled. In a
    large corpus a word just beyond the vocabulary is in many texts; Spark splits its rows, as the counts have one row a word.
    A text's own row goes the same way under a name that no word has.
    """
    schema = "k1 long, k2 long, doc_id long, held_out boolean, one long, n_tokens long, n_known long, base double, score double, token string, n long"

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = vocab.value
        a, b, log_z = _tables(net.value)
        get, rest, start = _lookup(vocab), len(v.words), v.n_classes
        classes = np.append(v.classes, v.rest).astype(np.int32)
        base_of = np.append(np.log10((v.counts + 0.5) / v.total), 0.0)
        within = np.append(np.log10((v.counts + 0.5) / v.mass[v.classes]), -np.log10(v.mass[v.rest]))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500).to_pydict()
                ids, rare = [], []
                for i, text in enumerate(rows["text"]):
                    own = tokens(text)
                    x = np.fromiter((get(t, rest) for t in own), np.int32)
                    ids.append(x)
                    rare += [(i, t, c) for t, c in Counter(own[j] for j in np.flatnonzero(x == rest)).items()]
                flat = np.concatenate(ids)
                lens = np.array([len(x) for x in ids])
                cut = np.concatenate(([0], np.cumsum(lens)[:-1]))
                uu, vv, ww = _contexts([classes[x] for x in ids], start)
                p = (a[uu, ww] + b[vv, ww] - log_z[uu, vv]).astype(np.float64) / LOG10 + within[flat]
                known = np.add.reduceat((flat < rest).astype(np.int64), cut)
                n, m = len(ids), len(rare)
                none = [None] * m
                who = [r[0] for r in rare]
                key = lambda c: pa.array(rows[c] + [rows[c][i] for i in who], pa.int64())  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [
                        key("k1"), key("k2"), pa.array(rows["doc_id"] + none, pa.int64()), pa.array(rows["held_out"] + none, pa.bool_()), pa.array([1] * n + [0] * m, pa.int64()),
                        pa.array(lens.tolist() + none, pa.int64()), pa.array(known.tolist() + none, pa.int64()), pa.array(np.add.reduceat(base_of[flat], cut).tolist() + none, pa.float64()), pa.array(np.add.reduceat(p, cut).tolist() + none, pa.float64()),
                        pa.array([f"\n{k}" for k in rows["k1"]] + [r[1].decode("utf-8", "replace") for r in rare], pa.string()), pa.array([None] * n + [r[2] for r in rare], pa.int64()),
                    ],
                    [x.split()[0] for x in schema.split(", ")],
                )

    v = vocab.value
    made = docs.select(*row_key(F.col("doc_id"), F.col("text")), "doc_id", "held_out", "text").mapInArrow(part, schema)
    c = F.coalesce(F.col("c"), F.lit(0))
    # a text's own row has no n; rows with equal doc_id and text meet in one group and part again below
    rare = F.col("n") * F.log10(c + 0.5)
    out = made.join(counts, "token", "left").groupBy("k1", "k2").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("one").alias("one"), F.max("n_tokens").alias("n_tokens"), F.max("n_known").alias("known"), F.max("base").alias("base"), F.max("score").alias("lm"),
        F.sum(F.when(c > 0, F.col("n"))).alias("more"), F.sum(rare).alias("rare"), F.sum("n").alias("n_rare"),
    )
    part_of = lambda x: F.coalesce(F.col(x) / F.col("one"), F.lit(0))
    return out.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("one")))).select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + part_of("more")).cast("long").alias("n_known"),
        F.lit(v.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + part_of("rare") - part_of("n_rare") * float(np.log10(v.total))).alias("base_score"),
        (F.col("lm") + part_of("rare")).alias("score"),
    )


def lm_scores(docs: DataFrame, held_out_mod: int = 5, single: int = 2000, frequent: int = 65_536, rounds: int = 2, seed: int = 11) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text).

    Rows whose crc32(doc_id) modulo ``held_out_mod`` is 1 are held out, the others teach, each in one of the
    ``rounds``. A null text is empty: it has the end alone. A null doc_id counts as the empty text for the split and
    stays null. Rows that repeat are rows of their own. An empty table gives no rows. Other columns are left alone
    and not returned.

    A partition trains on its own rows from common parameters, so the network, and with it ``score``, depends on how the rows are
    dealt out to partitions; counts and ``base_score`` do not. The same files read with the same settings give the same scores.

    The driver and tasks hold ``frequent`` words and about ``single`` x ``single`` scores, whatever the corpus.
    """
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").alias("text"), (remainder(column("doc_id"), held_out_mod) == 1).alias("held_out"))
    taught = rows.where(~F.col("held_out"))
    counts = table(count_words(taught), "word-counts")
    vocab = spark.sparkContext.broadcast(vocabulary(counts, single, frequent))
    net = spark.sparkContext.broadcast(initial(vocab.value, seed))
    for k in range(rounds):
        net = spark.sparkContext.broadcast(train_round(taught.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == k), vocab, net, seed + k))
    return score_texts(rows, vocab, net, counts)
