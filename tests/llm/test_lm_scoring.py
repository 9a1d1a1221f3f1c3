import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sievemark.llm import lm_scoring as lm
from sievemark.llm import queries

from .conftest import docs_frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\n"]


def brute(rows):
    taught = Counter(w for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1 for w in tokens(t))
    n, v = sum(taught.values()), len(taught)
    out = []
    for i, t in rows:
        own = tokens(t)
        base = sum(math.log10((taught[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        out.append((i, len(own), sum(taught[w] > 0 for w in own), n, round(base, 6)))
    return sorted(out, key=str)


def shown(df):
    return sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def scored(spark, sf):
    return queries.op1_lm_scoring(spark, sf).cache()


def test_base_equals_brute_force(spark, sf, scored):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert shown(scored) == brute(rows)


def test_small_vocabulary_changes_only_the_path(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert shown(lm.lm_scores(docs, single=20, frequent=50)) == brute(rows)


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert shown(lm.lm_scores(odd)) == brute(rows)


def test_empty_table(spark):
    assert lm.lm_scores(docs_frame(spark, [])).count() == 0


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    net = lm.Network(*(rng.normal(size=s).astype(np.float32) for s in ((7, 16), (7,), (8, 16), (8, 16))))
    a, b, z = lm._tables(net)
    p = np.exp(a[:, None, :] + b[None, :, :] - z[:, :, None]).sum(2)
    assert np.allclose(p, 1, atol=1e-4)


def test_training_lowers_the_loss():
    rng = np.random.default_rng(1)
    follow = rng.permutation(30)
    w = np.zeros(60000, np.int64)
    for i in range(1, len(w)):
        w[i] = follow[w[i - 1]] if rng.random() < 0.8 else rng.integers(30)
    vocab = lm.Vocabulary([], np.zeros(0), np.zeros(0, int), 0, 0, 30, np.bincount(w, minlength=30) + 0.5)
    u, v, w = lm._contexts([w], 30)

    def loss(net):
        a, b, z = lm._tables(net)
        return -(a[u, w] + b[v, w] - z[u, v]).mean()

    start = lm.initial(vocab, 0)
    trainer = lm.Trainer(start, vocab.mass, 0, batch=512)
    for _ in range(3):
        trainer.fit(u, v, w)
    t = trainer.par
    assert loss(lm.Network(t[0][:, :-1], t[0][:, -1], t[1], t[2])) < loss(start) - 0.5


def test_model_beats_the_base_on_held_out_rows(spark):
    scores = queries.op1_lm_scoring(spark, "/root/testdata/sf0.1").where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert scores.s > scores.b
