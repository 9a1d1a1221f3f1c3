"""The cosine join in cells against all pairs, and how many candidates it compares."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.operators import profile


def clustered(n, centres, spread, seed, dims=24):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(centres, dims))
    rows = points[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, dims))
    return [(int(i), "x" if i % 50 else "y", [float(v) for v in r]) for i, r in enumerate(rows)]


def all_pairs(rows, least):
    out = {}
    for label in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == label and np.linalg.norm(r[2])]
        for size in {len(r[2]) for r in own}:
            some = [r for r in own if len(r[2]) == size]
            v = np.array([r[2] for r in some], np.float32).astype(float)
            v /= np.linalg.norm(v, axis=1, keepdims=True)
            close = v @ v.T
            for i, j in zip(*np.nonzero(np.triu(close >= least, 1)), strict=True):
                out[(label, min(some[i][0], some[j][0]), max(some[i][0], some[j][0]))] = close[i, j]
    return out


@pytest.mark.parametrize(("tile", "spread", "least"), [(4000, 0.2, 0.94), (40, 0.2, 0.94), (40, 0.05, 0.99), (25, 1.0, 0.5), (40, 0.0, 0.9)])
def test_same_pairs(spark, tile, spread, least):
    rows = clustered(700, 40, spread, 3) + [(9000, "x", [0.0] * 24), (9001, "x", [1.0, 2.0]), (9002, "x", [2.0, 4.0]), (9003, "z", [1.0])]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "id int, label string, v array<float>")
    made = profile.similar_pairs(df, ["label"], "id", "v", least, tile).collect()
    want = all_pairs(rows, least)
    assert len(made) == len({(r.label, r.a, r.b) for r in made})
    assert {(r.label, r.a, r.b) for r in made} == set(want)
    assert all(abs(r.similarity - want[(r.label, r.a, r.b)]) < 1e-9 for r in made)


def test_candidates_are_few(spark):
    rows = clustered(6000, 300, 0.05, 4)
    df = spark.createDataFrame(rows, "id int, label string, v array<float>")
    cells = profile.similarity_cells(df, ["label"], "id", "v", 0.94, 100)
    compared = cells.groupBy("_cell").agg(F.count("*").alias("n")).agg(F.sum(F.col("n") * F.col("n")) / 2, F.max("n")).first()
    assert compared[0] < 0.05 * 6000**2 / 2 and compared[1] < 600
    assert cells.count() < 3 * 6000


def test_no_rows(spark):
    assert profile.similar_pairs(spark.createDataFrame([], "id int, label string, v array<float>"), ["label"], "id", "v").count() == 0
