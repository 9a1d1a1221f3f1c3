"""Quantile sketches by view within their stated error, and an embedding cache that asks the model once."""

import random

from pyspark.sql import functions as F

from sievemark.operators import analysis, profile


def test_sketches_are_within_their_error(spark):
    rng = random.Random(5)
    pages = [(rng.randrange(40), rng.lognormvariate(3, 2)) for _ in range(20_000)] + [(41, None)]
    members = [(v, c) for c in range(45) for v in ("global", f"industry:{c % 3}")]
    p, m = spark.createDataFrame(pages, "company_id int, x double"), spark.createDataFrame(members, "view_key string, company_id int")
    exact = {r.view_key: r for r in analysis.view_distributions(m, p, "x").collect()}
    got = {r.view_key: r for r in analysis.view_sketches(m, p, "x").collect()}
    assert set(got) == set(exact) and len(got) == 4
    for view, r in got.items():
        values = sorted(x for c, x in pages if x is not None and (view, c) in set(members))
        assert r.n == len(values) == exact[view].n and r.min == values[0] and r.max == values[-1]
        for q, name in zip(analysis.PERCENTILES, ["median", *(f"p{round(q * 100)}" for q in analysis.PERCENTILES[1:])], strict=True):
            rank = sum(v <= r[name] for v in values) / len(values)
            assert abs(rank - q) < 0.01


def test_a_second_run_asks_for_nothing(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()

    def embedder(texts):
        import os
        import uuid

        with open(os.path.join(str(asked), uuid.uuid4().hex), "w") as f:
            f.write(str(len(texts)))
        return [[float(len(t)), 1.0] for t in texts]

    n = lambda: sum(int(f.read_text()) for f in asked.iterdir())
    cache = f"file://{tmp_path}/cache"
    df = spark.createDataFrame([(f"text {i % 30}",) for i in range(90)] + [(None,)], "t string")
    first = sorted(map(tuple, profile.embed_cached(df, "t", embedder, cache, "m1").select("t", F.col("embedding")[0]).collect()))
    assert n() == 30 and first == sorted((f"text {i}", float(len(f"text {i}"))) for i in range(30))
    assert sorted(map(tuple, profile.embed_cached(df, "t", embedder, cache, "m1").select("t", F.col("embedding")[0]).collect())) == first and n() == 30
    more = df.union(spark.createDataFrame([("new",)], "t string"))
    assert profile.embed_cached(more, "t", embedder, cache, "m1").count() == 31 and n() == 31
    assert profile.embed_cached(df, "t", embedder, cache, "m2").count() == 30 and n() == 61
