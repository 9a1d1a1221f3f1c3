"""Roots merged in one shuffle against the merge of one after the other, sentence dedup against the greedy scan, and spans of many matches."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from sievemark.functions.binding import starts
from sievemark.operators import match, merge, profile


def test_indexes_fold_in_order(spark):
    rng = random.Random(1)
    flag = lambda: rng.choice([True, False, None])
    sources = [spark.createDataFrame([(c, u, flag(), flag(), rng.choice(["", None, f"p{k}"]), rng.choice(["", f"n{k}"])) for c in range(6) for u in range(12) if rng.random() < 0.7], "company_id int, url int, md_done boolean, llm_done boolean, path string, note string") for k in range(4)]
    want = sources[0]
    for more in sources[1:]:
        want = merge.merge_index(want, more, ["path", "note"])
    key = lambda df: sorted(map(str, df.collect()))
    made = merge.merge_indexes(sources, ["path", "note"])
    assert key(made) == key(want)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0


def test_roots_with_missing_tables(spark):
    rows = spark.createDataFrame([(1, "pending", None), (2, "llm_done", "5")], "company_id int, status string, updated_at string")
    more = spark.createDataFrame([(1, "pending", "3"), (2, "pending", "9"), (3, "x", None)], "company_id int, status string, updated_at string")
    out = merge.merge_roots(merge.Root(), [merge.Root(companies=rows), merge.Root(companies=more, ledger=rows)], [])
    assert sorted((r.company_id, r.status, r.updated_at) for r in out.companies.collect()) == [(1, "pending", "3"), (2, "llm_done", "5"), (3, "x", None)]
    assert out.runs is None and out.ledger is None
    assert merge.merge_report([merge.Root(companies=rows), merge.Root(companies=more, ledger=rows)]).first() == (3, 2)


def test_distinct_sentences(spark):
    rng = random.Random(2)
    vectors = {f"s{i}": [rng.gauss(0, 1) for _ in range(3)] for i in range(60)} | {"zero": [0.0, 0.0, 0.0]}
    asked = []
    rows = [(g, i, rng.choice(list(vectors))) for g in range(8) for i in range(50)] + [(99, 0, "zero"), (99, 1, "ZERO"), (99, 2, None), (99, 3, " "), (98, 0, None)]
    vectors[" "] = [1.0, 0.0, 0.0]

    def embedder(texts):
        asked.extend(texts)
        return [vectors[t] for t in texts]

    got = {r.g: list(r.sentences) for r in profile.distinct_sentences(spark.createDataFrame(rows, "g int, i int, sentence string"), ["g"], ["i"], embedder, 0.9, 8).collect()}
    want = {}
    for g in range(8):
        kept, said, seen = [], [], set()
        for _, _, s in sorted(r for r in rows if r[0] == g):
            v = np.array(vectors[s], np.float32).astype(float)
            v = v / np.linalg.norm(v) if np.linalg.norm(v) else v
            if s not in seen and len(said) < 8 and not any(v @ k >= 0.9 for k in kept):
                kept.append(v)
                said.append(s)
            seen.add(s)
        want[g] = said
    assert got == want | {99: ["zero", " "]}


def test_running_sums_and_spans(spark):
    rng = random.Random(3)
    arrays = [[], [5], [rng.randrange(9) for _ in range(1000)], [1] * 257]
    out = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "i int, a array<int>").select("i", starts(F.col("a")).alias("s")).orderBy("i").collect()
    assert [list(r.s) for r in out] == [list(np.cumsum([0, *a])[:-1]) if a else [] for a in arrays]
    n = 300_000
    began = time.perf_counter()
    row = spark.range(1).select(match.spans(F.repeat(F.lit("é the "), n), F.lit(r"\bthe\b")).alias("s")).select(F.size("s"), F.element_at("s", -1)).first()
    assert row[0] == n and tuple(row[1]) == (6 * n - 4, 6 * n - 1)
    assert time.perf_counter() - began < 60
