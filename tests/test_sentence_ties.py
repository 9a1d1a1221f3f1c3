"""Described offerings as in the SQL twin: a cosine of exactly the threshold is a repeat, and missing texts, turns and keys lose nothing."""

import itertools

from sievemark.operators import profile
from sievemark.plans import catalog

from .oracle import connect, same


def _at_threshold():
    """Pairs of count vectors with a cosine of exactly 0.9, in whole numbers, and pairs just below it."""
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    each = [v for v in itertools.product(range(4), repeat=4) if any(v)]
    gap = {(a, b): 100 * dot(a, b) ** 2 - 81 * dot(a, a) * dot(b, b) for a in each for b in each if a < b}
    ties = sorted(p for p, g in gap.items() if g == 0)
    below = sorted((p for p, g in gap.items() if g < 0), key=lambda p: (-gap[p] / (dot(p[0], p[0]) * dot(p[1], p[1])), p))
    return ties, below[: len(ties)]


def test_cosine_of_just_the_threshold(spark):
    ties, below = _at_threshold()
    assert len(ties) > 30
    rows = [(g, i, ".".join(map(str, v))) for g, pair in enumerate(ties + below) for i, v in enumerate(pair)]
    embedder = lambda texts: [[float(x) for x in t.split(".")] for t in texts]
    got = {r.g: len(r.sentences) for r in profile.distinct_sentences(spark.createDataFrame(rows, "g int, i int, sentence string"), ["g"], ["i"], embedder).collect()}
    assert got == {g: 1 if g < len(ties) else 2 for g in range(len(ties + below))}


def test_query_at_the_threshold(spark, tmp_path):
    ties, below = _at_threshold()
    said = lambda v: "".join(c * n for c, n in zip("etan", v, strict=True)) + "."
    rows = [(g, i, "user", said(v)) for g, pair in enumerate(ties + below) for i, v in enumerate(pair)]
    _same_as_twin(spark, tmp_path, rows)


def test_query_with_gaps(spark, tmp_path):
    """Groups without a sentence have no row, null turns come last, and the one sentence of a null key stays."""
    gone = [(k, 0, "user", t) for k, t in enumerate([None, "", "  ", "•", "\n\n"])]
    rows = [(10, None, "user", "Last one."), (10, 0, "user", "Zeta."), (11, None, "user", "Same."), (11, 3, "user", "SAME."), (12, 0, None, "No role."), (None, 0, "user", "No id."), (13, 0, "user", None), (13, 1, "user", "Some.")]
    _same_as_twin(spark, tmp_path, gone + rows)


def _same_as_twin(spark, tmp_path, rows):
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    same(catalog.QUERIES["offering_descriptions"](spark, str(tmp_path)), con, catalog.ORACLES["offering_descriptions"])
