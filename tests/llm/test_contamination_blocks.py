"""Test items without an id, and test sets of several blocks."""

import pytest

from sievemark.llm import decontamination as c
from sievemark.llm import queries

from .conftest import docs_frame
from .test_dedup_and_contamination import ITEMS, contamination_brute

PASSAGE = " ".join(f"w{i}" for i in range(20))


def test_query_and_decontaminate_find_items_without_an_id(spark, tmp_path):
    docs_frame(spark, [(1, f"x {PASSAGE}"), (2, "clean text here")]).write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([(None, PASSAGE)], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in queries.op6_decontamination(spark, str(tmp_path)).collect()}
    assert found == {1: (20, 0, True), 2: (0, 0, False)}
    assert [r.doc_id for r in c.decontaminate(spark.read.parquet(f"{tmp_path}/documents.parquet"), items).collect()] == [2]


@pytest.mark.parametrize("limits", [{}, {"block_bytes": 20, "shard_words": 50}])
def test_unnamed_items_against_brute_force(spark, odd, limits):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in c.find_contamination(odd, items, unnamed=True, **limits).collect()), key=str)
    want = contamination_brute([(r.doc_id, r.text) for r in odd.collect()], [("none" if i is None else i, t) for i, t in ITEMS])
    assert got == sorted(((i, n, hit, tuple(x for x in names if x != "none")) for i, n, hit, names in want), key=str)


def test_one_pass_in_a_plan(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = c.find_contamination(odd, items, block_bytes=20)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") <= 1


def test_blocks_write_hits_alone(spark, odd, monkeypatch):
    """No pass writes a text, and an item above a block is searched whole."""
    written = []
    real = c.table
    monkeypatch.setattr(c, "table", lambda df, tag: written.append((tag, df.columns)) or real(df, tag))
    items = spark.createDataFrame([*ITEMS, (77, PASSAGE + " " + PASSAGE[::-1])], "item_id long, text string")
    c.find_contamination(odd, items, block_bytes=20).count()
    assert len(written) > 2 and {"key", "n_words", "ranges", "items", "matches", "block"} >= {x for tag, names in written if tag == "contamination" for x in names}


def test_blocks_agree_with_one_block(spark):
    """Copies, texts that several blocks hit, and an item in several places."""
    docs = docs_frame(spark, [(i, f"start {PASSAGE} {i % 3} {PASSAGE.replace('w1', 'v1')} end") for i in range(40)] + [(100, None), (101, PASSAGE), (101, PASSAGE), (None, PASSAGE)])
    items = spark.createDataFrame([(1, PASSAGE), (1, PASSAGE.replace("w1", "v1")), (2, "end"), (3, "nowhere at all"), (4, " ".join(PASSAGE.split()[3:]))], "item_id long, text string")
    key = lambda df: sorted(map(str, df.select("doc_id", "n_words", "n_hit", "items", "matches").collect()))
    assert key(c.find_contamination(docs, items)) == key(c.find_contamination(docs, items, block_bytes=30))
    assert sorted(map(str, c.decontaminate(docs, items).collect())) == sorted(map(str, c.decontaminate(docs, items, block_bytes=30).collect()))
