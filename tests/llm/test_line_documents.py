"""Lines are counted by documents, not by rows, where ids tell documents apart."""

import corpus_pipeline
from sievemark.llm import line_dedup as ld
from sievemark.llm import queries

from .conftest import docs_frame
from .test_dedup_and_contamination import lines_brute


def by_id_brute(rows, least):
    """Every row, with the lines that ``least`` documents have taken out; rows without an id are documents of their own."""
    docs = {}
    for n, (i, t) in enumerate(rows):
        docs.setdefault(("row", n) if i is None else i, []).append(t or "")
    gone = {x for x in {x for _, t in rows for x in (t or "").split("\n")} if x and sum(any(x in t.split("\n") for t in own) for own in docs.values()) >= least}
    kept = [[x for x in (t or "").split("\n") if x not in gone] for _, t in rows]
    return sorted(((i, "\n".join(k), len((t or "").split("\n")), len((t or "").split("\n")) - len(k)) for (i, t), k in zip(rows, kept, strict=True)), key=str)


ROWS = [(1, "once\nshared\nmine"), *[(2, "ten rows\nof one id\nshared")] * 10, (3, "shared"), (3, "shared\nother"), (None, "null a\nshared"), (None, "null a"), (None, "null a"), (4, None), (5, "")]


def test_rows_of_an_id_count_once(spark):
    got = sorted(((r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in ld.line_dedup(docs_frame(spark, ROWS), min_docs=3, by_id=True).collect()), key=str)
    assert got == by_id_brute(ROWS, 3)
    assert ("null a" not in " ".join(r[1] for r in got)) and any("ten rows" in r[1] for r in got)


def test_unique_ids_count_as_rows(spark):
    rows = [(i, f"same\nown {i}") for i in range(12)]
    got = sorted(((r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in ld.line_dedup(docs_frame(spark, rows), by_id=True).collect()), key=str)
    assert got == lines_brute(rows, 10)


def test_query_and_pipeline_keep_a_row_that_repeats(spark, tmp_path):
    docs = docs_frame(spark, [(2, "a b\nc d", "web")] * 10)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.n_dropped for r in queries.op5_line_dedup(spark, str(tmp_path)).collect()} == {0}
    assert {r.text for r in corpus_pipeline.lines(spark, docs, "").collect()} == {"a b\nc d"}
