"""Readers and sinks on small files, and loading as one call."""

import json
import sqlite3
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievemark.operators import ingest, match
from sievemark.sources import readers, sinks


def rows(df):
    return sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "one.csv").write_text('id,name,url\n1,"Ann, Co",https://www.a.com/\n2,Bee,b.com\n')
    (tmp_path / "a" / "two.csv").write_text("name,url,id,nace\nCee,c.com/index.html,3,11\n")
    (tmp_path / "a" / "three.tsv").write_text("id\tname\turl\n4\tDee\td.com\n")
    (tmp_path / "four.json").write_text(json.dumps({"data": [{"id": 5, "name": "Eee", "url": "https://a.com", "tags": [1]}, {"id": 6}]}))
    (tmp_path / "five.jsonl").write_text('{"id": "7", "name": "Gee", "url": "g.com"}\nnot json\n\n{"id": "8"}\n')
    (tmp_path / "note.unknown").write_text("skip me")
    pd.DataFrame({"id": ["9"], "name": ["Iii"], "url": ["b.com/"]}).to_parquet(tmp_path / "a" / "six.parquet")
    pd.DataFrame({"id": ["10"], "name": ["Jay"], "url": ["j.com"]}).to_feather(tmp_path / "seven.feather")
    pd.DataFrame({"id": ["11"], "name": ["Kay"], "url": ["k.com"]}).to_stata(tmp_path / "eight.dta", write_index=False)
    return tmp_path


def test_folder_reads_every_known_table_by_column_name(spark, folder):
    got = {r.id: r for r in readers.read_folder(spark, str(folder)).collect()}
    assert sorted(got, key=int) == [str(i) for i in range(1, 12)]
    assert (got["1"].name, got["3"].name, got["3"].nace, got["4"].url, got["5"].tags) == ("Ann, Co", "Cee", "11", "d.com", "[1]")
    assert got["3"].source_path.endswith("two.csv") and got["11"].source_path.endswith("eight.dta") and got["6"].name is None
    with pytest.raises(ValueError, match="no table"):
        (folder / "empty").mkdir()
        (folder / "empty" / "x.unknown").write_text("")
        readers.read_folder(spark, str(folder / "empty"))


def test_loading_as_one_call(spark, folder):
    raw = ingest.from_files(readers.read_folder(spark, str(folder)))
    one = lambda k, label: spark.createDataFrame([(k, label)], "nace int, label string")
    pairs = one(11, "pair").withColumn("industry", F.lit(1))
    got = {r.root_url: r for r in ingest.load(raw, "ord", pairs, one(11, "by code"), spark.createDataFrame([(1, "x")], "industry int, label string")).collect()}
    assert set(got) == {"https://a.com/", "https://b.com/", "https://c.com/", "https://d.com/", "https://g.com/", "https://j.com/", "https://k.com/"}
    assert set(got["https://a.com/"].company_id.split("|")) == {"1", "5"} and got["https://a.com/"].agg_count == 2
    assert (got["https://c.com/"].industry_label, got["https://c.com/"].industry_label_source) == ("by code", "nace")
    assert got["https://d.com/"].industry_label_source == "unknown"


def test_json_forms(spark, tmp_path):
    for name, value, want in (("list", [{"a": 1}, {"b": "x"}], 2), ("single", {"a": 1}, 1), ("rows", {"rows": [{"a": 1}]}, 1), ("bad", [1, 2], 0)):
        (tmp_path / f"{name}.json").write_text(json.dumps(value))
        assert readers.read_json(spark, str(tmp_path / f"{name}.json")).count() == want


def test_sqlite_by_status(spark, tmp_path):
    con = sqlite3.connect(tmp_path / "s.db")
    con.execute("CREATE TABLE companies (company_id TEXT, status TEXT, n INTEGER)")
    con.executemany("INSERT INTO companies VALUES (?, ?, ?)", [("a", "pending", 1), ("b", "llm_done", None), ("c", "it's", 3)])
    con.commit()
    con.close()
    path = str(tmp_path / "s.db")
    ids = lambda *a: sorted(r.company_id for r in readers.read_sqlite(spark, path, "companies", *a).collect())
    assert ids() == ["a", "b", "c"] and ids(["pending", "it's"]) == ["a", "c"] and ids(["pending"], True) == ["b", "c"]
    assert {r.company_id: r.n for r in readers.read_sqlite(spark, path, "companies").collect()} == {"a": "1", "b": None, "c": "3"}
    with pytest.raises(ValueError, match="table"):
        readers.read_sqlite(spark, path, "a; drop")


def test_ods(spark, tmp_path):
    ns = 'xmlns:office="o" xmlns:table="urn:oasis:names:tc:opendocument:xmlns:table:1.0" xmlns:text="urn:oasis:names:tc:opendocument:xmlns:text:1.0"'
    cell = lambda v, more="": f"<table:table-cell{more}><text:p>{v}</text:p></table:table-cell>"
    body = f'<table:table-row>{cell("id")}{cell("v")}{cell("w")}</table:table-row><table:table-row table:number-rows-repeated="2">{cell("1")}{cell("x", " table:number-columns-repeated=\'2\'")}</table:table-row>'
    with zipfile.ZipFile(tmp_path / "t.ods", "w") as z:
        z.writestr("content.xml", f"<office:document {ns}><table:table>{body}</table:table></office:document>")
    assert rows(readers.read_table(spark, str(tmp_path / "t.ods"))) == [("1", "x", "x")] * 2


def test_log_lines_are_numbered_over_blocks(spark, tmp_path):
    for k, n in enumerate((1, 5000, 0)):
        (tmp_path / f"{k}.log").write_text("".join(f"line {i} of {k}\r\n" if i % 2 else f"line {i} of {k}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        got = readers.read_log_lines(spark, str(tmp_path / "*.log")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 5001
    assert all(r.line == f"line {r.line_no - 1} of {r.log_path[-5]}" for r in got)


def test_strict_tables_and_ids(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,label\n 1 ,a\n,\n2,\n")
    assert readers.read_strict(spark, str(tmp_path / "t.csv"), ["id", "label"]).count() == 2
    assert rows(readers.read_ids(spark, str(tmp_path / "t.csv"), "id")) == [("1",), ("2",)]
    (tmp_path / "e.csv").write_text("id,label\n")
    with pytest.raises(ValueError, match="empty"):
        readers.read_strict(spark, str(tmp_path / "e.csv"), ["id"])
    with pytest.raises(ValueError, match="other"):
        readers.read_strict(spark, str(tmp_path / "t.csv"), ["other"])
    with pytest.raises(ValueError, match="no reader"):
        readers.read_table(spark, "x.unknown")


def test_taxonomy_as_published(spark):
    cols = list(match.TAXONOMY)
    data = [("about", "", "", "", "", "text"), ("010001", "1", "", "p", "", "glue [adhesive]"), (match.HEADING, "1", "", "", "", "Class 1"), ("", "1", "", "", "", "no number"), ("010002", "1", "", "", "", " ")]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], ["n", *cols])
    got = match.taxonomy_rows(table, "n").first()
    assert (got.token_id, got.label, got.cl) == ("010001", "glue [adhesive]", "1")
    assert match.taxonomy_rows(table, "n").count() == 1
    with pytest.raises(ValueError, match="Cl"):
        match.taxonomy_rows(table.drop("Cl."), "n")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(i, f'a"{i}, b') for i in range(50)], "n int, v string")
    sinks.write_ordered(df, str(tmp_path / "o"), "n")
    lines = [x for p in sorted((tmp_path / "o").glob("part-*")) for x in p.read_text().splitlines()[1:]]
    assert [int(x.split(",")[0]) for x in lines] == list(range(50))
    for ending in ("csv", "tsv", "json", "parquet", "orc"):
        path = str(tmp_path / f"t.{ending}")
        sinks.write_table(df, path, one_file=True)
        if ending in ("csv", "tsv", "parquet"):
            assert rows(readers.read_table(spark, path)) == rows(df)
    with pytest.raises(ValueError, match="no writer"):
        sinks.write_table(df, str(tmp_path / "t.what"))


def test_index_documents_round_trip(spark):
    entries = spark.createDataFrame([("a", "u1", "markdown_done"), ("a", "u2", None), ("b", "u1", "x")], "company_id string, url string, status string")
    back = readers.index_entries(sinks.index_documents(entries))
    assert rows(back.select("company_id", "url", "status")) == rows(entries)
    meta = spark.createDataFrame([("a", '{"__meta__": {"total_pages": 3, "crawl_finished": true}, "u": {}}')], "company_id string, value string")
    assert readers.index_meta(meta).first().total_pages == 3 and readers.index_entries(meta).count() == 1
