"""Corrupt JSON files from real bytes, and the tables that mend their companies."""

from pyspark.sql import functions as F

from sievemark.operators import calibrate

FILES = {
    "ok": b'{"a": 1}', "twice": b'{"a": 1, "a": 2}', "nan": b' {"a": NaN}\n', "empty": b"", "nul": b"\x00" * 20, "late": b'{"a": "' + b"x" * 300 + b'\x00"}', "early": b"\n\t \x00{}", "inner": b'{"a\x00": 1}', "utf8": b'{"a": "\xc3"}',
    "blank": b" \n\r\t", "cut": b'{"a": ', "more": b'{"a": 1} x', "list": b"[1]", "word": b'"a"', "null": b"null",
}
WANT = {
    "empty": "empty", "nul": "nul_bytes_prefix_or_early", "early": "nul_bytes_prefix_or_early", "late": "json_parse_error", "inner": "json_parse_error", "utf8": "non_utf8_bytes", "blank": "whitespace_only", "cut": "json_parse_error", "more": "json_parse_error",
    "list": "json_not_dict", "word": "json_not_dict", "null": "json_not_dict",
}


def test_scan_and_fix(spark, tmp_path):
    for name, content in FILES.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "url_index.json").write_bytes(content)
    files = spark.read.format("binaryFile").load(f"file://{tmp_path}/*/url_index.json")
    listed = spark.createDataFrame([(f"file:{tmp_path}/{name}/url_index.json",) for name in FILES], "path string")
    corrupt = calibrate.corrupt_files(files, F.element_at(F.split("path", "/"), -2), listed)
    got = {r.company_id: r for r in corrupt.collect()}
    assert {k: r.reason for k, r in got.items()} == WANT
    assert got["cut"].head_bytes_hex == FILES["cut"].hex() and got["cut"].size_bytes == 6 and got["blank"].head_text_preview == " \\n\\r\\t"
    assert got["utf8"].head_text_preview == '{"a": "�"}' and len(got["late"].head_bytes_hex) == 160
    companies = spark.createDataFrame([(n, "llm_done", 3, 2, 1, "r") for n in FILES if n != "word"], "company_id string, status string, urls_total int, urls_md int, urls_llm int, done_reason string")
    runs = spark.createDataFrame([("r1", "2024-01-01"), ("r2", "2024-02-01")], "run_id string, started_at string")
    done = spark.createDataFrame([(r, n) for r in ("r1", "r2") for n in ("ok", "cut", "list")], "run_id string, company_id string")
    renames, mended, left, report = calibrate.corruption_fix(corrupt, companies, runs, done, "7")
    assert renames.count() == len(WANT) - 1 and all(r.aside == r.path + ".corrupt.7" for r in renames.collect())
    rows = {r.company_id: r for r in mended.collect()}
    assert (rows["cut"].status, rows["cut"].urls_total, rows["cut"].done_reason, rows["cut"].last_error) == ("pending", 0, None, "corrupt_url_index_json")
    assert (rows["ok"].status, rows["ok"].urls_total, rows["ok"].last_error) == ("llm_done", 3, None)
    assert sorted(map(tuple, left.collect())) == [("r1", "cut"), ("r1", "list"), ("r1", "ok"), ("r2", "ok")]
    assert report.first().asDict() == {"scanned_companies": 14, "affected_companies": 11, "quarantined_files": 11, "run_done_unmarked": 2}
