"""Readers by file ending, and readers of the state files that a crawl leaves.

Formats that Spark splits are read by Spark. The rest (Stata, SAS, SPSS, Excel, ODS) have no splittable layout: each file is one
row of Spark's binary scan and is parsed inside its task, so many files are read side by side.
"""

from __future__ import annotations

import io
import os
import sqlite3
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import closing
from functools import reduce
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Paths = str | list[str]
Reader = Callable[[SparkSession, Paths], DataFrame]
ENTRY = "struct<status:string,markdown_path:string,markdown_done:boolean,llm_done:boolean,product_path:string,gating_action:string,gating_reason:string,error:string,status_code:int,depth:int>"
META = "struct<crawl_finished:boolean,total_pages:int,markdown_saved:int,markdown_suppressed:int,timeout_pages:int,memory_pressure_pages:int>"


def _source() -> Column:
    """The file that a row was read from."""
    return F.col("_metadata.file_path").alias("source_path")


def _text_columns(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and, of the map of texts ``m``, a column for each key, in order; a row without a key has null there."""
    names = sorted(r.k for r in rows.select(F.explode(F.map_keys("m")).alias("k")).distinct().collect())
    return rows.select(*keep, *(F.col("m")[n].alias(n) for n in names))


def read_csv(spark: SparkSession, path: Paths, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """Delimited text with a header; all values are text. A large file is read by many tasks, unless ``multi_line``, which allows line ends within quotes."""
    return spark.read.csv(path, sep=sep, header=True, inferSchema=False, multiLine=multi_line, escape='"')


def read_tsv(spark: SparkSession, path: Paths, multi_line: bool = False) -> DataFrame:
    return read_csv(spark, path, "\t", multi_line)


def _json_lines(spark: SparkSession, path: Paths) -> DataFrame:
    return spark.read.text(path).select(_source(), F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"}).alias("m"), F.try_parse_json("value").alias("v")).where(F.col("v").isNotNull() & F.col("m").isNotNull()).drop("v")


def _json(spark: SparkSession, path: Paths) -> DataFrame:
    text = spark.read.text(path, wholetext=True).select(_source(), F.trim("value").alias("value"))
    body = F.coalesce(*(F.get_json_object("value", f"$.{k}") for k in ("data", "records", "items", "rows")), F.col("value"))
    items = F.when(F.trim(body).startswith("["), F.from_json(body, "array<variant>")).otherwise(F.array(F.try_parse_json(body)))
    objects = text.select("source_path", F.explode(items).alias("v")).select("source_path", F.to_json("v").alias("j")).where(F.col("j").startswith("{"))
    return objects.select("source_path", F.from_json("j", "map<string,string>").alias("m"))


def read_json_lines(spark: SparkSession, path: Paths) -> DataFrame:
    """One object a line, as text columns; nested values are JSON. Lines that do not parse are left out."""
    return _text_columns(_json_lines(spark, path), [])


def read_json(spark: SparkSession, path: Paths) -> DataFrame:
    """A list of objects, an object with the list under data, records, items or rows, or a single object, as text columns; nested values are JSON."""
    return _text_columns(_json(spark, path), [])


def read_parquet(spark: SparkSession, path: Paths) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def _ods(raw: bytes) -> pd.DataFrame:
    """The first sheet of an ODS file: repeated cells are laid out, the first filled row is the header."""
    ns = {"t": "urn:oasis:names:tc:opendocument:xmlns:table:1.0", "x": "urn:oasis:names:tc:opendocument:xmlns:text:1.0"}
    t = f"{{{ns['t']}}}"
    grid: list[list[str]] = []
    sheet = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(raw)).read("content.xml")).find(".//t:table", ns)
    for row in [] if sheet is None else sheet.iter(f"{t}table-row"):
        cells: list[str] = []
        for cell in row:
            text = "\n".join("".join(p.itertext()) for p in cell.findall("x:p", ns))
            n = int(cell.get(f"{t}number-columns-repeated", "1"))
            cells += [text] * (n if text else min(n, 256))
        while cells and not cells[-1]:
            cells.pop()
        if cells:
            grid += [cells] * min(int(row.get(f"{t}number-rows-repeated", "1")), 1_000_000)
    if not grid:
        return pd.DataFrame()
    head = grid[0]
    return pd.DataFrame([(r + [""] * len(head))[: len(head)] for r in grid[1:]], columns=head)


def _spss(raw: bytes) -> pd.DataFrame:
    """SPSS needs ``pyreadstat``, which reads from a name; the file is in memory under one."""
    import pyreadstat

    with open(f"/dev/fd/{os.memfd_create('sav')}", "r+b") as f:
        f.write(raw)
        f.flush()
        return pyreadstat.read_sav(f.name)[0]


PARSERS: dict[str, Callable[[bytes], pd.DataFrame]] = {
    "dta": lambda raw: pd.read_stata(io.BytesIO(raw), convert_categoricals=False),
    "sas7bdat": lambda raw: pd.read_sas(io.BytesIO(raw), format="sas7bdat", encoding="utf-8"),
    "xlsx": lambda raw: pd.read_excel(io.BytesIO(raw), dtype=str),
    "xls": lambda raw: pd.read_excel(io.BytesIO(raw), dtype=str),
    "feather": lambda raw: pd.read_feather(io.BytesIO(raw)),
    "sav": lambda raw: _spss(raw),
    "ods": _ods,
}


def _sqlite(table: str, statuses: Sequence[str] = (), without: bool = False) -> Callable[[bytes], pd.DataFrame]:
    """A parser of one table of a SQLite file, whose rows SQLite itself picks by status."""
    if not table.isidentifier():
        raise ValueError(f"table {table!r}")
    marks = ", ".join("?" * len(statuses))
    where = f" WHERE status {'NOT IN' if without else 'IN'} ({marks})" if statuses else ""

    def parse(raw: bytes) -> pd.DataFrame:
        with closing(sqlite3.connect(":memory:")) as con:
            con.deserialize(raw)
            found = con.execute(f"SELECT * FROM {table}{where}", list(statuses))
            return pd.DataFrame(found.fetchall(), columns=[c[0] for c in found.description], dtype=object)

    return parse


def _cells(rows: pd.DataFrame) -> list[dict[str, str]]:
    rows = rows.rename(columns=str).astype(object)
    return [{k: str(v) for k, v in r.items() if not pd.isna(v)} for r in rows.to_dict("records")]


def _parsed(spark: SparkSession, path: Paths, parse: Callable[[bytes], pd.DataFrame]) -> DataFrame:
    """source_path and a map of texts for each row of whole files; each file is parsed in the task that reads it."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("source_path"), "content")

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for source, raw in zip(pdf["source_path"], pdf["content"], strict=True):
                cells = _cells(parse(bytes(raw)))
                yield pd.DataFrame({"source_path": [source] * len(cells), "m": cells})

    return files.mapInPandas(part, "source_path string, m map<string,string>")


def read_sqlite(spark: SparkSession, path: Paths, table: str, statuses: Sequence[str] = (), without: bool = False) -> DataFrame:
    """A table of SQLite files as text columns, with the rows of some statuses, or of all others."""
    return _text_columns(_parsed(spark, path, _sqlite(table, statuses, without)), [])


def _whole(kind: str) -> Reader:
    def read(spark: SparkSession, path: Paths) -> DataFrame:
        """Rows of whole files as text columns."""
        return _text_columns(_parsed(spark, path, PARSERS[kind]), [])

    return read


REGISTRY: dict[str, Reader] = {"csv": read_csv, "txt": read_csv, "tsv": read_tsv, "json": read_json, "jsonl": read_json_lines, "ndjson": read_json_lines, "parquet": read_parquet, **{k: _whole(k) for k in PARSERS}}


def register(ending: str, reader: Reader) -> None:
    """Add a reader, or replace the one for an ending."""
    REGISTRY[ending.lower().lstrip(".")] = reader


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table by its path's ending."""
    ending = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if ending not in REGISTRY:
        raise ValueError(f"no reader for {path!r}")
    return REGISTRY[ending](spark, path)


def _headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The files of each first line; only the first block of each file is read."""
    first = spark.read.text(paths).select(_source(), F.col("_metadata.file_block_start").alias("at"), "value").where("at = 0").groupBy("source_path").agg(F.first("value").alias("head"))
    return {r["head"]: sorted(r.paths) for r in first.groupBy("head").agg(F.collect_list("source_path").alias("paths")).collect()}


def _with_path(spark: SparkSession, ending: str, paths: list[str]) -> DataFrame:
    """All files of one ending, read together: text columns, and the file in ``source_path``."""
    if ending in ("csv", "txt", "tsv"):
        parts = [REGISTRY[ending](spark, own).select("*", _source()) for own in _headers(spark, paths).values()]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if ending in ("json", "jsonl", "ndjson"):
        return _text_columns((_json if ending == "json" else _json_lines)(spark, paths), ["source_path"])
    if ending in PARSERS:
        return _text_columns(_parsed(spark, paths, PARSERS[ending]), ["source_path"])
    if ending == "parquet":
        return spark.read.option("mergeSchema", "true").parquet(*paths).select("*", _source())
    return REGISTRY[ending](spark, paths).select("*", _source())


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    """All tables below a folder whose endings are known, by column name, as text, with the file in ``source_path``.

    The files of an ending are one scan (delimited ones: one for each header), however many they are; only names come to the driver.
    """
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).alias("e"))
    found = {r.e: sorted(r.paths) for r in names.where(F.col("e").isin(*REGISTRY)).groupBy("e").agg(F.collect_list("path").alias("paths")).collect()}
    if not found:
        raise ValueError(f"no table below {folder!r}")
    parts = [_with_path(spark, e, found[e]) for e in sorted(found)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in p.columns)) for p in parts])


def read_ids(spark: SparkSession, path: Paths, column: str) -> DataFrame:
    """The ids of a delimited file's column, trimmed, without blanks."""
    rows = read_csv(spark, path)
    if column not in rows.columns:
        raise ValueError(f"column {column!r} not in {rows.columns}")
    return rows.select(F.trim(column).alias(column)).where(F.col(column) != "")


def read_strict(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A lookup table: it must have the columns and a row; rows that are blank in all of them go."""
    rows = read_table(spark, path)
    if missing := [c for c in columns if c not in rows.columns]:
        raise ValueError(f"columns {missing} not in {path!r}")
    filled = F.lit(False)
    for c in columns:
        filled = filled | (F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "")
    rows = rows.where(filled)
    if rows.isEmpty():
        raise ValueError(f"{path!r} is empty")
    return rows


def index_entries(docs: DataFrame) -> DataFrame:
    """company_id, url, and the fields of ``ENTRY`` from URL-index documents (company_id, value).

    A document maps URLs to entries; names that start with ``__`` are reserved. Of a URL that a document has twice the last counts.
    """
    pairs = docs.select("company_id", F.posexplode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("_at", "kv"))
    rows = pairs.select("company_id", F.col("kv.key").alias("url"), "_at", F.col("kv.value").alias("j")).where(~F.col("url").startswith("__"))
    last = rows.groupBy("company_id", "url").agg(F.max_by("j", "_at").alias("j"))
    return last.select("company_id", "url", F.from_json("j", ENTRY).alias("e")).select("company_id", "url", "e.*")


def index_meta(docs: DataFrame) -> DataFrame:
    """company_id and the fields of ``META`` from URL-index documents."""
    meta = F.from_json("value", "map<string,string>")["__meta__"]
    return docs.select("company_id", F.from_json(meta, META).alias("m")).select("company_id", "m.*")


def read_documents(spark: SparkSession, glob: str) -> DataFrame:
    """company_id (the folder's name), file, value of whole text files."""
    rows = spark.read.text(glob, wholetext=True)
    name = F.split(F.input_file_name(), "/")
    return rows.select(F.element_at(name, -2).alias("company_id"), F.element_at(name, -1).alias("file"), "value")


def read_log_lines(spark: SparkSession, glob: str) -> DataFrame:
    """log_path, line_no, line of log files, gzip ones too. A large plain file is read in blocks, and lines are numbered over them."""
    place = [F.col("_metadata.file_path").alias("log_path"), F.col("_metadata.file_block_start").alias("block")]
    rows = spark.read.text(glob, lineSep="\n").select(*place, F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", r"\r\z", "").alias("line"))
    # a block is read by one task in order, so its first id tells a line's place in it; only block sizes are summed
    blocks = rows.groupBy("log_path", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("log_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("log_path", "block", "first", before.alias("before"))
    return rows.join(blocks, ["log_path", "block"]).select("log_path", (F.col("at") - F.col("first") + F.col("before") + 1).alias("line_no"), "line")


def markdown_pages(entries: DataFrame, files: DataFrame, strict: bool = False) -> DataFrame:
    """company_id, file, url, value: Markdown files with the URL whose entry names them; without one the URL is empty, or an error if ``strict``."""
    named: Column = F.element_at(F.split("markdown_path", r"[/\\]"), -1)
    known = entries.where(F.col("markdown_path").isNotNull()).groupBy("company_id", named.alias("file")).agg(F.min("url").alias("url"), F.count_distinct("url").alias("n"))
    rows = files.join(known, ["company_id", "file"], "left")
    if strict:
        bad = F.col("url").isNull() | (F.col("n") > 1)
        return rows.withColumn("url", F.when(bad, F.raise_error(F.concat(F.lit("no single URL for "), F.col("file")))).otherwise(F.col("url"))).drop("n")
    return rows.withColumn("url", F.coalesce("url", F.lit(""))).drop("n")
