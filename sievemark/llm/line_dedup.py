"""Line dedup: lines that many documents share go from all of them. DataFrame functions alone.

A row's lines become hashes of their keys. Exploded once for each row they are counted, summed before the shuffle. Where
ids tell documents apart, rows of an id that repeats count once together; all other rows still count as one each. Exploded by position they meet the frequent hashes in a semi-join, of
which Spark splits hot keys. What comes back to a document is the list of its own positions that go; the text
is then put together again by position, in place. Texts are shuffled once, by row, and line texts never.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, need, packed, row_key, table

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _hash(line: Column, least: int) -> Column:
    """128 bits of a line's key in 32 hex digits, null for a key under ``least`` code points."""
    key = line_key(line)
    return F.when(F.length(key) >= least, F.md5(key.cast("binary")))


def _counted(docs: DataFrame, hashes: Column, by_id: bool) -> DataFrame:
    """h, n: how many rows, or with ``by_id`` how many documents, have a hash."""
    if not by_id:
        once = docs.select(F.explode(hashes).alias("h")).where(F.col("h").isNotNull()).select(F.unhex("h").alias("h"))
        return once.groupBy("h").agg(F.count("*").alias("n"))
    repeated = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("_n")).where("_n > 1")
    repeated = table(repeated.select("doc_id", F.col("doc_id").alias("again")), "repeated-ids")  # few or none as a rule: its size is then known, and it is broadcast
    rows = docs.select("doc_id", hashes.alias("_hs")).join(repeated, "doc_id", "left")
    # the outer form, as for the other Spark would add a filter on the array and hash all lines twice
    once = rows.select("again", F.explode_outer("_hs").alias("h")).where(F.col("h").isNotNull()).select("again", F.unhex("h").alias("h"))
    # rows of ids that do not repeat share the null, so that they are summed before the shuffle
    pairs = once.groupBy("h", "again").agg(F.count("*").alias("_n"))
    return pairs.groupBy("h").agg(F.sum(F.when(F.col("again").isNull(), F.col("_n")).otherwise(1)).alias("n"))


def _cleaned(docs: DataFrame, min_docs: int, min_chars: int, by_id: bool, *replaced: str) -> DataFrame:
    """row (the columns of ``docs`` but for ``replaced``), kept_text, n_lines, n_dropped."""
    need(docs, "doc_id", "text")
    keyed = docs.select(*row_key(column("doc_id"), column("text")), column("doc_id").alias("doc_id"), packed(docs, *replaced))
    text = F.coalesce(F.col("row.text"), F.lit(""))  # read from the row, so that texts are dealt out once
    lines = F.split(text, "\n", -1)
    hashed = F.transform(lines, lambda x: _hash(x, min_chars))
    frequent = _counted(keyed, F.array_distinct(hashed), by_id).where(F.col("n") >= min_docs).select("h")
    frequent = table(frequent, "frequent-lines")  # so that the join deals both sides anew, and Spark can split a hot line
    placed = keyed.select("k1", "k2", F.posexplode(hashed).alias("at", "h")).where(F.col("h").isNotNull()).select("k1", "k2", "at", F.unhex("h").alias("h"))
    hits = placed.join(frequent, "h", "left_semi").groupBy("k1", "k2").agg(F.collect_set("at").alias("hit"))
    rows = keyed.drop("doc_id").join(hits, ["k1", "k2"], "left").select("row", "hit", lines.alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("hit"))
    kept = F.when(F.col("hit").isNull(), text).otherwise(F.array_join(F.transform(stay, lambda i: F.element_at("lines", i + 1)), "\n"))
    n_dropped = F.when(F.col("hit").isNull(), 0).otherwise(F.size("hit"))
    return rows.select("row", kept.alias("kept_text"), F.size("lines").cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"))


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, by_id: bool = False) -> DataFrame:
    """The columns of ``docs`` (doc_id, text), with ``kept_text``, ``n_lines`` and ``n_dropped``.

    A line goes if its key has at least ``min_chars`` code points and at least ``min_docs`` rows have it. A null or
    empty text is one empty line, and stays. Rows count one by one, also if they repeat or their id is null; with
    ``by_id`` the rows of an id count once, and rows without an id still one by one. Columns named as one of the three
    results are replaced, all others stay, whatever their names; an empty table gives no rows.
    """
    results = ("kept_text", "n_lines", "n_dropped")
    return _cleaned(docs, min_docs, min_chars, by_id, *results).select("row.*", *results)


def drop_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with the shared lines taken out of ``text``, and ``n_chars``, where there is one, the new number of code points. Null becomes empty.

    Documents count by id, as in ``line_dedup`` with ``by_id``. All columns stay.
    """
    types = dict(docs.dtypes)
    made = {"text": F.col("kept_text")} | ({"n_chars": F.length("kept_text").cast(types["n_chars"])} if "n_chars" in types else {})
    out = _cleaned(docs, min_docs, min_chars, True)
    return out.select(*(made.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
