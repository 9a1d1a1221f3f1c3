"""Regex scan of log lines with context; hits inside the lines after a hit are skipped."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import safe_id
from ..shared import table

ID_LINE = r"(?:company_id|bvdid)[=:\s]+\"?([A-Za-z0-9_*.\-]+)"


def level(line: Column, default: str = "INFO") -> Column:
    out = F.lit(default)
    for name in ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"):
        out = F.when(line.rlike(rf"\b{name}\b"), name).otherwise(out)
    return out


def scan(lines: DataFrame, patterns: Sequence[str], tokens: Sequence[str] = (), before: int = 2, after: int = 2, default: str = "INFO", block: int = 1 << 16) -> DataFrame:
    """log_path, line_no, company_id, level, message, context_before, context_after of the hits.

    lines: log_path, line_no (one row a number; contexts are lines with the numbers before and after), line. A line is a candidate if it has one of the ``tokens`` (where there are any) and
    matches a pattern. A hit's ``after`` lines are passed over, and the id of the last line that names one is carried on, except from lines passed
    over.

    The walk goes by blocks of lines, so a file, however long, is spread over tasks. All that a block needs from those before it is how many of its
    lines are still passed over, at most ``after``, and the id: each is walked for every such number, what comes out is chained from block to block, and
    the blocks are walked again from where they really begin. Contexts come from windows over blocks, which have copies of the lines around them.
    """
    block = max(block, before + 1, after + 1)
    line, at = F.col("line"), F.col("line_no").cast("long")
    some = F.lit(True)
    if tokens:
        some = F.exists(F.array(*(F.lit(t.lower()) for t in tokens)), lambda t: F.contains(F.lower(line), t))
    found = F.lit(False)
    for p in patterns:
        found = found | line.rlike(p)
    rows = lines.select("log_path", "line_no", "line", F.floor(at / block).alias("_block"), (some & found & (line != "")).alias("_hit"))
    events = rows.select("log_path", "_block", at.alias("n"), F.coalesce("_hit", F.lit(False)).alias("hit"), F.nullif(F.regexp_extract(line, ID_LINE, 1), F.lit("")).alias("id"))
    events = table(events.where("hit OR id IS NOT NULL"), "log-events")
    taken = _taken(events, after, block)

    inside = F.pmod(at, F.lit(block))
    shifts = F.array(F.lit(0), F.when(inside >= block - before, 1), F.when(inside < after, -1))
    copies = rows.withColumn("_shift", F.explode(F.array_compact(shifts))).withColumn("_block", F.col("_block") + F.col("_shift"))
    w = Window.partitionBy("log_path", "_block").orderBy(at)
    context = lambda a, b: F.collect_list("line").over(w.rangeBetween(a, b)) if b >= a else F.array().cast("array<string>")
    near = copies.withColumn("context_before", context(-before, -1)).withColumn("context_after", context(1, after)).where("_hit AND _shift = 0")
    hits = near.join(taken, (near["log_path"] == taken["path"]) & (near["line_no"].cast("long") == taken["n"]))
    return hits.select("log_path", "line_no", F.coalesce("company_id", F.lit("UNKNOWN")).alias("company_id"), level(line, default).alias("level"), line.alias("message"), "context_before", "context_after")


def _runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str], rest: Sequence[str]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Sorted rows by runs of ``keys``; a run's rows are read as they come."""
    every = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in (*keys, *rest)), strict=True))
    for key, own in groupby(every, key=lambda r: r[: len(keys)]):
        yield key, (r[len(keys) :] for r in own)


def _sent(made: Iterator[tuple], names: Sequence[str], types: Sequence[pa.DataType], size: int = 10_000) -> Iterator[pa.RecordBatch]:
    while rows := list(islice(made, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], list(names))


def _taken(events: DataFrame, after: int, block: int) -> DataFrame:
    """path, n, company_id of the hits that count. events: log_path, _block, n, hit, id."""

    def walk(state: list, n: int, hit: bool, id_: str | None) -> bool:
        """Move a state (first line that counts, id) over a line; whether the line is a hit that counts."""
        if n < state[0]:
            return False
        if id_ is not None:
            state[1] = id_
        if hit:
            state[0] = n + after + 1
        return hit

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            for (path, k), lines in _runs(batches, ["log_path", "_block"], ["n", "hit", "id"]):
                live = [[k * block + s, None, [s]] for s in range(after + 1)]  # states that have met go on as one
                for n, hit, id_ in lines:
                    moved = [walk(x, n, hit, id_) or id_ is not None for x in live]
                    if len(live) > 1 and any(moved):
                        met: dict = {}
                        for x in live:
                            met.setdefault((x[0] if x[0] > n else 0, x[1]), [x[0], x[1], []])[2].extend(x[2])
                        live = list(met.values())
                out = {s: (max(0, x[0] - (k + 1) * block), x[1]) for x in live for s in x[2]}
                yield path, k, [out[s][0] for s in range(after + 1)], [out[s][1] for s in range(after + 1)]

        return _sent(made(), ["path", "k", "skips", "ids"], [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string())])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            for (path,), blocks in _runs(batches, ["path"], ["k", "skips", "ids"]):
                last, skip, id_ = None, 0, None
                for k, skips, ids in blocks:
                    skip = skip if last == k - 1 else 0
                    yield path, k, skip, id_
                    last, skip, id_ = k, skips[skip], ids[skip] if ids[skip] is not None else id_

        return _sent(made(), ["path", "k", "skip", "before"], [pa.string(), pa.int64(), pa.int32(), pa.string()])

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            for (path, k), lines in _runs(batches, ["log_path", "_block"], ["n", "hit", "id", "skip", "before"]):
                state = None
                for n, hit, id_, skip, before in lines:
                    state = state or [k * block + skip, before]
                    if walk(state, n, hit, id_):
                        yield path, n, state[1]

        return _sent(made(), ["path", "n", "company_id"], [pa.string(), pa.int64(), pa.string()])

    dealt = lambda df: df.repartition("log_path", "_block").sortWithinPartitions("log_path", "_block", "n")
    sums = dealt(events).mapInArrow(summed, "path string, k long, skips array<int>, ids array<string>")
    entry = sums.repartition("path").sortWithinPartitions("path", "k").mapInArrow(chained, "path string, k long, skip int, before string")
    met = events.join(entry, (events["log_path"] == entry["path"]) & (events["_block"] == entry["k"])).drop("path", "k")
    return dealt(met).mapInArrow(walked, "path string, n long, company_id string")


def by_company(hits: DataFrame) -> DataFrame:
    return hits.groupBy("company_id").agg(F.count("*").alias("hits"), F.min("line_no").alias("first_line"))


def original_ids(keys: DataFrame, source: DataFrame) -> DataFrame:
    """company_id, name, url of keys (key) that are ids or ids made safe as file names; an unknown key stays as it is.

    source: company_id, name, url. Of ids with one safe form the greatest counts.
    """
    known = source.groupBy("company_id").agg(F.max(F.struct("name", "url")).alias("own"))
    safe = known.groupBy(safe_id(F.col("company_id")).alias("key")).agg(F.max("company_id").alias("other"))
    rows = keys.select("key").distinct().join(known.select(F.col("company_id").alias("key"), F.lit(True).alias("is_id")), "key", "left").join(safe, "key", "left")
    rows = rows.select(F.when(F.col("is_id"), F.col("key")).otherwise(F.coalesce("other", "key")).alias("company_id")).distinct()
    return rows.join(known, "company_id", "left").select("company_id", F.coalesce("own.name", F.lit("")).alias("name"), F.coalesce("own.url", F.lit("")).alias("url"))
