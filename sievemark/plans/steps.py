"""A JSON list of steps as one lazy DataFrame: no step is run or written on its own."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dataset as d


def _select(df: DataFrame, s: Mapping[str, Any], tables: Mapping[str, DataFrame]) -> DataFrame:
    sizes = d.allocate(d.group_counts(df, s["by"]), s.get("total"), s.get("cap"), s.get("min", 0), s.get("max"))
    return d.take_per_group(df, s["by"], sizes, s["order"], s.get("how", "first"), s.get("seed", 0))


VERBS: dict[str, Callable[[DataFrame, Mapping[str, Any], Mapping[str, DataFrame]], DataFrame]] = {
    "copy": lambda df, s, t: d.project(df, s.get("keep"), s.get("rename"), s.get("first")),
    "filter": lambda df, s, t: d.where_all(df, s["where"]),
    "sort": lambda df, s, t: d.sort_rows(df, s["by"], s["order"], s.get("desc", False)),
    "dedup": lambda df, s, t: d.dedup(df, s["keys"], s["order"], s.get("keep", "first")),
    "join": lambda df, s, t: d.join_tables(df, t[s["table"]], s["on"], s.get("how", "left")),
    "idcopy": lambda df, s, t: d.semi_by_id(df, t[s["table"]], s["on"], s.get("id")),
    "append": lambda df, s, t: d.append(df, t[s["table"]]),
    "split": lambda df, s, t: d.split_parts(df, s["order"], s.get("parts"), s.get("chunk")),
    "select": _select,
    "stats": lambda df, s, t: d.group_counts(df, s["by"]) if s.get("by") else d.null_counts(df),
    "schema": lambda df, s, t: d.schema_of(df),
    "limit": lambda df, s, t: df.orderBy(F.col(s["order"])).limit(s["n"]),
}


def run_steps(source: DataFrame, steps: str | list[Mapping[str, Any]], tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Apply steps (each with ``verb`` and its arguments) to ``source``; ``tables`` holds the frames that joins name."""
    for step in json.loads(steps) if isinstance(steps, str) else steps:
        if step["verb"] not in VERBS:
            raise ValueError(f"verb {step['verb']!r}")
        source = VERBS[step["verb"]](source, step, tables or {})
    return source
