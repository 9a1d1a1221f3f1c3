"""Page results as they arrive: gating and error flags are a projection, the same for batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.errors import page_error
from ..functions.gating import gate
from ..operators.state import fold_log

FIELDS = ("status", "status_code", "gating_action", "gating_reason", "markdown_done", "error_kind")


def index_patches(pages: DataFrame) -> DataFrame:
    """company_id, url, ord and the index fields of each page result (markdown, error, status_code). Memory goes before timeout, and both before gating."""
    g, kind = gate(F.col("markdown")), page_error(F.col("error"))
    status = F.when(kind == "memory", "memory_pressure").when(kind == "timeout", "timeout").when(g["action"] == "save", "markdown_saved").otherwise("markdown_suppressed")
    return pages.select("company_id", "url", "ord", status.alias("status"), "status_code", g["action"].alias("gating_action"), g["reason"].alias("gating_reason"), (status == "markdown_saved").alias("markdown_done"), kind.alias("error_kind"))


def write_index(pages: DataFrame, path: str, checkpoint: str):
    """Start a query that appends patches to a change log; ``read_index`` folds it. Appending and folding keep writers from rewriting a whole index."""
    return index_patches(pages).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def read_index(log: DataFrame) -> DataFrame:
    """The current entry of each URL: of each field the last value that is known."""
    return fold_log(log, ["company_id", "url"], "ord", FIELDS)


def event_windows(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by event type and tumbling window, with a watermark for late events."""
    rows = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return rows.select(F.col("window.start").alias("start"), "event_type", "n", "total")
