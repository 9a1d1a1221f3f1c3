"""Writers. Spark's commit protocol makes them whole or absent; one file only where it is asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import artifact_name


def write_table(df: DataFrame, path: str, one_file: bool = False, mode: str = "errorifexists") -> None:
    """Write by the path's ending: csv, tsv, json, jsonl, orc or parquet."""
    ending = path.rsplit(".", 1)[-1].lower()
    out = (df.coalesce(1) if one_file else df).write.mode(mode)
    if ending in ("csv", "tsv"):
        out.csv(path, header=True, sep="\t" if ending == "tsv" else ",", escape='"')
    elif ending in ("json", "jsonl"):
        out.json(path)
    elif ending in ("parquet", "orc"):
        out.format(ending).save(path)
    else:
        raise ValueError(f"no writer for {path!r}")


def write_artifacts(df: DataFrame, path: str, stage: str) -> None:
    """Pages of a stage (company_id, url, body) as Parquet by stage, with the file name that a page would have."""
    df.withColumn("stage", F.lit(stage)).withColumn("name", artifact_name(F.col("url"))).write.mode("append").partitionBy("stage").parquet(path)


def write_hits(df: DataFrame, path: str) -> None:
    """Log hits as JSON in a folder for each company."""
    df.write.mode("overwrite").partitionBy("company_id").json(path)


def index_documents(entries: DataFrame) -> DataFrame:
    """company_id, value: entries as one JSON document per company, URLs in order."""
    fields = [c for c in entries.columns if c not in ("company_id", "url")]
    rows = entries.groupBy("company_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("url", F.struct(*fields).alias("e"))))).alias("m"))
    return rows.select("company_id", F.to_json("m").alias("value"))


def append_events(df: DataFrame, path: str) -> None:
    """Ledger events as JSON lines, added to what is there."""
    df.write.mode("append").json(path)


def write_ordered(df: DataFrame, path: str, order: str, mode: str = "errorifexists") -> None:
    """Delimited text in the order of a column: part files follow one another, each has the header."""
    df.repartitionByRange(F.col(order)).sortWithinPartitions(order).write.mode(mode).csv(path, header=True, escape='"')
