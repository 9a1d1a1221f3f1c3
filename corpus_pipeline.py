"""The corpus pipeline: each stage applies one operator to the documents that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.llm import common, decontamination, line_dedup, near_dedup, quality_classifier, source_mix


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_classifier.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that many documents share; ``n_chars`` follows the text."""
    return line_dedup.drop_lines(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dedup.drop_near_duplicates(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix, with ``copies``, how often each is in it, and ``taken``, its words in it; columns of those names are replaced."""
    out = source_mix.mix_sources(docs).where(F.col("copies") > 0)
    more = [c for c in ("size", "source_size", "target") if c not in docs.columns]
    return out.drop(*more)


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("near_dedup", near), ("decontamination", contamination), ("source_mix", mix)]

#: The classifier is fitted, so SQL can't express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written in the shared folder and read again, and goes once the next one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, common.table(stage(spark, docs, sf_dir), name)
        common.release(before)
    return docs
