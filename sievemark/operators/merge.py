"""Merging tables of several run roots: which row or field wins."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import MERGE_RANK, epoch_seconds, rank


def best_rows(sources: Sequence[DataFrame], keys: Sequence[str], order: Sequence[Column], later_wins: bool = False) -> DataFrame:
    """One row per key of the sources' union by the given order; ties go to the earlier source, or the later one."""
    marked = [df.withColumn("_src", F.lit(k)) for k, df in enumerate(sources)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, F.col("_src").desc() if later_wins else F.col("_src").asc()))
    return rows.withColumn("_turn", turn).where("_turn = 1").drop("_turn", "_src")


def merge_tables(base: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """Union of headers and rows, one row per id, ``base`` first; blanks for columns a table lacks."""
    rows = best_rows([base, more], [key], [])
    return rows.na.fill("")


def merge_companies(target: DataFrame, source: DataFrame) -> DataFrame:
    """The further status wins, then the newer row, then the target's."""
    return best_rows([target, source], ["company_id"], [rank(F.col("status"), MERGE_RANK).desc(), epoch_seconds(F.col("updated_at")).desc()])


def merge_retry(target: DataFrame, source: DataFrame) -> DataFrame:
    """The newer state wins, then the one with more attempts, then the target's."""
    return best_rows([target, source], ["company_id"], [F.col("updated_at").desc_nulls_last(), F.col("attempts").desc_nulls_last()])


def merge_quarantine(target: DataFrame, source: DataFrame) -> DataFrame:
    """The newer entry wins; of equal ones the source's."""
    return best_rows([target, source], ["company_id"], [F.col("ts").desc_nulls_last()], later_wins=True)


def replace_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows by primary key; the source's replaces the target's."""
    return best_rows([target, source], keys, [], later_wins=True)


def merge_index(target: DataFrame, source: DataFrame, fields: Sequence[str]) -> DataFrame:
    """company_id, url and ``fields`` of two indexes with md_done and llm_done.

    An entry with a higher score (2 for extraction, 1 for Markdown) replaces the other as a whole; at equal scores the source
    fills the target's blanks; a lower one is ignored.
    """
    score = lambda side: 2 * F.col(f"{side}.llm_done").cast("int") + F.col(f"{side}.md_done").cast("int")
    t, s = target.alias("t"), source.alias("s")
    rows = t.join(s, (F.col("t.company_id") == F.col("s.company_id")) & (F.col("t.url") == F.col("s.url")), "full_outer")
    whole = F.col("t.url").isNull() | F.coalesce(score("s") > score("t"), F.lit(False))
    fill = F.coalesce(score("s") == score("t"), F.lit(False))

    def pick(c: str) -> Column:
        a, b = F.col(f"t.{c}"), F.col(f"s.{c}")
        blank = F.coalesce(a.cast("string"), F.lit("")) == ""
        return F.when(whole, b).when(fill & blank, b).otherwise(a).alias(c)

    return rows.select(F.coalesce("t.company_id", "s.company_id").alias("company_id"), F.coalesce("t.url", "s.url").alias("url"), *(pick(c) for c in ("md_done", "llm_done", *fields)))


def merge_indexes(indexes: Sequence[DataFrame], fields: Sequence[str]) -> DataFrame:
    """Many indexes as ``merge_index`` would merge them one after the other: filling blanks does not commute.

    All entries of a page meet in one shuffle and are folded in the order of their indexes.
    """
    cols = ["md_done", "llm_done", *fields]
    marked = [df.select("company_id", "url", F.struct(F.lit(k).alias("_src"), *(F.col(f"`{c}`") for c in cols)).alias("_e")) for k, df in enumerate(indexes)]
    grouped = reduce(DataFrame.unionByName, marked).groupBy("company_id", "url").agg(F.array_sort(F.collect_list("_e")).alias("_all"))
    score = lambda e: 2 * e["llm_done"].cast("int") + e["md_done"].cast("int")

    def step(acc: Column, e: Column) -> Column:
        whole, fill = F.coalesce(score(e) > score(acc), F.lit(False)), F.coalesce(score(e) == score(acc), F.lit(False))
        pick = lambda c: F.when(whole | (fill & (F.coalesce(acc[c].cast("string"), F.lit("")) == "")), e[c]).otherwise(acc[c])
        return F.struct(acc["_src"].alias("_src"), *(pick(c).alias(c) for c in cols))

    folded = grouped.select("company_id", "url", F.aggregate(F.slice("_all", F.lit(2), F.size("_all")), F.col("_all")[0], step).alias("_e"))
    return folded.select("company_id", "url", *(F.col("_e")[c].alias(c) for c in cols))


@dataclass(frozen=True)
class Root:
    """The tables of a run root; None where it has none.

    companies: company_id, status, updated_at. runs: run_id. done: run_id, company_id. retry: company_id, updated_at, attempts. quarantine: company_id, ts.
    index: company_id, url, md_done, llm_done. ledger: any columns. Other columns go along.
    """

    companies: DataFrame | None = None
    runs: DataFrame | None = None
    done: DataFrame | None = None
    retry: DataFrame | None = None
    quarantine: DataFrame | None = None
    index: DataFrame | None = None
    ledger: DataFrame | None = None


def merge_roots(target: Root, sources: Sequence[Root], fields: Sequence[str], include_ledger: bool = False) -> Root:
    """The roots' tables merged into the target's, as if one source came after the other. Each table takes one shuffle, however many roots there are.

    Companies: the further status, then the newer row, then the earlier root. Runs and done rows: the first of a key. Retry states: the newer, then that with more
    attempts, then the earlier root; quarantine: the newer, then the later root. Index entries are folded in order (``merge_indexes``). Ledger lines
    are appended with the number of their root in ``root`` if ``include_ledger``, else the target's stay alone.
    """
    if not sources:
        raise ValueError("a merge needs at least one source")
    roots = [target, *sources]

    def merged(table: str, how: Callable[[list[DataFrame]], DataFrame]) -> DataFrame | None:
        tables = [df for r in roots if (df := getattr(r, table)) is not None]
        return how(tables) if tables else None

    status = [rank(F.col("status"), MERGE_RANK).desc(), epoch_seconds(F.col("updated_at")).desc_nulls_last()]
    lines = [r.ledger.withColumn("root", F.lit(k)) for k, r in enumerate(roots) if r.ledger is not None and (include_ledger or k == 0)]
    return Root(
        companies=merged("companies", lambda x: best_rows(x, ["company_id"], status)),
        runs=merged("runs", lambda x: best_rows(x, ["run_id"], [])),
        done=merged("done", lambda x: best_rows(x, ["run_id", "company_id"], [])),
        retry=merged("retry", lambda x: best_rows(x, ["company_id"], [F.col("updated_at").desc_nulls_last(), F.col("attempts").desc_nulls_last()])),
        quarantine=merged("quarantine", lambda x: best_rows(x, ["company_id"], [F.col("ts").desc_nulls_last()], later_wins=True)),
        index=merged("index", lambda x: merge_indexes(x, fields)),
        ledger=reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lines) if lines else None,
    )


def merge_report(sources: Sequence[Root]) -> DataFrame:
    """One row: merged_company_ids, the distinct companies of the sources, and ledger_lines, the lines that they bring."""
    ids = [r.companies.select(F.col("company_id").cast("string").alias("id")) for r in sources if r.companies is not None]
    lines = [r.ledger.select(F.lit(None).cast("string").alias("id")) for r in sources if r.ledger is not None]
    both = reduce(DataFrame.unionByName, [*(x.distinct().withColumn("line", F.lit(0)) for x in ids), *(x.withColumn("line", F.lit(1)) for x in lines)])
    return both.groupBy("id").agg(F.sum("line").alias("lines")).agg(F.count("id").alias("merged_company_ids"), F.coalesce(F.sum("lines"), F.lit(0)).alias("ledger_lines"))


def split_root(companies: DataFrame, dataset_ids: DataFrame, chosen: DataFrame | None = None, not_done: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, rows that move): candidates are in the dataset and, if asked, not done; ``chosen`` ids restrict them."""
    moved = companies.join(dataset_ids.select("company_id").distinct(), "company_id", "left_semi")
    if not_done:
        moved = moved.where(~F.col("status").isin("llm_done", "terminal_done"))
    if chosen is not None:
        moved = moved.join(chosen.select("company_id").distinct(), "company_id", "left_semi")
    return companies.join(moved.select("company_id"), "company_id", "left_anti"), moved


def better_files(target: DataFrame, source: DataFrame) -> DataFrame:
    """path, length, modified of two trees: the larger file wins, then the newer, then the target's."""
    return best_rows([target, source], ["path"], [F.col("length").desc(), F.col("modified").desc()])
