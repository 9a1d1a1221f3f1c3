"""Verbs on tables: keep, rename, filter, sort, dedup, select, split, join, stats.

Spark has no row order, so every verb that depends on one takes an ``order`` column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.coerce import blank_to_null

NULL_GROUP = "__NA__"


def require(df: DataFrame, names: Sequence[str]) -> None:
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"columns {missing} not in {df.columns}")


def project(df: DataFrame, keep: Sequence[str] | None = None, rename: Mapping[str, str] | None = None, first: Sequence[str] | None = None) -> DataFrame:
    """Keep columns, rename some, and put some first; a missing column raises."""
    if keep:
        require(df, keep)
        df = df.select(*keep)
    if rename:
        require(df, list(rename))
        df = df.withColumnsRenamed(dict(rename))
    if first:
        require(df, first)
        df = df.select(*first, *(c for c in df.columns if c not in first))
    return df


def parse_mapping(text: str) -> dict[str, str]:
    """``a:b,c:d`` as a mapping; a source named twice raises."""
    out: dict[str, str] = {}
    for piece in filter(None, (p.strip() for p in text.split(","))):
        source, sep, target = (x.strip() for x in piece.partition(":"))
        if not sep or not source or not target or source in out:
            raise ValueError(f"mapping {text!r} at {piece!r}")
        out[source] = target
    return out


def condition(text: str) -> Column:
    """``col=value`` or ``col!=value`` on the column's text; a null reads ``nan``."""
    name, negated, value = text.partition("!=")
    if not negated:
        name, sep, value = text.partition("=")
        if not sep:
            raise ValueError(f"condition {text!r}")
    shown = F.coalesce(F.col(name.strip()).cast("string"), F.lit("nan"))
    return shown != value.strip() if negated else shown == value.strip()


def where_all(df: DataFrame, conditions: Sequence[str]) -> DataFrame:
    for c in conditions:
        df = df.where(condition(c))
    return df


def sort_rows(df: DataFrame, by: Sequence[str], order: str, desc: bool = False) -> DataFrame:
    """Sort by columns in one direction, nulls last, ties in the order of ``order``."""
    require(df, [*by, order])
    return df.orderBy(*(F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last() for c in by), F.col(order).asc())


def dedup(df: DataFrame, keys: Sequence[str], order: str, keep: str = "first") -> DataFrame:
    """One row of each key (nulls are equal): the first or last by ``order``.

    The survivor's order is a minimum by key, summed before the shuffle; the rows then meet it in an equi-join, so a hot key is split.
    """
    require(df, [*keys, order])
    pick = (F.min if keep == "first" else F.max)(order).alias("_pick")
    best = df.groupBy(*keys).agg(pick)
    same = F.col(f"l.{order}") == F.col("r._pick")
    for k in keys:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return df.alias("l").join(best.alias("r"), same, "left_semi")


def semi_by_id(df: DataFrame, ids: DataFrame, on: str, id_col: str | None = None) -> DataFrame:
    """Rows whose id, as text, is among ``ids``; nulls match nothing."""
    known = ids.select(blank_to_null(F.col(id_col or on)).alias("_id")).where(F.col("_id").isNotNull()).distinct()
    return df.join(known, blank_to_null(F.col(on)) == F.col("_id"), "left_semi")


def split_by_ids(df: DataFrame, ids: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """(rows that remain, rows whose id is named)."""
    known = ids.select(blank_to_null(F.col(on)).alias("_id")).where(F.col("_id").isNotNull()).distinct()
    same = blank_to_null(F.col(on)) == F.col("_id")
    return df.join(known, same, "left_anti"), df.join(known, same, "left_semi")


def join_tables(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys of which nulls are equal; other columns that collide get ``_l`` and ``_r``."""
    require(left, on)
    require(right, on)
    clash = {c for c in left.columns if c in right.columns and c not in on}
    same = F.lit(True)
    for k in on:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    keys = [F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in on]
    own = [F.col(f"l.{c}").alias(f"{c}_l" if c in clash else c) for c in left.columns if c not in on]
    other = [F.col(f"r.{c}").alias(f"{c}_r" if c in clash else c) for c in right.columns if c not in on]
    return left.alias("l").join(right.alias("r"), same, {"outer": "full_outer"}.get(how, how)).select(*keys, *own, *other)


def group_name(c: Column) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(NULL_GROUP))


def null_counts(df: DataFrame) -> DataFrame:
    """column, nulls, rows."""
    counts = df.agg(F.count("*").alias("_rows"), *(F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls"), F.col("_rows").alias("rows")) for c in df.columns))).alias("s")).select("s.*")


def group_counts(df: DataFrame, by: str) -> DataFrame:
    """group, n, with nulls and blanks under ``__NA__``."""
    return df.groupBy(group_name(F.col(by)).alias("group")).agg(F.count("*").alias("n"))


def allocate(counts: DataFrame, total: int | None = None, cap: int | None = None, least: int = 0, most: int | None = None) -> DataFrame:
    """Rows to take of each group (group, n): at most ``cap`` each, or ``total`` shared in proportion.

    Shares are rounded down and raised to ``least``; what is left goes one each by largest remainder, then group name,
    to groups with rows left. ``most`` then cuts, and what it cuts is not shared again. One row per group.
    """
    if total is None:
        take = F.col("n") if cap is None else F.least(F.col("n"), F.lit(cap))
    else:
        every = Window.partitionBy()
        exact = F.col("n") * float(total) / F.sum("n").over(every)
        counts = counts.withColumn("_floor", F.least(F.greatest(F.floor(exact), F.lit(least)), F.col("n"))).withColumn("_rest", exact - F.floor(exact))
        slack = F.col("_floor") < F.col("n")
        turn = F.row_number().over(Window.orderBy(F.when(slack, 0).otherwise(1), F.col("_rest").desc(), "group"))
        left = F.lit(total) - F.sum("_floor").over(every)
        take = F.col("_floor") + F.when(slack & (turn <= left), 1).otherwise(0)
    if most is not None:
        take = F.least(take, F.lit(most))
    return counts.select("group", "n", take.cast("long").alias("take"))


def take_per_group(df: DataFrame, by: str, sizes: DataFrame, order: str, how: str = "first", seed: int = 0) -> DataFrame:
    """The first, last or a seeded random ``take`` rows of each group; nulls and blanks are one group."""
    named = df.withColumn("_g", group_name(F.col(by)))
    key = {"first": F.col(order).asc(), "last": F.col(order).desc(), "random": F.xxhash64(F.lit(seed), F.col("_g"), F.col(order)).asc()}[how]
    most = sizes.agg(F.max("take")).first()[0] or 0  # a bound that Spark applies before it shuffles, to each task's own rows
    turn = F.row_number().over(Window.partitionBy("_g").orderBy(key))
    rows = named.withColumn("_turn", turn).where(F.col("_turn") <= int(most)).join(sizes.select(F.col("group").alias("_g"), "take"), "_g")
    return rows.where(F.col("_turn") <= F.col("take")).drop("_g", "_turn", "take")


def numbered(df: DataFrame, order: str | Sequence[str], name: str = "row", by: Sequence[str] = ()) -> DataFrame:
    """``df`` with its rank (from 1) by ``order``, in each group of ``by``: rows are sorted within range partitions, and only partition sizes are summed.

    So no group, however large, is put in order by one task. Ties get different ranks. The ranged rows are persisted, so both reads see the same partitions.
    """
    keys = [*by, *([order] if isinstance(order, str) else order)]
    ranged = df.repartitionByRange(*map(F.col, keys)).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id()).withColumn("_in", F.monotonically_increasing_id()).persist(StorageLevel.DISK_ONLY)
    own = [F.col(k).alias(f"_by{i}") for i, k in enumerate(by)]
    sizes = ranged.groupBy("_part", *own).agg(F.count("*").alias("_n"), F.min("_in").alias("_first")).withColumnRenamed("_part", "_of")
    names = [f"_by{i}" for i in range(len(by))]
    before = Window.partitionBy(*names).orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    same = F.col("_part") == F.col("_of")
    for k, n in zip(by, names, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return ranged.join(sizes if by else F.broadcast(sizes), same).withColumn(name, F.col("_in") - F.col("_first") + F.col("_before") + 1).drop("_part", "_in", "_of", "_first", "_before", "_n", *names)


def split_parts(df: DataFrame, order: str, parts: int | None = None, chunk: int | None = None) -> DataFrame:
    """``df`` with ``part`` (from 1): contiguous parts by ``order``, ``parts`` of them or of ``chunk`` rows each."""
    size = chunk or max(1, -(-df.count() // parts))
    return numbered(df, order, "_row").withColumn("part", (F.floor((F.col("_row") - 1) / size) + 1).cast("long")).drop("_row")


def append(base: DataFrame, more: DataFrame) -> DataFrame:
    """All rows of both; unequal column lists raise."""
    if base.columns != more.columns:
        raise ValueError(f"{base.columns} is not {more.columns}")
    return base.union(more)


def sample_ids(df: DataFrame, id_col: str, k: int, seed: int = 0) -> DataFrame:
    """``k`` distinct ids, the same for a seed whatever the order of rows: those whose MD5 of ``seed:id`` comes first."""
    ids = df.select(blank_to_null(F.col(id_col)).alias(id_col)).where(F.col(id_col).isNotNull()).distinct()
    return ids.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary")), id_col).limit(k)


def even_shares(df: DataFrame, order: str, n: int, name: str = "part") -> DataFrame:
    """``df`` with ``name`` (from 1): ``n`` contiguous shares by ``order`` whose sizes differ by one row at most, larger ones first."""
    if n < 1:
        raise ValueError("n must be 1 or more")
    base, more = divmod(df.count(), n)
    at = F.col("_row") - 1
    late = F.floor((at - more * (base + 1)) / max(base, 1)) + more
    return numbered(df, order, "_row").withColumn(name, (F.when(at < more * (base + 1), F.floor(at / (base + 1))).otherwise(late) + 1).cast("long")).drop("_row")


def schema_of(df: DataFrame) -> DataFrame:
    """column, type of each column."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")
