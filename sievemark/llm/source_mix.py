"""Mixing sources to target weights by Pareto order sampling. DataFrame functions alone.

A source's target gives every one of its documents the same number of certain whole copies; what is left is a sample. Each document
has an inclusion probability that grows with its size, and a random number fixed by its content; documents are ranked by
random odds divided by inclusion odds, and the sample is the head of the ranking whose words come nearest to what is
left. The head's end is found by sums over bins of the rank, twice, and only the last bin's few documents
are put in order, so no source is ever sorted or gathered, however large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, column, need, packed, release, row_key, table

BINS = 4096


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """source, source_size -> weight and target in addition.

    Sources in the order of code points (null last) have the weights in turn and share the sum of all sizes. A target stops
    at ``cap`` times the source's size and the rest is shared anew by weight: with sources ordered by ``cap * size / weight``,
    those that stop are a head of that order, so running sums find them in one pass. One row per source.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(turn, F.lit(len(weights))) + 1).cast("double"))
    order = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rows = rows.withColumn("full", F.col("source_size") * F.lit(cap))
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    share = left / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("share", share).withColumn("stops", F.col("full") <= F.col("share") * F.col("weight"))
    level = F.max(F.when(~F.col("stops"), F.col("share"))).over(every)  # the first that does not stop
    return rows.select("source", "source_size", "weight", F.when(F.col("stops"), F.col("full")).otherwise(F.coalesce(level, F.lit(0.0)) * F.col("weight")).alias("target"))


def _ranked(docs: DataFrame, seed: int, *more: Column) -> DataFrame:
    """source, size, u (a random number in (0, 1) fixed by doc_id, source and text), the row's key, and ``more``."""
    size = F.coalesce(F.regexp_count(column("text"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(*more, column("source").alias("source"), size.alias("size"), *row_key(column("doc_id"), column("source"), column("text")))
    return rows.withColumn("u", (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "k1", "k2"), 11) + 0.5) / float(1 << 53))


def _place(tilt: float):
    """Rank in (0, 1): q / (1 + q), where q is the random odds over the inclusion odds. Needs ``size``, ``u`` and the source's sums."""
    chance = F.least(F.lit(0.999999), F.greatest(F.lit(1e-9), F.col("part") * F.pow(F.col("size"), F.lit(tilt)) / F.col("mean")))
    q = F.col("u") / (1 - F.col("u")) * (1 - chance) / chance
    return q / (1 + q)


def plan(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, seed: int = 17, tilt: float = 0.25) -> DataFrame:
    """One row per source: source_size, target, whole copies, and the rank and key at which its sample ends."""
    rows = table(_ranked(docs, seed), "mix-rows")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.pow(F.col("size"), F.lit(tilt))).alias("tilted"))
    goal = targets(sums.select("source", "source_size"), weights, cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = goal.withColumn("whole", F.floor(ratio + 1e-9).cast("int")).withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    goal = goal.join(sums.select(F.col("source").alias("s"), "tilted"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    # mean: what makes the expected words of the sample equal to the rest
    goal = goal.withColumn("part", F.when(F.col("source_size") > 0, F.col("rest") / F.col("source_size")).otherwise(0.0)).withColumn("mean", F.when(F.col("source_size") > 0, F.greatest(F.lit(1.0), F.col("tilted") / F.col("source_size"))).otherwise(1.0))
    goal = table(goal.drop("tilted"), "mix-goal")

    def inside(found: DataFrame, known: DataFrame) -> DataFrame:
        """Rows of ``found`` with their source's columns."""
        right = known.withColumnRenamed("source", "s")
        return found.join(right, F.col("source").eqNullSafe(F.col("s"))).drop("s")

    live = inside(rows.where(F.col("size") > 0), goal.where(F.col("rest") > 0).select("source", "rest", "part", "mean")).select("source", "size", "k1", "k2", "rest", _place(tilt).alias("place"))
    scale, last, bins = BINS, None, []
    for _ in range(2):
        binned = live if last is None else inside(live.drop("rest"), last).where(F.floor(F.col("place") * (scale // BINS)) == F.col("bin")).drop("bin")
        steps = binned.withColumn("b", F.floor(F.col("place") * scale)).groupBy("source", "b").agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
        upto = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        steps = steps.withColumn("upto", upto).where(F.col("upto") < F.col("rest"))
        last = steps.groupBy("source").agg(F.max_by("b", "b").alias("bin"), (F.max_by("rest", "b") - F.max_by("upto", "b")).alias("rest"))
        last = table(last, "mix-bin")
        bins.append(last)
        scale *= BINS
    ends = inside(live.drop("rest"), last).where(F.floor(F.col("place") * (scale // BINS)) == F.col("bin"))
    # rows that repeat have one place and go together: the head ends before or after all of them, whichever is nearer
    ends = ends.groupBy("source", "place", "k1", "k2").agg(F.sum("size").alias("size"), F.max("rest").alias("rest"))
    order = Window.partitionBy("source").orderBy("place", "k1", "k2")
    ends = ends.withColumn("upto", F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ends = ends.where(F.col("upto") + F.col("size") / 2 <= F.col("rest")).groupBy("source").agg(F.max(F.struct("place", "k1", "k2")).alias("end"))
    floor = last.select("source", (F.col("bin") / float(scale // BINS)).alias("below"))
    out = goal.join(floor.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    out = table(out.join(ends.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "mix-plan")
    release(rows, goal, *bins)
    return out


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, seed: int = 17, tilt: float = 0.25) -> DataFrame:
    """The columns of ``docs`` (doc_id, source, text), with size, source_size, target, copies and taken.

    ``size`` is the number of words (a null text: 0), ``copies`` how often the mix has the document, at most ``cap`` times,
    ``taken`` their product. Null is a source like any other, in the last place. Rows with equal doc_id, source and text have
    one random number and so one fate, so a source's words meet its target to within half of its largest document, its repeats
    counted together. The result depends on the rows and the seed, not on their order. Columns named as one of the
    results are replaced, all others stay, whatever their names; an empty table gives no rows.
    """
    need(docs, "doc_id", "source", "text")
    results = ("size", "source_size", "target", "copies", "taken")
    known = plan(docs, weights, cap, seed, tilt)
    rows = _ranked(docs, seed, packed(docs, *results))
    rows = rows.join(known.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).withColumn("place", _place(tilt))
    head = (F.col("place") < F.col("below")) | F.coalesce(F.struct("place", "k1", "k2") <= F.col("end"), F.lit(False))
    more = F.coalesce((F.col("size") > 0) & head, F.lit(False)).cast("int")
    copies = F.col("whole") + more
    return rows.select("row.*", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
