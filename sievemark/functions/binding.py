"""A value that is worked out once, however often an expression uses it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``; Spark would write the value out, and evaluate it, at each place where the body names it."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def starts(lengths: Column, block: int = 256) -> Column:
    """For each item of an array of numbers the sum of those before it. It goes by blocks, so no long array is copied for each item."""

    def running(values: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("out"))
        return F.aggregate(values, zero, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")))

    def joined(parts: Column) -> Column:
        before = running(F.transform(parts, lambda p: p["at"]))["out"]
        return F.flatten(F.zip_with(parts, before, lambda p, at: F.transform(p["out"], lambda x: x + at)))

    def cut(values: Column) -> Column:
        n = F.ceil(F.size(values) / block).cast("int")
        places = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda k: running(F.slice(values, k * block + 1, block)))

    return let(let(F.transform(lengths, lambda x: x.cast("long")), cut), joined)
