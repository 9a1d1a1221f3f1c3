"""Entity resolution of offerings: similar names are linked, links make clusters, clusters make offerings."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.binding import let
from ..functions.text import clean_ws, descriptiveness, has_evidence, norm_name, norm_type, profile_sentences
from ..functions.vectors import dot, norm
from ..shared import exists, release, table


def clean_mentions(mentions: DataFrame, pages: DataFrame) -> DataFrame:
    """Mentions with normal names and types, a filled name, and evidence on their page.

    mentions: company_id, source_url, type_raw, raw_name, raw_description. pages: source_url, body.
    """
    rows = mentions.join(pages, "source_url", "left").select("company_id", "source_url", norm_type(F.col("type_raw")).alias("type"), clean_ws(F.col("raw_name")).alias("name"), norm_name(F.col("raw_name")).alias("name_norm"), clean_ws(F.coalesce("raw_description", F.lit(""))).alias("description"), "body")
    return rows.where((F.col("name_norm") != "") & (F.col("body").isNull() | has_evidence(F.col("body"), F.col("name"), F.col("description")))).drop("body")


def embed_texts(texts: DataFrame, text: str, embedder: Callable[[list[str]], list[list[float]]]) -> DataFrame:
    """text, embedding of the distinct texts; the embedder gets a batch at a time inside tasks."""

    def part(batches):
        for pdf in batches:
            yield pd.DataFrame({text: pdf[text], "embedding": embedder(pdf[text].tolist())})

    return texts.select(text).where(F.col(text).isNotNull()).distinct().mapInPandas(part, f"`{text}` string, embedding array<float>")


def embed_cached(texts: DataFrame, text: str, embedder: Callable[[list[str]], list[list[float]]], cache: str, model: str) -> DataFrame:
    """text, embedding of the distinct texts, of which the embedder gets those alone that the table at ``cache`` has not.

    The cache is a Parquet table by model; an entry's key is the SHA-256 of its text, so the texts themselves stay where they are. New entries are
    appended once they are all made; a run that ends early appends none. Runs of one cache come one after the other.
    """
    spark = texts.sparkSession
    wanted = texts.select(F.col(text).alias("text")).where(F.col("text").isNotNull()).distinct().withColumn("key", F.sha2("text", 256))
    held = T.StructType([T.StructField("key", T.StringType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("model", T.StringType())])

    def known() -> DataFrame:
        rows = spark.read.schema(held).parquet(cache) if exists(spark, cache) else spark.createDataFrame([], held)
        return rows.where(F.col("model") == model).select("key", "embedding").dropDuplicates(["key"])

    new = table(wanted.join(known().select("key"), "key", "left_anti"), "embedding-texts")
    if not new.isEmpty():
        made = embed_texts(new, "text", embedder).select(F.sha2("text", 256).alias("key"), "embedding", F.lit(model).alias("model"))
        made.write.mode("append").partitionBy("model").parquet(cache)
    release(new)
    return wanted.join(known(), "key").select(F.col("text").alias(text), "embedding")


def hashed_embedding(texts: list[str], size: int = 64) -> list[list[float]]:
    """A stand-in for a model: counts of character trigrams by hash, at unit length."""
    import zlib

    import numpy as np

    out = []
    for t in texts:
        v = np.zeros(size, np.float32)
        padded = f"  {t.lower()} "
        for i in range(len(padded) - 2):
            v[zlib.crc32(padded[i : i + 3].encode()) % size] += 1
        n = float(np.linalg.norm(v))
        out.append((v / n if n else v).tolist())
    return out


def similar_pairs(rows: DataFrame, block: list[str], key: str, vector: str, least: float = 0.94, tile: int = 4000) -> DataFrame:
    """block, a, b, similarity of the pairs of rows in a block with a cosine of at least ``least``; a < b. Vectors of other lengths, and of length zero, have no pairs.

    A block of more than ``tile`` rows is cut into cells (``similarity_cells``) such that each pair meets in exactly one; a cell that cannot be cut is dealt out
    in parts. Each group of at most two parts is compared by matrix products in a task.
    """
    cells = similarity_cells(rows, block, key, vector, least, tile)
    parts = F.ceil(F.col("_c") / tile).cast("int")
    own = F.pmod(F.xxhash64("_key", F.lit(7)), parts).cast("int")
    # a row meets its own part and all others, each pair of parts as one group
    groups = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda k: F.struct(F.least(k, F.col("_part")).alias("i"), F.greatest(k, F.col("_part")).alias("j")))
    dealt = cells.withColumns({"_parts": parts, "_part": own}).withColumn("_g", F.explode(groups)).select(*block, "_cell", F.col("_g.i").alias("_i"), F.col("_g.j").alias("_j"), "_part", "_visits", "_key", "_unit")
    dealt = dealt.repartition("_cell", "_i", "_j").sortWithinPartitions("_cell", "_i", "_j")
    kept = [dealt.schema[c] for c in block]
    out = T.StructType([*kept, T.StructField("_x", dealt.schema["_key"].dataType), T.StructField("_y", dealt.schema["_key"].dataType), T.StructField("similarity", T.DoubleType())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("_cell", "_i", "_j")), strict=True))
            cuts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if held and keys[lo] != last:
                    yield from _close_pairs(pa.Table.from_batches(held), block, least, out.names)
                    held = []
                held.append(batch.slice(lo, hi - lo))
                last = keys[lo]
        if held:
            yield from _close_pairs(pa.Table.from_batches(held), block, least, out.names)

    pairs = dealt.mapInArrow(part, out)
    return pairs.select(*block, F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"), "similarity")


def _close_pairs(group: pa.Table, block: list[str], least: float, names: list[str], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Pairs of a group: of its two parts with each other, or of its one part, that do not both visit at one level."""
    group = group.combine_chunks()
    unit = group.column("_unit").chunk(0) if group.num_rows else None
    if unit is None:
        return
    vectors = unit.flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, -1)
    part, visits = group.column("_part").to_numpy(), group.column("_visits").to_numpy()
    i, j = group.column("_i")[0].as_py(), group.column("_j")[0].as_py()
    x, y = np.flatnonzero(part == i), np.flatnonzero(part == j)
    for at in range(0, len(x), rows):
        some = x[at : at + rows]
        close = vectors[some] @ vectors[y].T
        good = (close >= least) & ((visits[some][:, None] & visits[y][None, :]) == 0)
        if i == j:
            good &= some[:, None] < y[None, :]
        p, q = np.nonzero(good)
        if len(p):
            left, right = group.take(pa.array(some[p])), group.take(pa.array(y[q]))
            yield pa.RecordBatch.from_arrays([*(left.column(c).combine_chunks() for c in block), left.column("_key").combine_chunks(), right.column("_key").combine_chunks(), pa.array(close[p, q])], names)


def similarity_cells(rows: DataFrame, block: list[str], key: str, vector: str, least: float, tile: int, pivots: int = 512, sample: int = 4096, most: int = 12) -> DataFrame:
    """block, _key, _unit, _cell, _visits, _c (rows of the cell): every pair with a cosine of at least ``least`` is in one cell, and in one alone do its rows' ``_visits`` share no bit.

    Pivots are rows drawn from a cell by hash, a quarter or about ``sample`` of them, without those within the threshold of one before. A row is at home with the nearest pivot and visits those
    before that to whose side of the plane between the two it is near enough that a row within the threshold's angle could be at home there. Large cells are cut again. A cell stays as it is where
    visits would more than double its rows or one part keeps most of them: vectors without neighbourhoods have no shorter way, and copies are all pairs.
    """
    unit = let(norm(F.col(vector)), lambda n: F.when(n > 0, F.transform(vector, lambda x: x.cast("double") / n)).otherwise(F.array().cast("array<double>")))
    todo = rows.select(*block, F.col(key).alias("_key"), unit.alias("_unit")).where(F.size("_unit") > 0)
    todo = todo.withColumn("_cell", F.sha1(F.to_json(F.struct(*block, F.size("_unit").alias("_dims"))))).withColumn("_visits", F.lit(0).cast("long")).withColumn("_of", F.lit(None).cast("long"))
    reach = float(np.sqrt(1 - least * least)) if 0 < least <= 1 else np.inf if least <= 0 else 0.0

    def home(key: tuple, rows: pa.Table, points: pa.Table) -> pa.Table:
        """Rows of a part of a cell with the pivots that they go to, the last of which is their own."""
        if not rows.num_rows or not points.num_rows:
            return pa.Table.from_batches([], arrow)
        drawn = points.column("_points")[0].values.field("unit")
        drawn, pivot = drawn.flatten().to_numpy(zero_copy_only=False).reshape(len(drawn), -1), []
        free = np.ones(len(drawn), bool)
        while free.any() and len(pivot) < pivots:
            pivot.append(drawn[free.argmax()])
            free &= drawn @ pivot[-1] < least
            free[: free.argmax() if free.any() else 0] = False
        pivot = np.array(pivot)
        vectors = rows.column("_unit").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
        chord, into = np.sqrt(np.maximum(0.0, 2 - 2 * pivot @ pivot.T)), []
        for at in range(0, len(vectors), 1024):
            near = vectors[at : at + 1024] @ pivot.T
            own = near.argmax(axis=1)
            fits = near.max(axis=1)[:, None] - near <= reach * chord[own] + 1e-9
            fits &= np.arange(len(pivot))[None, :] < own[:, None]
            into += [[*np.flatnonzero(f).tolist(), o] for f, o in zip(fits, own.tolist(), strict=True)]
        kept = [c for c in arrow.names if c != "_into"]
        return rows.select(kept).append_column("_into", pa.array(into, pa.list_(pa.int32()))).cast(arrow)

    names, done = [*block, "_key", "_unit", "_cell", "_visits", "_c"], []
    for level in range(most):
        sized = table(todo.join(todo.groupBy("_cell").agg(F.count("*").alias("_c")), "_cell"), "similarity-cells")
        open_ = (F.col("_c") > tile) & (F.col("_of").isNull() | (F.col("_c") < 0.8 * F.col("_of")))
        if level == most - 1 or sized.where(open_).isEmpty():
            return reduce(DataFrame.unionByName, [*done, sized.select(names)])
        every = F.greatest(F.lit(4), F.col("_c") / sample).cast("long")
        turn = F.xxhash64("_key", F.lit(level))
        drawn = sized.where(open_ & (F.pmod(turn, every) == 0))
        points = drawn.groupBy("_cell").agg(F.slice(F.array_sort(F.collect_list(F.struct(turn.alias("turn"), F.col("_unit").alias("unit")))), 1, 2 * sample).alias("_points"), F.ceil(F.max("_c") / tile).cast("int").alias("_parts")).where(F.size("_points") > 1)
        points = points.select("_cell", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), "_points")
        dealt = sized.where(open_).withColumn("_part", F.pmod(F.xxhash64("_key", F.lit(7)), F.ceil(F.col("_c") / tile).cast("int")).cast("int"))
        out = T.StructType([*(dealt.schema[c] for c in names), T.StructField("_into", T.ArrayType(T.IntegerType()))])
        arrow = to_arrow_schema(out)
        # a task gets one part of a cell and the cell's pivots
        placed = table(dealt.groupBy("_cell", "_part").cogroup(points.groupBy("_cell", "_part")).applyInArrow(home, out), "similarity-placed")
        cut = placed.groupBy("_cell").agg((F.sum(F.size("_into")) <= 2 * F.count("*")).alias("_cut")).where("_cut").select("_cell")
        stays = sized.join(cut, "_cell", "left_anti")
        done.append(stays.select(names))
        into = placed.join(cut, "_cell").withColumn("_to", F.explode("_into"))
        visits = F.col("_visits").bitwiseOR(F.when(F.col("_to") == F.element_at("_into", -1), F.lit(0).cast("long")).otherwise(F.lit(1 << level).cast("long")))
        todo = into.select(*block, "_key", "_unit", F.sha1(F.concat_ws(":", "_cell", F.col("_to").cast("string"))).alias("_cell"), visits.alias("_visits"), F.col("_c").alias("_of"))
    raise AssertionError("the last level returns")


def components(edges: DataFrame, nodes: DataFrame | None = None, most: int = 60) -> DataFrame:
    """node, label: the least node of each component of ``edges`` (a, b). ``nodes`` (node) adds those without edges.

    Labels fall to the least label next to them and then to their label's label, until none changes, so a path of n nodes takes about log n rounds.
    """
    both = table(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "component-edges")
    state, written = both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), None
    for _ in range(most):
        near = both.join(state.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        low = state.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = low.select(F.col("node").alias("low"), F.col("low").alias("far"))
        new = low.join(jump, "low", "left").select("node", F.least("low", F.coalesce("far", "low")).alias("label"), (F.least("low", F.coalesce("far", "low")) != F.col("label")).alias("moved"))
        before, written = written, table(new, "component-labels")
        release(before)
        state = written.select("node", "label")
        if written.where("moved").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    release(both)
    if nodes is None:
        return state
    return nodes.select("node").distinct().join(state, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def offering_id(company: Column, kind: Column, name: Column) -> Column:
    return F.concat(F.lit("off_"), F.substring(F.sha1(F.concat_ws("|", company.cast("string"), kind, name).cast("binary")), 1, 16))


def canonical_offerings(clustered: DataFrame) -> DataFrame:
    """One row per (company_id, type, cluster): the best name, other names, sources and descriptions.

    clustered: company_id, type, cluster, name, source_url, description. The best name is the most descriptive, then the first in order.
    """
    key = F.struct(*(-descriptiveness(F.col("name"))[c] for c in ("length", "words", "shapes")), F.col("name"))
    rows = clustered.groupBy("company_id", "type", "cluster").agg(
        F.min_by("name", key).alias("best"), F.array_sort(F.collect_set("name")).alias("names"), F.array_sort(F.collect_set("source_url")).alias("sources"),
        F.array_sort(F.collect_set(F.when(F.col("description") != "", F.col("description")))).alias("descriptions"), F.count("*").alias("mentions"),
    )
    return rows.withColumn("aliases", F.array_except("names", F.array("best"))).withColumn("offering_id", offering_id(F.col("company_id"), F.col("type"), F.lower("best"))).drop("names")


def distinct_sentences(sentences: DataFrame, by: list[str], order: list[str], embedder: Callable[[list[str]], list[list[float]]], least: float = 0.90, most: int = 8) -> DataFrame:
    """by, sentences: of each group's sentences (by, order, sentence) those, in order, whose cosine to every one kept before is below ``least``, ``most`` at the most.

    Of sentences that differ in case alone the first counts. Equal texts are embedded once and joined back by text. A group passes by its vectors in
    order and holds those it keeps, so it is never put together, however large; an empty one has no row.
    """
    low = F.lower("sentence")
    first = sentences.where(F.coalesce(F.col("sentence"), F.lit("")) != "").groupBy(*by, low.alias("_low")).agg(F.min(F.struct(*order, "sentence")).alias("_f")).select(*by, "_f.*")
    known = table(embed_texts(first, "sentence", embedder), "sentence-vectors")  # a model is asked once
    rows = first.join(known, "sentence").repartition(*by).sortWithinPartitions(*by, *order, "sentence")

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, kept, said = None, [], []
        for batch in batches:
            done = []
            vectors = batch.column("embedding")
            for i, (*own, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in (*by, "sentence")), strict=True)):
                if own != key:
                    done += [(key, said)] if key is not None else []
                    key, kept, said = own, [], []
                if len(said) < most:
                    v = np.asarray(vectors[i].values, float)
                    own_square = float(v @ v)
                    # divided once, at the end: units would be rounded, and a cosine of just ``least`` could fall below it
                    if not any((float(v @ k) / math.sqrt(own_square * square) if own_square * square else 0.0) >= least for k, square in kept):
                        kept.append((v, own_square))
                        said.append(text)
            yield built(done)
        if key is not None:
            yield built([(key, said)])

    fields = [*(first.schema[c] for c in by), T.StructField("sentences", T.ArrayType(T.StringType()))]
    arrow = to_arrow_schema(T.StructType(fields))

    def built(done: list[tuple[list, list[str]]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(by, k, strict=True)) | {"sentences": x} for k, x in done], schema=arrow)

    return rows.mapInArrow(part, T.StructType(fields))


def described_offerings(clustered: DataFrame, embedder: Callable[[list[str]], list[list[float]]], order: list[str], least: float = 0.90, most: int = 8) -> DataFrame:
    """``canonical_offerings`` whose descriptions are the distinct sentences of the cluster's, in the order of its mentions by ``order``."""
    by = ["company_id", "type", "cluster"]
    said = clustered.select(*by, *order, F.posexplode(profile_sentences(F.coalesce("description", F.lit("")))).alias("_pos", "sentence"))
    kept = distinct_sentences(said, by, [*order, "_pos"], embedder, least, most)
    kept = kept.select(*(F.col(c).alias(f"_{c}") for c in by), "sentences")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])  # a null is a key as well
    return canonical_offerings(clustered).drop("descriptions").join(kept, same, "left").withColumn("descriptions", F.coalesce("sentences", F.array().cast("array<string>"))).drop("sentences", *(f"_{c}" for c in by))


def offering_text(best: Column, aliases: Column, kind: Column, descriptions: Column) -> Column:
    """The text of an offering that is embedded."""
    return F.concat_ws("\n", best, F.when(F.size(aliases) > 0, F.concat(F.lit("Aliases: "), F.array_join(aliases, ", "))), F.concat(F.lit("Type: "), kind), F.when(F.size(descriptions) > 0, F.array_join(descriptions, " ")))


def profile_markdown(offerings: DataFrame) -> DataFrame:
    """company_id, markdown: a document of each company's offerings by type and name."""
    line = F.concat(F.lit("- **"), F.col("best"), F.lit("**"), F.when(F.size("descriptions") > 0, F.concat(F.lit(": "), F.col("descriptions")[0])).otherwise(""))
    rows = offerings.groupBy("company_id").agg(F.array_sort(F.collect_list(F.struct("type", "best", line.alias("line")))).alias("x"))
    part = lambda kind, title: F.concat(F.lit(f"## {title}\n"), F.array_join(F.transform(F.filter("x", lambda o: o["type"] == kind), lambda o: o["line"]), "\n"))
    return rows.select("company_id", F.concat_ws("\n\n", F.concat(F.lit("# "), F.col("company_id").cast("string")), part("product", "Products"), part("service", "Services")).alias("markdown"))


def embed_outputs(offerings: DataFrame, embedder: Callable[[list[str]], list[list[float]]]) -> DataFrame:
    """company_id, kind (profile or offering), id (of the company or the offering), text, embedding: a vector for each profile and each offering.

    Equal texts are embedded once; a profile without text has no vector.
    """
    each = offerings.select("company_id", F.lit("offering").alias("kind"), F.col("offering_id").alias("id"), offering_text(F.col("best"), F.col("aliases"), F.col("type"), F.col("descriptions")).alias("text"))
    whole = profile_markdown(offerings).select("company_id", F.lit("profile").alias("kind"), F.col("company_id").cast("string").alias("id"), F.col("markdown").alias("text"))
    rows = each.unionByName(whole)
    return rows.join(embed_texts(rows, "text", embedder), "text").select("company_id", "kind", "id", "text", "embedding")
