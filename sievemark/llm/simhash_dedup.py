"""Near-duplicates by 64-bit SimHash fingerprints and multi-index hashing.

A bit of a text's fingerprint is the majority of that bit over the hashes of its shingles. Fingerprints are cut into two segments of 32
bits. Of two that differ in at most two bits, either the first segments differ in at most one bit or the second ones in none. So each
distinct fingerprint is filed under both segments, and looks in the first table under every segment that differs from its own in one bit.
Of such a pair one has that bit set, so only set bits are turned off: about 16 look-ups, not 32. Matches are compared as a whole.

Buckets of more than ``DIRECT`` rows do not pair their members. There the ball is enumerated over the whole fingerprint: each member is
filed under itself and its 64 neighbours. Two fingerprints are filed under a common value exactly if they differ in at most two bits, so
all that share a value are linked to the least of them. A value has at most 65 members, so no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, need, release, table, words_of
from .near_dedup import components, meet

WIDTH = 3
SEED = 42
#: Bits in which linked fingerprints may differ. The segments and the ball below are made for it.
RADIUS = 2
#: Largest bucket whose members are paired as they are.
DIRECT = 64
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def shingles(words: list[bytes], width: int = WIDTH) -> list[bytes]:
    """The windows of ``width`` words, joined by spaces, repeats included; all words where there are fewer."""
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]


def fingerprints(texts: list[str | None], width: int = WIDTH) -> np.ndarray:
    """The fingerprint of each text, as a signed number; bit 63 is the sign."""
    hashed: list[int] = []
    ends = []
    for text in texts:
        hashed += [xxhash.xxh64_intdigest(s, SEED) for s in shingles([w.lower() for w in words_of(text)], width)]
        ends.append(len(hashed))
    size = np.diff(ends, prepend=0)
    owner = np.repeat(np.arange(len(texts)), size)
    votes = np.zeros((len(texts), 64), np.int64)
    h = np.array(hashed, ">u8")
    for at in range(0, len(h), CHUNK):
        bits = np.unpackbits(h[at : at + CHUNK].view(np.uint8)).reshape(-1, 64)
        own = owner[at : at + CHUNK]
        start = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        votes[own[start]] += np.add.reduceat(bits, start, axis=0, dtype=np.int64)
    return np.packbits(2 * votes > size[:, None], axis=1).view(">u8").ravel().astype(np.uint64).view(np.int64)


def _printed(rows: DataFrame, width: int) -> DataFrame:
    """doc_id, text -> doc_id, fp."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum(np.array([len(t.as_py() or "") for t in batch.column("text")], np.int64)) // 2_000_000
            for s in np.unique(size):
                a, b = np.searchsorted(size, [s, s + 1])
                some = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(fingerprints(some.column("text").to_pylist(), width))], ["doc_id", "fp"])

    return rows.mapInArrow(part, "doc_id long, fp long")


def _cells(prints: DataFrame) -> DataFrame:
    """fp -> bucket, fp, own: under both of its segments (own), and under the first with each set bit turned off.

    The bucket has the segment's 32 bits below bit 32, which tells the tables apart.
    """
    first, second = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.lit(1 << 32))
    off = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: first.bitwiseAND(F.bitwise_not(_bit(k))))
    balls = F.filter(off, lambda v: v != first)
    filed = F.concat(F.array(F.struct(first.alias("bucket"), F.lit(True).alias("own")), F.struct(second.alias("bucket"), F.lit(True).alias("own"))), F.transform(balls, lambda v: F.struct(v.alias("bucket"), F.lit(False).alias("own"))))
    return prints.select("fp", F.explode(filed).alias("cell")).select("cell.bucket", "fp", "cell.own")


def _bit(k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), k)


def _near(x: Column, y: Column) -> Column:
    return F.bit_count(x.bitwiseXOR(y)) <= RADIUS


def links(prints: DataFrame, direct: int = DIRECT) -> DataFrame:
    """Pairs (a, b) of the distinct fingerprints ``prints`` (fp) that differ in at most two bits, written.

    Every pair of the smaller buckets; of larger ones as many as connect what is linked there.
    """
    cells = _cells(prints)
    sizes = cells.groupBy("bucket").agg(F.count("*").alias("c"), F.count_if("own").alias("owners")).where("c > 1 AND owners > 0").select("bucket", "c")
    shared = table(cells.join(sizes, "bucket"), "simhash-cells")
    few = shared.where(F.col("c") <= direct)
    x, y = few.where("own").alias("x"), few.alias("y")
    found = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (~F.col("y.own") | (F.col("x.fp") < F.col("y.fp"))) & _near(F.col("x.fp"), F.col("y.fp")))
    pairs = found.select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b"))
    # ``own`` and turned-off rows of one fingerprint never meet, as their buckets differ
    many = shared.where(F.col("c") > direct).select("fp").distinct()
    ball = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.col("fp").bitwiseXOR(_bit(k))))
    around = many.select("fp", F.explode(ball).alias("value")).groupBy("value").agg(F.sort_array(F.collect_list("fp")).alias("fps")).where(F.size("fps") > 1)
    star = around.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, 64)).alias("b"))
    out = table(pairs.union(star).distinct(), "simhash-links")
    release(shared)
    return out


def simhash_components(docs: DataFrame, width: int = WIDTH, direct: int = DIRECT) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of ``docs`` (doc_id, text).

    A-Z is lower-cased, words are cut at ASCII white space, shingles have ``width`` words; a bit is 1 if it is set in more than half of their
    hashes (XXH64 of UTF-8, seed 42), repeats counted. Fingerprints that differ in at most two bits are linked; a component's id is the
    smallest doc_id in it, null if it has none. ``fingerprint`` has 16 lower-case hex digits. A null, empty or blank text has fingerprint
    zero, which is linked like any other. Rows that repeat are copies and each is returned. An empty table gives no rows. Other columns are
    not returned.
    """
    need(docs, "doc_id", "text")
    rows = table(_printed(docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").alias("text")), width), "simhash-prints")
    nodes = table(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    near = links(nodes.select("fp"), direct)
    label = components(near).withColumnRenamed("node", "fp")
    linked = table(nodes.join(label, "fp"), "simhash-linked")
    # the least id of a component is summed up before the shuffle
    smallest = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    lone = nodes.join(linked.select("fp"), "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    known = table(meet(linked, smallest, "label").select("fp", "component_id").union(lone), "simhash-known")
    out = table(meet(rows, known, "fp"), "simhash-rows")
    release(nodes, near, linked, rows, known)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
