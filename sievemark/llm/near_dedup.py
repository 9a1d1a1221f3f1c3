"""Near-duplicates under weighted Jaccard similarity by BagMinHash.

A text is a bag of shingles of five words. The weight axis of a shingle is cut into dyadic blocks, [0,1), [1,2), [2,4), ...;
each block has a Poisson process of its length's rate, whose points carry a time, a register and a place in the block, all
hashed from the shingle, the block and the point's number. A bag takes the points below its weight, with places inside the
last block splitting it. A register keeps its earliest point, so two bags agree in a register with a chance
equal to their weighted Jaccard similarity. Points after a text's horizon can hardly be the earliest anywhere and are not made; a
text with an empty register is done again with a later horizon. A long text so costs one hash by shingle and
about ``REGISTERS * log(REGISTERS)`` points.

Bands of registers give buckets. Texts with the same words are one node. In a bucket every node is compared with the
node that is in the largest buckets; links that hold make components. Only in buckets that still hold several components are the
members of different components compared, if their sizes and a sketch of their registers allow the similarity. Buckets of more
than ``DIRECT`` nodes do not pair their members: their nodes' rarest shingles, as many as two linked bags must share one of,
give the pairs. So a large group of copies costs one comparison a node, not all pairs, and no link between components is lost.
Comparisons count the overlap of the whole bags. Nothing is collected. A text is known by a 128-bit hash of its words, which
different texts don't share; nodes are numbers of these hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, need, packed, release, row_key, table

WIDTH = 5
BANDS, ROWS = 30, 5
REGISTERS = BANDS * ROWS
#: Largest bucket whose members are paired as they are: at most half as many pairs for each member.
DIRECT = 16
#: Slots in which the elements of large mixed buckets are counted; the bound on what is broadcast, 8 MB.
SLOTS = 1 << 21
#: Bits of the sketch (one by register) that may differ: expected 0.1 of them at 0.8, and 5.5 deviations more.
SKETCH_BITS = int(0.1 * REGISTERS + 5.5 * (0.09 * REGISTERS) ** 0.5)

_G = np.uint64(0x9E3779B97F4A7C15)
_P = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 2**64) for k in range(1, 16)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


def tokens(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingles(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hashes of the windows of word hashes; fewer words than ``width``, but one, are one shingle."""
    size = min(width, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    n = len(words) - size + 1
    out = np.full(n, np.uint64(size))
    for k in range(size):
        out = out + words[k : k + n] * _P[k]
    return _mix(out)


def _counted(bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle and count of each distinct shingle of each text."""
    text, sh = np.repeat(np.arange(len(bags)), [len(b) for b in bags]), np.concatenate(bags)
    order = np.lexsort((sh, text))
    text, sh = text[order], sh[order]
    at = np.flatnonzero(np.concatenate(([True], (sh[1:] != sh[:-1]) | (text[1:] != text[:-1]))))
    return text[at], sh[at], np.diff(np.append(at, len(sh)))


def signatures(bags: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """Texts x registers: the hash of each register's earliest point. No bag may be empty."""
    text, sh, count = _counted(bags)
    total = np.array([len(b) for b in bags], float)
    out = np.zeros((len(bags), registers), np.uint64)
    todo, slack = np.arange(len(bags)), 4.5
    while len(todo):
        own = np.isin(text, todo) if len(todo) < len(bags) else slice(None)
        horizon = registers / total * (np.log(registers) + slack)
        early, sig = _earliest(text[own], sh[own], count[own], horizon, len(bags), registers)
        done = np.isfinite(early[todo]).all(1)
        out[todo[done]] = sig[todo[done]]
        todo, slack = todo[~done], slack * 2
    return out


def _earliest(text: np.ndarray, sh: np.ndarray, count: np.ndarray, horizon: np.ndarray, n: int, registers: int) -> tuple[np.ndarray, np.ndarray]:
    keys, times, hashes = [], [], []
    start, block = 0, 0
    while (pick := np.flatnonzero(count > start)).size:
        length = max(1, start)
        seed = _mix(sh[pick] + np.uint64(block * int(_G) % 2**64))
        share = np.minimum(1.0, (count[pick] - start) / length)
        expected = horizon[text[pick]] * length
        for low, high, k in ((0, 6, 4), (6, 60, 32), (60, np.inf, 512)):  # points made at once
            part = np.flatnonzero((expected > low) & (expected <= high))
            for at in range(0, len(part), max(1, 400_000 // k)):
                some = part[at : at + max(1, 400_000 // k)]
                for i, t, h in _points(seed[some], text[pick[some]], share[some], horizon, length, k):
                    keys.append(i * registers + (h >> np.uint64(33)).astype(np.int64) % registers)
                    times.append(t)
                    hashes.append(h)
        start, block = max(1, 2 * start), block + 1
    early, sig = np.full(n * registers, np.inf), np.zeros(n * registers, np.uint64)
    for i, t in zip(keys, times, strict=True):
        np.minimum.at(early, i, t)
    for i, t, h in zip(keys, times, hashes, strict=True):
        won = t == early[i]
        sig[i[won]] = h[won]
    return early.reshape(n, registers), sig.reshape(n, registers)


def _points(seed: np.ndarray, text: np.ndarray, share: np.ndarray, horizon: np.ndarray, length: int, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Points of each process up to its text's horizon and inside its share of the block: text, time, hash."""
    time, number = np.zeros(len(seed)), 0
    end = horizon[text]
    while len(seed):
        step = (np.arange(number + 1, number + k + 1, dtype=np.uint64) * _G)[None, :]
        a = _mix(seed[:, None] + step)
        t = time[:, None] + np.cumsum(-np.log(((a >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53), axis=1) / length
        live = t <= end[:, None]
        last = live[:, -1]
        i, j = np.nonzero(live)
        h = _mix(a[i, j] ^ _P[7])
        if length > 1:
            inside = (h & np.uint64(0xFFFFFFFF)).astype(np.float64) < share[i] * 2.0**32
            i, j, h = i[inside], j[inside], h[inside]
        yield text[i], t[i, j], h
        time, number = t[last, -1], number + k
        seed, text, share, end = seed[last], text[last], share[last], end[last]


def overlap(a: list[bytes], b: list[bytes], cache: _Hashes, width: int = WIDTH) -> tuple[int, int]:
    """Sums of the least and of the greatest counts of two bags of shingles."""
    x, y = (np.sort(shingles(np.fromiter((cache[w] for w in s), np.uint64, len(s)), width)) for s in (a, b))
    ux, cx = np.unique(x, return_counts=True)
    uy, cy = np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(ux, uy, assume_unique=True, return_indices=True)
    least = int(np.minimum(cx[i], cy[j]).sum())
    return least, len(x) + len(y) - least


def _signed(rows: DataFrame, width: int) -> DataFrame:
    """k1, k2, doc_id, text -> k1, k2, doc_id, words (their hash, null without any), n, sketch, bands."""
    names = ["k1", "k2", "doc_id", "words", "n", "sketch", "bands"]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Hashes()
        for batch in batches:
            size = np.cumsum(np.array([len(t.as_py() or "") for t in batch.column("text")], np.int64)) // 600_000
            for s in np.unique(size):
                a, b = np.searchsorted(size, [s, s + 1])
                yield _sign(batch.slice(a, b - a), cache, width, names)
                if len(cache) > 500_000:
                    cache.clear()

    return rows.mapInArrow(part, "k1 long, k2 long, doc_id long, words struct<high:long,low:long>, n long, sketch array<long>, bands array<long>")


def _sign(rows: pa.RecordBatch, cache: _Hashes, width: int, names: list[str]) -> pa.RecordBatch:
    split = [tokens(t.as_py()) for t in rows.column("text")]
    some = [i for i, w in enumerate(split) if w]
    own = np.zeros((len(split), 2), np.int64)
    own[some] = np.frombuffer(b"".join(xxhash.xxh3_128_digest(b" ".join(split[i])) for i in some), np.int64).reshape(-1, 2)
    sketch, bands, n = [None] * len(split), [None] * len(split), [0] * len(split)
    if some:
        bags = [shingles(np.fromiter((cache[w] for w in split[i]), np.uint64, len(split[i])), width) for i in some]
        sig = signatures(bags)
        bits = ((sig >> np.uint64(5)) & np.uint64(1)).astype(np.uint8)
        packed = np.packbits(np.pad(bits, ((0, 0), (0, -REGISTERS % 64))), axis=1).view(np.int64).tolist()
        key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * _G + (sig.reshape(-1, BANDS, ROWS) * _P[:ROWS]).sum(axis=2)
        key = _mix(key).astype(np.int64).tolist()
        for i, s, k, bag in zip(some, packed, key, bags, strict=True):
            sketch[i], bands[i], n[i] = s, k, len(bag)
    none = pa.array([w is None for w in bands], pa.bool_())
    words = pa.StructArray.from_arrays([pa.array(own[:, 0].copy()), pa.array(own[:, 1].copy())], ["high", "low"], mask=none)
    return pa.RecordBatch.from_arrays([*(rows.column(c) for c in names[:3]), words, pa.array(n, pa.int64()), pa.array(sketch, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))], names)


def _verified(pairs: DataFrame, texts: DataFrame, width: int, share: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose bags have a similarity of at least ``share``."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Hashes()
        for batch in batches:
            good = []
            for x, y in zip(batch.column("ta"), batch.column("tb"), strict=True):
                least, most = overlap(tokens(x.as_py()), tokens(y.as_py()), cache, width)
                good.append(share[1] * least >= share[0] * most)
                if len(cache) > 500_000:
                    cache.clear()
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(part, "a long, b long")


def components(edges: DataFrame, most: int = 50) -> DataFrame:
    """node, label of every node of ``edges`` (a, b): the least node of its component.

    Large-star and small-star steps, each a minimum by node that is summed before the shuffle and a join; the state
    is written after each pair of steps. It is done when every node points at one node that points nowhere.
    """
    for k in range(most):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # every edge now goes from a node to a smaller one
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        edges, before = table(small, "components"), edges
        if k:
            release(before)
        ends = edges.groupBy("a").agg(F.count("*").alias("out")).unionByName(edges.select(F.col("b").alias("a"), F.lit(1).cast("long").alias("out")).distinct())
        if ends.groupBy("a").agg(F.sum("out").alias("out")).where("out > 1").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
    raise RuntimeError(f"components did not settle in {most} steps")


def _sketches_allow(x: str, y: str) -> Column:
    size = F.least(f"{x}.n", f"{y}.n") * 5 >= F.greatest(f"{x}.n", f"{y}.n") * 4
    differ = F.lit(0)
    for k in range(-(-REGISTERS // 64)):
        differ = differ + F.bit_count(F.col(f"{x}.sketch")[k].bitwiseXOR(F.col(f"{y}.sketch")[k]))
    return size & (differ <= SKETCH_BITS)


def _elements(text: str, width: int, cache: _Hashes) -> np.ndarray:
    """The members of a text's bag: the k-th copy of a shingle is an element of its own, so a bag is a set."""
    own = tokens(text)
    bag = np.sort(shingles(np.fromiter((cache[w] for w in own), np.uint64, len(own)), width))
    new = np.concatenate(([True], bag[1:] != bag[:-1]))
    copy = np.arange(len(bag)) - np.maximum.accumulate(np.where(new, np.arange(len(bag)), 0))
    if len(cache) > 500_000:
        cache.clear()
    return _mix(bag + copy.astype(np.uint64) * _G)


def _slot_counts(texts: DataFrame, width: int) -> np.ndarray:
    """How often elements fall into each of ``SLOTS`` slots. A task sends its sums, and the driver gets one number a slot."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = _Hashes(), np.zeros(SLOTS, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                np.add.at(seen, (_elements(text.as_py(), width, cache) % np.uint64(SLOTS)).astype(np.int64), 1)
        slot = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(seen[slot])], ["slot", "c"])

    made = texts.select("text").mapInArrow(part, "slot int, c long").groupBy("slot").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(SLOTS, np.int32)
    out[made.column("slot").to_numpy()] = np.minimum(made.column("c").to_numpy(), 2**31 - 1)
    return out


def _by_rare_shingles(nodes: DataFrame, texts: DataFrame, width: int, held: list[DataFrame]) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, label, n, sketch) of different labels that can have a similarity of 0.8.

    Bags of m <= n elements need an overlap of 4/9 (m + n), which is at least 8/9 m and 4/5 n. With all elements in one order, such bags
    share one among the first m - 8/9 m + 1 of the smaller and the first n - 4/5 n + 1 of the larger, and from the first that they
    share on enough elements are left in both. That holds in any order; in this one elements of rare slots come first. An edit makes
    rare elements, so versions of a text that differ too much meet in none, however many share the rest. Texts whose rarest elements
    are the same in all pair up as often as sizes and sketches allow; no pair is left out for that.
    """
    own = table(nodes.join(texts.select("node", "text"), "node"), "near-heavy")
    counts = own.sparkSession.sparkContext.broadcast(_slot_counts(own, width))  # a number for each slot, whatever the input

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Hashes()
        for batch in batches:
            row, el, place, early = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                x = _elements(text.as_py(), width, cache)
                n, c = len(x), counts.value[(x % np.uint64(SLOTS)).astype(np.int64)]
                at = np.lexsort((x, c))[: n - -(-4 * n // 5) + 1]
                at, where = at[c[at] > 1], np.flatnonzero(c[at] > 1)  # what only one text has joins nothing, but keeps its place
                row.append(np.full(len(at), i))
                el.append(x[at].astype(np.int64))
                place.append(where)
                early.append(where < n - -(-8 * n // 9) + 1)
            held = batch.select(["node", "label", "n", "sketch"]).take(pa.array(np.concatenate([np.zeros(0, np.int64), *row])))
            more = [pa.array(np.concatenate([np.zeros(0, kind), *x]).astype(kind)) for x, kind in ((el, np.int64), (place, np.int32), (early, bool))]
            yield pa.RecordBatch.from_arrays([*held.columns, *more], ["node", "label", "n", "sketch", "el", "at", "early"])

    head = table(own.mapInArrow(part, "node long, label long, n long, sketch array<long>, el long, at int, early boolean"), "near-heads")
    held += [own, head]
    x, y = head.where("early").alias("x"), head.alias("y")
    after = F.struct("x.n", "x.node") < F.struct("y.n", "y.node")
    enough = 9 * F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at")) >= 4 * (F.col("x.n") + F.col("y.n"))
    found = x.join(y, (F.col("x.el") == F.col("y.el")) & (F.col("x.label") != F.col("y.label")) & after & enough & _sketches_allow("x", "y"))
    return found.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def _members(docs: DataFrame, width: int) -> DataFrame:
    """k1, k2, doc_id, words and label (null without words) of every row."""
    need(docs, "doc_id", "text")
    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").alias("text")).select(*row_key(F.col("doc_id"), F.col("text")), "doc_id", "text")
    signed = table(_signed(rows, width), "near-signed")
    nodes = signed.where(F.col("words").isNotNull()).groupBy("words").agg(F.first("k1").alias("k1"), F.first("k2").alias("k2"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands"))
    # in order of the hashes, so that reruns give them the same numbers
    nodes = nodes.withColumnRenamed("k1", "q1").withColumnRenamed("k2", "q2").sortWithinPartitions("words").withColumn("node", F.monotonically_increasing_id())
    nodes = table(nodes, "near-nodes")
    cells = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = cells.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1")
    cells = table(cells.join(shared, "bucket"), "near-cells")
    # the text that others were made from is in the largest buckets
    weight = cells.groupBy("node").agg(F.sum("c").alias("weight"))
    pivot = cells.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("top")).select("bucket", F.col("top.node").alias("pivot"))

    about = nodes.select("node", "n", "sketch")
    star = cells.join(pivot, "bucket").where("node <> pivot").select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b")).distinct()
    star = table(_allowed(star, about), "near-star")
    texts = nodes.select("node", "q1", "q2").join(cells.select("node").distinct(), "node", "left_semi")
    keyed = rows.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), "text")
    texts = table(texts.join(keyed, ["q1", "q2"]).select("node", "text").dropDuplicates(["node"]), "near-texts")
    links = table(_verified(star, texts, width, (4, 5)), "near-links")

    held = [signed, nodes, cells, star, texts, links]
    label = components(links)
    placed = cells.select("bucket", "node").join(label, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    mixed = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("held")).where("low <> high").select("bucket", "held")
    rest = table(placed.join(mixed, "bucket").join(about, "node"), "near-rest")
    held.append(rest)
    if rest.isEmpty():
        return _labelled(signed, nodes, label, held)
    few, many = rest.where(F.col("held") <= DIRECT), rest.where(F.col("held") > DIRECT)
    x, y = few.alias("x"), few.alias("y")
    cross = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.label") < F.col("y.label")) & _sketches_allow("x", "y"))
    cross = cross.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    if not many.isEmpty():
        cross = cross.union(_by_rare_shingles(many.select("node", "label", "n", "sketch").distinct(), texts, width, held))
    cross = cross.distinct().join(star, ["a", "b"], "left_anti")
    more = table(_verified(cross, texts, width, (4, 5)), "near-links")
    held.append(more)
    if not more.isEmpty():
        label = components(links.union(more))

    return _labelled(signed, nodes, label, held)


def meet(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """``rows`` left-joined with ``facts`` (one row a key) by ``key``.

    Keys that hold more than a thousandth of the rows, of which there are fewer than a thousand, are broadcast, so that no task gets all
    rows of one; the others are joined as Spark sees fit.
    """
    large = rows.groupBy(key).agg(F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("n") * 1000 > rows.count())).select(key)
    known = F.struct(*(c for c in facts.columns if c != key)).alias("fact")
    held = F.broadcast(table(facts.join(F.broadcast(large), key).select(key, known), "near-large"))
    marked = rows.join(held, key, "left")
    rest = marked.where(F.col("fact").isNull()).drop("fact").join(facts, key, "left")
    return marked.where(F.col("fact").isNotNull()).select(*rows.columns, "fact.*").unionByName(rest)


def _labelled(signed: DataFrame, nodes: DataFrame, label: DataFrame, held: list[DataFrame]) -> DataFrame:
    """The rows with their labels, written; what was written on the way goes."""
    known = nodes.select("words", "node").join(label, "node", "left").select("words", F.coalesce("label", "node").alias("label"))
    rows = signed.select("k1", "k2", "doc_id", "words")
    out = meet(rows.where(F.col("words").isNotNull()), known, "words").unionByName(rows.where(F.col("words").isNull()).withColumn("label", F.lit(None).cast("long")))
    out = table(out, "near-member")
    release(*held)
    return out


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, node, class_id for every row of ``docs`` (doc_id, text); ``node`` is the hash of its words in 32 hex digits, null without any.

    Words are lower-cased (A-Z) and cut at ASCII white space. Rows with the same words are copies; other rows are linked if the
    weighted Jaccard similarity of their bags of ``width``-word shingles (all words, where there are fewer) is 0.8 or more. A class is a
    component of links; its id is its least doc_id (null if it has none). A text without words, null or empty, is alone in its class. Rows
    that repeat are copies. An empty table gives no rows. Other columns are not returned.

    A link of 0.8 is missed by all bands with a chance of ``(1 - 0.8 ** ROWS) ** BANDS``, 7 in a million, and less above.
    """
    member = _members(docs, width)
    classed = member.where(F.col("label").isNotNull())
    first = table(classed.groupBy("label").agg(F.min("doc_id").alias("class_id")), "near-classes")
    node = F.lower(F.concat(F.lpad(F.hex("words.high"), 16, "0"), F.lpad(F.hex("words.low"), 16, "0"))).alias("node")
    out = meet(classed.select("label", "doc_id", "words"), first, "label").select("doc_id", node, "class_id")
    return out.union(member.where(F.col("label").isNull()).select("doc_id", F.lit(None).cast("string"), F.col("doc_id").alias("class_id")))


def _allowed(pairs: DataFrame, about: DataFrame) -> DataFrame:
    """The pairs that sizes and sketches allow."""
    x = about.select(F.col("node").alias("a"), F.struct("n", "sketch").alias("x"))
    y = about.select(F.col("node").alias("b"), F.struct("n", "sketch").alias("y"))
    return pairs.join(x, "a").join(y, "b").where(_sketches_allow("x", "y")).select("a", "b")


def drop_near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with one document of each class: that with the least doc_id, or any one where no row has an id.

    Texts without words all stay.
    """
    member = _members(docs, width)
    classed = member.where(F.col("label").isNotNull())
    least = table(classed.groupBy("label").agg(F.min("doc_id").alias("least")), "near-classes")
    first = meet(classed, least, "label").where(F.col("doc_id").eqNullSafe(F.col("least"))).select("label", "k1", "k2")
    one = first.join(first.groupBy("label").agg(F.min("k1").alias("k1")), ["label", "k1"]).groupBy("k1", "k2").agg(F.count("*").alias("c"))
    stay = table(one.union(member.where(F.col("label").isNull()).select("k1", "k2", F.lit(1).cast("long")).distinct()), "near-stay")
    keyed = docs.select(*row_key(column("doc_id").cast("long"), column("text")), packed(docs))
    lone = keyed.join(stay.where("c = 1"), ["k1", "k2"], "left_semi")
    if not (again := stay.where("c > 1")).isEmpty():  # rows that repeat as a whole
        lone = lone.unionByName(keyed.join(again, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]))
    return lone.select("row.*")
