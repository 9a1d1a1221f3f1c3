"""The trie of conversation prefixes, from sorted turn sequences and range minima over their common prefixes.

Turns become two 64-bit hashes and a count of code points, so texts stay where they are read. Conversations are rebuilt, sorted by their
sequences of hashes over all tasks, and cut into blocks. In a block, neighbours have common prefixes of known lengths (LCPs). A prefix is
a candidate where it is seen first; a sparse table of LCP minima lets each binary-search how far it reaches to the right, and the prefix
that it branches from how far to the left. That gives member intervals; sums over an interval are differences of running sums.

Intervals that reach an end of a block may go on in the next. They are prefixes of a block's first or last sequence, so they are few.
They leave with a 128-bit digest of the prefix, and their parts are added up by it. What the first and the last position of a task add
depends on how much of their sequences the neighbouring tasks share, which is found by the digests too and corrected in the sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, need, release, table

#: Rebuilt conversations of one hundred ids begin with turns of the first, at most ``SHARED`` - 1.
FAMILY, SHARED = 100, 6
#: Turns, and conversations, after which a block is closed.
BLOCK_TURNS, BLOCK_ROWS = 1 << 20, 1 << 16
#: Largest table of open prefixes that is broadcast, in rows of five numbers.
BROADCAST_ROWS = 1 << 18

NOTHING = hashlib.sha256(b"").hexdigest()
_LONGS = "depth n_convs conv_id parent_conv_id n_children n_leaves saved_tokens k1 k2 pk1 pk2 total cum_before cum last_len first_id".split()
_FLAGS = "open at_first at_last goes_on".split()
_PIECES = ", ".join([*(f"{c} long" for c in _LONGS), *(f"{c} boolean" for c in _FLAGS), "part int, ends_sha256 string, ids string"])


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, h (two hashes a turn), cp (code points a turn) of every rebuilt conversation of ``turns`` (conv_id, turn, role, text)."""
    conv = column("conv_id").cast("long")
    role, text = (F.coalesce(column(c).cast("string"), F.lit("")) for c in ("role", "text"))
    hashed = turns.where(conv.isNotNull()).select(
        (conv - conv % FAMILY).alias("base"), conv.alias("conv_id"), column("turn").cast("long").alias("turn"), role.alias("role"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(0x5EED), role, text).alias("b"), F.char_length(text).cast("long").alias("cp"),
    )
    # dealt by family, so that rows of a conversation and the head of its family meet without a second shuffle
    own = hashed.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "a", "b", "cp"))).alias("t"))
    heads = own.where("conv_id = base").select("base", F.slice("t", 1, SHARED - 1).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("int")
    none = F.slice("t", 1, 0)
    whole = F.concat(F.slice(F.coalesce("head", none), F.lit(1), taken), F.slice("t", taken + 1, F.size("t")))
    return own.join(heads, "base", "left").select("conv_id", whole.alias("t")).select("conv_id", F.flatten(F.transform("t", lambda x: F.array(x["a"], x["b"]))).alias("h"), F.transform("t", lambda x: x["cp"]).alias("cp"))


@dataclass
class Block:
    """Consecutive conversations in sorted order, flat: ids, lengths, hashes (two columns) and code points of turns."""

    ids: np.ndarray
    size: np.ndarray
    hashes: np.ndarray
    cp: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Block:
        h, cp = batch.column("h"), batch.column("cp")
        return cls(batch.column("conv_id").to_numpy(), np.diff(cp.offsets.to_numpy()).astype(np.int64), h.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2), cp.flatten().to_numpy(zero_copy_only=False).astype(np.int64))

    @classmethod
    def joined(cls, parts: list[Block]) -> Block:
        return cls(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("ids", "size", "hashes", "cp")))

    def first(self) -> np.ndarray:
        return self.hashes[: self.size[0]]

    def last(self) -> np.ndarray:
        return self.hashes[len(self.hashes) - self.size[-1] :]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Turns that two sequences of hashes share at their start."""
    n = min(len(a), len(b))
    differ = np.flatnonzero((a[:n] != b[:n]).any(axis=1))
    return int(differ[0]) if len(differ) else n


def neighbour_lcps(size: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """LCP of each sequence but the first with the one before it."""
    start = np.cumsum(size) - size
    least = np.minimum(size[1:], size[:-1])
    pair = np.repeat(np.arange(len(least)), least)
    step = np.arange(len(pair)) - np.repeat(np.cumsum(least) - least, least)
    differ = np.flatnonzero((hashes[start[pair] + step] != hashes[start[pair + 1] + step]).any(axis=1))
    out = least.copy()
    np.minimum.at(out, pair[differ], step[differ])
    return out


def sparse_minima(values: np.ndarray) -> list[np.ndarray]:
    """Row k has the least of ``values[i : i + 2**k]`` at i."""
    rows = [values]
    while 2 << (len(rows) - 1) <= len(values):
        half = 1 << (len(rows) - 1)
        rows.append(np.minimum(rows[-1][:-half], rows[-1][half:]))
    return rows


def right_extent(rows: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last position up to which all LCPs after ``at`` are at least ``depth``."""
    r, n = at.copy(), len(rows[0])
    for k in range(len(rows) - 1, -1, -1):
        inside = r + (1 << k) < n
        low = rows[k][np.where(inside, r + 1, 0)]
        r = np.where(inside & (low >= depth), r + (1 << k), r)
    return r


def left_extent(rows: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first position from which all LCPs up to ``at`` are at least ``depth``."""
    left = at.copy()
    for k in range(len(rows) - 1, -1, -1):
        inside = left >= (1 << k)
        low = rows[k][np.where(inside, left - (1 << k) + 1, 0)]
        left = np.where(inside & (low >= depth), left - (1 << k), left)
    return left


def range_minimum(rows: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least value from ``left`` to ``right``."""
    k = np.frexp((right - left + 1).astype(float))[1] - 1
    out = np.empty(len(left), rows[0].dtype)
    for j in np.unique(k):
        own = k == j
        out[own] = np.minimum(rows[j][left[own]], rows[j][right[own] - (1 << j) + 1])
    return out


def _digests(seq: np.ndarray) -> np.ndarray:
    """Two numbers for each prefix of a sequence of hashes, the empty one first."""
    state, out = hashlib.blake2b(digest_size=16), [b""] * (len(seq) + 1)
    out[0] = state.digest()
    for d, turn in enumerate(np.ascontiguousarray(seq)):
        state.update(turn.tobytes())
        out[d + 1] = state.digest()
    return np.frombuffer(b"".join(out), np.int64).reshape(-1, 2)


def _running(values: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(values)))


def block_nodes(b: Block, before: np.ndarray | None, after: np.ndarray | None, part: int) -> pa.RecordBatch:
    """Every prefix of a block as a row. ``before`` and ``after`` are the sequences around it, None at the ends of a task."""
    n, at_first, at_last = len(b.ids), before is None, after is None
    lcp = np.concatenate(([-1 if at_first else _common(before, b.first())], neighbour_lcps(b.size, b.hashes)))
    beyond = -1 if at_last else _common(b.last(), after)
    rows = sparse_minima(lcp)

    # candidates: the first position of each prefix in the block
    begin = lcp + 1
    begin[0] = 0
    count = b.size - begin + 1
    where = _running(count)
    pos = np.repeat(np.arange(n), count)
    depth = np.arange(where[-1]) - where[pos] + begin[pos]
    right = right_extent(rows, pos, depth)
    parent = np.arange(len(pos)) - 1
    branch = np.flatnonzero((depth == begin[pos]) & (pos > 0))
    left = left_extent(rows, pos[branch], depth[branch] - 1)
    parent[branch] = where[left] + depth[branch] - 1 - begin[left]

    start, cp = _running(b.size), _running(b.cp)
    total = cp[start[1:]] - cp[start[:-1]]
    def cum(at, d):  # code points of the first d turns
        return cp[start[at] + np.maximum(d, 0)] - cp[start[at]]
    fresh = total - cum(np.arange(n), lcp)
    fresh[0] = 0
    members = right - pos + 1
    own, of_all = _running(fresh), _running(total)
    cum_before = cum(pos, depth - 1)
    tail = total[pos] - np.where(pos == 0, np.maximum(cum_before, cum(pos, lcp[pos])), cum_before)
    unknown = (pos == 0) & at_first
    saved = of_all[right + 1] - of_all[pos] - members * cum_before - (own[right + 1] - own[pos + 1]) - np.where(unknown, 0, tail)

    leaf = np.concatenate((lcp[1:], [b.size[-1] if at_last else beyond])) < b.size
    leaves = _running(leaf)
    new = (depth > 0) & ((pos > 0) | (~unknown & (depth > lcp[0])))
    children = np.bincount(parent[new], minlength=len(pos))
    first_conv = range_minimum(sparse_minima(b.ids), pos, right)

    first, last = unknown, (right == n - 1) & at_last
    open_ = first | last | ((pos == 0) & (depth <= lcp[0])) | ((right == n - 1) & (depth <= beyond))
    key = np.zeros((len(pos), 2), np.int64)
    ahead = open_ & (pos == 0)
    key[ahead] = _digests(b.first())[depth[ahead]]
    behind = open_ & (pos > 0)
    key[behind] = _digests(b.last())[depth[behind]] if behind.any() else 0
    asks = (depth > 0) & open_[parent]

    # members without a further turn: the run of equal sequences that begins at the prefix's first position
    ends = np.flatnonzero(depth == b.size[pos])
    run = np.flatnonzero(count > 0)
    run_end = np.append(run, n)[np.searchsorted(run, pos[ends], side="right")]
    sha, ids, first_id = np.full(len(pos), NOTHING, object), np.full(len(pos), None, object), np.zeros(len(pos), np.int64)
    for c, a, z in zip(ends, pos[ends], run_end, strict=True):
        text = ",".join(map(str, b.ids[a:z].tolist()))
        if open_[c]:
            ids[c], first_id[c] = text, b.ids[a]
        else:
            sha[c] = hashlib.sha256(text.encode()).hexdigest()

    no = np.zeros(len(pos), bool)
    longs = {
        "depth": (depth, no), "n_convs": (members, no), "conv_id": (first_conv, no), "parent_conv_id": (first_conv[parent], asks | (depth == 0)), "n_children": (children, no),
        "n_leaves": (leaves[right + 1] - leaves[pos], no), "saved_tokens": (saved, no), "k1": (key[:, 0], ~open_), "k2": (key[:, 1], ~open_), "pk1": (key[parent, 0], ~asks), "pk2": (key[parent, 1], ~asks),
        "total": (total[pos], ~open_), "cum_before": (cum_before, ~open_), "cum": (cum(pos, depth), ~open_), "last_len": (np.full(len(pos), b.size[-1]), ~open_), "first_id": (first_id, ids == None),  # noqa: E711
    }
    flags = {"open": open_, "at_first": first, "at_last": last, "goes_on": depth < b.size[pos]}
    arrays = [*(pa.array(longs[c][0].astype(np.int64), mask=longs[c][1]) for c in _LONGS), *(pa.array(flags[c]) for c in _FLAGS), pa.array(np.full(len(pos), part, np.int32)), pa.array(sha, pa.string()), pa.array(ids, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, [*_LONGS, *_FLAGS, "part", "ends_sha256", "ids"])


def _pieces(sequences: DataFrame, block_turns: int, block_rows: int) -> DataFrame:
    """Every prefix of every block of the sorted sequences."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, before, held = TaskContext.get().partitionId(), None, []
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                new = Block.of(batch.slice(at, block_rows))
                if held and (sum(len(x.cp) for x in held) >= block_turns or sum(len(x.ids) for x in held) >= block_rows):
                    block = Block.joined(held)
                    yield block_nodes(block, before, new.first(), number)
                    before, held = block.last(), []
                held.append(new)
        if held:
            yield block_nodes(Block.joined(held), before, None, number)

    return sequences.repartitionByRange("h", "conv_id").sortWithinPartitions("h", "conv_id").mapInArrow(part, _PIECES)


def _edges(pieces: DataFrame) -> DataFrame:
    """part, lcp_before, cum_shared, lcp_after: what each task's first and last sequence share with the tasks around it. One row a task."""
    first = pieces.where("at_first").select("part", "depth", "k1", "k2", "cum")
    last = pieces.where("at_last").select("part", "depth", "k1", "k2")
    order = first.select("part").distinct().withColumn("next", F.lead("part").over(Window.orderBy("part")))
    met = last.join(order, "part").select(F.col("part").alias("earlier"), F.col("next").alias("part"), "depth", "k1", "k2").join(first, ["part", "depth", "k1", "k2"])
    shared = met.groupBy("earlier", "part").agg(F.max("depth").alias("lcp"), F.max("cum").alias("cum_shared"))
    before = shared.select("part", F.col("lcp").alias("lcp_before"), "cum_shared")
    after = shared.select(F.col("earlier").alias("part"), F.col("lcp").alias("lcp_after"))
    out = order.select("part").join(before, "part", "left").join(after, "part", "left")
    return out.select("part", F.coalesce("lcp_before", F.lit(-1)).alias("lcp_before"), F.coalesce("cum_shared", F.lit(0)).alias("cum_shared"), F.coalesce("lcp_after", F.lit(-1)).alias("lcp_after"))


def _long_ends(pieces: DataFrame) -> DataFrame:
    """depth, k1, k2, ends_sha256 of open prefixes: the hash runs over the parts in order, which are not put together."""
    keys = ["depth", "k1", "k2"]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for *own, ids in zip(*(batch.column(c).to_pylist() for c in (*keys, "ids")), strict=True):
                if own != key:
                    done += [(*key, state.hexdigest())] if key else []
                    key, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield _rows(done)
        if key:
            yield _rows([(*key, state.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*done, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], [*keys, "ends_sha256"])

    some = pieces.where(F.col("ids").isNotNull()).select(*keys, "first_id", "ids")
    return some.repartition(*keys).sortWithinPartitions(*keys, "first_id").mapInArrow(part, "depth long, k1 long, k2 long, ends_sha256 string")


RESULT = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def prefix_trie(turns: DataFrame, block_turns: int = BLOCK_TURNS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for every distinct prefix of the rebuilt conversations of ``turns`` (conv_id, turn, role, text), the empty one included.

    Turns of a conversation are ordered by ``turn`` (null first), ties by role and then by the hash of role and text, so a row that repeats is a
    turn of its own. Null roles and texts are empty. Conversation c is rebuilt from the first h turns of conversation ``c - c % 100`` (all if
    fewer, none if absent) and its own turns after its first h, with h = crc32(c) % 6. A prefix has ``depth``; its smallest member ``conv_id``; its
    parent's, ``parent_conv_id`` (null for depth 0); the numbers of members, children, and childless prefixes below it or at it; the code points
    that its subtree saves if each last text is kept once; and the SHA-256 of its members that end there. Rows without a conv_id belong to no
    conversation and are left out. An empty table gives no rows. Other columns are not used.

    A conversation's turns are held in one array, 24 bytes a turn, without roles and texts.
    """
    need(turns, "conv_id", "turn", "role", "text")
    sequences = table(rebuilt(turns), "trie-sequences")
    pieces = table(_pieces(sequences, block_turns, block_rows), "trie-pieces")
    open_ = pieces.where("open")
    edges = F.broadcast(_edges(open_))  # one row a task
    known = open_.join(edges, "part")
    keys = ["depth", "k1", "k2"]

    def if_(flag: Column, value: Column) -> Column:
        return F.when(flag, value).otherwise(F.lit(0))

    fixed = known.select(
        *keys, "pk1", "pk2", "n_convs", "conv_id",
        (F.col("n_children") + if_(F.expr("at_first AND goes_on AND depth + 1 > lcp_before"), F.lit(1))).alias("n_children"),
        (F.col("n_leaves") + if_(F.expr("at_last AND lcp_after < last_len"), F.lit(1))).alias("n_leaves"),
        (F.col("saved_tokens") - if_(F.col("at_first"), F.col("total") - F.greatest("cum_before", "cum_shared"))).alias("saved_tokens"),
    )
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = fixed.groupBy(*keys).agg(F.min("conv_id").alias("conv_id"), F.max("pk1").alias("pk1"), F.max("pk2").alias("pk2"), *sums)
    merged = table(merged.join(_long_ends(open_), keys, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))), "trie-open")
    above = merged.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("pk1"), F.col("k2").alias("pk2"), F.col("conv_id").alias("above"))
    if merged.count() <= BROADCAST_ROWS:
        above = F.broadcast(above)
    closed = pieces.where("NOT open")
    asking = closed.where(F.col("pk1").isNotNull()).select(*keys, "pk1", "pk2", *(c for c in RESULT if c not in ("depth", "parent_conv_id")))
    asking = asking.unionByName(merged.select(asking.columns)).join(above, ["depth", "pk1", "pk2"], "left").withColumnRenamed("above", "parent_conv_id")
    out = table(closed.where(F.col("pk1").isNull()).select(RESULT).unionByName(asking.select(RESULT)), "trie-nodes")
    release(sequences, pieces, merged)
    return out
