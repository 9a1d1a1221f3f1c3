"""Benchmark decontamination by suffix arrays over shards of the training texts.

A task cuts its rows into shards of about a million words and sorts the word positions of each by the words that
follow, as far as a test window is long: a suffix array to that depth. Positions whose next words the tests do
not know cannot match and are left out. All test suffixes then search the array together, by two vectorised
binary searches each (first and last place), which gives every verbatim occurrence; neighbours on
one diagonal join to the longest matches. Training texts are neither shuffled nor gathered.

Tests are broadcast in blocks of bounded size; a larger test set takes more passes over the texts, not more memory. Each pass writes
its hits alone, by a key of the text, before the next begins; at the end they are joined to the rows. One item is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, need, packed, release, row_key, table
from .near_dedup import meet

#: What separates words: ASCII but for letters and digits. A-Z become a-z.
_TABLE = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i > 127 else 32 for i in range(256))
#: The same words for regular expressions.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MATCH = T.StructType([T.StructField("item_id", T.StringType()), *(T.StructField(c, T.IntegerType()) for c in ("doc_word", "item_word", "n_words"))])
RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("ranges", T.ArrayType(T.IntegerType())), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("matches", T.ArrayType(MATCH))])


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class TestSuffixes:
    """The windows of test items as sorted word numbers, packed several to a 62-bit key."""

    def __init__(self, items: list[tuple[str | None, str]], width: int):
        self.names = [i for i, _ in items]
        split = [words(t) for _, t in items]
        self.number = {w: k + 1 for k, w in enumerate(sorted({w for x in split for w in x}))}
        self.bits = max(1, len(self.number).bit_length())
        self.pack = max(1, 62 // self.bits)
        self.columns = -(-width // self.pack)
        rows, lens, where = [], [], []
        for k, x in enumerate(split):
            size = min(width, len(x))
            ids = [self.number[w] for w in x]
            for at in range(len(x) - size + 1 if size else 0):
                rows.append(ids[at : at + size] + [0] * (width - size))
                lens.append(size)
                where.append((k, at))
        lens, where = np.array(lens, np.int64), np.array(where, np.int64).reshape(-1, 2)
        keys = self.keys(np.array(rows, np.int64).reshape(-1, width), lens)
        self.key, at = np.unique(np.column_stack([lens[:, None], keys]), axis=0, return_inverse=True)  # equal windows once
        self.size, self.key = self.key[:, 0], self.key[:, 1:]
        order = np.argsort(at.ravel(), kind="stable")
        self.where, self.bound = where[order], np.searchsorted(at.ravel()[order], np.arange(len(self.key) + 1))
        self.mask = self.keys(np.full((len(self.key), width), (1 << self.bits) - 1), self.size)
        self.least = int(self.size.min()) if len(self.size) else 0
        self.width = width

    def keys(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Rows of word numbers as keys; words from a row's size on are 0."""
        ids = np.where(np.arange(ids.shape[1])[None, :] < sizes[:, None], ids, 0)
        out = np.zeros((len(ids), self.columns), np.int64)
        for k in range(self.columns * self.pack):
            out[:, k // self.pack] = (out[:, k // self.pack] << self.bits) | (ids[:, k] if k < ids.shape[1] else 0)
        return out

    def suffix_array(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions that can match, in the order of the words that follow, and their keys."""
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        n = len(ids) - self.least + 1
        at = np.flatnonzero(known[self.least : self.least + n] - known[:n] == self.least) if n > 0 else np.zeros(0, np.int64)
        ids = np.concatenate([ids, np.zeros(self.columns * self.pack, ids.dtype)])
        keys = np.zeros((len(at), self.columns), np.int64)
        for k in range(self.columns * self.pack):
            keys[:, k // self.pack] = (keys[:, k // self.pack] << self.bits) | ids[at + k]
        order = np.lexsort(keys.T[::-1])
        return at[order], keys[order]

    def search(self, keys: np.ndarray, after: bool) -> np.ndarray:
        """For each window the first place whose masked key is not below it (``after``: above it)."""
        low, high = np.zeros(len(self.key), np.int64), np.full(len(self.key), len(keys), np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) // 2
            less, equal = np.zeros(len(open_), bool), np.ones(len(open_), bool)
            for c in range(self.columns):
                found = keys[mid, c] & self.mask[open_, c]
                less |= equal & (found < self.key[open_, c])
                equal &= found == self.key[open_, c]
            go = less | equal if after else less
            low[open_[go]] = mid[go] + 1
            high[open_[~go]] = mid[~go]
        return low

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All occurrences in a shard: positions and windows."""
        at, keys = self.suffix_array(ids)
        first, last = self.search(keys, False), self.search(keys, True)
        n = last - first
        which = np.repeat(np.arange(len(n)), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        return at[place], which


def _merge(ranges: np.ndarray) -> np.ndarray:
    """Sorted disjoint ranges that cover the same words."""
    if not len(ranges):
        return ranges
    ranges = ranges[np.lexsort(ranges.T[::-1])]
    reach = np.maximum.accumulate(ranges[:, 1])
    new = np.concatenate(([True], ranges[1:, 0] > reach[:-1]))
    at = np.flatnonzero(new)
    return np.column_stack([ranges[at, 0], np.maximum.reduceat(ranges[:, 1], at)])


def _shard(tests: TestSuffixes, split: list[list[bytes]]) -> list[tuple[np.ndarray, dict[str, tuple[int, int, int]]]]:
    """For each text of a shard: ranges of hit words, and by item its longest match."""
    out: list = [(np.zeros((0, 2), np.int64), {}) for _ in split]
    if not tests.least:
        return out
    get = tests.number.get
    ids = np.zeros(sum(map(len, split)) + len(split), np.int64)  # a 0 stands after each text
    starts = np.concatenate(([0], np.cumsum([len(x) + 1 for x in split])))
    for x, s in zip(split, starts, strict=False):
        ids[s : s + len(x)] = [get(w, 0) for w in x]
    at, which = tests.find(ids)
    if not len(at):
        return out
    doc = np.searchsorted(starts, at, side="right") - 1
    ranges = np.column_stack([at - starts[doc], at - starts[doc] + tests.size[which]])
    order = np.argsort(doc, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1):
        out[doc[part[0]]] = (_merge(ranges[part]), {})
    # every place of a window in an item, on its diagonal: equal windows may be in several items
    n = tests.bound[which + 1] - tests.bound[which]
    row = np.repeat(np.arange(len(at)), n)
    place = tests.where[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(tests.bound[which], n)]
    item, offset, pos = place[:, 0], place[:, 1], at[row]
    order = np.lexsort((pos, pos - offset, item))
    item, offset, pos, size, who = item[order], offset[order], pos[order], tests.size[which[row]][order], doc[row][order]
    new = np.concatenate(([True], (item[1:] != item[:-1]) | (pos[1:] - offset[1:] != pos[:-1] - offset[:-1]) | (pos[1:] != pos[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(pos)) - 1
    for f, length in zip(first, (last - first + size[first]).tolist(), strict=True):
        best = out[who[f]][1]
        name = tests.names[item[f]]
        if name is not None:
            _better(best, name, (int(pos[f] - starts[who[f]]), int(offset[f]), length))
    return out


def _better(best: dict[str, tuple[int, int, int]], item: str, match: tuple[int, int, int]) -> None:
    """Keep the longer match (place in the text, place in the item, words) of an item; of equal ones the first in the text, then in the item."""
    old = best.get(item)
    if old is None or (-match[2], match[:2]) < (-old[2], old[:2]):
        best[item] = match


@lru_cache(maxsize=1)
def _index(broadcast, width: int) -> TestSuffixes:
    return TestSuffixes(broadcast.value, width)


def _blocks(benchmark: DataFrame, limit: int, unnamed: bool) -> Iterator[tuple[list[tuple[str | None, str]], bool]]:
    """Items with a text, and an id or ``unnamed``, in blocks of about ``limit`` bytes at most; True with the last."""
    rows = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), "text")
    rows = rows if unnamed else rows.where(F.col("item_id").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 if size <= limit else 2 * -(-size // limit)
    for k in range(n):
        own = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield sorted((tuple(r) for r in own.collect()), key=lambda x: (x[0] is None, x[0] or "", x[1])), k == n - 1


_MATCH = pa.struct([("item_id", pa.string()), ("doc_word", pa.int32()), ("item_word", pa.int32()), ("n_words", pa.int32())])
_TYPES = {"n_words": pa.int64(), "ranges": pa.list_(pa.int32()), "items": pa.list_(pa.string()), "matches": pa.list_(_MATCH)}


def _result(n_words: list[int], found: list[tuple[np.ndarray, dict[str, tuple[int, int, int]]]]) -> list[pa.Array]:
    """Columns of ``RESULT``."""
    matches = [[dict(zip(("item_id", "doc_word", "item_word", "n_words"), (i, *best[i]), strict=True)) for i in sorted(best)] for _, best in found]
    made = {"n_words": n_words, "ranges": [r.ravel().tolist() for r, _ in found], "items": [sorted(best) for _, best in found], "matches": matches}
    return [pa.array(made[c], t) for c, t in _TYPES.items()]


def _pass(rows: DataFrame, block: list[tuple[str | None, str]], width: int, shard_words: int, hits_only: bool) -> DataFrame:
    """``rows`` (text and others) without their text, with what ``block`` hits in it; with ``hits_only`` those with a hit."""
    index = rows.sparkSession.sparkContext.broadcast(block)
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = _index(index, width)
        for batch in batches:
            lengths = np.cumsum(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            for k in np.unique(lengths // (6 * shard_words)):
                a, b = np.searchsorted(lengths // (6 * shard_words), [k, k + 1])
                some = batch.slice(a, b - a)
                split = [words(t.as_py()) for t in some.column("text")]
                found = _shard(tests, split)
                at = [i for i, (ranges, _) in enumerate(found) if len(ranges) or not hits_only]
                made = _result([len(split[i]) for i in at], [found[i] for i in at])
                yield pa.RecordBatch.from_arrays([*(some.column(f.name).take(pa.array(at, pa.int64())) for f in kept), *made], [*(f.name for f in kept), *_TYPES])

    return rows.mapInArrow(part, T.StructType([*kept, *RESULT]))


def _together(found: DataFrame) -> DataFrame:
    """key, found (``RESULT``) of texts that several blocks hit: covers are joined, and of each item the longest match stays."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, out = [], []
            for parts in batch.column("parts").to_pylist():
                ranges = _merge(np.vstack([np.array(p["ranges"], np.int64).reshape(-1, 2) for p in parts]))
                best: dict[str, tuple[int, int, int]] = {}
                for m in (m for p in parts for m in p["matches"]):
                    _better(best, m["item_id"], (m["doc_word"], m["item_word"], m["n_words"]))
                n_words.append(parts[0]["n_words"])
                out.append((ranges, best))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.StructArray.from_arrays(_result(n_words, out), list(_TYPES))], ["key", "found"])

    key = found.schema["key"]
    # rows that repeat find the same, so a key has one row a block; one row at most holds a text's finds of all blocks
    parts = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("block", "n_words", "ranges", "matches"))).alias("parts"))
    return parts.mapInArrow(part, T.StructType([key, T.StructField("found", RESULT)]))


def _searched(docs: DataFrame, benchmark: DataFrame, width: int, block_bytes: int, shard_words: int, unnamed: bool, *replaced: str) -> DataFrame:
    """row (the columns of ``docs`` but for ``replaced``), n_words, n_hit, items, matches."""
    need(docs, "doc_id", "text")
    need(benchmark, "item_id", "text")
    text = column("text").cast("string")
    rows, written = docs.select(packed(docs, *replaced), text.alias("text")), []
    for k, (block, last) in enumerate(_blocks(benchmark, block_bytes, unnamed)):
        if last and not written:
            out = _pass(rows, block, width, shard_words, False)
            break
        # of several blocks each writes its hits alone, so that one index is alive at a time and no text is written
        keyed = docs.select(F.struct(*row_key(text)).alias("key"), text.alias("text")).where(F.col("text").isNotNull())
        hits = _pass(keyed, block, width, shard_words, True).dropDuplicates(["key"]).withColumn("block", F.lit(k))
        written.append(table(hits, "contamination"))
    else:
        known = table(_together(reduce(DataFrame.unionByName, written)), "contamination-hits")
        release(*written)
        n_words = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
        keyed = rows.select("row", n_words.alias("own"), F.struct(*row_key(F.col("text"))).alias("key"))
        none = F.array().cast("array<int>"), F.array().cast("array<string>"), F.array().cast(T.ArrayType(MATCH))
        out = meet(keyed, known, "key").select("row", F.col("own").alias("n_words"), *(F.coalesce(F.col("found")[c], empty).alias(c) for c, empty in zip(("ranges", "items", "matches"), none, strict=True)))
    hit = F.aggregate(F.transform("ranges", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select("row", "n_words", hit.alias("n_hit"), "items", "matches")


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13, block_bytes: int = 16_000_000, shard_words: int = 1_000_000, unnamed: bool = False) -> DataFrame:
    """The columns of ``docs`` (doc_id, text), with n_words, n_hit, items and matches.

    A window is ``width`` consecutive words of an item of ``benchmark`` (item_id, text), or a whole shorter item with
    a word. ``n_hit`` counts a text's words inside any occurrence; ``items`` has the ids (as text, sorted) of items with
    one; ``matches`` has the longest verbatim match of each such item (the first in the text
    of equal ones), with its place in the text and in the item.

    A null text has no words. Items without a text are left out, and those without an id unless ``unnamed``: then they
    count in ``n_hit`` alone. Items that repeat an id count as one. Rows of ``docs`` that repeat or have no id are judged one
    by one. With no items nothing is hit. Columns named as one of the four results are replaced, all others stay.
    """
    results = ("n_words", "n_hit", "items", "matches")
    return _searched(docs, benchmark, width, block_bytes, shard_words, unnamed, *results).select("row.*", *results)


def is_contaminated(share: int = 20):
    """At least one word in ``share`` is hit."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 13, share: int = 20, block_bytes: int = 16_000_000) -> DataFrame:
    """``docs`` without the contaminated rows; all their columns stay."""
    return _searched(docs, benchmark, width, block_bytes, 1_000_000, True).where(~is_contaminated(share)).select("row.*")
