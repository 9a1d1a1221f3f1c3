"""Spelling variants: words that differ by one inserted, deleted or replaced code point, and the frequent form of each rare one.

Words are compared in dense tiles: two blocks of words as padded matrices of code points, one pair of matrices aligned left and one
right, give the common prefix p and suffix s of all their pairs at once. Of two words whose longer one has m code points, p + s >= m - 1
says that one edit makes them equal.

Which blocks meet is found by halving. If p + s >= m - 1, the words share their first half or their last half, so each word is filed
under both, once as the longer word (m is its length) and once as the shorter (m is one more). Groups of more than ``LARGE`` words are halved
again by what is not yet known to be equal, until the rest is one code point; then all of a group are within one edit of each other, and
there are no more of them than letters. A pair that shares both halves counts under the first alone: every group knows below which
prefix length its pairs have to be. So each pair is counted once, and no group grows with the data.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, need, release, table

SHORTEST, LEAST = 7, 2
#: A form has at least so many times the word's occurrences.
TIMES = 10
#: Of so many runs one loses a code point.
SLIPS = 31
#: Largest group of words that is compared as it is, and rows of a block.
LARGE, BLOCK = 512, 64
#: Cells of a tile (rows x rows x width); long words get smaller blocks.
CELLS = 8_000_000
#: Distinct words a task counts before it sends them on.
COUNTED = 300_000


def runs_of(doc_id: int | None, text: str | None, shortest: int = SHORTEST) -> Counter:
    """Words of a text in Latin-1 and how often each occurs, with the slips that its doc_id says."""
    found = Counter(re.findall(rb"[a-z\xc0-\xff]{%d,}" % shortest, text.encode("latin-1", "replace").lower())) if text else Counter()
    seed = zlib.crc32(b"%d:" % doc_id if doc_id is not None else b":")
    out = Counter()
    for run, n in found.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
        if h % SLIPS == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < shortest:
                continue
        out[run] += n
    return out


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """word, n of the words of all texts."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                seen.update(runs_of(doc_id.as_py(), text.as_py(), shortest))
                if len(seen) > COUNTED:
                    yield sent(seen)
                    seen = Counter()
        yield sent(seen)

    def sent(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").cast("string").alias("text"))
    return rows.mapInArrow(part, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _halved(rows: DataFrame) -> DataFrame:
    """word, n, m, a, b, below -> the same for both halves of what is not known to be equal.

    In a group the longest words have ``m`` code points, all share their first ``a`` and last ``b``, and of its pairs those with a common
    prefix shorter than ``below`` count.
    """
    rest = F.col("m") - 1 - F.col("a") - F.col("b")
    upper, lower = F.ceil(rest / 2).cast("int"), F.floor(rest / 2).cast("int")
    first = F.struct((F.col("a") + upper).alias("a"), F.col("b").alias("b"), F.col("below").alias("below"))
    last = F.struct(F.col("a").alias("a"), (F.col("b") + lower + 1).alias("b"), (F.col("a") + upper).alias("below"))
    return rows.select("word", "n", "m", F.explode(F.array(first, last)).alias("half")).select("word", "n", "m", "half.a", "half.b", "half.below")


def _filed(rows: DataFrame) -> DataFrame:
    """The rows with the hash of their group, ``cell``."""
    size = F.char_length("word")
    return rows.withColumn("cell", F.xxhash64("m", "a", "b", F.substr("word", F.lit(1), F.col("a")), F.substr("word", size - F.col("b") + 1, F.col("b"))))


def groups(words: DataFrame, large: int = LARGE) -> list[DataFrame]:
    """Tables of word, n, m, a, b, below, cell: words of which some pair may be one edit apart, in groups that are small or cannot be halved."""
    size = F.char_length("word")
    start = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("m")).select("*", F.lit(0).alias("a"), F.lit(0).alias("b"), (F.col("m") + 1).alias("below"))
    out, todo = [], start
    while True:
        filed = _filed(_halved(todo))
        counts = filed.groupBy("cell").agg(F.count("*").alias("c"), F.count_if(F.char_length("word") == F.col("m")).alias("longest")).where("c > 1 AND longest > 0").select("cell", "c")
        placed = table(filed.join(counts, "cell").select("word", "n", "m", "a", "b", "below", "cell", "c"), "spelling-groups")
        out.append(placed)
        todo = placed.where((F.col("c") > large) & _divisible())
        if todo.isEmpty():
            return out


def _divisible() -> Column:
    return F.col("m") - 1 > F.col("a") + F.col("b")


def _matrix(words: list[bytes], width: int, pad: bytes) -> np.ndarray:
    return np.frombuffer(b"".join(w.ljust(width, pad) for w in words), np.uint8).reshape(len(words), width)


def tile(x: list[bytes], y: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix and suffix lengths of every word of ``x`` with every one of ``y``."""
    width = max(map(len, (*x, *y))) + 1
    # the pads differ and close every row, so that each comparison ends
    prefix = (_matrix(x, width, b"\0")[:, None, :] == _matrix(y, width, b"\1")[None, :, :]).argmin(axis=2)
    suffix = (_matrix([w[::-1] for w in x], width, b"\0")[:, None, :] == _matrix([w[::-1] for w in y], width, b"\1")[None, :, :]).argmin(axis=2)
    return prefix, suffix


def _blocks(words: list[bytes], block: int) -> list[tuple[int, int]]:
    """Spans of at most ``block`` words, fewer where words are long."""
    out, at = [], 0
    while at < len(words):
        width = max(map(len, words[at : at + block])) + 1
        end = min(len(words), at + min(block, max(1, math.isqrt(CELLS // width))))
        out.append((at, end))
        at = end
    return out


def compared(rows: pa.Table, block: int) -> pa.RecordBatch:
    """Rows of whole groups, sorted by group, falling n and word -> word, near, best_n, best: how many are near, and the first of them."""
    words = [w.encode("latin-1") for w in rows.column("word").to_pylist()]
    m, a, b, below, cell, n = (rows.column(c).to_numpy() for c in ("m", "a", "b", "below", "cell", "n"))
    longest = np.array([len(w) for w in words]) == m
    near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))
    spans = _blocks(words, block)
    for k, (x0, x1) in enumerate(spans):
        for y0, y1 in spans[k:]:
            if y0 != x0 and cell[y0] != cell[x1 - 1]:
                break
            prefix, suffix = tile(words[x0:x1], words[y0:y1])
            i, j = slice(x0, x1), slice(y0, y1)
            same = np.logical_and.reduce([c[i, None] == c[None, j] for c in (cell, m, a, b)])
            good = same & (longest[i, None] | longest[None, j]) & (prefix + suffix >= m[i, None] - 1) & (prefix >= a[i, None]) & (suffix >= b[i, None]) & (prefix < below[i, None])
            if x0 == y0:
                good &= np.arange(x0, x1)[:, None] < np.arange(y0, y1)[None, :]
            if good.any():
                near[i] += good.sum(axis=1)
                near[j] += good.sum(axis=0)
                best[i] = np.where(good.any(axis=1), np.minimum(best[i], y0 + good.argmax(axis=1)), best[i])
                best[j] = np.where(good.any(axis=0), np.minimum(best[j], x0 + good.argmax(axis=0)), best[j])
    some = np.flatnonzero(near)
    return pa.RecordBatch.from_arrays([pa.array([words[k].decode("latin-1") for k in some], pa.string()), pa.array(near[some]), pa.array(n[best[some]]), pa.array([words[k].decode("latin-1") for k in best[some]], pa.string())], ["word", "near", "best_n", "best"])


def near_words(words: DataFrame, large: int = LARGE, block: int = BLOCK) -> DataFrame:
    """word, n_near, best_n, best for the words of ``words`` (word, n) with near words: their number, and the one of largest n (ties: the smallest)."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            if not len(cell):
                continue
            cut = int(np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))[-1])  # where the last group begins
            if held and held[-1].column("cell")[-1].as_py() != cell[0]:
                yield compared(pa.Table.from_batches(held), block)
                held = []
            if cut:
                yield compared(pa.Table.from_batches([*held, batch.slice(0, cut)]), block)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield compared(pa.Table.from_batches(held), block)

    made = groups(words, large)
    done = None
    for g in made:
        small = g.where((F.col("c") <= large) | ~_divisible()).drop("c")
        done = small if done is None else done.unionByName(small)
    tiles = done.repartition("cell").sortWithinPartitions("m", "cell", F.desc("n"), "word").mapInArrow(part, "word string, near long, best_n long, best string")
    top = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word")))
    out = table(tiles.groupBy("word").agg(F.sum("near").alias("n_near"), top.alias("top")).select("word", "n_near", (-F.col("top.minus")).alias("best_n"), F.col("top.word").alias("best")), "spelling-near")
    release(*made)
    return out


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of the words of ``forms`` (word, form), by pointer doubling. Each form is ``TIMES`` as frequent, so five rounds reach the last."""
    up = table(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        higher = up.select(F.col("word").alias("root"), F.col("root").alias("higher"))
        if up.join(higher, "root", "left_semi").isEmpty():
            return up
        new = table(up.join(higher, "root", "left").select("word", F.coalesce("higher", "root").alias("root")), "spelling-roots")
        release(up)
        up = new


def spelling_variants(docs: DataFrame, large: int = LARGE, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n for the words of ``docs`` (doc_id, text).

    Runs of letters (A-Z, a-z and U+00C0 to U+00FF, two signs included) are lower-cased in A-Z alone. A run whose CRC-32 with its doc_id is
    divisible by 31 loses one code point. Words are the results of at least 7 code points with at least 2 occurrences, n. ``n_near`` counts the
    words that one inserted, deleted or replaced code point makes of it; its form is that of largest n (ties: the smallest in code-point
    order), if that is at least ten times its own, else null; ``root`` is the last form that forms lead to, or the word itself. A null or empty
    text has no words; a null doc_id counts as empty. Rows that repeat are counted each. An empty table gives no rows. Other columns are not
    used. A word of any length is compared whole.
    """
    need(docs, "doc_id", "text")
    words = table(vocabulary(docs), "spelling-words")
    near = near_words(words, large, block)
    is_form = F.col("best_n") >= TIMES * F.col("n")
    found = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"))
    found = table(found, "spelling-forms")
    up = _roots(found.where(F.col("form").isNotNull()))
    out = table(found.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "spelling-out")
    release(words, near, found, up)
    return out
