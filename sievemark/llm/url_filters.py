"""URL filters by a bit-parallel wildcard automaton.

All glob rules are packed into one multiword Shift-And automaton: a bit for each literal character or ``?`` of a rule, and
a self-loop on the states before a ``*``. One step per character moves every rule at once, over a batch of URLs
held as a numpy matrix, so the cost is characters x words of 64 bits, not characters x rules.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column, need


@dataclass(frozen=True)
class Rule:
    """Allow or block a host, its subdomains, and paths that start with ``path``; ``name`` is host and path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @classmethod
    def of(cls, verdict: str, name: str) -> Rule:
        host, slash, path = name.partition("/")
        return cls(verdict, host.lower(), slash + path)


#: Globs over ``host/path`` that block what no host rule decides: files that hold no text, and session or cart pages.
DEFAULT_BLOCKS = (
    "ads.**", "ad.**", "track.**", "pixel.**", "*.ads.**", "**/cgi-bin/**", "**/wp-admin**", "**/wp-login**", "**/login**", "**/logout**", "**/signin**", "**/signup**", "**/cart**", "**/checkout**", "**/print/**",
    *(f"*/**.{x}" for x in ("jpg", "jpeg", "png", "gif", "svg", "ico", "css", "js", "zip", "gz", "rar", "exe", "dmg", "mp3", "mp4", "avi", "mov", "woff", "woff2")),
)


_LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def canonical(url: str | None) -> tuple[str, str]:
    """Host (A-Z in lower case) and path of a URL; both empty where there is no ``://``."""
    if not url or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    ends = [i for c in "/?#" if (i := rest.find(c)) >= 0]
    cut = min(ends, default=len(rest))
    host = rest[:cut].translate(_LOWER)
    path = rest[cut:]
    if not path.startswith("/"):
        return host, ""
    return host, path[: min((i for c in "?#" if (i := path.find(c)) >= 0), default=len(path))]


class WildcardAutomaton:
    """Globs matched against whole subjects, over UTF-8: ``*`` is any run without ``/``, ``**`` any run, ``?`` any one byte.

    A pattern of n literals has states 0..n; state i means that i literals have matched. Bit positions of all
    patterns follow one another. ``step[c]`` has the states whose literal accepts byte c, ``loop[c]`` those before
    a star that takes c, which stay.
    """

    def __init__(self, patterns: Sequence[str]):
        self.patterns = list(patterns)
        literals, loops, starts, ends = [], [], [], []
        for p in self.patterns:
            starts.append(len(literals))
            literals.append(None)  # the start state is entered by no byte
            loops.append(0)
            for byte in p.encode("utf-8"):
                if byte == ord("*"):
                    loops[-1] += 1
                else:
                    literals.append(byte)
                    loops.append(0)
            ends.append(len(literals) - 1)
        n = max(1, -(-len(literals) // 64))
        self.start = np.zeros(n, np.uint64)
        self.step, self.loop = np.zeros((256, n), np.uint64), np.zeros((256, n), np.uint64)
        bit = lambda i: np.uint64(1 << (i % 64))
        for i, (byte, loop) in enumerate(zip(literals, loops, strict=True)):
            if byte == ord("?"):
                self.step[:, i // 64] |= bit(i)
            elif byte is not None:
                self.step[byte, i // 64] |= bit(i)
            if loop:
                self.loop[:, i // 64] |= bit(i)
            if loop == 1:
                self.loop[ord("/"), i // 64] &= ~bit(i)
        for i in starts:
            self.start[i // 64] |= bit(i)
        self.ends = np.array(ends, np.int64)

    def match(self, subjects: Sequence[str], cells: int = 4_000_000) -> np.ndarray:
        """Subjects x patterns, boolean.

        Subjects go in order of length, in batches of at most ``cells`` bytes with their padding, so a long one brings few
        others along; one that is alone in its batch is walked with all words of the automaton in one integer.
        """
        out = np.zeros((len(subjects), len(self.patterns)), bool)
        if not len(subjects) or not self.patterns:
            return out
        raw = [s.encode("utf-8", "surrogatepass") for s in subjects]
        order = np.argsort([-len(r) for r in raw], kind="stable")
        at = 0
        while at < len(order):
            some = order[at : at + max(1, cells // max(1, len(raw[order[at]])))]
            out[some] = self._alone(raw[some[0]]) if len(some) == 1 else self._together([raw[i] for i in some])
            at += len(some)
        return out

    def _together(self, raw: list[bytes]) -> np.ndarray:
        """Subjects from the longest to the shortest: a step touches only those still running."""
        size = np.array([len(r) for r in raw])
        chars = np.zeros((len(raw), max(1, size[0])), np.uint8)
        for k, r in enumerate(raw):
            chars[k, : size[k]] = np.frombuffer(r, np.uint8)
        running = np.searchsorted(-size, -np.arange(chars.shape[1]), side="left")  # subjects longer than each position
        state = np.repeat(self.start[None, :], len(raw), axis=0)
        for at in range(chars.shape[1]):
            d, c = state[: running[at]], chars[: running[at], at]
            moved = d << np.uint64(1)
            moved[:, 1:] |= d[:, :-1] >> np.uint64(63)  # the carry from word to word
            state[: running[at]] = (moved & self.step[c]) | (d & self.loop[c])
        return ((state[:, self.ends // 64] >> (self.ends % 64).astype(np.uint64)) & np.uint64(1)).astype(bool)

    def _alone(self, raw: bytes) -> np.ndarray:
        whole = lambda words: int.from_bytes(words.astype("<u8").tobytes(), "little")
        step, loop, state = [whole(w) for w in self.step], [whole(w) for w in self.loop], whole(self.start)
        for c in raw:
            state = ((state << 1) & step[c]) | (state & loop[c])
        return np.array([state >> int(e) & 1 for e in self.ends], bool)


def _escaped(text: str) -> bool:
    return "*" in text or "?" in text


def url_filters(pages: DataFrame, rules: Sequence[Rule], blocks: Sequence[str] = DEFAULT_BLOCKS) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url).

    The longest rule that fits decides; equal lengths: the one named first. Where none fits, a glob of
    ``blocks`` over host and path blocks and its text is in ``glob``, else the verdict is allow. A null URL, and one without ``://``, has an
    empty host and path, which no rule fits. Repeated rows are judged one by one; an empty table gives no rows; other columns
    are not returned. Memory does not depend on how long a URL is, but for the URL itself.
    """
    need(pages, "page_id", "url")
    if bad := [r for r in rules if _escaped(r.name) or r.verdict not in ("allow", "block")]:
        raise ValueError(f"rules {bad}")
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].name), i))
    ranked = [rules[i] for i in order]
    globs = [g for r in ranked for g in (f"{r.name}**", f"*.{r.name}**")]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = WildcardAutomaton([*globs, *blocks])
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                rows = batch.slice(at, 4096)
                split = [canonical(u.as_py()) for u in rows.column(1)]
                hit = automaton.match([h + p for h, p in split])
                by_rule = hit[:, 0 : 2 * len(ranked) : 2] | hit[:, 1 : 2 * len(ranked) : 2]
                glob = hit[:, 2 * len(ranked) :]
                names, verdicts, why = [], [], []
                for i, (host, _) in enumerate(split):
                    r = ranked[int(by_rule[i].argmax())] if host and by_rule[i].any() else None
                    g = blocks[int(glob[i].argmax())] if r is None and glob[i].any() else None
                    names.append(r.name if r else None)
                    verdicts.append(r.verdict if r else "block" if g else "allow")
                    why.append(g)
                yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(x, pa.string()) for x in ([h for h, _ in split], [p for _, p in split], names, verdicts, why))], ["page_id", "host", "path", "rule", "verdict", "glob"])

    return pages.select(column("page_id").cast("long").alias("page_id"), column("url").alias("url")).mapInArrow(part, "page_id long, host string, path string, rule string, verdict string, glob string")
