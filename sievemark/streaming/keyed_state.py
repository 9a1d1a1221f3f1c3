"""Keyed state on streams: the first sight of a URL, the page cap of a company, and forced readiness with timers.

Each has a batch form that gives the same rows (``urlfilter.first_seen``, ``state.cap_pages``, ``control.force_ready``). Rows of one micro-batch are taken by ``ord``;
over micro-batches the order of arrival counts. State is kept by key in RocksDB, so it grows with the keys, not with memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.control import COOLDOWN, FORCE_REASON, MAX_FORCED

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FORCED = "company_id string, ord long, ts double, outcome string, hits int, last_forced double, next_eligible_at double, quarantine string"


def keep_state_on_disk(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class _Counter(StatefulProcessor):
    """Marks the first ``most`` rows of each key."""

    def __init__(self, most: int, flag: str, ttl_ms: int | None):
        self.most, self.flag, self.ttl = most, flag, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "n long", self.ttl) if self.ttl else handle.getValueState("seen", "n long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n = self.seen.get()[0] if self.seen.exists() else 0
        for pdf in _in_order(rows):
            left = max(0, self.most - n)
            n = min(self.most, n + len(pdf))  # what is beyond the cap need not be counted
            yield pdf.assign(**{self.flag: [i < left for i in range(len(pdf))]})
        self.seen.update((n,))

    def close(self) -> None:
        pass


def _in_order(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts = list(rows)
    if parts:
        yield pd.concat(parts).sort_values("ord", kind="stable")


def _counted(df: DataFrame, key: str, most: int, flag: str, ttl_ms: int | None) -> DataFrame:
    schema = T.StructType([*df.schema.fields, T.StructField(flag, T.BooleanType())])
    return df.groupBy(key).transformWithStateInPandas(_Counter(most, flag, ttl_ms), schema, "Append", "ProcessingTime" if ttl_ms else "None")


def first_seen(stream: DataFrame, url: str = "url", ttl_ms: int | None = None) -> DataFrame:
    """A stream (``url``, ord, more) with ``first``: whether the row is the first with its exact URL. With ``ttl_ms`` a URL is new again after that time without a row."""
    return _counted(stream, url, 1, "first", ttl_ms)


def cap_pages(stream: DataFrame, cap: int, ttl_ms: int | None = None) -> DataFrame:
    """A stream (company_id, ord, more) with ``kept``: the first ``cap`` pages of each company as they arrive."""
    return _counted(stream, "company_id", cap, "kept", ttl_ms)


class _Force(StatefulProcessor):
    def __init__(self, most: int, cooldown: float):
        self.most, self.cooldown = most, cooldown

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "hits int, last double, eligible double, quarantine string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        known = self.state.get() if self.state.exists() else None
        out = []
        for pdf in _in_order(rows):
            for e in pdf.itertuples(index=False):
                if e.kind == "state":
                    hits, last = known[:2] if known else (0, 0.0)
                    eligible, quarantine = (None if pd.isna(v) else v for v in (e.next_eligible_at, e.quarantine))
                    known = (hits, last, eligible, quarantine)
                    self._set_timer(eligible if quarantine is None else None)
                    out.append((key[0], e.ord, e.ts, "state", *self._shown(known)))
                    continue
                known, outcome = self._forced(known, e)
                out.append((key[0], e.ord, e.ts, outcome, *self._shown(known)))
        if known is not None:
            self.state.update(known)
        yield _frame(out)

    def _forced(self, known: tuple | None, e: object) -> tuple[tuple | None, str]:
        if known is None:
            return known, "unknown"
        hits, last, eligible, quarantine = known
        if quarantine is not None:
            return known, "quarantined"
        if self.cooldown > 0 and e.ts - last < self.cooldown:
            return known, "cooldown"
        said = FORCE_REASON if pd.isna(e.reason) or not e.reason else e.reason
        if hits + 1 > self.most:
            self._set_timer(None)
            return (hits + 1, e.ts, eligible, f"force_ready_hits_exceeded hits={hits + 1} max={self.most}: {said}"), "exceeded"
        self._set_timer(e.ts)
        return (hits + 1, e.ts, e.ts, None), "ready"

    def _set_timer(self, at: float | None) -> None:
        """One timer a company: when it becomes eligible."""
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if at is not None:
            self.handle.registerTimer(int(at * 1000))

    @staticmethod
    def _shown(known: tuple | None) -> tuple:
        return (0, 0.0, None, None) if known is None else known

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        known = self.state.get()
        yield _frame([(key[0], None, expiredTimerInfo.getExpiryTimeInMs() / 1000, "eligible", *self._shown(known))])

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in FORCED.split(", ")])
    return out.astype({"ord": "Int64", "ts": "Float64", "hits": "Int32", "last_forced": "Float64", "next_eligible_at": "Float64"})


def force_ready(stream: DataFrame, most: int = MAX_FORCED, cooldown: float = COOLDOWN, late: str = "10 minutes") -> DataFrame:
    """What becomes of forces, as they arrive.

    stream: company_id, ord, ts (seconds), kind (``state`` or ``force``), next_eligible_at, quarantine (of states), reason (of forces). A state sets when a company is eligible and
    whether it is in quarantine; a force counts as in ``control.force_ready``. Each row gives one with its ``outcome`` (state, ready, cooldown, exceeded, quarantined,
    or unknown for a company without a state) and what is known then. When event time (behind by ``late``) passes the moment from which a company is eligible,
    a timer gives a row ``eligible``, without an ord. Rows behind the watermark are left out.
    """
    timed = stream.withColumn("at", F.timestamp_millis((F.col("ts") * 1000).cast("long"))).withWatermark("at", late)
    return timed.groupBy("company_id").transformWithStateInPandas(_Force(most, cooldown), FORCED, "Append", "EventTime")
