"""The retry fold over an endless ledger: one keyed state per company, updated in the order of its events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.retry import MAX_NET, MAX_STALL, MAX_STALL_FAST, NXDOMAIN_CUTOFF, STREAK_GENERIC, STREAK_GOTO, classify

OUTPUT = "company_id string, ord long, attempts long, net_attempts long, stall_attempts long, mem_attempts long, streak long, signature string, quarantine string"
STATE = "attempts long, net long, stall long, mem long, streak long, signature string, progress long, seen long"
EMPTY = (0, 0, 0, 0, 0, "", 0, 0)


def _fold(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(batches)).sort_values("ord")
    attempts, net, stall, mem, streak, sig, progress, seen = state.get if state.exists else EMPTY
    out = []
    for e in rows.itertuples(index=False):
        if e.event == "success":
            attempts, net, stall, mem, streak, sig, progress, seen = EMPTY
            continue
        before, last = progress, seen
        md = None if pd.isna(e.md_done) else int(e.md_done)
        if md is not None:
            seen, progress = md, max(progress, md)
        if e.event != "failure":
            continue
        streak = streak + 1 if e.signature == sig else 1
        sig, attempts = e.signature, attempts + 1
        net, stall, mem = net + (e.cls == "net"), stall + (e.cls == "stall"), mem + (e.cls == "mem")
        goto = e.cls == "stall" and e.stall_kind == "goto"
        moved = md is not None and (md > before or (not goto and md > last))
        limit = min(MAX_STALL, MAX_STALL_FAST) if e.stall_kind in ("goto", "no_yield") else MAX_STALL
        why = None
        if goto and sig == "goto_timeout" and streak >= STREAK_GOTO:
            why = "repeat_goto_timeout"
        elif not goto and streak >= STREAK_GENERIC and not moved:
            why = "repeat_same_error"
        elif e.cls == "permanent":
            why = "permanent"
        elif e.nxdomain_like and net >= NXDOMAIN_CUTOFF:
            why = "nxdomain_like_cutoff"
        elif e.cls == "net" and net >= MAX_NET:
            why = "max_net_attempts"
        elif e.cls == "stall" and stall >= limit and not moved:
            why = f"max_stall_attempts[{e.stall_kind}]"
        out.append((key[0], int(e.ord), attempts, net, stall, mem, streak, sig, why))
    state.update((attempts, net, stall, mem, streak, sig, progress, seen))
    yield pd.DataFrame(out, columns=[c.split()[0] for c in OUTPUT.split(", ")])


def retry_stream(ledger: DataFrame) -> DataFrame:
    """The state after each failure of a streaming ledger (columns as in ``operators.retry``), to be written in append mode."""
    rows = classify(ledger).select(F.col("company_id").cast("string"), "ord", "event", "cls", "stall_kind", "signature", F.col("nxdomain_like"), "md_done")
    return rows.groupBy("company_id").applyInPandasWithState(_fold, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)
