"""Retry state from a ledger of events, as windows over each company's events.

ledger: company_id, ord, ts, event, cls, stage, error, status_code, nxdomain_like, stall_kind, md_done. A success clears the state: events are
cut into epochs at successes, and every running value restarts with its epoch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.errors import any_of, backoff_seconds, compact, is_goto, retry_class, retry_signature, stall_kind

# Fixed values.
MAX_NET, MAX_STALL, MAX_STALL_FAST, NXDOMAIN_CUTOFF = 3, 4, 2, 1
STREAK_GOTO, STREAK_GENERIC = 2, 4
TRANSIENT = ("cancelled by scheduler", "canceled by scheduler", "scheduler_cancel", "scheduler cancel", "cancel_reason=scheduler", "task cancelled", "task canceled", "cancellederror")


def classify(ledger: DataFrame) -> DataFrame:
    """``ledger`` with a normal error text, class, stall kind and signature; a failure that a scheduler caused becomes ``transient``."""
    rows = ledger.withColumn("error", compact(F.col("error"), 1200)).withColumn("stage", F.trim(F.coalesce("stage", F.lit("")))).withColumn("nxdomain_like", F.coalesce("nxdomain_like", F.lit(False)))
    passing = (F.col("event") == "failure") & (any_of(F.col("error"), TRANSIENT) | any_of(F.col("stage"), TRANSIENT))
    rows = rows.withColumn("event", F.when(passing, "transient").otherwise(F.col("event")))
    code = F.col("status_code")
    rows = rows.withColumn("cls", retry_class(F.col("cls"), F.col("error"), F.col("stage"), code)).withColumn("stall_kind", stall_kind(F.col("stall_kind"), F.col("error"), F.col("stage"), code))
    rows = rows.withColumn("stall_kind", F.when(is_goto(F.col("stage"), F.col("error")), "goto").otherwise(F.col("stall_kind")))
    return rows.withColumn("signature", retry_signature(F.col("cls"), F.col("stall_kind"), F.col("nxdomain_like"), F.col("error"), F.col("stage"), code))


def epochs(rows: DataFrame) -> DataFrame:
    """``rows`` with ``epoch``: how many successes came before."""
    before = Window.partitionBy("company_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("epoch", F.coalesce(F.count_if(F.col("event") == "success").over(before), F.lit(0)))


def failures(ledger: DataFrame) -> DataFrame:
    """Each failure with the state after it: attempts by class, streak, progress, quarantine and base delay."""
    rows = epochs(classify(ledger))
    epoch = Window.partitionBy("company_id", "epoch").orderBy("ord")
    upto, before = epoch.rowsBetween(Window.unboundedPreceding, 0), epoch.rowsBetween(Window.unboundedPreceding, -1)
    # progress looks at transient events too; a streak and attempts do not
    rows = rows.withColumn("seen", F.coalesce(F.max("md_done").over(before), F.lit(0))).withColumn("last_seen", F.coalesce(F.last("md_done", ignorenulls=True).over(before), F.lit(0)))
    rows = rows.where("event = 'failure'")
    new = F.coalesce(F.lag("signature").over(epoch) != F.col("signature"), F.lit(True))
    rows = rows.withColumn("_island", F.sum(new.cast("int")).over(upto))
    rows = rows.withColumn("streak", F.row_number().over(Window.partitionBy("company_id", "epoch", "_island").orderBy("ord"))).drop("_island")
    count = lambda c: F.count_if(c).over(upto)
    rows = rows.withColumns({"attempts": F.count("*").over(upto), **{f"{k}_attempts": count(F.col("cls") == k) for k in ("net", "stall", "mem")}})
    goto = (F.col("cls") == "stall") & (F.col("stall_kind") == "goto")
    md = F.col("md_done")
    progressed = F.coalesce(F.when(goto, md > F.col("seen")).otherwise((md > F.col("seen")) | (md > F.col("last_seen"))), F.lit(False))
    rows = rows.withColumn("progressed", progressed)
    limit = F.when(F.col("stall_kind").isin("goto", "no_yield"), min(MAX_STALL, MAX_STALL_FAST)).otherwise(MAX_STALL)
    reason = (
        F.when(goto & (F.col("signature") == "goto_timeout") & (F.col("streak") >= STREAK_GOTO), "repeat_goto_timeout")
        .when(~goto & (F.col("streak") >= STREAK_GENERIC) & ~F.col("progressed"), "repeat_same_error")
        .when(F.col("cls") == "permanent", "permanent")
        .when(F.col("nxdomain_like") & (F.col("net_attempts") >= NXDOMAIN_CUTOFF), "nxdomain_like_cutoff")
        .when((F.col("cls") == "net") & (F.col("net_attempts") >= MAX_NET), "max_net_attempts")
        .when((F.col("cls") == "stall") & (F.col("stall_attempts") >= limit) & ~F.col("progressed"), F.concat(F.lit("max_stall_attempts["), F.col("stall_kind"), F.lit("]")))
    )
    attempts = F.when(F.col("cls") == "permanent", 1).otherwise(F.col("attempts"))
    return rows.withColumn("quarantine", reason).withColumn("delay", backoff_seconds(attempts, F.col("cls"), F.col("stall_kind")))


def state(ledger: DataFrame) -> DataFrame:
    """One row per company that has failed since its last success: its state after the last failure, and when it is eligible."""
    found = failures(ledger)
    last = epochs(ledger).groupBy("company_id").agg(F.max("epoch").alias("epoch"), F.max_by("event", "ord").alias("last_event"))
    live = found.join(last.where("last_event <> 'success'"), ["company_id", "epoch"])
    names = ["attempts", "net_attempts", "stall_attempts", "mem_attempts", "streak", "cls", "stall_kind", "signature", "quarantine", "delay", "ts"]
    return live.groupBy("company_id").agg(F.max_by(F.struct(*names), "ord").alias("s")).select("company_id", "s.*").withColumn("next_eligible_at", F.col("ts") + F.col("delay"))


def eligible(states: DataFrame, now: float) -> DataFrame:
    """companies, eligible, quarantined, next_at: who may run now and when the next may."""
    free = F.col("quarantine").isNull()
    return states.agg(F.count("*").alias("companies"), F.count_if(free & (F.col("next_eligible_at") <= now)).alias("eligible"), F.count_if(~free).alias("quarantined"), F.min(F.when(free & (F.col("next_eligible_at") > now), F.col("next_eligible_at"))).alias("next_at"))


def exit_code(eligible_now: Column, retry_code: int = 17) -> Column:
    return F.when(eligible_now > 0, retry_code).otherwise(0)


def outcome(kind: Column) -> Column:
    """Class of an attempt that did not end by itself."""
    return F.when(kind.isin("user", "sigterm"), "cancelled").when(kind == "scheduler", "transient").when(kind == "memory", "mem").otherwise("stall")


def decayed_ratio(events: DataFrame, by: str, half_life: float) -> DataFrame:
    """by, ratio: errors to all events, each weighing ``0.5 ** (age / half_life)``, its age counted to the newest of its group. events: by, ts, is_error."""
    last = F.max("ts").over(Window.partitionBy(by))
    rows = events.withColumn("w", F.pow(F.lit(0.5), (last - F.col("ts")) / half_life))
    return rows.groupBy(by).agg((F.sum(F.when(F.col("is_error"), F.col("w")).otherwise(0.0)) / F.sum("w")).alias("ratio"))


def trailing_count(events: DataFrame, by: str, seconds: int) -> DataFrame:
    """``events`` (by, ts in seconds) with ``recent``: how many of the group in the ``seconds`` up to each.

    Time is cut into slots of ``seconds``; events also go to the slot after their own, so each slot has all that its events look
    back on, and a group is spread over as many tasks as it has slots.
    """
    slot = F.floor(F.col("ts") / max(seconds, 1))
    rows = events.withColumn("_at", F.explode(F.array(F.struct(slot.alias("slot"), F.lit(True).alias("own")), F.struct((slot + 1).alias("slot"), F.lit(False).alias("own"))))).withColumn("_slot", F.col("_at.slot"))
    rows = rows.withColumn("recent", F.count("*").over(Window.partitionBy(by, "_slot").orderBy("ts").rangeBetween(-seconds, 0)))
    return rows.where("_at.own").drop("_at", "_slot")


def ramp(samples: DataFrame, by: str, seconds: float = 3.0, order: str | None = None) -> DataFrame:
    """``samples`` (by, ts, used) with ``ramp``: the change of ``used`` a second over the trailing window.

    Of samples that share the window's first ``ts`` the one with the least ``order`` counts, of equal ones that with the least ``used``.
    """
    w = Window.partitionBy(by).orderBy("ts").rangeBetween(-seconds, 0)
    start = F.min(F.struct("ts", *([order] if order else []), F.col("used").alias("start"))).over(w)
    span = F.col("ts") - start["ts"]
    return samples.withColumn("ramp", F.when(span > 0, (F.col("used") - start["start"]) / span).otherwise(0.0))


def stalest(progress: DataFrame, k: int) -> DataFrame:
    """The ``k`` rows with the oldest progress."""
    return progress.orderBy("last_progress", "company_id").limit(k)
