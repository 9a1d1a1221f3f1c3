"""What a ledger says beside failures: transient events, quarantine, forced readiness, and the decisions that follow.

ledger: as in ``retry``, with events ``failure``, ``transient``, ``success``, ``quarantine``, ``unquarantine`` and ``force_ready``, and ``delay_sec``, how long a transient
event asks to wait (null: not at all).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .retry import STREAK_GOTO, classify, epochs, failures

MAX_FORCED, COOLDOWN = 3, 60.0
FORCE_REASON = "scheduler_force_ready"
CLEARS = ("success", "unquarantine")
CANCELS = ("scheduler_cancel", "cancelled", "cancel")


def control_state(ledger: DataFrame) -> DataFrame:
    """One row per company with events since its last success: attempts, progress, eligibility and quarantine.

    A transient event moves time, stage, progress and eligibility, but no attempts. A company is in quarantine by its last
    cause, a failure past its limits or an event that says so, unless a success or ``unquarantine`` came after.
    """
    rows = epochs(classify(ledger))
    found = failures(ledger)
    names = ["ord", "attempts", "net_attempts", "stall_attempts", "mem_attempts", "streak", "stall_kind", "signature", "delay", "quarantine"]
    known = found.select("company_id", *names).withColumnRenamed("quarantine", "cause")
    rows = rows.drop("stall_kind", "signature").join(known, ["company_id", "ord"], "left")
    cause = F.when(F.col("event") == "quarantine", F.coalesce(F.nullif(F.trim("error"), F.lit("")), F.lit("quarantined"))).otherwise(F.col("cause"))
    moves = F.col("event").isin("failure", "transient", "quarantine")
    wait = F.when(F.col("event") == "failure", F.col("delay")).otherwise(F.greatest(F.coalesce("delay_sec", F.lit(0.0)), F.lit(0.0)))
    clear = F.max(F.when(F.col("event").isin(*CLEARS), F.col("ord")))
    last = rows.groupBy("company_id").agg(F.max("epoch").alias("epoch"), clear.alias("cleared"))
    live = rows.join(last, ["company_id", "epoch"]).withColumn("cause", F.when(F.col("cleared").isNull() | (F.col("ord") > F.col("cleared")), cause))
    failed, timed = F.col("event") == "failure", F.col("event").isin("failure", "transient")
    out = live.where(moves).groupBy("company_id").agg(
        *(F.coalesce(F.max_by(F.when(failed, F.col(c)), F.when(failed, F.col("ord"))), F.lit(0)).cast("long").alias(c) for c in ("attempts", "net_attempts", "stall_attempts", "mem_attempts", "streak")),
        *(F.max_by(F.when(failed, F.col(c)), F.when(failed, F.col("ord"))).alias(c) for c in ("stall_kind", "signature")),
        F.coalesce(F.max("md_done"), F.lit(0)).cast("long").alias("progress"), F.max("ts").alias("updated_at"), F.max_by("stage", "ord").alias("last_stage"),
        F.max_by(F.when(timed, F.col("ts") + wait), F.when(timed, F.col("ord"))).alias("next_eligible_at"), F.max_by("cause", F.when(F.col("cause").isNotNull(), F.col("ord"))).alias("quarantine"),
    )
    return out.withColumn("doomed", F.coalesce((F.col("stall_kind") == "goto") & (F.col("signature") == "goto_timeout") & (F.col("streak") >= STREAK_GOTO), F.lit(False)))


def force_ready(states: DataFrame, forces: DataFrame, most: int = MAX_FORCED, cooldown: float = COOLDOWN, ignore_quarantine: bool = False) -> DataFrame:
    """``states`` (company_id, next_eligible_at, quarantine) after forces (company_id, ord, ts, reason), with hits and last_forced.

    A force counts if the one that counted before it is ``cooldown`` seconds away. The first ``most`` make the company eligible at once; one more
    puts it in quarantine and leaves it eligible from the force before, and after that none counts. So ``most + 1`` sums find them all, each one by company and
    added up before its shuffle, however many forces a company has. A company without a state, or (unless ignored) in quarantine, is not touched.
    """
    who = states.select("company_id", "quarantine")
    live = forces.join(who if ignore_quarantine else who.where(F.col("quarantine").isNull()), "company_id").select("company_id", "ord", "ts", "reason")
    none = F.lit(None)
    done = states.select("company_id", F.lit(0).alias("hits"), F.lit(0.0).alias("last_forced"), F.lit(-1).cast("long").alias("at"), none.cast("string").alias("why"), none.cast("double").alias("ready"))
    for _ in range(most + 1):
        fits = live.join(done, "company_id").where((F.col("ord") > F.col("at")) & ((F.lit(cooldown) <= 0) | (F.col("ts") - F.col("last_forced") >= cooldown)))
        first = fits.groupBy("company_id").agg(F.min(F.struct("ord", "ts", "reason")).alias("f"))
        again = F.col("f").isNotNull()
        done = done.join(first, "company_id", "left").select(
            "company_id", (F.col("hits") + again.cast("int")).alias("hits"), F.coalesce("f.ts", "last_forced").alias("last_forced"), F.coalesce("f.ord", "at").alias("at"),
            F.when(again, F.col("f.reason")).otherwise(F.col("why")).alias("why"), F.when(again & (F.col("hits") < most), F.col("f.ts")).otherwise(F.col("ready")).alias("ready"),
        )
    why = F.coalesce(F.nullif(F.col("why"), F.lit("")), F.lit(FORCE_REASON))
    exceeded = F.when(F.col("hits") > most, F.concat(F.lit("force_ready_hits_exceeded hits="), F.col("hits"), F.lit(f" max={most}: "), why))
    out = states.join(done.select("company_id", "hits", "last_forced", "ready", exceeded.alias("exceeded")), "company_id", "left")
    return out.withColumn("next_eligible_at", F.coalesce("ready", "next_eligible_at")).withColumn("quarantine", F.coalesce("exceeded", "quarantine")).drop("exceeded", "ready")


def terminalization(md_done: Column, action: Column, reason: Column, attempt: Column, failure: Column) -> Column:
    """Struct (terminal, reason, cls, stall_kind): whether a company's crawl is over for good.

    ``action`` is the page summary's (terminal, mem, stall or null), ``failure`` what an exception looks like (goto_fail_fast, nxdomain, goto or null).
    A first attempt is never the last.
    """
    why = F.coalesce(reason, F.lit(""))
    made = lambda terminal, text, cls, kind: F.struct(F.lit(terminal).alias("terminal"), text.alias("reason"), F.lit(cls).alias("cls"), F.lit(kind).cast("string").alias("stall_kind"))
    say = lambda text: F.concat(F.lit(text), why)
    return (
        F.when(md_done > 0, made(False, F.lit("has_progress"), "stall", "unknown"))
        .when((action == "terminal") & (attempt == 0), made(False, say("page_summary_terminal_downgraded:"), "stall", "unknown"))
        .when(action == "terminal", made(True, say("page_summary_terminal:"), "permanent", None))
        .when(action == "mem", made(False, say("page_summary_mem:"), "mem", None))
        .when(action == "stall", made(False, say("page_summary_stall:"), "stall", "unknown"))
        .when(failure == "goto_fail_fast", made(False, F.lit("goto_fail_fast_downgraded"), "stall", "goto"))
        .when(failure == "nxdomain", made(False, F.lit("nxdomain_like"), "net", None))
        .when(failure == "goto", made(False, F.lit("goto_timeout"), "stall", "goto"))
        .otherwise(made(False, F.lit("no_terminalize"), "stall", "unknown"))
    )


def recorded(terminal: Column, ok: Column, stage: Column, quarantined: Column) -> Column:
    """How an attempt goes into the ledger: terminalized, success (or kept in quarantine), transient_cancel or failure."""
    return F.when(terminal, "terminalized").when(ok & quarantined, "success_but_quarantined_kept").when(ok, "success").when(stage.isin(*CANCELS), "transient_cancel").otherwise("failure")


def requeue(stop: Column, runnable: Column, quarantined: Column, doomed: Column, next_at: Column, now: Column) -> Column:
    """Struct (again, delay, reason): whether a company goes back to the queue, and after how many seconds."""
    no = lambda text: F.struct(F.lit(False).alias("again"), F.lit(0.0).alias("delay"), F.lit(text).alias("reason"))
    yes = F.struct(F.lit(True).alias("again"), F.greatest(F.lit(0.0), next_at - now).alias("delay"), F.lit("retry_policy_next_eligible").alias("reason"))
    return F.when(stop, no("stop_requested")).when(~runnable, no("not_runnable")).when(quarantined, no("quarantined")).when(doomed, no("doomed_repeat_goto")).otherwise(yes)


def process_exit(forced: Column, pending: Column, retry_pending: Column, in_progress: Column, retry_code: int = 17) -> Column:
    """A forced code, else ``retry_code`` while anything is pending, else 0."""
    return F.coalesce(forced, F.when((pending > 0) | (retry_pending > 0) | in_progress, retry_code).otherwise(0))
