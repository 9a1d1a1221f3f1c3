"""Queries of ledger transitions, decisions and forced readiness. Events stand for the ledger, as in ``queries_retry``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import control
from .base import Catalog
from .queries_retry import _DELAY, _LEDGER, ledger

C = Catalog()

#: Purchases that also lift a quarantine without clearing the state, and signups that put a company in quarantine by hand.
_KIND = "CASE WHEN event_type = 'purchase' AND value > 90 THEN 'unquarantine' WHEN event_type = 'purchase' THEN 'success' WHEN event_type = 'signup' AND value > 95 THEN 'quarantine' WHEN event_type = 'signup' THEN 'transient' ELSE 'failure' END"


def _control(t):
    rows = t("events").select(F.col("event_id").alias("ord"), F.expr(_KIND).alias("event"), (F.col("value") * 10).alias("delay_sec"), F.floor("value").cast("int").alias("md"))
    base = ledger(t("events")).drop("event", "md_done").join(rows, "ord")
    return base.withColumn("md_done", F.when(F.col("event") == "transient", F.col("md"))).withColumn("delay_sec", F.when(F.col("event") == "transient", F.col("delay_sec"))).drop("md")


_CONTROL = _LEDGER.replace("CASE event_type WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'transient' ELSE 'failure' END AS event", f"{_KIND} AS event") + f""",
a AS (SELECT e.company_id, e.ord, e.event, e.epoch, floor(epoch(v.ts)) AS ts, CASE WHEN e.event = 'transient' THEN CAST(floor(v.value) AS INT) END AS md, q.attempts, q.streak, q.sig AS qsig, {_DELAY.replace('attempts', 'q.attempts').replace('cls', 'q.cls').replace('sig =', 'q.sig =')} AS delay,
  CASE WHEN e.event = 'quarantine' THEN 'x' ELSE q.quarantine END AS cause, v.value FROM e JOIN events v ON v.event_id = e.ord LEFT JOIN q ON q.ord = e.ord),
lst AS (SELECT company_id, max(epoch) AS epoch, max(ord) FILTER (event IN ('success', 'unquarantine')) AS cleared FROM e GROUP BY 1),
g AS (SELECT a.company_id, coalesce(arg_max(attempts, a.ord) FILTER (event = 'failure'), 0) AS attempts, coalesce(arg_max(streak, a.ord) FILTER (event = 'failure'), 0) AS streak, coalesce(max(md), 0) AS progress, max(ts) AS updated_at,
  arg_max(ts + CASE WHEN event = 'failure' THEN delay ELSE value * 10 END, a.ord) FILTER (event IN ('failure', 'transient')) AS next_eligible_at, count(*) FILTER (cause IS NOT NULL AND (cleared IS NULL OR a.ord > cleared)) > 0 AS quarantined,
  coalesce(arg_max(qsig, a.ord) FILTER (event = 'failure') = 'goto_timeout' AND arg_max(streak, a.ord) FILTER (event = 'failure') >= 2, FALSE) AS doomed
  FROM a JOIN lst ON lst.company_id = a.company_id AND lst.epoch = a.epoch WHERE event IN ('failure', 'transient', 'quarantine') GROUP BY 1)"""


@C.query("control_state", f"WITH {_CONTROL} SELECT company_id, CAST(attempts AS BIGINT) AS attempts, CAST(streak AS BIGINT) AS streak, CAST(progress AS BIGINT) AS progress, CAST(updated_at AS DOUBLE) AS updated_at, round(next_eligible_at, 3) AS next_eligible_at, quarantined, doomed FROM g")
def control_state(t):
    out = control.control_state(_control(t))
    return out.select("company_id", "attempts", "streak", "progress", "updated_at", F.round("next_eligible_at", 3).alias("next_eligible_at"), F.col("quarantine").isNotNull().alias("quarantined"), "doomed")


@C.query(
    "force_ready",
    """WITH RECURSIVE f AS (SELECT user_id AS company_id, event_id AS ord, CAST(floor(epoch(ts)) AS DOUBLE) AS ts FROM events WHERE event_type IN ('click', 'error')), s AS (SELECT DISTINCT user_id AS company_id, CASE WHEN user_id % 11 = 0 THEN 'held' END AS quarantine FROM events),
w AS (SELECT company_id, 0 AS hits, 0.0::DOUBLE AS last, CAST(-1 AS BIGINT) AS at FROM s WHERE quarantine IS NULL
  UNION ALL SELECT company_id, hits + 1, n.ts, n.ord FROM (SELECT w.company_id, w.hits, min({'ord': f.ord, 'ts': f.ts}) AS n FROM w JOIN f ON f.company_id = w.company_id AND f.ord > w.at AND f.ts - w.last >= 86400 WHERE w.hits < 4 GROUP BY 1, 2)),
g AS (SELECT company_id, max(hits) AS hits, arg_max(last, hits) FILTER (hits BETWEEN 1 AND 3) AS last FROM w GROUP BY 1)
SELECT s.company_id, CAST(coalesce(hits, 0) AS INT) AS hits, coalesce(last, 5e9) AS next_eligible_at, coalesce(CASE WHEN hits > 3 THEN 'force_ready_hits_exceeded hits=4 max=3: idle' END, quarantine) AS quarantine FROM s LEFT JOIN g ON g.company_id = s.company_id""",
)
def force_ready(t):
    e = t("events")
    states = e.select(F.col("user_id").alias("company_id"), F.lit(5e9).alias("next_eligible_at"), F.when(F.col("user_id") % 11 == 0, "held").alias("quarantine")).distinct()
    forces = e.where("event_type in ('click', 'error')").select(F.col("user_id").alias("company_id"), F.col("event_id").alias("ord"), F.unix_timestamp("ts").cast("double").alias("ts"), F.lit("idle").alias("reason"))
    out = control.force_ready(states, forces, cooldown=86400.0)
    return out.select("company_id", "hits", "next_eligible_at", "quarantine")


_ACTION = "CASE event_id % 5 WHEN 0 THEN 'terminal' WHEN 1 THEN 'mem' WHEN 2 THEN 'stall' END"
_FAILURE = "CASE event_id % 7 WHEN 0 THEN 'goto_fail_fast' WHEN 1 THEN 'nxdomain' WHEN 2 THEN 'goto' END"


@C.query(
    "terminalization",
    f"""WITH x AS (SELECT event_id, event_id % 9 = 0 AS md, {_ACTION} AS a, event_type AS why, event_id % 3 AS n, {_FAILURE} AS f FROM events)
SELECT event_id, NOT md AND coalesce(a = 'terminal' AND n > 0, FALSE) AS terminal, CASE WHEN md THEN 'has_progress' WHEN a = 'terminal' THEN 'page_summary_terminal' || CASE WHEN n = 0 THEN '_downgraded:' ELSE ':' END || why WHEN a IS NOT NULL THEN 'page_summary_' || a || ':' || why
  WHEN f = 'goto_fail_fast' THEN 'goto_fail_fast_downgraded' WHEN f = 'nxdomain' THEN 'nxdomain_like' WHEN f = 'goto' THEN 'goto_timeout' ELSE 'no_terminalize' END AS reason,
  CASE WHEN md THEN 'stall' WHEN a = 'terminal' AND n > 0 THEN 'permanent' WHEN a = 'mem' THEN 'mem' WHEN a IS NOT NULL THEN 'stall' WHEN f = 'nxdomain' THEN 'net' ELSE 'stall' END AS cls FROM x""",
)
def terminalization(t):
    md = F.when(F.col("event_id") % 9 == 0, 1).otherwise(0)
    made = control.terminalization(md, F.expr(_ACTION), F.col("event_type"), F.col("event_id") % 3, F.expr(_FAILURE))
    return t("events").select("event_id", made.alias("d")).select("event_id", "d.terminal", "d.reason", "d.cls")


@C.query(
    "requeue_decisions",
    f"""WITH {_CONTROL}, d AS (SELECT *, CAST(company_id AS INT) % 17 = 0 AS stop, CAST(company_id AS INT) % 13 <> 0 AS runnable FROM g)
SELECT company_id, NOT stop AND runnable AND NOT quarantined AND NOT doomed AS again, CASE WHEN NOT stop AND runnable AND NOT quarantined AND NOT doomed THEN round(greatest(0, next_eligible_at - 1706000000), 3) ELSE 0.0 END AS delay,
  CASE WHEN stop THEN 'stop_requested' WHEN NOT runnable THEN 'not_runnable' WHEN quarantined THEN 'quarantined' WHEN doomed THEN 'doomed_repeat_goto' ELSE 'retry_policy_next_eligible' END AS reason FROM d""",
)
def requeue_decisions(t):
    rows, k = control.control_state(_control(t)), F.col("company_id").cast("int")
    made = control.requeue(k % 17 == 0, k % 13 != 0, F.col("quarantine").isNotNull(), F.col("doomed"), F.col("next_eligible_at"), F.lit(1706000000.0))
    return rows.select("company_id", made.alias("d")).select("company_id", "d.again", F.round("d.delay", 3).alias("delay"), "d.reason")


@C.query("recorded_attempts", "SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'terminalized' WHEN event_type = 'purchase' THEN CASE WHEN value > 50 THEN 'success_but_quarantined_kept' ELSE 'success' END WHEN event_type = 'signup' THEN 'transient_cancel' ELSE 'failure' END AS note FROM events")
def recorded_attempts(t):
    stage = F.when(F.col("event_type") == "signup", "cancelled").otherwise("fetch")
    return t("events").select("event_id", control.recorded(F.col("event_id") % 6 == 0, F.col("event_type") == "purchase", stage, F.col("value") > 50).alias("note"))


@C.query("process_exit", "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 3 WHEN event_id % 4 = 1 OR value > 70 OR event_type = 'error' THEN 17 ELSE 0 END AS code FROM events")
def process_exit(t):
    code = control.process_exit(F.when(F.col("event_id") % 10 == 0, 3), F.when(F.col("event_id") % 4 == 1, 2).otherwise(0), F.when(F.col("value") > 70, 1).otherwise(0), F.col("event_type") == "error")
    return t("events").select("event_id", code.alias("code"))


@C.query("doomed_companies", f"WITH {_CONTROL} SELECT company_id FROM g WHERE doomed")
def doomed_companies(t):
    return control.control_state(_control(t)).where("doomed").select("company_id")


