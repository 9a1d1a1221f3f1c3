"""Queries of the retry ledger, control signals and log lines. Events stand for both."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import logscan, retry
from .base import Catalog

C = Catalog()


def ledger(events):
    """A ledger from events: a purchase is a success, a signup is transient, others are failures of several kinds."""
    k = F.col("event_id") % 7
    error = F.when(k < 2, "connection refused").when(k < 4, F.concat(F.lit("Page.goto: Timeout 3000"), F.lit("0ms exceeded"))).when(k < 5, "rate limit hit").otherwise(F.concat(F.lit("odd thing "), F.col("event_id")))
    event = F.when(F.col("event_type") == "purchase", "success").when(F.col("event_type") == "signup", "transient").otherwise("failure")
    return events.select(F.col("user_id").cast("string").alias("company_id"), F.col("event_id").alias("ord"), F.unix_timestamp("ts").cast("double").alias("ts"), event.alias("event"), F.lit("net").alias("cls"), F.lit("fetch").alias("stage"), error.alias("error"), F.lit(None).cast("int").alias("status_code"), F.lit(False).alias("nxdomain_like"), F.lit(None).cast("string").alias("stall_kind"), F.lit(None).cast("int").alias("md_done"))


_LEDGER = """l AS (SELECT CAST(user_id AS VARCHAR) AS company_id, event_id AS ord, CASE event_type WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'transient' ELSE 'failure' END AS event,
  CASE WHEN event_id % 7 < 2 THEN 'net' WHEN event_id % 7 < 5 THEN 'stall' ELSE 'net' END AS cls, CASE WHEN event_id % 7 < 2 THEN 'refused' WHEN event_id % 7 < 4 THEN 'goto_timeout' WHEN event_id % 7 < 5 THEN 'rate_limit' ELSE 'odd' END AS sig FROM events),
e AS (SELECT *, coalesce(count(*) FILTER (event = 'success') OVER (PARTITION BY company_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS epoch FROM l),
f AS (SELECT *, count(*) OVER w AS attempts, count(*) FILTER (cls = 'net') OVER w AS net_attempts, count(*) FILTER (cls = 'stall') OVER w AS stall_attempts, coalesce(lag(sig) OVER (PARTITION BY company_id, epoch ORDER BY ord) <> sig, TRUE) AS new FROM e WHERE event = 'failure' WINDOW w AS (PARTITION BY company_id, epoch ORDER BY ord)),
i AS (SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY company_id, epoch ORDER BY ord) AS island FROM f), s AS (SELECT *, row_number() OVER (PARTITION BY company_id, epoch, island ORDER BY ord) AS streak FROM i),
q AS (SELECT *, CASE WHEN sig = 'goto_timeout' AND streak >= 2 THEN 'repeat_goto_timeout' WHEN sig <> 'goto_timeout' AND streak >= 4 THEN 'repeat_same_error' WHEN cls = 'net' AND net_attempts >= 3 THEN 'max_net_attempts'
  WHEN cls = 'stall' AND stall_attempts >= CASE WHEN sig = 'goto_timeout' THEN 2 ELSE 4 END THEN 'max_stall_attempts[' || CASE WHEN sig = 'goto_timeout' THEN 'goto' ELSE 'rate_limit' END || ']' END AS quarantine FROM s)"""


@C.query("retry_fold", f"WITH {_LEDGER} SELECT company_id, ord, attempts, net_attempts, stall_attempts, CAST(streak AS INT) AS streak, quarantine FROM q")
def retry_fold(t):
    return retry.failures(ledger(t("events"))).select("company_id", "ord", "attempts", "net_attempts", "stall_attempts", "streak", "quarantine")


@C.query("error_streaks", f"WITH {_LEDGER} SELECT company_id, CAST(max(streak) AS INT) AS longest FROM s GROUP BY 1")
def error_streaks(t):
    return retry.failures(ledger(t("events"))).groupBy("company_id").agg(F.max("streak").alias("longest"))


_DELAY = "CASE WHEN cls = 'net' THEN [20, 60, 300][least(attempts, 3)] WHEN sig = 'goto_timeout' THEN [30, 120][least(attempts, 2)] ELSE [60, 300, 1200, 3600][least(attempts, 4)] END"


@C.query("backoff", f"WITH {_LEDGER} SELECT company_id, ord, CAST({_DELAY} AS DOUBLE) AS delay FROM q")
def backoff(t):
    return retry.failures(ledger(t("events"))).select("company_id", "ord", "delay")


_STATE = f"{_LEDGER}, le AS (SELECT company_id, max(epoch) AS epoch, arg_max(event, ord) AS last_event FROM e GROUP BY 1), st AS (SELECT q.company_id, arg_max(attempts, ord) AS attempts, arg_max(quarantine, ord) FILTER (TRUE) AS x, max(ord) AS ord FROM q JOIN le ON q.company_id = le.company_id AND q.epoch = le.epoch AND last_event <> 'success' GROUP BY 1)"


@C.query("retry_state", f"WITH {_STATE} SELECT st.company_id, st.attempts, q.quarantine FROM st JOIN q ON q.ord = st.ord")
def retry_state(t):
    return retry.state(ledger(t("events"))).select("company_id", "attempts", "quarantine")


@C.query("eligible_now", f"WITH {_STATE}, z AS (SELECT q.quarantine, CAST(floor(epoch(ts)) AS BIGINT) + {_DELAY.replace('attempts', 'q.attempts')} AS due FROM st JOIN q ON q.ord = st.ord JOIN events v ON v.event_id = st.ord) SELECT count(*) AS companies, count(*) FILTER (quarantine IS NULL AND due <= 1706000000) AS eligible, count(*) FILTER (quarantine IS NOT NULL) AS quarantined, CAST(min(due) FILTER (quarantine IS NULL AND due > 1706000000) AS DOUBLE) AS next_at FROM z")
def eligible_now(t):
    return retry.eligible(retry.state(ledger(t("events"))), 1706000000.0)


@C.query("error_ewma", "WITH e AS (SELECT user_id, epoch(ts) AS s, event_type = 'error' AS bad, max(epoch(ts)) OVER (PARTITION BY user_id) AS last FROM events) SELECT user_id, round(sum(CASE WHEN bad THEN pow(0.5, (last - s) / 86400.0) ELSE 0 END) / sum(pow(0.5, (last - s) / 86400.0)), 6) AS ratio FROM e GROUP BY 1")
def error_ewma(t):
    rows = t("events").select("user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("ts"), (F.col("event_type") == "error").alias("is_error"))
    return retry.decayed_ratio(rows, "user_id", 86400.0).withColumn("ratio", F.round("ratio", 6))


@C.query("stall_storms", "SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY CAST(floor(epoch(ts)) AS BIGINT) RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS recent FROM events")
def stall_storms(t):
    rows = t("events").select("event_id", "event_type", F.unix_timestamp("ts").alias("ts"))
    return retry.trailing_count(rows, "event_type", 3600).select("event_id", "recent")


@C.query("ramp_rate", """WITH e AS (SELECT event_id, user_id, CAST(floor(epoch(ts)) AS DOUBLE) AS s, value FROM events), w AS (SELECT event_id, s, value, user_id, min(s) OVER (PARTITION BY user_id ORDER BY s RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS s0 FROM e),
f AS (SELECT user_id, s, arg_min(value, event_id) AS value FROM e GROUP BY 1, 2) SELECT w.event_id, round(CASE WHEN w.s > s0 THEN (w.value - f.value) / (w.s - s0) ELSE 0 END, 6) + 0.0 AS ramp FROM w JOIN f ON f.user_id = w.user_id AND f.s = s0""")
def ramp_rate(t):
    rows = t("events").select("event_id", "user_id", F.unix_timestamp("ts").cast("double").alias("ts"), F.col("value").alias("used"))
    return retry.ramp(rows, "user_id", 86400, "event_id").select("event_id", (F.round("ramp", 6) + 0.0).alias("ramp"))


@C.query("outcomes", "SELECT event_id, CASE WHEN event_id % 5 < 2 THEN 'cancelled' WHEN event_id % 5 = 2 THEN 'transient' WHEN event_id % 5 = 3 THEN 'mem' ELSE 'stall' END AS cls FROM events")
def outcomes(t):
    kind = F.element_at(F.array(*map(F.lit, ("user", "sigterm", "scheduler", "memory", "other"))), (F.col("event_id") % 5 + 1).cast("int"))
    return t("events").select("event_id", retry.outcome(kind).alias("cls"))


def log_lines(events):
    """Log lines from events: a file for each user, numbered by event."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    line = F.when(F.col("event_type") == "signup", F.concat(F.lit("INFO company_id=c"), F.col("event_id"))).when(F.col("event_type") == "error", "ERROR fetch failed").otherwise(F.concat(F.lit("DEBUG "), "event_type"))
    return events.select(F.concat(F.lit("log"), "user_id").alias("log_path"), n.alias("line_no"), line.alias("line"))


_LINES = """l AS (SELECT 'log' || user_id AS log_path, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, CASE event_type WHEN 'signup' THEN 'INFO company_id=c' || event_id WHEN 'error' THEN 'ERROR fetch failed' ELSE 'DEBUG ' || event_type END AS line,
  CASE WHEN event_type = 'signup' THEN 'c' || event_id END AS id, event_type = 'error' AS hit FROM events)"""


def _hits(after: int) -> str:
    """Hits with the id in force: lines after a hit are passed over, so the walk goes from hit to hit."""
    return f"""WITH RECURSIVE {_LINES}, w AS (SELECT log_path, min(n) AS n FROM l WHERE hit GROUP BY 1 UNION ALL SELECT log_path, m FROM (SELECT w.log_path, w.n, min(l.n) AS m FROM w JOIN l ON l.log_path = w.log_path AND l.hit AND l.n > w.n + {after} GROUP BY 1, 2)),
k AS (SELECT l.*, w.n IS NOT NULL AS taken FROM l LEFT JOIN w ON w.log_path = l.log_path AND w.n = l.n), z AS (SELECT *, max(CASE WHEN taken THEN n END) OVER (PARTITION BY log_path ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS near FROM k),
c AS (SELECT *, coalesce(last_value(CASE WHEN taken OR coalesce(n > near + {after}, TRUE) THEN id END IGNORE NULLS) OVER (PARTITION BY log_path ORDER BY n), 'UNKNOWN') AS company_id, lag(line) OVER o AS p1, lead(line) OVER o AS n1, lead(line, 2) OVER o AS n2 FROM z WINDOW o AS (PARTITION BY log_path ORDER BY n))"""


@C.query("log_scan", f"{_hits(2)} SELECT log_path, CAST(n AS INT) AS line_no, company_id, 'ERROR' AS level, coalesce(p1, '') AS before, concat_ws('|', n1, n2) AS after FROM c WHERE taken")
def log_scan(t):
    hits = logscan.scan(log_lines(t("events")), ["failed", "refused"], ["fetch"], 1, 2)
    return hits.select("log_path", "line_no", "company_id", "level", F.concat_ws("|", "context_before").alias("before"), F.concat_ws("|", "context_after").alias("after"))


@C.query("log_hits_by_company", f"{_hits(0)} SELECT company_id, count(*) AS hits, CAST(min(n) AS INT) AS first_line FROM c WHERE taken GROUP BY 1")
def log_hits_by_company(t):
    return logscan.by_company(logscan.scan(log_lines(t("events")), ["failed"], before=0, after=0))
