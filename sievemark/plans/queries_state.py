"""Queries of index folds, stages, merges and repairs. Events stand for index changes: a user is a company, ``event_id % 23`` a page."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import calibrate, merge, state
from .base import Catalog

C = Catalog()
_LOG = """log AS (SELECT CAST(user_id AS VARCHAR) AS company_id, 'u' || CAST(event_id % 23 AS VARCHAR) AS url, event_id AS ord, CASE WHEN event_type IN ('view', 'purchase') THEN 'markdown_done' WHEN event_type = 'click' THEN 'timeout' END AS status,
  CASE WHEN event_type = 'purchase' THEN TRUE END AS llm, CASE WHEN value > 50 THEN 'f' || CAST(event_id AS VARCHAR) END AS path FROM events)"""
_FOLD = f"WITH {_LOG}, e AS (SELECT company_id, url, arg_max(status, ord) FILTER (status IS NOT NULL) AS status, arg_max(llm, ord) FILTER (llm IS NOT NULL) AS llm, arg_max(path, ord) FILTER (path IS NOT NULL) AS path FROM log GROUP BY company_id, url)"
_DONE = f"{_FOLD}, x AS (SELECT *, coalesce(llm, FALSE) OR coalesce(status = 'llm_done', FALSE) AS llm_done FROM e), d AS (SELECT *, coalesce(path <> '', FALSE) OR coalesce(status = 'markdown_done', FALSE) OR llm_done AS md_done FROM x)"
_STAGE = f"""{_DONE}, m AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS company_id, user_id % 2 = 0 AS fin FROM events), c AS (SELECT m.company_id, fin AS crawl_finished, count(url) AS urls_total, count(*) FILTER (md_done) AS urls_md, count(*) FILTER (llm_done) AS urls_llm FROM m LEFT JOIN d ON m.company_id = d.company_id GROUP BY 1, 2),
s AS (SELECT *, CASE WHEN urls_total = 0 THEN 'pending' WHEN NOT crawl_finished AND urls_md = 0 THEN 'pending' WHEN urls_md < urls_total THEN 'markdown_not_done' WHEN urls_llm >= urls_total THEN 'llm_done' WHEN urls_llm > 0 THEN 'llm_not_done' WHEN crawl_finished THEN 'markdown_done' ELSE 'llm_not_done' END AS status FROM c)"""


def _entries(t):
    log = t("events").select(
        F.col("user_id").cast("string").alias("company_id"), F.concat(F.lit("u"), F.col("event_id") % 23).alias("url"), F.col("event_id").alias("ord"),
        F.when(F.col("event_type").isin("view", "purchase"), "markdown_done").when(F.col("event_type") == "click", "timeout").alias("status"), F.when(F.col("event_type") == "purchase", True).alias("llm"),
        F.when(F.col("value") > 50, F.concat(F.lit("f"), F.col("event_id"))).alias("path"),
    )
    return state.fold_log(log, ["company_id", "url"], "ord", ["status", "llm", "path"])


def _done(t):
    none = F.lit(None)
    return _entries(t).withColumn("d", state.completed(F.col("status"), none.cast("boolean"), F.col("llm"), F.col("path"), none.cast("string"))).select("company_id", "url", "status", "path", "d.md_done", "d.llm_done")


def _stages(t):
    meta = t("events").select(F.col("user_id").cast("string").alias("company_id"), (F.col("user_id") % 2 == 0).alias("crawl_finished")).distinct()
    return state.company_stage(_done(t), meta)


@C.query("index_fold", f"{_FOLD} SELECT company_id, url, status, llm, path FROM e")
def index_fold(t):
    return _entries(t)


@C.query("entry_completion", f"{_DONE} SELECT company_id, url, md_done, llm_done FROM d")
def entry_completion(t):
    return _done(t).select("company_id", "url", "md_done", "llm_done")


@C.query("pending_urls", f"{_DONE} SELECT company_id, url FROM d WHERE md_done AND NOT llm_done")
def pending_urls(t):
    return state.pending(_done(t), "llm").select("company_id", "url")


@C.query("company_stage", f"{_STAGE} SELECT company_id, crawl_finished, urls_total, urls_md, urls_llm, status FROM s")
def company_stage(t):
    return _stages(t).select("company_id", "crawl_finished", "urls_total", "urls_md", "urls_llm", "status")


_STATUSES = ("pending", "markdown_not_done", "terminal_done", "markdown_done", "llm_not_done", "llm_done")


@C.query("global_state", f"""{_STAGE}, g AS (SELECT count(*) AS n_companies, {', '.join(f"count(*) FILTER (status = '{x}') AS n_{x}" for x in _STATUSES)}, CAST(sum(urls_total) AS BIGINT) AS urls_total, CAST(sum(urls_md) AS BIGINT) AS urls_md, CAST(sum(urls_llm) AS BIGINT) AS urls_llm FROM s)
SELECT *, CASE WHEN urls_total > 0 THEN round(urls_md * 100.0::DOUBLE / urls_total, 2) ELSE 0.0 END AS pct_md, CASE WHEN urls_total > 0 THEN round(urls_llm * 100.0::DOUBLE / urls_total, 2) ELSE 0.0 END AS pct_llm, round((n_llm_done + n_terminal_done) * 100.0::DOUBLE / n_companies, 2) AS pct_done FROM g""")
def global_state(t):
    return state.global_state(_stages(t))


@C.query("progress", f"{_STAGE} SELECT count(*) FILTER (status IN ('llm_done', 'terminal_done')) AS done, count(*) AS total FROM s")
def progress(t):
    return state.progress(_stages(t))


@C.query("worklist_runnable", f"{_STAGE} SELECT company_id FROM s WHERE status NOT IN ('markdown_done', 'terminal_done') AND company_id NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'error')")
def worklist_runnable(t):
    retry = t("events").where("event_type = 'error'").select(F.col("user_id").cast("string").alias("company_id"))
    rows = _stages(t).where(state.runnable(F.col("status"), llm=False)).select("company_id")
    return state.worklist(rows, retry, "skip-retry")


@C.query("normalize_counters", f"""{_STAGE}, o AS (SELECT company_id, status, urls_total - 1 AS urls_total, urls_md, urls_llm + 2 AS urls_llm FROM s), p AS (SELECT *, greatest(urls_total, urls_md, urls_llm) AS tt FROM o),
q AS (SELECT company_id, tt, urls_md, status, CASE WHEN status = 'llm_done' THEN tt ELSE greatest(urls_llm, 0) END AS ll FROM p) SELECT company_id, tt AS urls_total, CASE WHEN status = 'llm_done' THEN tt ELSE greatest(urls_md, ll) END AS urls_md, ll AS urls_llm FROM q""")
def normalize_counters(t):
    rows = _stages(t).select("company_id", "status", (F.col("urls_total") - 1).alias("urls_total"), "urls_md", (F.col("urls_llm") + 2).alias("urls_llm"))
    return state.normalize_counters(rows).select("company_id", "urls_total", "urls_md", "urls_llm")


@C.query("recompute", f"""{_STAGE}, r(status, k) AS (VALUES ('pending', 0), ('markdown_not_done', 1), ('terminal_done', 2), ('markdown_done', 2), ('llm_not_done', 3), ('llm_done', 4)),
o AS (SELECT company_id, CASE WHEN CAST(company_id AS INT) % 3 = 0 THEN 'markdown_done' ELSE 'pending' END AS st, CAST(7 AS BIGINT) AS tt FROM s)
SELECT o.company_id, CASE WHEN rs.k > ro.k THEN s.status ELSE o.st END AS status, greatest(tt, urls_total) AS urls_total FROM o JOIN s USING (company_id) JOIN r rs ON rs.status = s.status JOIN r ro ON ro.status = o.st""")
def recompute(t):
    d = _stages(t)
    old = d.select("company_id", F.when(F.col("company_id").cast("int") % 3 == 0, "markdown_done").otherwise("pending").alias("status"), F.lit(7).cast("long").alias("urls_total"), F.lit(0).cast("long").alias("urls_md"), F.lit(0).cast("long").alias("urls_llm"), F.lit(False).alias("crawl_finished"))
    return state.recompute(old, d).select("company_id", "status", "urls_total")


@C.query("recrawl_policy", f"{_STAGE} SELECT company_id, CASE WHEN status IN ('markdown_done', 'llm_not_done', 'llm_done') AND urls_total = 23 THEN 'markdown_not_done' ELSE status END AS status, status IN ('markdown_done', 'llm_not_done', 'llm_done') AND urls_total = 23 AS reopened FROM s")
def recrawl_policy(t):
    return state.recrawl(_stages(t), forced=False, old_cap=23, new_cap=50).select("company_id", "status", "reopened")


_PAGES = """p AS (SELECT CAST(user_id AS VARCHAR) AS company_id, event_id AS ord, CASE WHEN value > 20 THEN 'save' ELSE 'suppress' END AS action, CASE event_type WHEN 'error' THEN 'timeout' WHEN 'signup' THEN 'other' END AS kind, CASE WHEN event_type IN ('error', 'signup') THEN event_type || CAST(event_id AS VARCHAR) END AS error FROM events)"""


def _pages(t):
    return t("events").select(F.col("user_id").cast("string").alias("company_id"), F.col("event_id").alias("ord"), F.when(F.col("value") > 20, "save").otherwise("suppress").alias("action"), F.when(F.col("event_type") == "error", "timeout").when(F.col("event_type") == "signup", "other").alias("error_kind"), F.when(F.col("event_type").isin("error", "signup"), F.concat("event_type", F.col("event_id").cast("string"))).alias("error"))


@C.query("page_summary", f"""WITH {_PAGES}, g AS (SELECT company_id, count(*) AS pages, count(*) FILTER (action = 'save') AS saved, count(*) FILTER (action = 'suppress') AS suppressed, count(*) FILTER (kind = 'timeout') AS timeouts, count(*) FILTER (kind = 'memory') AS memory,
  coalesce(arg_max(error, ord) FILTER (kind = 'timeout'), arg_max(error, ord) FILTER (error IS NOT NULL)) AS last_error FROM p GROUP BY 1)
SELECT *, round(timeouts / pages::DOUBLE, 6) AS timeout_share, CASE WHEN memory > 0 THEN 'mem' WHEN timeouts >= 0.6 * pages THEN 'stall' ELSE 'ok' END AS decision FROM g""")
def page_summary(t):
    return state.page_decision(state.page_summary(_pages(t)))




def _sides(t):
    rows = _done(t).select("company_id", "url", "status", "md_done", "llm_done", F.coalesce("path", F.lit("")).alias("path"))
    left = rows.where(F.coalesce("status", F.lit("")) != "timeout")
    more = F.col("path").endswith("7")
    right = rows.where((F.col("path") != "") | F.col("llm_done")).withColumn("llm_done", F.col("llm_done") | more).withColumn("md_done", F.col("md_done") | more).withColumn("path", F.concat(F.lit("s"), "path"))
    return left.drop("status"), right.drop("status")


@C.query("merge_url_index", f"""{_DONE}, r AS (SELECT company_id, url, status, md_done, llm_done, coalesce(path, '') AS path FROM d), a AS (SELECT * FROM r WHERE coalesce(status, '') <> 'timeout'),
b AS (SELECT company_id, url, md_done OR ends_with(path, '7') AS md_done, llm_done OR ends_with(path, '7') AS llm_done, 's' || path AS path FROM r WHERE path <> '' OR llm_done),
j AS (SELECT coalesce(a.company_id, b.company_id) AS company_id, coalesce(a.url, b.url) AS url, a.md_done AS am, a.llm_done AS al, a.path AS ap, b.md_done AS bm, b.llm_done AS bl, b.path AS bp, a.url IS NULL AS no_a, 2 * CAST(a.llm_done AS INT) + CAST(a.md_done AS INT) AS sa, 2 * CAST(b.llm_done AS INT) + CAST(b.md_done AS INT) AS sb FROM a FULL JOIN b ON a.company_id = b.company_id AND a.url = b.url)
SELECT company_id, url, CASE WHEN no_a OR sb > sa THEN bm ELSE am END AS md_done, CASE WHEN no_a OR sb > sa THEN bl ELSE al END AS llm_done, CASE WHEN no_a OR sb > sa OR (sa = sb AND ap = '') THEN bp ELSE ap END AS path FROM j""")
def merge_url_index(t):
    left, right = _sides(t)
    return merge.merge_index(left, right, ["path"])


_ROWS = """a AS (SELECT c_custkey AS company_id, CASE WHEN c_custkey % 3 = 0 THEN 'llm_done' WHEN c_custkey % 3 = 1 THEN 'terminal_done' ELSE 'pending' END AS status, CAST(c_custkey % 10 AS VARCHAR) AS updated_at, 'a' AS src FROM customer WHERE c_acctbal > 0),
b AS (SELECT c_custkey AS company_id, CASE WHEN c_custkey % 2 = 0 THEN 'llm_done' ELSE 'pending' END AS status, CAST(c_custkey % 7 AS VARCHAR) AS updated_at, 'b' AS src FROM customer WHERE c_mktsegment <> 'BUILDING')"""


def _rows(t):
    c, k = t("customer"), F.col("c_custkey")
    a = c.where("c_acctbal > 0").select(k.alias("company_id"), F.when(k % 3 == 0, "llm_done").when(k % 3 == 1, "terminal_done").otherwise("pending").alias("status"), (k % 10).cast("string").alias("updated_at"), F.lit("a").alias("src"))
    b = c.where("c_mktsegment <> 'BUILDING'").select(k.alias("company_id"), F.when(k % 2 == 0, "llm_done").otherwise("pending").alias("status"), (k % 7).cast("string").alias("updated_at"), F.lit("b").alias("src"))
    return a, b


@C.query("merge_company_rows", f"""WITH {_ROWS}, u AS (SELECT *, CASE status WHEN 'pending' THEN 0 WHEN 'llm_done' THEN 4 ELSE 5 END AS rk FROM (SELECT * FROM a UNION ALL SELECT * FROM b)), r AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY rk DESC, CAST(updated_at AS DOUBLE) DESC, src) AS k FROM u)
SELECT company_id, status, updated_at, src FROM r WHERE k = 1""")
def merge_company_rows(t):
    return merge.merge_companies(*_rows(t)).select("company_id", "status", "updated_at", "src")


@C.query("merge_retry_states", f"WITH {_ROWS}, r AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY updated_at DESC, length(status) DESC, src) AS k FROM (SELECT * FROM a UNION ALL SELECT * FROM b)) SELECT company_id, updated_at, CAST(length(status) AS INT) AS attempts, src FROM r WHERE k = 1")
def merge_retry_states(t):
    a, b = (x.withColumn("attempts", F.length("status")).drop("status") for x in _rows(t))
    return merge.merge_retry(a, b).select("company_id", "updated_at", "attempts", "src")


@C.query("merge_quarantine", f"WITH {_ROWS}, r AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY updated_at DESC, src DESC) AS k FROM (SELECT * FROM a UNION ALL SELECT * FROM b)) SELECT company_id, updated_at AS ts, src FROM r WHERE k = 1")
def merge_quarantine(t):
    a, b = (x.select("company_id", F.col("updated_at").alias("ts"), "src") for x in _rows(t))
    return merge.merge_quarantine(a, b)


@C.query("replace_rows", f"WITH {_ROWS} SELECT company_id, status, src FROM b UNION ALL SELECT company_id, status, src FROM a WHERE company_id NOT IN (SELECT company_id FROM b)")
def replace_rows(t):
    return merge.replace_rows(*_rows(t), ["company_id"]).select("company_id", "status", "src")


#: Rows of three roots: rank of the status, number of attempts, time, and the root.
_ROOTS = """k AS (SELECT c_custkey AS id, c_acctbal, c_mktsegment AS seg, c_custkey % 3 AS a, c_custkey % 2 AS b, c_custkey % 4 AS c, c_custkey % 10 AS ua, c_custkey % 7 AS ub, c_custkey % 5 AS uc FROM customer),
r0 AS (SELECT id, CASE a WHEN 0 THEN 'llm_done' WHEN 1 THEN 'terminal_done' ELSE 'pending' END AS status, ua AS u, 'r0' AS src FROM k WHERE c_acctbal > 0),
r1 AS (SELECT id, CASE b WHEN 0 THEN 'llm_done' ELSE 'pending' END AS status, ub AS u, 'r1' AS src FROM k WHERE seg <> 'BUILDING'), r2 AS (SELECT id, CASE c WHEN 0 THEN 'pending' ELSE 'terminal_done' END AS status, uc AS u, 'r2' AS src FROM k WHERE seg <> 'MACHINERY')"""
_BETTER = {
    "company": "CASE y.status WHEN 'pending' THEN 0 WHEN 'llm_done' THEN 4 ELSE 5 END > CASE x.status WHEN 'pending' THEN 0 WHEN 'llm_done' THEN 4 ELSE 5 END OR y.status = x.status AND y.u > x.u",
    "retry": "y.u > x.u OR y.u = x.u AND length(y.status) > length(x.status)", "quarantine": "y.u >= x.u", "run": "FALSE",
}


def _after_each_other(kind: str) -> str:
    """The three roots merged one after the other, by the rule of a table."""
    pair = lambda x, y: f"SELECT coalesce(x.id, y.id) AS id, CASE WHEN x.id IS NULL OR y.id IS NOT NULL AND ({_BETTER[kind]}) THEN y.status ELSE x.status END AS status, CASE WHEN x.id IS NULL OR y.id IS NOT NULL AND ({_BETTER[kind]}) THEN y.u ELSE x.u END AS u, CASE WHEN x.id IS NULL OR y.id IS NOT NULL AND ({_BETTER[kind]}) THEN y.src ELSE x.src END AS src FROM {x} x FULL JOIN {y} y ON x.id = y.id"
    return f"SELECT '{kind}' AS kind, CAST(id AS BIGINT) AS id, src FROM ({pair('(' + pair('r0', 'r1') + ')', 'r2')})"


def _run_roots(t):
    c, k, seg = t("customer"), F.col("c_custkey"), F.col("c_mktsegment")
    sides = [
        (c.where("c_acctbal > 0"), F.when(k % 3 == 0, "llm_done").when(k % 3 == 1, "terminal_done").otherwise("pending"), k % 10), (c.where(seg != "BUILDING"), F.when(k % 2 == 0, "llm_done").otherwise("pending"), k % 7),
        (c.where(seg != "MACHINERY"), F.when(k % 4 == 0, "pending").otherwise("terminal_done"), k % 5),
    ]
    out = []
    for i, (rows, status, u) in enumerate(sides):
        rows = rows.select(k.alias("company_id"), k.alias("run_id"), status.alias("status"), u.cast("string").alias("updated_at"), F.length(status).alias("attempts"), u.alias("ts"), F.lit(f"r{i}").alias("src"))
        out.append(merge.Root(rows.select("company_id", "status", "updated_at", "src"), rows.select("run_id", "src"), rows.select("run_id", "company_id", "src"), rows.select("company_id", "updated_at", "attempts", "src"), rows.select("company_id", "ts", "src"), ledger=rows.select("company_id", "src")))
    return out


@C.query("merge_run_roots", f"WITH {_ROOTS} {' UNION ALL '.join(map(_after_each_other, _BETTER))} UNION ALL SELECT 'done', id, src FROM ({_after_each_other('run')}) UNION ALL SELECT 'ledger', id, src FROM (SELECT * FROM r0 UNION ALL SELECT * FROM r1 UNION ALL SELECT * FROM r2)")
def merge_run_roots(t):
    target, *sources = _run_roots(t)
    out = merge.merge_roots(target, sources, [], include_ledger=True)
    pick = lambda df, kind, key="company_id": df.select(F.lit(kind).alias("kind"), F.col(key).cast("long").alias("id"), "src")
    parts = [pick(out.companies, "company"), pick(out.retry, "retry"), pick(out.quarantine, "quarantine"), pick(out.runs, "run", "run_id"), pick(out.done, "done"), pick(out.ledger, "ledger")]
    return reduce(lambda a, b: a.unionByName(b), parts)


@C.query("merge_report", f"WITH {_ROOTS}, s AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2) SELECT count(DISTINCT id) AS merged_company_ids, count(*) AS ledger_lines FROM s")
def merge_report(t):
    return merge.merge_report(_run_roots(t)[1:])


def _index_step(x: str, y: str) -> str:
    whole = "(x.url IS NULL OR coalesce(2 * CAST(y.llm_done AS INT) + CAST(y.md_done AS INT) > 2 * CAST(x.llm_done AS INT) + CAST(x.md_done AS INT), FALSE))"
    fill = "coalesce(2 * CAST(y.llm_done AS INT) + CAST(y.md_done AS INT) = 2 * CAST(x.llm_done AS INT) + CAST(x.md_done AS INT), FALSE)"
    pick = lambda c: f"CASE WHEN {whole} OR {fill} AND coalesce(CAST(x.{c} AS VARCHAR), '') = '' THEN y.{c} ELSE x.{c} END AS {c}"
    return f"SELECT coalesce(x.company_id, y.company_id) AS company_id, coalesce(x.url, y.url) AS url, {pick('md_done')}, {pick('llm_done')}, {pick('path')}, {pick('note')} FROM {x} x FULL JOIN {y} y ON x.company_id = y.company_id AND x.url = y.url"


@C.query("merge_run_indexes", f"""{_DONE}, r AS (SELECT company_id, url, status, md_done, llm_done, coalesce(path, '') AS path FROM d), a AS (SELECT company_id, url, md_done, llm_done, path, '' AS note FROM r WHERE coalesce(status, '') <> 'timeout'),
b AS (SELECT company_id, url, md_done OR ends_with(path, '7') AS md_done, llm_done OR ends_with(path, '7') AS llm_done, 's' || path AS path, CASE WHEN length(path) % 2 = 0 THEN 'b' ELSE '' END AS note FROM r WHERE path <> '' OR llm_done),
c AS (SELECT company_id, url, md_done, NOT llm_done AS llm_done, CASE WHEN ends_with(path, '3') THEN 'c' || path ELSE '' END AS path, 'c' AS note FROM r WHERE coalesce(status, '') <> 'ok' OR md_done) {_index_step('(' + _index_step('a', 'b') + ')', 'c')}""")
def merge_run_indexes(t):
    left, right = _sides(t)
    rows = _done(t).select("company_id", "url", "status", "md_done", "llm_done", F.coalesce("path", F.lit("")).alias("path"))
    third = rows.where((F.coalesce("status", F.lit("")) != "ok") | F.col("md_done")).select("company_id", "url", "md_done", (~F.col("llm_done")).alias("llm_done"), F.when(F.col("path").endswith("3"), F.concat(F.lit("c"), "path")).otherwise("").alias("path"), F.lit("c").alias("note"))
    note = F.when((F.length("path") - 1) % 2 == 0, "b").otherwise("")
    return merge.merge_indexes([left.withColumn("note", F.lit("")), right.withColumn("note", note), third], ["path", "note"])


@C.query("split_root", f"WITH {_ROWS} SELECT company_id, CASE WHEN company_id IN (SELECT company_id FROM b) AND status NOT IN ('llm_done', 'terminal_done') THEN 'moved' ELSE 'stays' END AS side FROM a")
def split_root(t):
    a, b = _rows(t)
    stay, moved = merge.split_root(a, b.select("company_id"))
    return stay.select("company_id", F.lit("stays").alias("side")).union(moved.select("company_id", F.lit("moved")))


_REASON = "CASE WHEN c_custkey % 4 = 0 THEN 'nxdomain' WHEN c_custkey % 4 = 1 THEN ' ' END"
_ST = "CASE c_custkey % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'terminal_done' ELSE 'llm_done' END"


def _reasons(t):
    return t("customer").select(F.col("c_custkey").alias("company_id"), F.expr(_ST).alias("status"), F.expr(_REASON).alias("done_reason"), F.lit(5).cast("long").alias("urls_total"), "c_acctbal", "c_mktsegment")


@C.query("reconcile", f"""WITH c AS (SELECT c_custkey AS company_id, {_ST} AS status, coalesce(trim({_REASON}), '') <> '' AS has FROM customer)
SELECT company_id, CASE WHEN status = 'pending' AND has THEN 'terminal_done' ELSE status END AS status, CASE WHEN status = 'terminal_done' AND NOT has THEN 'terminal-without-reason' WHEN status = 'pending' AND has THEN 'reason-without-terminal' END AS problem FROM c""")
def reconcile(t):
    return calibrate.reconcile(_reasons(t)).select("company_id", "status", "problem")


@C.query("reset_candidates", f"""WITH c AS (SELECT c_custkey AS company_id, {_ST} AS status, {_REASON} AS done_reason, c_acctbal, c_mktsegment FROM customer)
SELECT company_id, concat_ws(',', CASE WHEN status = 'pending' THEN 'pending' END, CASE WHEN done_reason = 'nxdomain' THEN 'nxdomain' END, CASE WHEN c_mktsegment = 'BUILDING' THEN 'included' END) AS reasons FROM c
WHERE (status = 'pending' OR coalesce(done_reason = 'nxdomain', FALSE) OR c_mktsegment = 'BUILDING') AND c_acctbal >= 0""")
def reset_candidates(t):
    rows = _reasons(t)
    found = calibrate.reset_candidates(rows, {"pending": F.col("status") == "pending", "nxdomain": F.col("done_reason") == "nxdomain"}, rows.where("c_mktsegment = 'BUILDING'"), rows.where("c_acctbal < 0"))
    return found.select("company_id", F.array_join("reasons", ",").alias("reasons"))


@C.query("reset_rows", f"SELECT c_custkey AS company_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'pending' ELSE {_ST} END AS status, CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 5 END AS BIGINT) AS urls_total, CASE WHEN c_mktsegment <> 'BUILDING' THEN {_REASON} END AS done_reason FROM customer")
def reset_rows(t):
    rows = _reasons(t)
    return calibrate.reset_rows(rows, rows.where("c_mktsegment = 'BUILDING'")).select("company_id", "status", F.col("urls_total").cast("long").alias("urls_total"), "done_reason")


@C.query("index_meta", f"""{_DONE} SELECT company_id, count(*) AS total_pages, count(*) FILTER (md_done AND coalesce(status, '') <> 'timeout') AS markdown_saved, count(*) FILTER (coalesce(status, '') = 'timeout') AS markdown_suppressed, count(*) FILTER (coalesce(status, '') = 'timeout') AS timeout_pages, CAST(0 AS BIGINT) AS memory_pressure_pages FROM d GROUP BY 1""")
def index_meta(t):
    rows = _done(t).withColumn("gating_action", F.when(F.col("status") == "timeout", "suppress").otherwise("save")).withColumn("gating_reason", F.lit("ok"))
    return calibrate.index_meta(rows)


@C.query("purge_retry", "SELECT event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 95)")
def purge_retry(t):
    e = t("events")
    return calibrate.purge(e, e.where("event_type = 'purchase' AND value > 95"), "user_id").select("event_id")


@C.query("max_pages_args", "SELECT event_id, TRY_CAST(CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 90 AS VARCHAR) WHEN event_id % 3 = 0 THEN CAST(event_id % 70 AS VARCHAR) END AS INT) AS max_pages FROM events")
def max_pages_args(t):
    args = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("--x --max_pages="), F.col("event_id") % 90)).when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"max_pages": '), F.col("event_id") % 70, F.lit("}"))).otherwise("none")
    return t("events").select("event_id", calibrate.max_pages(args).alias("max_pages"))


@C.query("json_health", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'empty' WHEN 2 THEN 'parse-error' ELSE 'not-object' END AS problem FROM events")
def json_health(t):
    doc = F.element_at(F.array(F.col("props"), F.lit(""), F.concat("props", F.lit("]")), F.concat(F.lit("["), "props", F.lit("]"))), (F.col("event_id") % 4 + 1).cast("int"))
    return t("events").select("event_id", calibrate.json_health(doc).alias("problem"))


@C.query("bytes_health", """SELECT event_id, CASE event_id % 9 WHEN 1 THEN 'empty' WHEN 2 THEN 'nul_bytes_prefix_or_early' WHEN 3 THEN 'non_utf8_bytes' WHEN 4 THEN 'whitespace_only' WHEN 5 THEN 'json_parse_error' WHEN 6 THEN 'json_not_dict' WHEN 7 THEN 'unreadable' END AS reason FROM events""")
def bytes_health(t):
    text = F.col("props").cast("binary")
    forms = {1: F.lit(b""), 2: F.concat(F.lit(b" \x00"), text), 3: F.concat(text, F.lit(b"\xff")), 4: F.lit(" \u00a0\n".encode()), 5: F.concat(text, F.lit(b"]")), 6: F.concat(F.lit(b"["), text, F.lit(b"]")), 7: F.lit(None).cast("binary"), 8: F.concat(F.lit(b'{"a":1,"a":'), text, F.lit(b"}"))}
    content = text
    for k, form in forms.items():
        content = F.when(F.col("event_id") % 9 == k, form).otherwise(content)
    return t("events").select("event_id", calibrate.bytes_health(content).alias("reason"))
