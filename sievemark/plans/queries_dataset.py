"""Queries of the table verbs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dataset as d
from ..operators import merge as m
from .base import Catalog
from .steps import run_steps

C = Catalog()


@C.query("ds_filter", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE CAST(o_orderstatus AS VARCHAR) = 'F' AND coalesce(CAST(o_orderpriority AS VARCHAR), 'nan') <> '1-URGENT'")
def ds_filter(t):
    return d.where_all(t("orders"), ["o_orderstatus=F", "o_orderpriority!=1-URGENT"]).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@C.query("ds_project", "SELECT c_name AS name, c_custkey AS id, c_mktsegment FROM customer")
def ds_project(t):
    return d.project(t("customer"), ["c_custkey", "c_name", "c_mktsegment"], d.parse_mapping("c_custkey:id,c_name:name"), ["name"])


@C.query("ds_sort_topn", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100")
def ds_sort_topn(t):
    return d.sort_rows(t("orders"), ["o_totalprice"], "o_orderkey", desc=True).limit(100).select("o_orderkey", "o_totalprice")


for _keep, _fn in (("first", "min"), ("last", "max")):

    @C.query(f"ds_dedup_{_keep}", f"SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE (o_custkey, o_orderkey) IN (SELECT o_custkey, {_fn}(o_orderkey) FROM orders GROUP BY o_custkey)")
    def ds_dedup(t, keep=_keep):
        return d.dedup(t("orders"), ["o_custkey"], "o_orderkey", keep).select("o_custkey", "o_orderkey", "o_totalprice")


for _how, _sql in (("inner", "JOIN"), ("left", "LEFT JOIN"), ("right", "RIGHT JOIN"), ("outer", "FULL JOIN")):

    @C.query(
        f"ds_join_{_how}",
        f"""SELECT coalesce(l.k, r.k) AS k, l.name AS name_l, r.name AS name_r, l.c_acctbal, r.o_totalprice
FROM (SELECT c_custkey AS k, c_name AS name, c_acctbal FROM customer) l {_sql} (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS k, o_orderpriority AS name, o_totalprice FROM orders) r ON l.k IS NOT DISTINCT FROM r.k""",
    )
    def ds_join(t, how=_how):
        left = t("customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), "c_acctbal")
        right = t("orders").select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"), F.col("o_orderpriority").alias("name"), "o_totalprice")
        return d.join_tables(left, right, ["k"], how)


@C.query("ds_idcopy", "SELECT c_custkey, c_name FROM customer WHERE CAST(c_custkey AS VARCHAR) IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'P')")
def ds_idcopy(t):
    return d.semi_by_id(t("customer"), t("orders").where("o_orderstatus = 'P'"), "c_custkey", "o_custkey").select("c_custkey", "c_name")


@C.query("ds_split_by_ids", "SELECT CASE WHEN s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49) THEN 'moved' ELSE 'remain' END AS side, count(*) AS n FROM supplier GROUP BY 1")
def ds_split_by_ids(t):
    ids = t("lineitem").where("l_quantity > 49").select(F.col("l_suppkey").alias("s_suppkey"))
    remain, moved = d.split_by_ids(t("supplier"), ids, "s_suppkey")
    return remain.select(F.lit("remain").alias("side")).union(moved.select(F.lit("moved"))).groupBy("side").agg(F.count("*").alias("n"))


@C.query("ds_split", "SELECT c_custkey, CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / ceil(count(*) OVER () / 7.0)) + 1 AS BIGINT) AS part FROM customer")
def ds_split(t):
    return d.split_parts(t("customer"), "c_custkey", parts=7).select("c_custkey", "part")


@C.query("ds_stats", """SELECT "column", nulls, "rows" FROM (SELECT 'c_custkey' AS "column", count(*) - count(c_custkey) AS nulls, count(*) AS "rows" FROM customer UNION ALL SELECT 'c_name', count(*) - count(c_name), count(*) FROM customer)""")
def ds_stats(t):
    return d.null_counts(t("customer").select("c_custkey", "c_name"))


@C.query("ds_group_counts", """SELECT coalesce(nullif(trim(c_mktsegment), ''), '__NA__') AS "group", count(*) AS n FROM customer GROUP BY 1""")
def ds_group_counts(t):
    return d.group_counts(t("customer"), "c_mktsegment")


_COUNTS = "SELECT coalesce(nullif(trim(c_mktsegment), ''), '__NA__') AS g, count(*) AS n FROM customer GROUP BY 1"
_ALLOC = f"""WITH c AS ({_COUNTS}), e AS (SELECT g, n, n * 100.0::DOUBLE / sum(n) OVER () AS x FROM c),
f AS (SELECT g, n, least(greatest(CAST(floor(x) AS BIGINT), 2), n) AS fl, x - floor(x) AS r FROM e),
w AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN fl < n THEN 0 ELSE 1 END, r DESC, g) AS turn, 100 - sum(fl) OVER () AS lft FROM f),
a AS (SELECT g, n, least(fl + CASE WHEN fl < n AND turn <= lft THEN 1 ELSE 0 END, 30) AS take FROM w)"""


@C.query("ds_allocate", f"""{_ALLOC} SELECT g AS "group", n, CAST(take AS BIGINT) AS take FROM a""")
def ds_allocate(t):
    return d.allocate(d.group_counts(t("customer"), "c_mktsegment"), total=100, least=2, most=30)


@C.query("ds_select_balanced", f"""{_ALLOC}, o AS (SELECT c_custkey, coalesce(nullif(trim(c_mktsegment), ''), '__NA__') AS g, row_number() OVER (PARTITION BY coalesce(nullif(trim(c_mktsegment), ''), '__NA__') ORDER BY c_custkey) AS k FROM customer)
SELECT c_custkey, o.g AS segment FROM o JOIN a ON o.g = a.g WHERE k <= take""")
def ds_select_balanced(t):
    sizes = d.allocate(d.group_counts(t("customer"), "c_mktsegment"), total=100, least=2, most=30)
    return d.take_per_group(t("customer"), "c_mktsegment", sizes, "c_custkey").select("c_custkey", F.col("c_mktsegment").alias("segment"))


@C.query("ds_select_last", "SELECT c_custkey, c_mktsegment FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey DESC) AS k FROM customer) WHERE k <= 3")
def ds_select_last(t):
    sizes = d.allocate(d.group_counts(t("customer"), "c_mktsegment"), cap=3)
    return d.take_per_group(t("customer"), "c_mktsegment", sizes, "c_custkey", "last").select("c_custkey", "c_mktsegment")


@C.query("ds_append", "SELECT n_nationkey AS k, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region")
def ds_append(t):
    return d.append(t("nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")), t("region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name")))


@C.query("ds_merge_tables", "SELECT id, name, coalesce(extra, '') AS extra FROM (SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, '' AS extra FROM supplier UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, 'customer' FROM customer WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier))")
def ds_merge_tables(t):
    base = t("supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"))
    more = t("customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("extra"))
    return m.merge_tables(base, more, "id")


@C.query("ds_steps", "SELECT o_custkey, o_orderkey AS id FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F') WHERE k = 1")
def ds_steps(t):
    return run_steps(t("orders"), '[{"verb": "filter", "where": ["o_orderstatus=F"]}, {"verb": "dedup", "keys": ["o_custkey"], "order": "o_orderkey"}, {"verb": "copy", "keep": ["o_custkey", "o_orderkey"], "rename": {"o_orderkey": "id"}}]')


@C.query("ds_sample_ids", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey FROM (SELECT DISTINCT c_custkey FROM customer) ORDER BY md5('7:' || CAST(c_custkey AS VARCHAR)), 1 LIMIT 50")
def ds_sample_ids(t):
    return d.sample_ids(t("customer"), "c_custkey", 50, seed=7)
