"""Streams against their batch forms, and small functions without a query of their own."""

import random

from pyspark.sql import functions as F

from sievemark.functions import errors, gating, language, markup, text, urls, vectors
from sievemark.operators import dataset, profile, retry, state
from sievemark.plans.steps import run_steps
from sievemark.streaming import page_stream, retry_stream

LEDGER = "company_id string, ord long, ts double, event string, cls string, stage string, error string, status_code int, nxdomain_like boolean, stall_kind string, md_done int"


def ledger_rows(n=400, seed=8):
    rng, out = random.Random(seed), []
    for i in range(n):
        event = rng.choice(["failure"] * 8 + ["success", "transient"])
        error = rng.choice(["connection refused", "Page.goto: Timeout 30000ms exceeded", "rate limit hit", "odd thing 12", "cancelled by scheduler", "no yield"])
        out.append((f"c{rng.randrange(9)}", i, float(i), event, rng.choice(["net", "stall", "mem", "permanent", None]), "fetch", error, rng.choice([None, 429, 502]), rng.random() < 0.1, None, rng.choice([None, None, 0, 1, 2, 5])))
    return out


def test_the_stream_folds_as_the_batch_does(spark, tmp_path):
    rows = ledger_rows()
    for k in range(4):  # the order of files is the order of events
        spark.createDataFrame(rows[k * 100 : k * 100 + 100], LEDGER).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    source = spark.readStream.schema(LEDGER).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    names = ["company_id", "ord", "attempts", "net_attempts", "stall_attempts", "mem_attempts", "streak", "signature", "quarantine"]
    q = retry_stream.retry_stream(source).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.ord: tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select(*names).collect()}
    want = {r.ord: tuple(r) for r in retry.failures(spark.createDataFrame(rows, LEDGER)).select(*names).collect()}
    assert got == want and len(want) > 200


def test_pages_append_patches_that_fold_to_an_index(spark, tmp_path):
    long = "# Head\n" + "plain words of a page " * 30
    pages = [("a", "u1", 1, long, None, 200), ("a", "u1", 2, "", "out of memory", None), ("a", "u2", 3, "short", None, 200), ("b", "u1", 4, long, "Timed out", None)]
    schema = "company_id string, url string, ord long, markdown string, error string, status_code int"
    spark.createDataFrame(pages, schema).write.parquet(f"{tmp_path}/in")
    page_stream.write_index(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/log", f"{tmp_path}/cp").awaitTermination(120)
    got = {(r.company_id, r.url): (r.status, r.error_kind, r.status_code) for r in page_stream.read_index(spark.read.parquet(f"{tmp_path}/log")).collect()}
    assert got == {("a", "u1"): ("memory_pressure", "memory", 200), ("a", "u2"): ("markdown_suppressed", None, 200), ("b", "u1"): ("timeout", "timeout", None)}


def test_windows_with_late_events(spark, tmp_path):
    spark.sql("SELECT timestamp'2024-01-01 00:10:00' + make_interval(0,0,0,0,0,id * 20) AS ts, if(id % 2 = 0, 'a', 'b') AS event_type, CAST(id AS double) AS value FROM range(12)").write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(f"{tmp_path}/in")
    q = page_stream.event_windows(source).writeStream.format("memory").queryName("late").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sum(r.n for r in spark.table("late").collect()) == 12 and sum(r.total for r in spark.table("late").collect()) == 66


def one(spark, column, **cells):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in cells.items()))
    return df.select(column.alias("v")).first().v


def test_small_functions(spark):
    c = F.col
    assert one(spark, text.markdown_text(c("t")), t="## Head\n- [x](y) `z` <i>q</i>\n```\ncode\n```\n![p](r) end") == "Head\nx z q \n \n end"
    assert one(spark, errors.compact(c("t")), t="  one\n two \nCall log: three") == "one two"
    assert one(spark, errors.compact(c("t"), 10), t="x" * 30) == "x" * 7 + "..."
    assert one(spark, text.main_content(c("t")), t="menu\n# Title\nbody") == "# Title\nbody"
    assert one(spark, text.has_evidence(c("b"), c("n"), c("d")), b="a steel pump of iron", n="Steel Pump", d="") is True
    assert one(spark, text.truncate(c("t"), 4), t="abcdef") == "abc…"
    assert one(spark, urls.path_segments(c("t")), t="a.com/x//y?z") == ["x", "y"]
    assert one(spark, vectors.bm25(F.array(F.lit("a"), F.lit("b"), F.lit("a")), ("z",))) == 0.0
    assert one(spark, markup.head_document(c("t")), t="<title> A\n b </title><meta name='description' content='D'>") == "A b A b A b  D D  D"
    assert one(spark, markup.head_document(c("t")), t="no head") == ""
    assert one(spark, text.profile_sentences(c("t")), t="A b. a B. • C! d") == ["A b.", "C!", "d"]
    assert language.any_of([]) == language.NOTHING and language.any_of(["a", " ", "b"]) == "(?:a)|(?:b)" and language.effective("en", []) == ("en",)


def test_gate_reasons(spark):
    words = "plain words of a page about pumps and valves "
    cases = {
        "": "empty", "one two": "no-structure", "# one two": "too-short", words * 20: "ok", words * 12 + "We use cookies. Accept cookies. Cookie policy. Cookie settings. " * 2: "cookie-dominant",
        words * 12 + "terms of use privacy policy license warranty " * 8: "legal-dominant", words * 12 + "Are you over 18? Age gate. ": "age-dominant", words * 12 + "Sign in. LOG IN. Paywall. ": "login-required",
    }
    df = spark.createDataFrame(list(cases.items()), "t string, want string").select("want", gating.gate(F.col("t")).alias("g"))
    for r in df.collect():
        assert (r.g.reason, r.g.action) == (r.want, "save" if r.want == "ok" else "suppress")


def test_ranks_in_groups_without_a_group_in_one_task(spark):
    df = spark.createDataFrame([(["a", "b", None][min(i % 7, 2)], i * 37 % 1000, i) for i in range(1000)], "g string, v int, i int")
    got = dataset.numbered(df, ["v"], "row", ["g"]).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.g, []).append((r.row, r.v))
    for own in groups.values():
        assert [v for _, v in sorted(own)] == sorted(v for _, v in own) and sorted(n for n, _ in own) == list(range(1, len(own) + 1))


def test_tiles_of_large_blocks_lose_no_pair(spark):
    rng = random.Random(1)
    rows = [(i, "x" if i % 3 else "y", [rng.gauss(0, 1) for _ in range(4)]) for i in range(200)] + [(200, "x", [0.0] * 4), (201, None, [1.0] * 4)]
    df = spark.createDataFrame(rows, "k long, g string, v array<double>")
    pairs = lambda t: sorted((r.a, r.b, round(r.similarity, 9)) for r in profile.similar_pairs(df, ["g"], "k", "v", 0.9, tile=t).collect())
    assert pairs(7) == pairs(10_000) and len(pairs(7)) > 20


def test_trailing_counts_over_slots(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("ab"), rng.randrange(0, 5000)) for i in range(500)]
    got = {r.i: r.recent for r in retry.trailing_count(spark.createDataFrame(rows, "i int, g string, ts long"), "g", 600).collect()}
    assert got == {i: sum(h == g and ts - 600 <= t <= ts for _, h, t in rows) for i, g, ts in rows}


def test_steps(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(10)], "id int, g int")
    out = run_steps(df, [{"verb": "filter", "where": ["g!=2"]}, {"verb": "select", "by": "g", "cap": 2, "order": "id"}, {"verb": "sort", "by": ["g"], "order": "id"}])
    assert sorted(r.id for r in out.collect()) == [0, 1, 3, 4]
    assert [r["column"] for r in run_steps(df, '[{"verb": "schema"}]').collect()] == ["id", "g"]


def test_page_decisions(spark):
    pages = spark.createDataFrame([("a", 1, "save", None, None), ("a", 2, "save", "timeout", "x"), ("b", 1, "suppress", "timeout", "y"), ("c", 1, "save", "memory", "z")], "company_id string, ord long, action string, error_kind string, error string")
    got = {r.company_id: (r.decision, r.last_error) for r in state.page_decision(state.page_summary(pages)).collect()}
    assert got == {"a": ("ok", "x"), "b": ("stall", "y"), "c": ("mem", "z")}
