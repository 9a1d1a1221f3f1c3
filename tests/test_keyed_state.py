"""Keyed streams against their batch forms, over several micro-batches and after a restart."""

import random

import pytest
from pyspark.sql import functions as F

from sievemark.operators import control, state, urlfilter
from sievemark.streaming import keyed_state


@pytest.fixture(autouse=True)
def rocksdb(spark):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    keyed_state.keep_state_on_disk(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def run(spark, tmp_path, schema, files, made):
    """All files but the last in one run, one a micro-batch; the last one after a restart."""
    for part in (files[:-1], files[-1:]):
        for k, rows in enumerate(part):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{len(part)}-{k}")
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        q = made(source).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").outputMode("append").trigger(availableNow=True).start()
        assert q.awaitTermination(300)
    return spark.read.parquet(f"{tmp_path}/out")


def test_first_urls_and_caps(spark, tmp_path):
    rng = random.Random(4)
    rows = [(f"c{rng.randrange(3)}", f"u{rng.randrange(60)}", i) for i in range(160)]
    schema = "company_id string, url string, ord long"
    files = [rows[k * 40 : k * 40 + 40] for k in range(4)]
    batch = spark.createDataFrame(rows, schema)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    assert key(run(spark, tmp_path / "a", schema, files, keyed_state.first_seen)) == key(urlfilter.first_seen(batch, "url", "ord"))
    assert key(run(spark, tmp_path / "b", schema, files, lambda s: keyed_state.cap_pages(s, 17))) == key(state.cap_pages(batch, 17, [F.col("ord")]))


def test_forced_readiness(spark, tmp_path):
    rng = random.Random(6)
    schema = "company_id string, ord long, ts double, kind string, next_eligible_at double, quarantine string, reason string"
    states = [(f"c{i}", i, 1.0 + i, "state", 500.0 + i, "old" if i == 3 else None, None) for i in range(6)] + [("quiet", 9, 9.0, "state", 300.0, None, None)]
    forces = [(f"c{rng.randrange(7)}", 100 + i, 100.0 + i * 9, "force", None, None, rng.choice(["r1", None])) for i in range(120)]
    out = run(spark, tmp_path, schema, [states, forces[:50], forces[50:90], forces[90:]], lambda s: keyed_state.force_ready(s, late="0 seconds")).cache()
    last = {}
    for r in out.where("ord IS NOT NULL").orderBy("ord").collect():
        last[r.company_id] = (r.hits, r.last_forced, r.next_eligible_at, r.quarantine)
    frame = spark.createDataFrame([(c, e, q) for c, _, _, _, e, q, _ in states], "company_id string, next_eligible_at double, quarantine string")
    want = control.force_ready(frame, spark.createDataFrame([(c, o, t, r) for c, o, t, *_, r in forces], "company_id string, ord long, ts double, reason string"))
    want = {r.company_id: (r.hits or 0, r.last_forced or 0.0, r.next_eligible_at, r.quarantine) for r in want.collect()}
    assert {c: v for c, v in last.items() if c in want} == want
    seen = {r.outcome for r in out.select("outcome").distinct().collect()}
    assert seen == {"state", "ready", "cooldown", "exceeded", "quarantined", "unknown", "eligible"}
    assert [(r.ts, r.next_eligible_at) for r in out.where("company_id = 'quiet' AND outcome = 'eligible'").collect()] == [(300.0, 300.0)]
