"""The log scan by blocks against a walk line by line, and a file of a million hits."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from sievemark.operators import logscan


def brute(rows, patterns, tokens, before, after):
    files = {}
    for path, n, line in rows:
        files.setdefault(path, {})[n] = line
    out = []
    for path, lines in files.items():
        free, current = -1, None
        for n in sorted(lines):
            line = lines[n]
            if n < free or line is None:
                continue
            if m := re.search(logscan.ID_LINE, line):
                current = m[1]
            if line and any(re.search(p, line) for p in patterns) and (not tokens or any(t in line.lower() for t in tokens)):
                out.append((path, n, current or "UNKNOWN", line, *(tuple(x for k in range(lo, hi) if (x := lines.get(k)) is not None) for lo, hi in ((n - before, n), (n + 1, n + 1 + after)))))
                free = n + after + 1
    return sorted(out)


@pytest.mark.parametrize(("before", "after", "block"), [(2, 2, 1), (1, 3, 7), (0, 0, 5), (3, 1, 1 << 16), (2, 5, 6)])
def test_blocks(spark, before, after, block):
    rng = random.Random(before * 100 + after)
    rows = []
    for f in range(4):
        dense = f / 3
        for n in range(1, 300):
            line = rng.choice(["ok", "", "ERROR fetch failed", "fetch refused by host"] if rng.random() < dense else ["ok", "company_id=c%d ok" % rng.randrange(5), "x"])
            rows.append((f"f{f}", n, line + (" bvdid: b%d" % rng.randrange(9) if rng.random() < 0.1 else "")))
    rows += [("g", 5, "failed at once"), ("g", 900, "failed later"), ("h", 1, None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "log_path string, line_no int, line string")
    out = logscan.scan(df, ["failed", "refused"], ["fetch", "at"], before, after, block=block).collect()
    got = sorted((r.log_path, r.line_no, r.company_id, r.message, tuple(r.context_before), tuple(r.context_after)) for r in out)
    assert got == brute(rows, ["failed", "refused"], ["fetch", "at"], before, after)


def test_a_million_hits_in_one_file(spark):
    n = 1_000_000
    lines = spark.range(n).select(F.lit("one.log").alias("log_path"), (F.col("id") + 1).cast("int").alias("line_no"), F.when(F.col("id") % 1000 == 0, F.concat(F.lit("company_id=c"), F.col("id").cast("string"), F.lit(" failed"))).otherwise("it failed").alias("line"))
    began = time.perf_counter()
    row = logscan.scan(lines, ["failed"], before=1, after=1).agg(F.count("*"), F.min("line_no"), F.max("line_no"), F.count_distinct("company_id")).first()
    assert tuple(row) == (n // 2, 1, n - 1, 1000)
    assert time.perf_counter() - began < 120
