"""The prefix trie against brute force over all prefixes."""

import hashlib
import random
import zlib

from pyspark.sql import types as T

from sievemark.llm import prefix_trie, queries

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("depth", T.LongType()), T.StructField("h", T.LongType())])


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, 8) for r in rows], SCHEMA)


def rebuilt(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:3])] for c, ts in convs.items()}
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = tuple(convs.get(base, [])[:h] + own[h:])
    return out


def brute(rows):
    convs = rebuilt(rows)
    nodes = {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    children = {p: 0 for p in nodes}
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if convs[c] == p)
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(prefix_trie.RESULT).collect()), key=str)


def some_rows(rng, n):
    rows = []
    for c in rng.sample(range(n * 3), n):
        kind = rng.random()
        for t in range(rng.randrange(1, 9) if kind > 0.1 else 40):
            text = "hello" if t == 0 and kind < 0.6 else f"t{rng.randrange(3)} é😀" if kind < 0.8 else "same"
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    return rows


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = some_rows(rng, 400)
    rows += [(2000 + i, t, "user", f"copy {t}") for i in range(90) for t in range(6)]  # a group of copies
    rows += [(-5, 0, "a", "x"), (-100, 0, "b", "y"), (-100, 1, "b", "y"), (9001, None, None, None), (9001, 3, None, "z"), (9001, None, "r", ""), (None, 1, "user", "no conversation"), (9002, 1, "u", "twice"), (9002, 1, "u", "twice")]
    rng.shuffle(rows)
    want = brute(rows)
    df = frame(spark, rows)
    assert got(prefix_trie.prefix_trie(df)) == want
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        for block in (1, 3, 50):  # intervals that cross blocks and tasks
            assert got(prefix_trie.prefix_trie(df, block_rows=block)) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got(prefix_trie.prefix_trie(df.repartition(1).coalesce(1), block_turns=10)) == want


def test_one_conversation_many_copies_and_long_ones(spark):
    rows = [(c, t, "user", "k" * (t % 5)) for c in range(100, 700) for t in range(3)]
    rows += [(c, t, "user", f"l{t}") for c in (5000, 5001) for t in range(3000)] + [(6000, 0, "user", "x" * 1_000_000)]
    assert got(prefix_trie.prefix_trie(frame(spark, rows), block_rows=64)) == brute_sparse(rows)


def brute_sparse(rows):
    """As ``brute``, with hashes in place of long prefixes."""
    convs = rebuilt(rows)
    members, parent, cost, last = {}, {}, {}, {}
    for c, seq in convs.items():
        key = "root"
        members.setdefault(key, []).append(c)
        for turn in seq:
            above, key = key, hashlib.md5(repr((key, turn)).encode()).hexdigest()
            parent[key], cost[key] = above, len(turn[1])
            members.setdefault(key, []).append(c)
        last.setdefault(key, []).append(c)
    depth = {"root": 0}
    order = ["root"]
    below = {}
    for k, p in parent.items():
        below.setdefault(p, []).append(k)
    for k in order:
        for x in below.get(k, []):
            depth[x] = depth[k] + 1
            order.append(x)
    leaves, saved = {}, {}
    for k in reversed(order):
        leaves[k] = sum(leaves[x] for x in below.get(k, [])) or 1
        saved[k] = sum(saved[x] for x in below.get(k, [])) + (len(members[k]) - 1) * cost.get(k, 0)
    return sorted(((min(members[k]), depth[k], min(members[parent[k]]) if k != "root" else None, len(members[k]), len(below.get(k, [])), leaves[k], saved[k], hashlib.sha256(",".join(map(str, sorted(last.get(k, [])))).encode()).hexdigest()) for k in order), key=str)


def test_empty_tables(spark):
    assert prefix_trie.prefix_trie(frame(spark, [])).count() == 0
    assert prefix_trie.prefix_trie(frame(spark, [(None, 1, "a", "b")])).count() == 0
    assert got(prefix_trie.prefix_trie(frame(spark, [(3, 0, None, None)]))) == brute([(3, 0, None, None)])


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.QUERIES["op12_prefix_trie"](spark, sf)) == brute(rows)
