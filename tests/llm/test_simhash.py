"""SimHash components against brute force over all pairs."""

import random

import xxhash

from sievemark.llm import queries, simhash_dedup

from .conftest import docs_frame


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """(doc_id, fingerprint, component_id) by comparing all pairs of distinct fingerprints."""
    prints = [fingerprint(r[1]) for r in rows]
    names = sorted(set(prints))
    root = {f: f for f in names}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[find(b)] = find(a)
    least = {}
    for (doc_id, *_), f in zip(rows, prints, strict=True):
        if doc_id is not None:
            k = find(f)
            least[k] = min(least.get(k, doc_id), doc_id)
    return sorted(((r[0], f"{f:016x}", least.get(find(f))) for r, f in zip(rows, prints, strict=True)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def versions(rng, n):
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    for _ in range(n):
        words = list(base)
        words[rng.randrange(150)] = f"x{rng.randrange(9)}"
        yield " ".join(words)


def test_components(spark):
    rng = random.Random(5)
    texts = [None, "", " \n", "One", "one\ttwo", "one two three", "ONE two three", *versions(rng, 150), *(" ".join(f"r{rng.randrange(1000)}" for _ in range(60)) for _ in range(100))]
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(1000, None), (900, texts[100]), (None, texts[9]), (None, "no id but words"), (7, "é è ü 😀 ß"), (7, "é è ü 😀 ß")]
    want = brute(rows)
    sizes = {c for _, _, c in want}
    assert len(sizes) < len(rows) - 100  # many are linked
    docs = docs_frame(spark, rows, ("fingerprint", "fp", "bucket"))
    assert got(simhash_dedup.simhash_components(docs)) == want
    assert got(simhash_dedup.simhash_components(docs, direct=2)) == want  # every bucket by balls


def test_bit_pairs(spark):
    """Links found through each segment and through common neighbours; bit 63 is the sign."""
    rng = random.Random(3)
    names = {0, -1}
    for _ in range(60):
        f = rng.getrandbits(64) - (1 << 63)
        names |= {f} | {int.from_bytes(((f % 2**64) ^ sum(1 << b for b in rng.sample(range(64), k))).to_bytes(8, "big"), "big", signed=True) for k in (1, 1, 2, 2, 2, 3)}
    want = {(a, b) for a in names for b in names if a < b and ((a ^ b) % 2**64).bit_count() <= 2}
    frame = spark.createDataFrame([(f,) for f in names], "fp long")
    assert {tuple(r) for r in simhash_dedup.links(frame).collect()} == want
    star = {tuple(r) for r in simhash_dedup.links(frame, direct=1).collect()}
    assert star <= want and len(star) > 50


def test_long_text_and_empty_table(spark):
    long = " ".join(f"v{i * i % 5003}" for i in range(200_000))
    rows = [(1, long), (2, long + " end"), (3, None)]
    assert got(simhash_dedup.simhash_components(docs_frame(spark, rows))) == brute(rows)
    assert simhash_dedup.simhash_components(docs_frame(spark, [])).count() == 0


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(queries.QUERIES["op11_simhash_dedup"](spark, sf)) == brute(docs)
