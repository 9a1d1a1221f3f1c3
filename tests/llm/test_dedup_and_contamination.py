import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sievemark.llm import decontamination as c
from sievemark.llm import line_dedup as ld
from sievemark.llm import near_dedup as nd
from sievemark.llm import queries

from ..oracle import connect, same
from .conftest import docs_frame

BIG = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twin(spark, name):
    same(queries.QUERIES[name](spark, BIG), connect(BIG), queries.ORACLES[name])


def lines_brute(rows, least):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", x))
    count = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        kept = [x for x in parts if not (key(x) and count[key(x)] >= least)]
        out.append((i, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=str)


def test_lines_of_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = sorted(((r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in ld.line_dedup(odd, min_docs=3).collect()), key=str)
    assert got == lines_brute(rows, 3)


def test_lines_that_differ_in_case_and_space(spark):
    rows = [(i, f"Same LINE \r\nown {i}\n  same line" if i % 2 else f"  same line\nown {i}") for i in range(12)]
    got = sorted(((r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in ld.line_dedup(docs_frame(spark, rows)).collect()), key=str)
    assert got == lines_brute(rows, 10)


def test_no_lines(spark):
    assert ld.line_dedup(docs_frame(spark, [])).count() == 0


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def contamination_brute(docs, items):
    windows = defaultdict(set)
    for i, t in items:
        if i is None:
            continue
        w = words(t)
        size = min(13, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[k : k + size])].add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if own := windows.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= own
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


ITEMS = [(1, "A b c."), (2, None), (None, "no id here"), (4, "..."), (5, "word1 other7 thing1 word2 other14 thing2 word3 other21 thing3 word4 other28 thing4 word5 other35 thing5"), (5, "line two"), (6, "a B c")]


@pytest.mark.parametrize("limits", [{}, {"block_bytes": 20, "shard_words": 50}])
def test_contamination_of_odd_rows(spark, odd, limits):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in c.find_contamination(odd, items, **limits).collect()), key=str)
    assert got == contamination_brute([(r.doc_id, r.text) for r in odd.collect()], ITEMS)


def test_longest_match_and_its_place(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = docs_frame(spark, [(1, f"x y {passage} z"), (2, "x w0 w1 w2 w3 z")])
    found = {r.doc_id: [tuple(m) for m in r.matches] for r in c.find_contamination(docs, spark.createDataFrame([(9, f"q {passage} r")], "item_id long, text string")).collect()}
    assert found == {1: [("9", 2, 1, 30)], 2: []}


def test_decontaminate_keeps_clean_rows_and_columns(spark, odd):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    left = c.decontaminate(odd, items)
    assert left.columns == odd.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted((i for i, t in ((r.doc_id, r.text) for r in odd.collect()) if words(t)[:3] != ["a", "b", "c"] or len(words(t)) > 60), key=str)


def test_empty_benchmark_and_documents(spark, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    assert c.find_contamination(odd, none).where("n_hit > 0").count() == 0
    assert c.find_contamination(docs_frame(spark, []), none).count() == 0


def classes_brute(rows):
    """doc_id -> class: components of copies and of pairs with a weighted Jaccard of 0.8 or more."""
    bags = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        k = min(5, len(w))
        bags.append((i, Counter(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else None))
    label = list(range(len(bags)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(bags)):
        for b in range(a):
            x, y = bags[a][1], bags[b][1]
            if x and y and 5 * min(sum(x.values()), sum(y.values())) >= 4 * max(sum(x.values()), sum(y.values())):
                least = sum((x & y).values())
                if 5 * least >= 4 * (sum(x.values()) + sum(y.values()) - least):
                    label[find(a)] = find(b)
    least_id = {}
    for k, (i, _) in enumerate(bags):
        if i is not None:
            least_id[find(k)] = min(i, least_id.get(find(k), i))
    return sorted(((i, least_id.get(find(k))) for k, (i, _) in enumerate(bags)), key=str)


def test_classes_equal_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.class_id) for r in queries.op8_near_dedup(spark, sf).collect()), key=str)
    assert got == classes_brute(rows)


def test_chain_of_versions_and_a_large_group(spark):
    base = [f"t{i}" for i in range(100)]
    rows = []
    for k in range(12):  # each version is near the next, the ends are far apart
        rows.append((100 + k, " ".join([f"n{j}" if j < 4 * k else base[j] for j in range(100)])))
    rows += [(200 + k, " ".join(base[:50] + [f"u{k}"] + base[51:])) for k in range(40)]
    rows += [(300 + k, "same text for all of these rows here") for k in range(40)]
    rows += [(1, "a"), (2, "A"), (3, "a b"), (4, "x " * 40), (5, "x " * 41), (6, "x " * 80)]
    got = sorted(((r.doc_id, r.class_id) for r in nd.near_duplicates(docs_frame(spark, rows)).select("doc_id", "class_id").collect()), key=str)
    assert got == classes_brute(rows)


@pytest.mark.parametrize("base", [[f"t{i}" for i in range(150)], ["a", "b", "c", "d", "e", "f"] * 25])
def test_group_whose_versions_differ_more_and_less(spark, base):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(160):
        own = list(base)
        for j in range(int(rng.integers(0, 12))):
            own[int(rng.integers(0, len(own)))] = f"e{k}.{j}" if rng.random() < 0.7 else f"s{j}"
        rows.append((k, " ".join(own[: int(rng.integers(125, 151))])))
    got = sorted(((r.doc_id, r.class_id) for r in nd.near_duplicates(docs_frame(spark, rows)).select("doc_id", "class_id").collect()), key=str)
    assert len({c for _, c in got}) > 3
    assert got == classes_brute(rows)


def test_classes_of_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = sorted(((r.doc_id, r.class_id) for r in nd.near_duplicates(odd).collect()), key=str)
    assert got == classes_brute(rows)


def test_one_of_each_class_stays(spark, odd):
    left = nd.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    # 1 stands for 5 and 5; texts without words stay
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([1, 2, 3, None, None, 6, 7, 8, 9], key=str)
    again = docs_frame(spark, [(5, "p q r"), (5, "p q r"), (None, "z z z"), (None, "z z z"), (7, "p Q r")])
    assert sorted((r.doc_id for r in nd.drop_near_duplicates(again).collect()), key=str) == [5, None]
    assert nd.near_duplicates(docs_frame(spark, [])).count() == 0


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(3)
    for spread in (12, 10**6):
        a = rng.integers(0, spread, 600)
        b = a.copy()
        b[rng.integers(0, 600, 25)] = 10**7
        x, y = (nd.shingles(nd._mix(v.astype(np.uint64) + np.uint64(1))) for v in (a, b))
        cx, cy = Counter(x.tolist()), Counter(y.tolist())
        true = sum((cx & cy).values()) / sum((cx | cy).values())
        s = nd.signatures([x, y], 2000)
        assert abs((s[0] == s[1]).mean() - true) < 0.05


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (100, 102), (101, 103)]
    got = {r.node: r.label for r in nd.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys(range(100, 104), 100)}
