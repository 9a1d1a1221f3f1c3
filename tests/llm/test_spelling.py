"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

from sievemark.llm import queries, spelling_variants

from .conftest import docs_frame


def vocabulary(rows):
    seen = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda x: x[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= 2}


def one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1 or x == y:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    return any(y[:k] + y[k + 1 :] == x for k in range(len(y)))


def brute(words):
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= 10 * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def edited(rng, word):
    at, kind = rng.randrange(len(word)), rng.randrange(3)
    return word[:at] + ("" if kind == 0 else rng.choice("abé")) + word[at + (kind != 1) :]


def some_words(rng, n):
    out = ["".join(rng.choice("abé") for _ in range(rng.randrange(7, 12))) for _ in range(n)]
    out += [edited(rng, w) for w in out] + [edited(rng, edited(rng, w)) for w in out] + ["a" * k for k in range(6, 14)] + ["ab" * k for k in range(3, 9)]
    return out


def test_near_words_in_every_kind_of_group(spark):
    rng = random.Random(2)
    words = {w: rng.choice((2, 3, 20, 30, 300, 4000)) for w in some_words(rng, 250) if len(w) >= 7}
    assert sum(r[4] > 0 for r in brute(words)) > 200
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    ranked = {w: (len(v), min(v, key=lambda x: (-words[x], x))) for w in words if (v := [x for x in words if one_edit(w, x)])}
    for large, block in ((512, 64), (1, 64), (3, 2), (40, 7)):
        out = {r.word: (r.n_near, r.best) for r in spelling_variants.near_words(frame, large, block).collect()}
        assert out == ranked


def test_operator(spark):
    rng = random.Random(4)
    pool = ["language", "langage", "languages", "Übersetzung", "übersetzung", "ubersetzung", "straße12weiter", "mañana×seguro", "Ÿtterbium", "naïveté", "abcdefg", "abcdefgh"]
    chain = ["chaining"] * 2000 + ["chainingx"] * 190 + ["chainingxy"] * 18
    rows = [(i, " ".join(rng.choices(pool, k=30)) + "\n" + " ".join(chain[i::20])) for i in range(20)]
    rows += [(50, None), (51, ""), (None, "language language mañanas"), (None, None), (3, "twicetwice"), (3, "twicetwice"), (60, "q" * 300_000 + " " + "q" * 300_000 + " " + "q" * 299_999 + " " + "q" * 299_999), (61, "日本語 language😀language Łanguages")]
    want = brute({w: n for w, n in vocabulary(rows).items() if len(w) < 1000})
    out = got(spelling_variants.spelling_variants(docs_frame(spark, rows, ("word", "n", "form"))))
    assert [r for r in out if len(r[0]) < 1000] == want
    long = vocabulary(rows).keys() - {r[0] for r in want}
    assert {r[0]: r[4] for r in out if len(r[0]) > 1000} == dict.fromkeys(long, len(long) - 1) and long
    assert any(r[1] and r[1] != r[2] for r in out)  # a form that has a form
    assert spelling_variants.spelling_variants(docs_frame(spark, [])).count() == 0
    assert spelling_variants.spelling_variants(docs_frame(spark, [(1, None), (2, "short words")])).count() == 0


def test_query(spark, sf):
    """Against single deletions: two words are near if they share one, at one place, or one is the other's."""
    words = vocabulary([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])
    holes = {}
    for w in words:
        for k in range(len(w)):
            holes.setdefault((k, w[:k] + w[k + 1 :]), set()).add(w)
    near = {w: set() for w in words}
    for (_, short), ws in holes.items():
        for w in ws:
            near[w] |= ws - {w}
            if short in near:
                near[w].add(short)
                near[short].add(w)
    form = {w: min(v, key=lambda x: (-words[x], x)) for w, v in near.items() if v}
    form = {w: f for w, f in form.items() if words[f] >= 10 * words[w]}
    want = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        want.append((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    assert got(queries.QUERIES["op13_spelling_variants"](spark, sf)) == sorted(want, key=str)
