import random
import re
from collections import Counter

from sievemark.llm import quality_rules as q
from sievemark.llm import queries
from sievemark.llm import url_filters as u

from .conftest import docs_frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            hit.update((i, i + 1, i + 2))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), len(words) < 50 or 100 * len(hit) > 50 * len(words)


def check(df, rows):
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=str)


def test_base_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(queries.op2_quality_rules(spark, sf), rows)


def test_odd_rows(odd):
    check(q.quality_rules(odd), [(r.doc_id, r.text) for r in odd.collect()])


def test_empty_table(spark):
    assert q.quality_rules(docs_frame(spark, [])).count() == 0


def test_kept_never_overrules_the_base(spark, sf):
    assert queries.op2_quality_rules(spark, sf).where("kept AND base_failed").count() == 0


def test_lines():
    assert q.judge_line("Home | About | Shop | Contact", 7) == "navigation"
    assert q.judge_line("a### b&&& c*** d%%%", 4) == "noise"
    assert q.judge_line("All rights reserved.", 3) == "boilerplate"
    assert q.judge_line("Read on", 2) == "fragment"
    assert q.judge_line("A plain sentence ends here.", 5) is None
    body = "This sentence is long enough to stay as it is. " * 3
    assert q.clean(f"{body}\nMenu | Home | Shop | Cart\n\nEnd here.")["clean_text"] == f"{body}\n\nEnd here."


def as_regex(glob):
    return re.compile("".join({"\x01": ".*", "*": "[^/]*", "?": "."}.get(c, re.escape(c)) for c in re.sub(r"\*\*+", "\x01", glob)), re.S)


def test_automaton_equals_regex():
    rnd = random.Random(5)
    globs = ["".join(rnd.choice("ab/.*?") for _ in range(rnd.randint(1, 8))) for _ in range(150)]  # several machine words
    subjects = ["".join(rnd.choice("ab/.") for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    hit = u.WildcardAutomaton(globs).match(subjects)
    assert [[bool(x) for x in row] for row in hit] == [[bool(as_regex(g).fullmatch(s)) for g in globs] for s in subjects]


def fits(rule, host, path):
    return (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)


def test_rules_equal_brute_force(spark, sf):
    rows = [(r.page_id, r.url) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    odd = [(900, None), (901, "no scheme"), (902, "http://A.COM"), (903, "http://x.com/?q=http://b.com/"), (904, "https://www.Example.com/en/1#f"), (905, "ftp://example.net/es/"), (906, "http://x.org/a.com/"), (None, "http://a.net/fr/"), (905, "ftp://example.net/es/")]
    df = spark.createDataFrame(rows + odd, "page_id long, url string")
    got = {}
    for r in u.url_filters(df, queries.URL_RULES).collect():
        got.setdefault(r.page_id, []).append(r)
    for page_id, url in rows + odd:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m and "://" in url else ("", "")
        best = max((x for x in queries.URL_RULES if host and fits(x, host, path)), key=lambda x: len(x.name), default=None)
        for r in got[page_id]:
            assert (r.host, r.path, r.rule) == (host, path, best.name if best else None)
            if best:
                assert r.verdict == best.verdict


def test_globs_judge_what_no_rule_fits(spark):
    df = spark.createDataFrame([(1, "http://x.org/a/b.zip"), (2, "http://x.org/login/now"), (3, "http://x.org/page"), (4, "http://ads.x.org/")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in u.url_filters(df, []).collect()} == {1: "block", 2: "block", 3: "allow", 4: "block"}


def test_no_pages(spark):
    assert u.url_filters(spark.createDataFrame([], "page_id long, url string"), queries.URL_RULES).count() == 0
