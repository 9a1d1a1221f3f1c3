"""The SQL twins of the rules, the URL filters and near-duplicates, on rows that reach every branch."""

import duckdb

from sievemark.llm import near_dedup, prefix_trie, quality_rules, queries, spelling_variants, twins, url_filters

from ..oracle import connect, same
from .conftest import docs_frame

PROSE = ["The river rose over night, and the mill stood still until noon.", "Nobody had told the children why the bell was silent.", "“Wait for the boat,” she said; it came late (as always)."]
LONG = " ".join(f"w{i}" for i in range(40))
LINES = [
    "Home | About | Contact", "Startseite > Shop > Kasse", "one | two and a good many other words that follow here", "§§ ¶¶ ★★ x", "wow !!!! #### $$$$", "Click here to read more", "Alle Rechte vorbehalten", "Lire la suite", LONG, LONG + ".", "Menu", "Fin.",
    "Ja »", "short line without any end", "another line without its end", "third line with no end", "\u00a0Fin de página\u2003", "\tindented, with an end.\r", "   ", "", "日本語の 文です。", "e\u0301 x", "| |", "a_b c_d e_f!", "Log in", "SIGN UP now and get the news of the whole week.",
]


def con_with(**tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    return con


def test_quality_rules(spark):
    texts = [None, "", " \n ", *LINES]
    for i, line in enumerate(LINES):
        for n in (2, 6):
            texts.append("\n".join([x for k in range(n) for x in (PROSE[k % 3].replace("river", f"river{i}.{k}"), line)]))
        texts.append("\n".join(PROSE + [line, *(f"{k} {LONG}." for k in range(2)), line]))
    texts.append("\n".join([LONG + ".", *LINES[13:16], "line number four has none"]))
    texts.append("\n".join([PROSE[0], LONG, " ".join(f"v{i}" for i in range(60))]))
    docs = docs_frame(spark, list(enumerate(texts)))
    out = quality_rules.quality_rules(docs, with_text=False)
    seen = out.selectExpr(*(f"sum(lost_{k}) AS {k}" for k in quality_rules.LINE_RULES), "count_if(kept)", "count_if(NOT kept AND NOT base_failed)", "count_if(base_failed)").first()
    assert all(x > 0 for x in seen)
    same(out, con_with(documents=docs), twins.QUALITY_RULES)


def test_url_filters(spark):
    hosts = ["example.com", "WWW.Example.com", "a.www.example.com", "notexample.com", "x.net", "net", "org", "ads.example.org", "shop.ads.org", "login.org", "", "bücher.org"]
    paths = ["", "/", "/en/", "/en/12", "/en", "/es/a", "/fr/", "/de/login?x=1", "/a/b.jpg", "/b.jpg#top", "?/en/", "#/es/", "/a/cgi-bin/x", "/cart", "/x\ny.css", "/wp-admin"]
    rows = [f"https://{h}{p}" for h in hosts for p in paths] + [None, "", "example.com/en/", "://", "http://a://b/en/", "file:///x/y.png"]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    out = url_filters.url_filters(pages, queries.URL_RULES)
    assert out.where("rule IS NOT NULL").select("rule").distinct().count() == len(queries.URL_RULES)
    assert out.select("glob").distinct().count() > 6
    same(out, con_with(pages=pages), twins.URL_FILTERS)


def test_near_duplicates(spark):
    base = [f"t{i}" for i in range(100)]
    rows = [(k, " ".join([f"n{j}" if j < 4 * k else base[j] for j in range(100)])) for k in range(9)]
    rows += [(20, "a"), (21, " A\n"), (22, "a b"), (23, "x " * 40), (24, "x " * 41), (25, "x " * 80), (26, None), (27, ""), (28, "p q r s t"), (29, "p q r s t")]
    docs = docs_frame(spark, rows)
    same(near_dedup.near_duplicates(docs).select("doc_id", "class_id"), con_with(documents=docs), twins.NEAR_DUPLICATES)


def test_prefix_trie(spark):
    rows = [(c, t, "user" if t % 2 == 0 else None, "hello" if t == 0 else f"t{(c * 7 + t) % 3} é") for c in (*range(0, 40), *range(100, 160), 305, -7) for t in range(c % 4 + 2)]
    rows += [(500, None, "a", None), (500, 1, None, "b"), (501, 0, "a", "x"), (None, 0, "user", "hello"), (502, 3, "a", "twice"), (502, 3, "a", "twice")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    same(prefix_trie.prefix_trie(turns), con_with(conversations=turns), twins.PREFIX_TRIE)


def test_spelling_variants(spark):
    words = ["Language", "langage", "languages", "über÷setzung", "übersetzungen", "ubersetzungen", "mañanas×seguros", "naïvetés", "abcdefg", "abcdefgh", "日本language"]
    rows = [(i, " ".join(words[(i * j) % len(words)] for j in range(25))) for i in range(40)] + [(None, "language mañanas"), (77, None), (78, ""), (79, "chaining " * 300 + "chainingx " * 20 + "chainingxy " * 2)]
    docs = docs_frame(spark, rows)
    out = spelling_variants.spelling_variants(docs)
    assert out.where("root <> coalesce(form, word)").count()
    same(out, con_with(documents=docs), twins.SPELLING_VARIANTS)


def test_queries(spark):
    con = connect("/root/testdata/sf0.01")
    for name in ("op12_prefix_trie", "op13_spelling_variants"):
        same(queries.QUERIES[name](spark, "/root/testdata/sf0.01"), con, queries.ORACLES[name])
