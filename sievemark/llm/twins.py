"""What operators 2, 3, 8, 12 and 13 compute, said a second time in DuckDB's SQL: each rule by its definition, with none of the operators' methods."""

from __future__ import annotations

import re

from . import quality_rules, url_filters

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
#: White space of any script, as ``str.isspace`` has it.
_WIDE = r"\s\x0B\x1C-\x1F\x85\p{Z}"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '{_WORD}') AS w FROM d),
win AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS pos FROM w WHERE len(w) > 3),
again AS (SELECT doc_id, unnest(list(pos)) AS pos FROM win GROUP BY doc_id, w[pos], w[pos + 1], w[pos + 2] HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS p FROM again) GROUP BY doc_id),
l AS (SELECT doc_id, line, len(regexp_extract_all(line, '{_WORD}')) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)),
f AS (SELECT doc_id, line, n, regexp_replace(line, '^[{_WIDE}]+|[{_WIDE}]+$', '', 'g') AS bare, strlen(regexp_replace(line, '{_BLANK}+', '', 'g')) AS size,
      len(list_filter(regexp_split_to_array(line, '[{_WIDE}]'), lambda x: x IN ('|', '>', '»', '•', '·', '/'))) AS seps,
      length(regexp_replace(line, '[\p{{L}}\p{{N}}_{_WIDE}.,;:?''"()\-–—’“”«»¿¡…]+', '', 'g')) AS noise,
      len(regexp_extract_all(lower(line), {_text(quality_rules.BOILERPLATE.pattern)})) AS phrases,
      regexp_matches(line, '[.,;:!?…。！？]') AS pause, regexp_matches(line, '[.!?:;…。！？]["''”’»)\]]*[{_WIDE}]*$') AS ended
      FROM l WHERE n > 0),
o AS (SELECT *, n > 3 AND n <= 8 AND NOT ended AS open, count(*) OVER (PARTITION BY doc_id, bare) >= {quality_rules.FURNITURE} AS often FROM f),
m AS (SELECT *, count(*) FILTER (open) OVER (PARTITION BY doc_id) AS n_open, count(*) OVER (PARTITION BY doc_id) AS n_lines FROM o),
j AS (SELECT *, CASE WHEN seps >= 2 AND 4 * seps >= n THEN 'navigation' WHEN noise * 2 > n + 2 THEN 'noise' WHEN 30 * phrases >= n THEN 'boilerplate' WHEN n > 30 AND NOT pause THEN 'unpunctuated'
      WHEN n <= 3 AND NOT ended THEN 'fragment' WHEN often THEN 'boilerplate' WHEN open AND n_open >= 3 AND 2 * n_open > n_lines THEN 'fragment' ELSE 'none' END AS rule FROM m),
s AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, sum(size) AS size, coalesce(sum(size) FILTER (rule = 'none'), 0) AS stays,
      {', '.join(f"count(*) FILTER (rule = '{k}') AS lost_{k}" for k in quality_rules.LINE_RULES)} FROM j GROUP BY doc_id),
b AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{_BLANK}+', '', 'g')) AS BIGINT) AS word_chars,
      CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, size, stays,
      {', '.join(f"coalesce(lost_{k}, 0) AS lost_{k}" for k in quality_rules.LINE_RULES)}
      FROM d JOIN w USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN s USING (doc_id))
SELECT * EXCLUDE (size, stays), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * stays >= size AS kept,
       CAST(coalesce(stays / size, 0) AS DOUBLE) AS kept_share
FROM b"""


def _glob(pattern: str) -> str:
    """The regular expression of a glob."""
    part = {"**": ".*", "*": "[^/]*", "?": "."}
    return "(?s)^" + "".join(part.get(x) or re.escape(x) for x in re.findall(r"\*\*|.", pattern)) + "$"


URL_FILTERS = rf"""
WITH r(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
g(pos, name, pattern) AS (VALUES {', '.join(f"({i}, {_text(g)}, {_text(_glob(g))})" for i, g in enumerate(url_filters.DEFAULT_BLOCKS))}),
u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT row_number() OVER () AS k, page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM u),
s AS MATERIALIZED (SELECT * FROM p),
fit AS (SELECT k, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.verdict, length(r.host || r.path)) AS verdict
        FROM s JOIN r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path) GROUP BY k),
hit AS (SELECT k, min_by(g.name, pos) AS block FROM s JOIN g ON regexp_matches(s.host || s.path, g.pattern) GROUP BY k)
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN verdict WHEN block IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, CASE WHEN rule IS NULL THEN block END AS "glob"
FROM s LEFT JOIN fit USING (k) LEFT JOIN hit USING (k)"""


NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
t AS (SELECT w, min(doc_id) AS node, least(5, len(w)) AS k FROM d WHERE len(w) > 0 GROUP BY w),
s AS (SELECT node, array_to_string(w[pos:pos + k - 1], ' ') AS sh FROM (SELECT node, w, k, unnest(range(1, len(w) - k + 2)) AS pos FROM t)),
bag AS (SELECT node, sh, count(*) AS c FROM s GROUP BY node, sh),
total AS (SELECT node, sum(c) AS n FROM bag GROUP BY node),
shared AS (SELECT x.node AS a, y.node AS b, sum(least(x.c, y.c)) AS c FROM bag x JOIN bag y ON x.sh = y.sh AND x.node < y.node GROUP BY x.node, y.node),
link AS (SELECT a, b FROM shared JOIN total x ON x.node = a JOIN total y ON y.node = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(node, seen) AS (SELECT node, node FROM t UNION SELECT reach.node, edge.b FROM reach JOIN edge ON edge.a = reach.seen),
class AS (SELECT node, min(seen) AS class_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id FROM d LEFT JOIN t ON d.w = t.w LEFT JOIN class ON class.node = t.node"""


#: The table of CRC-32, by its polynomial.
_CRC = "crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t)"


def _crc(col: str) -> str:
    """CRC-32 of a text, by the table ``crc.t``."""
    bytes_ = f"list_transform(range(strlen({col})), lambda i: CAST('0x' || substr(hex(encode({col})), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {bytes_}), lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])))"


PREFIX_TRIE = f"""
WITH RECURSIVE {_CRC},
own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
cut AS (SELECT o.conv_id, o.turns, b.turns AS base, {_crc("CAST(o.conv_id AS VARCHAR)")} % 6 AS h FROM crc, own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
whole AS (SELECT conv_id, list_concat(coalesce(base, [])[1:h], turns[h + 1:]) AS turns FROM cut),
prefix AS (SELECT conv_id, d, len(turns) AS size, turns[1:d] AS p, sha256(CAST(turns[1:d] AS VARCHAR)) AS key, sha256(CAST(turns[1:d - 1] AS VARCHAR)) AS up, turns FROM whole, unnest(range(len(turns) + 1)) AS x(d)),
node AS (SELECT d, key, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(max(length(p[d].t)), 0) AS last, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256 FROM prefix GROUP BY d, key),
child AS (SELECT d - 1 AS d, up AS key, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
below AS (SELECT p.d, p.key, sum((n.n_convs - 1) * n.last) AS saved, count(*) FILTER (c.key IS NULL) AS leaves
  FROM node n JOIN prefix p ON p.conv_id = n.conv_id AND p.d <= n.d LEFT JOIN child c ON c.d = n.d AND c.key = n.key GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, b.leaves AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node n JOIN below b ON b.d = n.d AND b.key = n.key LEFT JOIN child c ON c.d = n.d AND c.key = n.key LEFT JOIN node u ON n.d > 0 AND u.d = n.d - 1 AND u.key = n.up"""
SPELLING_VARIANTS = rf"""
WITH RECURSIVE {_CRC},
every AS (SELECT d, run, count(*) AS n FROM (SELECT doc_id AS d, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL),
named AS (SELECT *, coalesce(CAST(d AS VARCHAR), '') || ':' || run AS s FROM every),
hashed AS (SELECT run, n, {_crc("s")} AS h FROM named, crc),
slip AS (SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slip WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
hole AS (SELECT word, n, k, word[:k] || word[k + 2:] AS rest FROM w, unnest(range(length(word))) AS x(k)),
pair AS (SELECT a.word AS a, b.word AS b FROM hole a JOIN hole b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word FROM hole a JOIN w b ON a.rest = b.word UNION SELECT b.word, a.word FROM hole a JOIN w b ON a.rest = b.word),
top AS (SELECT a AS word, count(*) AS n_near, first(b ORDER BY w.n DESC, b) AS best, max(w.n) AS best_n FROM pair JOIN w ON w.word = b GROUP BY a),
found AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form, CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n FROM w LEFT JOIN top USING (word)),
up AS (SELECT word, form AS root FROM found WHERE form IS NOT NULL UNION SELECT up.word, f.form FROM up JOIN found f ON f.word = up.root WHERE f.form IS NOT NULL),
last AS (SELECT up.word, up.root FROM up JOIN found f ON f.word = up.root WHERE f.form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM found LEFT JOIN last USING (word)"""
ORACLES: dict[str, str] = {"op2_quality_rules": QUALITY_RULES, "op3_url_filters": URL_FILTERS, "op8_near_dedup": NEAR_DUPLICATES, "op12_prefix_trie": PREFIX_TRIE, "op13_spelling_variants": SPELLING_VARIANTS}
