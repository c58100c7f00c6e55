"""The queries that SQL can express, in SQL."""

from __future__ import annotations

import re

from wordloom.llm.quality_rules import BOILERPLATE, ENDS

GAP = r"[\x20\x09-\x0D]+"

# The sentence ends in this engine's spelling of code points and scripts.
_ENDS = re.sub(r"\\u([0-9A-F]{4})", r"\\x{\1}", ENDS).replace("{Is", "{")
# A line's parts between separators: pairs of quotation marks go first, and middle dots between letters are no separators.
_MENU_PARTS = "line"
for _open, _close in ("«»", "»«", "‹›", "›‹"):
    _MENU_PARTS = f"regexp_replace({_MENU_PARTS}, '{_open}([^{_open}{_close}]*){_close}', '\\1', 'g')"
for _ in range(2):
    _MENU_PARTS = rf"regexp_replace({_MENU_PARTS}, '([\p{{L}}\p{{N}}])·([\p{{L}}\p{{N}}])', '\1.\2', 'g')"
_MENU_PARTS = f"string_split_regex({_MENU_PARTS}, '[|»›>·]')"
_SHORT = r"list_filter(parts, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]') AND length(trim(x)) <= 30)"

OP4 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '{GAP}'), lambda x: x <> '') AS ws FROM d),
p AS (SELECT doc_id, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM w),
q AS (SELECT doc_id, i, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w1, w2, w3) AS n FROM q WHERE w3 IS NOT NULL),
r AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM g WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
v AS (SELECT doc_id, line, length(line) AS n, regexp_matches(line, '[^\x20\x09-\x0D]') AS worded, {_MENU_PARTS} AS parts FROM l),
f AS (
  SELECT doc_id, line, n, worded,
    NOT worded OR NOT (
      14 * (n - length(regexp_replace(line, '[#*$%&|<>]', '', 'g'))) > n
      OR NOT regexp_matches(line, '{_ENDS}')
      OR regexp_matches(line, '!![^!]+!!')
      OR regexp_matches(line, '[|»›·>][^|»›·>]+[|»›·>]') AND len(parts) > 2 AND len({_SHORT}) > 1 AND 2 * list_sum(list_transform({_SHORT}, lambda x: length(x))) >= list_sum(list_transform(parts, lambda x: length(x)))
      OR regexp_matches(line, '{BOILERPLATE}') AND (n <= 100 OR 2 * length(regexp_replace(line, '{BOILERPLATE}', '', 'g')) <= n)
    ) AS ok
  FROM v),
s AS (SELECT doc_id, count(*) FILTER (worded) - count(DISTINCT line) FILTER (worded) AS n_dup_lines, sum(n) AS n, coalesce(sum(n) FILTER (ok), 0) AS n_ok FROM f GROUP BY doc_id),
a AS (
  SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '{GAP}', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n, n_ok
  FROM w JOIN s USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * n_ok >= 60 * n AS kept
FROM a
"""

_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP7 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
g AS (
  SELECT doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(ws) - 3, 1) + 1), lambda i: array_to_string(ws[i : i + 3], ' ')))) AS g
  FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS sig FROM g GROUP BY doc_id),
c AS (SELECT sig, min(doc_id) AS id, any_value(n) AS n FROM n GROUP BY sig),
m AS (SELECT id, n, g FROM c JOIN g ON g.doc_id = c.id),
e AS (
  SELECT x.id AS a, y.id AS b FROM m x JOIN m y ON x.g = y.g AND x.id < y.id AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
  GROUP BY x.id, y.id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
b AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT id, id AS to_id FROM c UNION SELECT r.id, b.b FROM r JOIN b ON b.a = r.to_id),
k AS (SELECT id, min(to_id) AS component_id FROM r GROUP BY id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(k.component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.sig = n.sig LEFT JOIN k ON k.id = c.id
"""

OP10 = rf"""
WITH i AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
ig AS (
  SELECT item_id, least(len(ws), 5) AS width,
    unnest(list_distinct(list_transform(range(1, greatest(len(ws) - 4, 1) + 1), lambda i: array_to_string(ws[i : i + 4], ' ')))) AS g
  FROM i WHERE len(ws) > 0),
q AS (SELECT item_id, count(*) AS n_item FROM ig GROUP BY item_id),
d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
k AS (SELECT DISTINCT width FROM ig),
dg AS (SELECT doc_id, width, unnest(list_distinct(list_transform(range(1, len(ws) - width + 2), lambda i: array_to_string(ws[i : i + width - 1], ' ')))) AS g FROM d, k WHERE len(ws) >= width),
s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM dg JOIN ig USING (width, g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM s JOIN q USING (item_id) WHERE 100 * n_shared >= 80 * n_item
"""

# crc32 by its byte table, which ``t`` holds as a list. Fixed value: the reflected polynomial.
_CRC_TABLE = r"""t AS MATERIALIZED (
  SELECT list(v ORDER BY n) AS tab FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS v FROM range(256) r(n)))"""


def _crc32(text: str) -> str:
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(tab[xor(c, b) % 256 + 1], c // 256)), 4294967295)"


OP12 = rf"""
WITH {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS id, * FROM (SELECT doc_id, 0 AS src, text FROM documents UNION ALL SELECT NULL, 1, text FROM benchmark)),
w AS MATERIALIZED (SELECT id, doc_id, src, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM d),
p AS (SELECT id, src, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM w),
l AS (SELECT id, src, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM p WINDOW o AS (PARTITION BY id ORDER BY i)),
f AS MATERIALIZED (SELECT id, src, w1 AS f FROM l UNION ALL SELECT id, src, w1 || ' ' || w2 FROM l WHERE w2 IS NOT NULL UNION ALL SELECT id, src, w1 || ' ' || w2 || ' ' || w3 FROM l WHERE w3 IS NOT NULL),
u AS (SELECT DISTINCT f FROM f),
b AS MATERIALIZED (SELECT f, {_crc32('f')} % 10000 AS bucket FROM u, t),
e AS MATERIALIZED (SELECT id, src, bucket FROM f JOIN b USING (f)),
n AS (SELECT bucket, count(*) FILTER (src = 0) AS s, count(*) FILTER (src = 1) AS t FROM e GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1.0::DOUBLE) * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM n),
x AS (SELECT id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM e JOIN g USING (bucket) WHERE src = 0 GROUP BY id),
y AS (
  SELECT id, doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(doc_id::VARCHAR, ''))[:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN x USING (id) WHERE src = 0),
r AS (SELECT id, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS rank, count(*) OVER () AS n FROM y WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank FROM y LEFT JOIN r USING (id)
"""

OP13 = rf"""
WITH {_CRC_TABLE},
x AS (
  SELECT conv_id, turn, role, text, length(text) AS chars, sha256(length(role) || ':' || role || text) AS mark
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
y AS (SELECT conv_id, turn, mark, {{'id': dense_rank() OVER (ORDER BY role, text), 'chars': chars}} AS t FROM x),
c AS MATERIALIZED (SELECT conv_id, list(t ORDER BY turn NULLS FIRST, mark) AS ts, {_crc32('conv_id::VARCHAR')} % 6 AS h FROM y, t GROUP BY conv_id, tab),
r AS (SELECT c.conv_id, list_concat(coalesce(b.ts, c.ts[1:0])[1:c.h], c.ts[c.h + 1:]) AS path FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100),
m AS (SELECT conv_id, path[1:d] AS p, d, d = len(path) AS ends FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM r)),
n AS MATERIALIZED (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY p, d),
k AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
a AS (
  SELECT p[1:up] AS p, up AS d, count(*) FILTER (n_children IS NULL) AS n_leaves, coalesce(sum(saved), 0)::BIGINT AS saved_tokens
  FROM (SELECT p, unnest(range(d + 1)) AS up, n_children, (n_convs - 1) * p[d].chars AS saved FROM n LEFT JOIN k USING (p, d)) GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM n JOIN a USING (p, d) LEFT JOIN k USING (p, d) LEFT JOIN n u ON u.d = n.d - 1 AND u.p = n.p[1:n.d - 1]
"""

ORACLES: dict[str, str] = {
    "op4_quality_rules": OP4,
    "op7_jaccard_join": OP7,
    "op10_decontam": OP10,
    "op12_importance": OP12,
    "op13_prefix_trie": OP13,
}
