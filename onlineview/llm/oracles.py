"""DuckDB SQL of the queries of this subpackage that SQL can express.

Not here: sharding and packing (crc32 and tokenizers are not SQL), and the queries that rest
on a learnt model or the guess-cost programme; tests hold those against brute force.
"""

from __future__ import annotations

from . import collocations, conversation_trie, decontaminate, line_dedup

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _join_sql(k: int, num: int, den: int) -> str:
    gram = " || ' ' || ".join(f"w[k + {j}]" for j in range(k))
    return rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT rid, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
                              ELSE [{gram} FOR k IN range(1, len(w) - {k} + 2)] END) AS sh FROM d),
n AS MATERIALIZED (SELECT rid, count(*) AS n FROM s GROUP BY rid),
c AS (SELECT a.rid AS x, b.rid AS y, count(*) AS i FROM s AS a JOIN s AS b ON a.sh = b.sh GROUP BY 1, 2),
l AS MATERIALIZED (
  SELECT x, y FROM c JOIN n AS nx ON nx.rid = x JOIN n AS ny ON ny.rid = y
  WHERE {den} * i >= {num} * (nx.n + ny.n - i)),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
m AS (SELECT r.x AS rid, min(e.doc_id) AS least FROM r JOIN d AS e ON e.rid = r.y GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.least, d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.rid = d.rid LEFT JOIN m ON m.rid = d.rid"""


_LINES_SQL = f"""
WITH p AS MATERIALIZED (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL),
tot AS (SELECT source, count(*) AS pages FROM p GROUP BY source),
l AS (SELECT DISTINCT source, text, unnest(string_split(text, chr(10))) AS line FROM p),
often AS (SELECT source, line, count(*) AS n FROM l WHERE line <> '' GROUP BY source, line),
bad AS (SELECT often.source, list(line) AS bad FROM often JOIN tot ON often.source IS NOT DISTINCT FROM tot.source
        WHERE n > {line_dedup.MAX_RATIO} * pages + {line_dedup.ERRORS} * sqrt({line_dedup.MAX_RATIO} * pages + 1) GROUP BY often.source)
SELECT d.doc_id, d.source,
       CASE WHEN bad IS NULL THEN text
            ELSE coalesce(array_to_string([x FOR x IN string_split(text, chr(10)) IF x = '' OR NOT list_contains(bad, x)], chr(10)), '') END AS text
FROM documents AS d LEFT JOIN bad ON d.source IS NOT DISTINCT FROM bad.source"""

_FOLDED = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
_W = decontaminate.WINDOW
_HITS_SQL = f"""
WITH i AS (SELECT item_id, {_FOLDED} AS w FROM benchmark),
win AS MATERIALIZED (
  SELECT DISTINCT item_id, least({_W}, len(w)) AS size,
         unnest([array_to_string(w[k : k + least({_W}, len(w)) - 1], ' ') FOR k IN range(1, len(w) - least({_W}, len(w)) + 2)]) AS s
  FROM i WHERE len(w) > 0),
d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_FOLDED} AS w FROM documents),
z AS (SELECT DISTINCT size FROM win),
g AS (SELECT rid, size, range(1, len(w) - size + 2) AS ks,
             [array_to_string(w[k : k + size - 1], ' ') FOR k IN range(1, len(w) - size + 2)] AS ss
      FROM d JOIN z ON len(w) >= size),
p AS (SELECT rid, size, unnest(ks) AS k, unnest(ss) AS s FROM g),
h AS MATERIALIZED (SELECT rid, k, p.size, item_id FROM p JOIN win ON p.size = win.size AND p.s = win.s),
hw AS (SELECT rid, count(DISTINCT place) AS n FROM (SELECT rid, unnest(range(k, k + size)) AS place FROM h) AS x GROUP BY rid),
hi AS (SELECT rid, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
       FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM h WHERE item_id IS NOT NULL) AS x GROUP BY rid)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hw.n, 0) AS n_hit, coalesce(hi.n, 0) AS n_items,
       sha256(coalesce(hi.ids, '')) AS items_sha256,
       coalesce(hw.n, 0) > 0 AND {decontaminate.ONE_IN} * coalesce(hw.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw ON hw.rid = d.rid LEFT JOIN hi ON hi.rid = d.rid"""

_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295], [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(c AS VARCHAR), '')]),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [CAST(0 AS BIGINT) FOR z IN range(8)]),
                             lambda p, q: CASE WHEN p % 2 = 1 THEN xor(p // 2, 3988292384) ELSE p // 2 END)))"""
# A node's path is the MD5s of its turns, 33 characters each with the comma.
_TRIE_SQL = f"""
WITH t AS MATERIALIZED (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS txt,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT c, count(*) AS n, c - c % {conversation_trie.POOL} AS base, {_CRC32} % {conversation_trie.HEADS} AS h FROM t GROUP BY c),
p AS MATERIALIZED (SELECT s.c, s.base, s.h, least(s.h, coalesce(b.n, 0)) AS head FROM s LEFT JOIN s AS b ON b.c = s.base),
r AS (SELECT p.c, t.i AS d, role, txt FROM p JOIN t ON t.c = p.base AND t.i <= p.h
      UNION ALL SELECT p.c, p.head + t.i - p.h, role, txt FROM p JOIN t ON t.c = p.c AND t.i > p.h),
m AS MATERIALIZED (
  SELECT c, d, length(txt) AS cp, string_agg(md5(strlen(role) || ':' || role || txt), ',') OVER (PARTITION BY c ORDER BY d) AS path FROM r
  UNION ALL SELECT c, 0, 0, '' FROM p),
e AS (SELECT c, max(d) AS last FROM m GROUP BY c),
n AS MATERIALIZED (
  SELECT path, d, max(cp) AS cp, count(*) AS n_convs, min(m.c) AS conv_id,
         string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c) FILTER (WHERE d = last) AS ends,
         CASE WHEN d > 0 THEN left(path, greatest(33 * (d - 1) - 1, 0)) END AS parent
  FROM m JOIN e ON e.c = m.c GROUP BY path, d),
k AS (SELECT parent, count(*) AS n FROM n WHERE parent IS NOT NULL GROUP BY parent),
u AS (SELECT unnest([left(n.path, greatest(33 * x - 1, 0)) FOR x IN range(0, d + 1)]) AS path, (n_convs - 1) * cp AS w,
             CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf FROM n LEFT JOIN k ON k.parent = n.path),
z AS (SELECT path, sum(w) AS w, sum(leaf) AS leaves FROM u GROUP BY path)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, o.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       CAST(z.leaves AS BIGINT) AS n_leaves, CAST(z.w AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM n JOIN z ON z.path = n.path LEFT JOIN k ON k.parent = n.path LEFT JOIN n AS o ON o.path = n.parent"""

_N = collocations.DEPTH
_PHRASES_SQL = rf"""
WITH p AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, '{collocations.UNKNOWN}') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents) AS x),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, k, unnest([array_to_string(w[i : i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS s
      FROM p, (SELECT unnest(range(1, {_N} + 1)) AS k) AS ks WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, s, count(*) AS a FROM g GROUP BY lang, k, s HAVING count(*) >= {collocations.MIN_COUNT}),
c AS MATERIALIZED (SELECT lang, k, s, a, string_split(s, ' ') AS w FROM f WHERE k > 1),
u AS (SELECT lang, s, k, a, w, unnest(range(1, k)) AS cut FROM c),
v AS (SELECT u.lang, u.s, u.a, cut, l.a AS l, r.a AS r, CAST(CAST(1000 AS HUGEINT) * u.a * t.n // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score, t.n
      FROM u JOIN t ON t.lang = u.lang JOIN f AS l ON l.lang = u.lang AND l.s = array_to_string(w[1 : cut], ' ')
      JOIN f AS r ON r.lang = u.lang AND r.s = array_to_string(w[cut + 1 :], ' ')),
b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, cut) = 1),
i AS (SELECT DISTINCT lang, a, unnest(flatten([[array_to_string(w[x : x + y - 1], ' ') FOR x IN range(1, k - y + 2)] FOR y IN range(2, k)])) AS s FROM c),
d AS (SELECT DISTINCT c.lang, c.s FROM c JOIN i ON i.lang = c.lang AND i.s = c.s WHERE i.a >= c.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s) AS rank, s AS phrase, a, l, r, n, score
FROM b WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.lang = b.lang AND d.s = b.s)
QUALIFY rank <= {collocations.TOP}"""

ORACLE = {
    "op8_ngram_jaccard_join": _join_sql(3, 90, 100),
    "op9_line_dedup": _LINES_SQL,
    "op10_benchmark_decontamination": _HITS_SQL,
    "op12_phrase_collocations": _PHRASES_SQL,
    "op13_conversation_trie": _TRIE_SQL,
}
