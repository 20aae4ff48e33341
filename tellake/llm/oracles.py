"""DuckDB SQL for the results of the training-data queries that SQL can express.  One SQL text a query, on the given tables."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(column: str) -> str:
    """A-Z to a-z, other characters unchanged."""
    return f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def crc32(column: str) -> str:
    """crc32 of a column as text, bit by bit."""
    bits = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    chars = f"list_transform(string_split(cast({column} AS VARCHAR), ''), lambda s: cast(ascii(s) AS BIGINT))"
    # a byte is one digit or a sign here; the first element starts the sum
    return f"xor(list_reduce(list_concat([cast(4294967295 AS BIGINT)], {chars}), lambda c, b: {bits}), cast(4294967295 AS BIGINT))"


MIXING_BASE = rf"""
WITH d AS (SELECT doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
w AS (SELECT source, source_size, k, 1.0 + k % 3 AS w, 3.0 * source_size AS cap, 3.0 * source_size / (1.0 + k % 3) AS level FROM s),
x AS (SELECT a.k, a.level, (sum(b.source_size) - coalesce(sum(b.cap) FILTER (b.level < a.level OR (b.level = a.level AND b.k < a.k)), 0))
             / (sum(b.w) - coalesce(sum(b.w) FILTER (b.level < a.level OR (b.level = a.level AND b.k < a.k)), 0)) AS x FROM w a, w b GROUP BY a.k, a.level),
y AS (SELECT min_by(x, level) AS x FROM x WHERE x <= level)
SELECT doc_id, size, cast(source_size AS BIGINT) AS source_size, cast(round(least(cap, coalesce(y.x * w, cap))) AS BIGINT) AS target
FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source CROSS JOIN y
"""

QUALITY_BASE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS p, words FROM d WHERE len(words) >= 3),
tri AS (SELECT doc_id, p, array_to_string(list_slice(words, p, p + 2), ' ') AS t FROM w),
often AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, t) AS n FROM tri),
cover AS (SELECT doc_id, count(DISTINCT q) AS n_repeat FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM often WHERE n > 1) GROUP BY doc_id),
b AS (
  SELECT d.doc_id, cast(len(words) AS BIGINT) AS n_words, cast(len(array_to_string(words, '')) AS BIGINT) AS word_chars,
         cast(len(text) - len(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         cast(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}'))) - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')))) AS BIGINT) AS n_dup_lines,
         cast(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN cover USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b
"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({lower("text")}, '{WORD}') AS words FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i FROM d WHERE len(words) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 3), ' ') AS g FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS node, a AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen),
low AS (SELECT node, min(seen) AS low FROM r GROUP BY node)
SELECT d.doc_id, cast(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.node = d.doc_id
"""

CONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({lower("text")}, '{TERM}') AS words FROM documents),
b AS (SELECT cast(item_id AS VARCHAR) AS item, regexp_extract_all({lower("text")}, '{TERM}') AS words FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT item, least(len(words), 10) AS size, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0),
q AS (SELECT DISTINCT item, size, array_to_string(list_slice(words, i, i + size - 1), ' ') AS g FROM bw),
dw AS (SELECT doc_id, size, words, unnest(range(1, len(words) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM q) WHERE len(words) >= size),
h AS (SELECT doc_id, item, i, dw.size FROM dw JOIN q ON q.size = dw.size AND q.g = array_to_string(list_slice(words, i, i + dw.size - 1), ' ')),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, cast(len(words) AS BIGINT) AS n_words, cast(coalesce(n_hit, 0) AS BIGINT) AS n_hit, cast(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

LANGUAGE_MODEL_BASE = rf"""
WITH d AS (SELECT doc_id, {crc32("doc_id")} % 10 = 0 AS held_out, list_append(regexp_extract_all({lower("text")}, '{WORD}'), '') AS words FROM documents),
t AS (SELECT doc_id, held_out, unnest(words) AS w FROM d),
c AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY w),
n AS (SELECT sum(c) AS n, count(*) AS v FROM c)
SELECT doc_id, any_value(held_out) AS held_out, cast(count(*) AS BIGINT) AS n_tokens, cast(count(c.c) AS BIGINT) AS n_known, cast(any_value(n.n) AS BIGINT) AS train_tokens,
       round(sum(log10((coalesce(c.c, 0) + 0.1) / (n.n + 0.1 * (n.v + 1)))), 4) AS base_score
FROM t LEFT JOIN c USING (w) CROSS JOIN n GROUP BY doc_id
"""

SUBSTRINGS = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(words) - 18)) AS i, unnest(list_transform(range(1, len(words) - 18), lambda j: array_to_string(list_slice(words, j, j + 19), ' '))) AS x FROM d WHERE len(words) >= 20),
g AS (SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS k FROM w),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM g WHERE k > 1),
every AS (SELECT doc_id, unnest(words) AS x, unnest(range(1, len(words) + 1)) AS p FROM d),
kept AS (SELECT e.doc_id, count(gone.p) AS n_removed, string_agg(x, ' ' ORDER BY e.p) FILTER (gone.p IS NULL) AS text
         FROM every e LEFT JOIN gone ON gone.doc_id = e.doc_id AND gone.p = e.p GROUP BY e.doc_id)
SELECT d.doc_id, cast(len(words) AS BIGINT) AS n_words, cast(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

PREFIX_TRIE = rf"""
WITH o AS (SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, own, {crc32("conv_id")} % 4 AS h FROM o),
r AS (SELECT a.conv_id, list_concat(coalesce(list_slice(b.own, 1, a.h), []), list_slice(a.own, a.h + 1, len(a.own))) AS s FROM h a LEFT JOIN o b ON b.conv_id = a.conv_id - a.conv_id % 20),
p AS (SELECT conv_id, list_slice(s, 1, d) AS key, d, d = len(s) AS ends FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM r)),
n AS (SELECT key, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(cast(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ends,
             coalesce(len(regexp_extract_all(key[d].text, '{WORD}')), 0) AS words FROM p GROUP BY key, d),
c AS (SELECT list_slice(key, 1, d - 1) AS key, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c ON c.key = n.key),
u AS (SELECT list_slice(key, 1, k) AS key, sum(cast(n_children = 0 AS BIGINT)) AS n_leaves, sum((n_convs - 1) * words) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM m) GROUP BY 1)
SELECT m.conv_id, m.d AS depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, cast(n_leaves AS BIGINT) AS n_leaves, cast(saved AS BIGINT) AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN u ON u.key = m.key LEFT JOIN n q ON m.d > 0 AND q.key = list_slice(m.key, 1, m.d - 1)
"""
