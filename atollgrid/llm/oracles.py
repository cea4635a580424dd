"""DuckDB SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations

from .common import LOWER, UPPER
from .decontamination import SLOP, WINDOW_WORDS
from .quality import MAX_HOST_RATE, ROUNDING, TAIL

_SPACE = r"[\x20\x09-\x0D]+"
_WORDS = rf"list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '')"

OP3 = rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
l AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
d AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n > 1),
r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM d) GROUP BY rid),
m AS (
  SELECT t.rid, doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM t JOIN l ON t.rid = l.rid LEFT JOIN r ON t.rid = r.rid),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(CASE WHEN base_failed THEN 1 ELSE 0 END) AS f FROM b GROUP BY source),
p AS (SELECT avg(f / n) AS m, var_pop(f / n) AS v FROM h),
k AS (SELECT m, CASE WHEN v > 0 THEN least(1e3, greatest(1e0, m * (1 - m) / v - 1)) ELSE 1e3 END AS k FROM p),
x AS (SELECT source, (f + m * k) / (n + k) AS rate, least({MAX_HOST_RATE!r}, m + {TAIL!r} * sqrt(m * (1 - m) / (k + 1))) + {ROUNDING!r} AS most FROM h, k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rate <= most AS kept, round(rate, 9) AS host_rate
FROM b JOIN x ON b.source IS NOT DISTINCT FROM x.source
"""

_LOWERED = rf"list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP10 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_LOWERED} AS w FROM documents),
i AS (SELECT item_id, w, least(len(w), {WINDOW_WORDS}) AS n FROM (SELECT item_id, {_LOWERED} AS w FROM benchmark) WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS p FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM i)),
s AS (SELECT DISTINCT n FROM p),
g AS (SELECT rid, q, n, array_to_string(list_slice(w, q, q + n - 1), ' ') AS p FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS q FROM d, s WHERE len(w) >= n)),
o AS (SELECT rid, q, g.n, item_id FROM g JOIN p ON g.p = p.p AND g.n = p.n),
h AS (SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(range(q, q + n)) AS x FROM (SELECT DISTINCT rid, q, n FROM o)) GROUP BY rid),
k AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM o WHERE item_id IS NOT NULL) GROUP BY rid),
u AS (SELECT rid, unnest(w) AS term, unnest(range(0, len(w))) AS pos FROM d),
f AS (SELECT term, count(*) AS freq FROM u GROUP BY term),
t AS (SELECT p, unnest(string_split(p, ' ')) AS term, unnest(range(0, n)) AS off FROM (SELECT DISTINCT p, n FROM p)),
r AS (SELECT t.*, freq, row_number() OVER (PARTITION BY p ORDER BY freq ASC NULLS FIRST, t.term, off) AS r FROM t LEFT JOIN f ON t.term = f.term),
y AS (
  SELECT a.p, a.term AS term1, a.off AS off1, b.term AS term2, b.off - a.off AS gap FROM r a LEFT JOIN r b ON a.p = b.p AND b.r = 2
  WHERE a.r = 1 AND a.freq IS NOT NULL AND (b.p IS NULL OR b.freq IS NOT NULL)),
c AS (
  SELECT a.rid, y.p, a.pos - off1 AS start FROM y JOIN u a ON a.term = term1, unnest(range(-{SLOP}, {SLOP} + 1)) t(slip)
  JOIN u b ON b.rid = a.rid AND b.term = term2 AND b.pos = a.pos + gap + slip WHERE b.pos <> a.pos),
x AS (SELECT DISTINCT g.rid, g.p FROM g JOIN p ON g.p = p.p AND g.n = p.n),
z AS (SELECT c.rid, c.p, min(start) AS start FROM c LEFT JOIN x ON c.rid = x.rid AND c.p = x.p WHERE x.rid IS NULL GROUP BY c.rid, c.p),
e AS (SELECT rid, count(*) AS n_near, string_agg(CAST(start AS VARCHAR), ',' ORDER BY start) AS near FROM z GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, coalesce(near, '') AS near
FROM d LEFT JOIN h ON d.rid = h.rid LEFT JOIN k ON d.rid = k.rid LEFT JOIN e ON d.rid = e.rid
"""

ORACLE = {"op3_quality_rules": OP3, "op10_decontamination": OP10}
