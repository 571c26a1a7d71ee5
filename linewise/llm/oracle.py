"""DuckDB SQL of the queries that have an SQL form."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

_OP10 = rf"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')) AS key
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight
  FROM per),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed),
targets AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, (max(level) OVER ()) * weight) AS target FROM levels),
queued AS (
  SELECT s.*, t.source_size, t.target,
         (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key))::BIGINT AS through
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT doc_id, key, size, target, (k * source_size + through) / target AS finish
  FROM queued, (VALUES (0), (1)) AS passes(k) WHERE target > 0 AND size > 0),
ordered AS (
  SELECT *, sum(size) OVER (ORDER BY finish, key) AS total FROM copies WHERE finish - size / target < 1),
taken AS (
  SELECT key, sum(size)::BIGINT // count(DISTINCT doc_id) AS taken FROM ordered
  WHERE total <= 1.5 * (SELECT sum(size) FROM sizes) GROUP BY key)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM queued q LEFT JOIN taken t ON q.key = t.key
"""

# Terms in code points; only A-Z is lower-cased.
_TERMS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{{80}}-\x{{10FFFF}}]+')"

_OP12 = f"""
WITH words AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format("coalesce(text, '')")} AS ts FROM documents),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM words WHERE len(ts) > 0),
items AS (SELECT row_number() OVER () AS i, item_id, {_TERMS.format("coalesce(text, '')")} AS ts
          FROM (SELECT DISTINCT item_id, text FROM benchmark) d),
wanted AS (SELECT i, t, count(*)::BIGINT AS q FROM (SELECT i, unnest(ts) AS t FROM items) u GROUP BY i, t),
tfs AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS t FROM words) u
        WHERE t IN (SELECT t FROM wanted) GROUP BY r, t),
weights AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
            FROM (SELECT t, count(*)::BIGINT AS df FROM tfs GROUP BY t) d, corpus),
norms AS (SELECT r, doc_id, (100 - 75 + (75 * len(ts)::BIGINT * n_docs) // n_terms)::BIGINT AS m
          FROM words, corpus WHERE len(ts) > 0),
scores AS (
  SELECT q.i, n.r, n.doc_id, sum(q.q * w.w * ((1000000000 * f.tf) // (1000 * f.tf + 8 * n.m)))::BIGINT AS score
  FROM wanted q JOIN weights w ON q.t = w.t JOIN tfs f ON f.t = q.t JOIN norms n ON n.r = f.r GROUP BY q.i, n.r, n.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT items.item_id, ranked.rank::INTEGER AS rank, ranked.doc_id, ranked.score
FROM ranked JOIN items ON ranked.i = items.i WHERE ranked.rank <= 10
"""

ORACLE: dict[str, str] = {
    "op10_fair_mix": _OP10,
    "op12_ranked_search": _OP12,
}
