"""Independent ANSI SQL (DuckDB dialect) for every catalogue query.

The SQL states each job the plain way a database user would: global windows,
UNNEST, UNPIVOT.  It is the correctness oracle, not the execution plan.
Integer sums are cast to BIGINT (DuckDB widens them to HUGEINT).
"""

from __future__ import annotations

_EVENT_GROUPS = """
WITH g AS (
  SELECT event_id,
         CASE WHEN event_type = 'signup' THEN CAST(0 AS BIGINT)
              ELSE CAST(round(value * 100) AS BIGINT) END AS cents,
         CAST(1 + SUM(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
              OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS group_id
  FROM events
), t AS (
  SELECT group_id, CAST(SUM(cents) AS BIGINT) AS total_cents, COUNT(*) AS n_rows
  FROM g GROUP BY group_id
)"""

_SCORED = """
WITH p AS (
  SELECT o_orderkey, o_orderstatus AS opponent, substr(o_orderpriority, 1, 1) AS mine FROM orders
), q AS (
  SELECT *, CASE opponent WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS opponent_points,
            CASE mine WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 3 END AS my_points
  FROM p
), s AS (
  SELECT *, CASE WHEN my_points = opponent_points THEN 3
                 WHEN (my_points - opponent_points + 3) % 3 = 1 THEN 6
                 WHEN my_points IS NOT NULL AND opponent_points IS NOT NULL THEN 0 END AS match_points
  FROM q
)"""

# The required move stated arithmetically (win: beat theirs, lose: lose to theirs).
_DEPENDENT = """
WITH q AS (
  SELECT o_orderkey,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS opponent_points,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 3 END AS my_points
  FROM orders
), r AS (
  SELECT *, CASE my_points WHEN 1 THEN 'lose' WHEN 2 THEN 'draw' WHEN 3 THEN 'win' END AS needed_result
  FROM q
), m AS (
  SELECT o_orderkey, needed_result,
         CASE needed_result WHEN 'lose' THEN 0 WHEN 'draw' THEN 3 WHEN 'win' THEN 6 END AS new_points,
         my_points - opponent_points AS point_dif,
         CASE needed_result WHEN 'draw' THEN opponent_points
                            WHEN 'win' THEN opponent_points % 3 + 1
                            WHEN 'lose' THEN (opponent_points + 1) % 3 + 1
                            ELSE 0 END AS new_play
  FROM r
)
SELECT o_orderkey, needed_result, new_points, point_dif, new_play, new_play + new_points AS new_total_points
FROM m"""

_HALVES = """
WITH h AS (
  SELECT doc_id, lang, text, CAST(length(text) // 2 AS INTEGER) AS half FROM documents
), s AS (
  SELECT doc_id, lang, substr(text, 1, half) AS a, substr(text, half + 1) AS b FROM h
)"""

_HALF_COMMON = _HALVES + """
, c AS (
  SELECT doc_id, lang,
         list_sort(list_filter(list_distinct(list_intersect(string_split(a, ''), string_split(b, ''))),
                               lambda x: regexp_full_match(x, '[A-Za-z]'))) AS common
  FROM s
)"""

_BATCH_COMMON = """
WITH b AS (
  SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // 3 + 1 AS batch_id FROM documents
), sz AS (
  SELECT batch_id, COUNT(*) AS n_docs FROM b GROUP BY batch_id
), e AS (
  SELECT DISTINCT batch_id, doc_id, unnest(string_split(text, '')) AS ch FROM b
), ce AS (
  SELECT e.batch_id, e.ch FROM e JOIN sz ON e.batch_id = sz.batch_id
  GROUP BY e.batch_id, e.ch, sz.n_docs HAVING COUNT(*) = sz.n_docs
)
SELECT sz.batch_id, sz.n_docs, CAST(COUNT(ce.ch) AS INTEGER) AS n_common,
       COALESCE(string_agg(ce.ch, '' ORDER BY ce.ch), '') AS common_chars
FROM sz LEFT JOIN ce ON sz.batch_id = ce.batch_id
GROUP BY sz.batch_id, sz.n_docs"""

_INTERVALS = """
WITH v AS (
  SELECT l_orderkey, l_linenumber,
         CAST(l_quantity AS INTEGER) AS a, CAST(round(l_discount * 100) AS INTEGER) * 5 AS b,
         l_linenumber * 7 AS c, CAST(round(l_tax * 100) AS INTEGER) * 6 AS d
  FROM lineitem
), n AS (
  SELECT l_orderkey, l_linenumber, least(a, b) AS val1, greatest(a, b) AS val2,
         least(c, d) AS val3, greatest(c, d) AS val4
  FROM v
), w AS (
  SELECT *, CAST(val1 AS VARCHAR) || '-' || CAST(val2 AS VARCHAR) || ',' ||
            CAST(val3 AS VARCHAR) || '-' || CAST(val4 AS VARCHAR) AS pair,
         CASE WHEN (val1 <= val3 AND val2 >= val4) OR (val3 <= val1 AND val4 >= val2) THEN 1 ELSE 0 END AS contained
  FROM n
)"""

_OVERLAP_COUNTS = """
SELECT CASE WHEN val3 > val2 OR val4 < val1 THEN 'disjoint' ELSE 'overlap' END AS label,
       COUNT(*) AS n_pairs, CAST(SUM(contained) AS BIGINT) AS n_contained
FROM w GROUP BY 1"""

_UNITS = """
WITH u AS (
  SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS quantity,
         NULLIF(CAST(round(l_discount * 100) AS BIGINT), 0) AS discount,
         CAST(round(l_tax * 100) AS BIGINT) AS tax
  FROM lineitem
)"""

_DOC_RECORDS = """
WITH r AS (
  SELECT CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines,
         CAST(length(replace(text, chr(10), '')) AS BIGINT) AS n_chars
  FROM documents
)"""

ORACLE: dict[str, str] = {
    "q01_boundary_group_totals": _EVENT_GROUPS + """
SELECT group_id, total_cents, n_rows FROM t""",
    "q02_top_groups": _EVENT_GROUPS + """
SELECT group_id, total_cents, n_rows FROM t ORDER BY total_cents DESC, group_id LIMIT 3""",
    "q03_top_groups_total": _EVENT_GROUPS + """
SELECT CAST(SUM(total_cents) AS BIGINT) AS top3_total_cents
FROM (SELECT total_cents FROM t ORDER BY total_cents DESC, group_id LIMIT 3) s""",
    "q04_code_pair_score": _SCORED + """
SELECT o_orderkey, opponent, mine, opponent_points, my_points, match_points,
       match_points + my_points AS total_points
FROM s""",
    "q05_score_total": _SCORED + """
SELECT CAST(SUM(match_points + my_points) AS BIGINT) AS score_total FROM s""",
    "q06_dependent_rule": _DEPENDENT,
    "q07_udf_rule": _DEPENDENT,
    "q08_recode_default": """
SELECT CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'auto' WHEN 'BUILDING' THEN 'building'
            WHEN 'MACHINERY' THEN 'machinery' ELSE 'Unknown' END AS segment_label,
       COUNT(*) AS n_customers
FROM customer GROUP BY 1""",
    "q09_half_common": _HALF_COMMON + """
SELECT doc_id, CAST(len(common) AS INTEGER) AS n_common, common[1] AS first_common FROM c""",
    "q10_half_weight": _HALF_COMMON + """
, w AS (
  SELECT lang, common[1] AS f FROM c
)
SELECT lang,
       CAST(SUM(CASE WHEN f BETWEEN 'a' AND 'z' THEN ascii(f) - ascii('a') + 1
                     WHEN f BETWEEN 'A' AND 'Z' THEN ascii(f) - ascii('A') + 27 END) AS BIGINT) AS total_weight,
       COUNT(*) AS n_docs, COUNT(f) AS n_weighted
FROM w GROUP BY lang""",
    "q11_except_twice": _HALVES + """
SELECT doc_id,
       CAST(len(list_distinct(list_intersect(string_split(a, ''), string_split(b, '')))) AS INTEGER) AS n_common,
       COALESCE(array_to_string(list_sort(list_distinct(list_intersect(string_split(a, ''), string_split(b, '')))), ''), '')
         AS common_chars
FROM s""",
    "q12_batch_common": _BATCH_COMMON,
    "q12b_batch_common_count": _BATCH_COMMON,
    "q13_interval_containment": _INTERVALS + """
SELECT l_orderkey, l_linenumber, pair, val1, val2, val3, val4, contained FROM w""",
    "q14_overlap_label_counts": _INTERVALS + _OVERLAP_COUNTS,
    "q14b_udf_overlap_label_counts": _INTERVALS + _OVERLAP_COUNTS,
    "q15_user_type_spans": """
WITH s AS (
  SELECT user_id,
         MIN(CASE WHEN event_type = 'view' THEN event_id END) AS a_lo,
         MAX(CASE WHEN event_type = 'view' THEN event_id END) AS a_hi,
         MIN(CASE WHEN event_type = 'purchase' THEN event_id END) AS b_lo,
         MAX(CASE WHEN event_type = 'purchase' THEN event_id END) AS b_hi
  FROM events GROUP BY user_id
)
SELECT user_id, a_lo, a_hi, b_lo, b_hi,
       CASE WHEN b_lo <= a_hi AND a_lo <= b_hi THEN 1 ELSE 0 END AS is_overlap,
       CASE WHEN (a_lo <= b_lo AND a_hi >= b_hi) OR (b_lo <= a_lo AND b_hi >= a_hi) THEN 1 ELSE 0 END AS is_contained
FROM s WHERE a_lo IS NOT NULL AND b_lo IS NOT NULL""",
    "q16_unpivot_totals": _UNITS + """
SELECT metric, CAST(SUM(value) AS BIGINT) AS total, COUNT(*) AS n_rows, COUNT(value) AS n_values
FROM u UNPIVOT INCLUDE NULLS (value FOR metric IN (quantity, discount, tax)) l
GROUP BY metric""",
    "q17_fixed_width": """
WITH l AS (
  SELECT l_orderkey, '[' || l_returnflag || '] [' || l_linestatus || '] [' || CAST(l_linenumber AS VARCHAR) || ']' AS layout
  FROM lineitem
)
SELECT l_orderkey, layout,
       CASE WHEN length(layout) > 1 THEN substr(layout, 2, 1) END AS list1,
       CASE WHEN length(layout) > 5 THEN substr(layout, 6, 1) END AS list5,
       CASE WHEN length(layout) > 9 THEN substr(layout, 10, 1) END AS list9,
       CASE WHEN length(layout) > 13 THEN substr(layout, 14, 1) END AS list13
FROM l""",
    "q18_prefix_rename": """
SELECT n_nationkey AS nat_n_nationkey, n_name AS nat_name FROM nation""",
    "q19_text_scan_lines": """
SELECT lang, COUNT(*) AS n_lines, CAST(SUM(length(line)) AS BIGINT) AS n_chars,
       COUNT(CASE WHEN line = '' THEN 1 END) AS n_blank
FROM (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents) t
GROUP BY lang""",
    "q20_row_number_batches": """
WITH b AS (
  SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 7 + 1 AS batch_id FROM events
)
SELECT batch_id, COUNT(*) AS n_rows, MIN(event_id) AS first_event_id, MAX(event_id) AS last_event_id
FROM b GROUP BY batch_id""",
    "q21_filters": """
SELECT COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE value IS NULL) AS n_null_value,
       COUNT(*) FILTER (WHERE value IS NOT NULL) AS n_value,
       COUNT(*) FILTER (WHERE event_type = 'signup') AS n_signup,
       COUNT(*) FILTER (WHERE value >= 10 AND value < 20) AS n_value_10_20,
       COUNT(*) FILTER (WHERE event_type = 'click' AND value > 100) AS n_click_over_100
FROM events""",
    "q21b_pushed_filter": """
SELECT user_id, COUNT(*) AS n_big_purchases, CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS big_purchase_cents
FROM events WHERE event_type = 'purchase' AND value >= 100 GROUP BY user_id""",
    "q22_unpivot_top_key": _UNITS + """
SELECT l_orderkey AS order_key, CAST(SUM(value) AS BIGINT) AS total_units
FROM u UNPIVOT INCLUDE NULLS (value FOR metric IN (quantity, discount, tax)) l
GROUP BY l_orderkey ORDER BY total_units DESC, order_key LIMIT 1""",
    "q23_text_record_groups": _DOC_RECORDS + """
SELECT n_lines, n_chars FROM r""",
    "q24_text_records_linesep": _DOC_RECORDS + """
SELECT n_lines, n_chars FROM r""",
    "q25_text_record_top3": _DOC_RECORDS + """
SELECT MAX(n_chars) AS largest_chars, CAST(SUM(n_chars) AS BIGINT) AS top3_chars
FROM (SELECT n_chars FROM r ORDER BY n_chars DESC LIMIT 3) t""",
    "q26_recode_join": """
SELECT COALESCE(n.n_name, 'Unknown') AS nation_name, COUNT(*) AS n_customers
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1""",
    "q27_stream_score_totals": _SCORED + """
SELECT opponent_points, my_points, COUNT(*) AS n_orders, CAST(SUM(match_points + my_points) AS BIGINT) AS total_points
FROM s GROUP BY opponent_points, my_points""",
    "q28_layout_header": """
WITH h AS (
  SELECT row_number() OVER (ORDER BY o_orderkey) AS line_no,
         '[' || o_orderstatus || '] [' || substr(o_orderpriority, 1, 1) || '] ' || substr(o_orderpriority, 3, 4) AS value
  FROM orders ORDER BY o_orderkey LIMIT 9
)
SELECT line_no, value,
       CASE WHEN length(value) > 1 THEN substr(value, 2, 1) END AS list1,
       CASE WHEN length(value) > 5 THEN substr(value, 6, 1) END AS list5,
       CASE WHEN length(value) > 9 THEN substr(value, 10, 1) END AS list9
FROM h""",
    "q29_stream_overlap_label_counts": _INTERVALS + _OVERLAP_COUNTS,
}

ORACLE["q30_event_group_ids"] = """
SELECT event_id, (1 + sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
    OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS group_id
FROM events
"""

ORACLE["q31_partitioned_sums"] = """
SELECT event_id, kind,
       (sum(v) OVER (PARTITION BY kind ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS running,
       row_number() OVER (PARTITION BY kind ORDER BY event_id) AS rn
FROM (SELECT event_id, nullif(event_type, 'view') AS kind,
             CASE WHEN event_id % 3 <> 0 THEN event_id % 100 END AS v FROM events)
"""

# The wanted result (1 lose, 2 draw, 3 win) and the move that gives it, as in _DEPENDENT.
ORACLE["q32_text_code_pairs"] = _SCORED + """
SELECT opponent_points AS theirs, my_points AS mine, COUNT(*) AS n_lines,
       CAST(SUM(match_points + my_points) AS BIGINT) AS total_points,
       CAST(SUM(CASE my_points WHEN 1 THEN (opponent_points + 1) % 3 + 1
                               WHEN 2 THEN 3 + opponent_points
                               WHEN 3 THEN 6 + opponent_points % 3 + 1 END) AS BIGINT) AS new_total_points
FROM s GROUP BY opponent_points, my_points"""

ORACLE["q33_text_letter_batches"] = """
WITH l AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS n,
         regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g') AS line FROM documents
), e AS (
  SELECT DISTINCT n, (n - 1) // 3 + 1 AS batch_id, unnest(string_split(line, '')) AS ch FROM l
), sz AS (
  SELECT (n - 1) // 3 + 1 AS batch_id, COUNT(*) AS rows_in FROM l GROUP BY 1
), c AS (
  SELECT e.batch_id, e.ch FROM e JOIN sz ON e.batch_id = sz.batch_id
  WHERE e.ch <> '' GROUP BY e.batch_id, e.ch, sz.rows_in HAVING COUNT(*) = sz.rows_in
), f AS (
  SELECT batch_id, MIN(ch) AS f FROM c GROUP BY batch_id
)
SELECT CAST(SUM(CASE WHEN f BETWEEN 'a' AND 'z' THEN ascii(f) - ascii('a') + 1
                     WHEN f BETWEEN 'A' AND 'Z' THEN ascii(f) - ascii('A') + 27 END) AS BIGINT) AS total_weight
FROM f"""

ORACLE["q34_text_interval_pairs"] = _INTERVALS + _OVERLAP_COUNTS

ORACLE["q35_text_line_numbers"] = """
SELECT n AS line_no, (n - 1) // 3 + 1 AS batch_id, CAST(o_orderkey AS VARCHAR) AS value
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) t"""

ORACLE["q36_error_reach"] = """
WITH numbered AS (
  SELECT event_id, 1 + sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (ORDER BY event_id) AS group_id FROM events
), spans AS (
  SELECT group_id::BIGINT AS group_id, min(event_id) AS first_id, max(event_id) AS last_id FROM numbered GROUP BY group_id
), errors AS (
  SELECT event_id, (event_id + floor(coalesce(value, 0)))::BIGINT AS reach FROM events WHERE event_type = 'error'
)
SELECT event_id, group_id, (event_id <= first_id AND last_id <= reach)::INTEGER AS is_inside
FROM errors JOIN spans ON event_id <= last_id AND first_id <= reach"""

ORACLE["q37_close_orders"] = """
SELECT a.o_custkey, a.o_orderkey, b.o_orderkey AS right_o_orderkey
FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey
 AND abs(date_diff('day', a.o_orderdate::DATE, b.o_orderdate::DATE)) <= 30"""

ORACLE["q38_orders_at_hand"] = """
WITH days AS (SELECT o_orderdate::DATE AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT o_orderkey, (SELECT sum(n) FROM days WHERE day BETWEEN o_orderdate::DATE - 3 AND o_orderdate::DATE + 3)::BIGINT AS n_at_hand
FROM orders"""

ORACLE["q39_view_before_purchase"] = """
WITH pairs AS (
  SELECT p.event_id, p.user_id, v.event_id AS view_id, v.value, p.ts - v.ts <= INTERVAL 1 DAY AS near,
         row_number() OVER (PARTITION BY p.event_id ORDER BY v.ts DESC NULLS LAST, v.event_id DESC NULLS LAST) AS r
  FROM events p LEFT JOIN events v ON v.event_type = 'view' AND v.user_id = p.user_id AND v.ts <= p.ts
  WHERE p.event_type = 'purchase')
SELECT event_id, user_id, CASE WHEN near THEN view_id END AS view_id,
       CASE WHEN near THEN round(value * 100)::BIGINT END AS view_cents
FROM pairs WHERE r = 1"""

ORACLE["q40_error_after_signup"] = """
WITH e AS (
  SELECT event_id, event_type,
         min(CASE WHEN event_type = 'error' THEN event_id END) OVER (ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS error_id
  FROM events)
SELECT e.event_id, e.error_id, f.user_id AS error_user FROM e LEFT JOIN events f ON f.event_id = e.error_id
WHERE e.event_type = 'signup'"""

ORACLE["q41_value_ranks"] = """
SELECT event_id, event_type, rank() OVER w AS value_rank, dense_rank() OVER w AS value_dense_rank, cume_dist() OVER w AS value_share
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY value DESC NULLS LAST)"""

ORACLE["q41b_quantity_ranks"] = """
SELECT l_orderkey, quantity, rank() OVER w AS quantity_rank, dense_rank() OVER w AS quantity_dense_rank, percent_rank() OVER w AS quantity_share
FROM (SELECT l_orderkey, l_quantity::INTEGER AS quantity FROM lineitem) l WINDOW w AS (ORDER BY quantity NULLS FIRST)"""

ORACLE["q42_price_tiles"] = """
SELECT o_orderkey, ntile(100) OVER (ORDER BY o_totalprice NULLS FIRST, o_orderkey NULLS FIRST) AS tile FROM orders"""

ORACLE["q43_user_neighbours"] = """
SELECT event_id, user_id, lag(event_id) OVER w AS previous_id, lead(event_type, 2) OVER w AS later_type,
       first_value(event_type) OVER w AS first_type,
       last_value(event_type) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)"""

ORACLE["q44_moving_cents"] = """
SELECT event_id, (sum(cents) OVER seven)::BIGINT AS cents_7, max(cents) OVER seven AS most_7,
       (sum(is_error) OVER (ORDER BY event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))::BIGINT AS errors_near
FROM (SELECT event_id, round(value * 100)::BIGINT AS cents, (event_type = 'error')::INTEGER AS is_error FROM events) e
WINDOW seven AS (ORDER BY event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

ORACLE["q45_week_of_orders"] = """
SELECT o_orderkey, count(*) OVER w AS n_week, (sum(round(o_totalprice * 100)::BIGINT) OVER w)::BIGINT AS cents_week
FROM (SELECT *, o_orderdate::DATE AS day FROM orders) o
WINDOW w AS (PARTITION BY o_orderpriority ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)"""

ORACLE["q46_event_cube"] = """
SELECT event_type, day, grouping_id(event_type, day)::INTEGER AS grouping_id, count(*) AS n_rows,
       count(DISTINCT user_id) AS n_users, sum(cents)::BIGINT AS total_cents
FROM (SELECT event_type, ts::DATE::VARCHAR AS day, user_id, round(value * 100)::BIGINT AS cents FROM events) e
GROUP BY CUBE (event_type, day)"""

# The priority of a row: the first 13 hexadecimal digits of the hash of seed and key, as a number in (0, 1).
_PRIORITY = "(('0x' || substr(md5('7' || chr(31) || {}::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0"

ORACLE["q47_sample_per_type"] = f"""
SELECT event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY {_PRIORITY.format("event_id")}, event_id) <= 50"""

ORACLE["q48_orders_by_price"] = f"""
SELECT o_orderkey FROM orders WHERE o_totalprice > 0
ORDER BY -ln({_PRIORITY.format("o_orderkey")}) / o_totalprice, o_orderkey LIMIT 200"""

# Windows are closed when the watermark, the latest event (in whole milliseconds) less an hour, has reached their end.
_TIMED = """WITH e AS (SELECT epoch_us(ts) AS us, event_type, user_id, round(value * 100)::BIGINT AS cents FROM events),
m AS (SELECT max(us) // 1000 * 1000 - 3600000000 AS mark FROM e)
"""
_WINDOWS = _TIMED + """, w AS (SELECT (us // {slide} - k) * {slide} AS from_us, us, event_type, cents
    FROM e, range({copies}) r(k))
SELECT from_us::BIGINT AS from_us, (from_us + {size})::BIGINT AS to_us, event_type, count(*) AS n_events,
       sum(cents)::BIGINT AS total_cents
FROM w WHERE from_us + {size} <= (SELECT mark FROM m) GROUP BY from_us, event_type"""

ORACLE["q49_daily_windows"] = _WINDOWS.format(size=86400000000, slide=86400000000, copies=1)
ORACLE["q50_sliding_windows"] = _WINDOWS.format(size=21600000000, slide=7200000000, copies=3)

ORACLE["q51_user_sessions"] = _TIMED + """,
n AS (SELECT *, CASE WHEN us <= lag(us) OVER u + 14400000000 THEN 0 ELSE 1 END AS opens FROM e
      WINDOW u AS (PARTITION BY user_id ORDER BY us)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY us) AS session FROM n)
SELECT min(us) AS from_us, (max(us) + 14400000000)::BIGINT AS to_us, user_id, count(*) AS n_events,
       sum(cents)::BIGINT AS total_cents
FROM s GROUP BY user_id, session HAVING max(us) + 14400000000 <= (SELECT mark FROM m)"""

ORACLE["q52_stream_user_groups"] = """
SELECT event_id, user_id, (1 + sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS group_id
FROM events"""
