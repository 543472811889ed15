"""DuckDB SQL oracles, written from each query's *definition* (joins, NOT EXISTS,
UNION ALL per column), independent of how the Spark plan computes it.

Cross-pairing oracles really join every left occurrence with every right
occurrence; that is affordable at the small check scale only, which is the
point: the Spark side computes the same figures from frequencies.
"""

from __future__ import annotations

from ..sources import WIDE_COMPARE, WIDE_MADE

ENROLL = """
WITH base AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS member_id,
         o_orderkey AS umi_id, o_orderpriority AS group_number,
         CAST(o_orderdate AS DATE) AS eligibility_start_date,
         c_mktsegment AS last_name, c_name AS first_name,
         o_orderkey AS ok, o_custkey AS ck, o_orderdate AS od
  FROM orders JOIN customer ON o_custkey = c_custkey),
enroll_dev AS (
  SELECT member_id, umi_id,
         CASE WHEN ok % 37 = 0 THEN NULL ELSE group_number END AS group_number,
         eligibility_start_date, last_name, first_name
  FROM base WHERE ok % 41 <> 0 AND ck % 17 <> 0),
prod_once AS (
  SELECT member_id, umi_id,
         CASE WHEN ok % 31 = 0 THEN NULL WHEN ok % 37 = 0 THEN 'NULL'
              WHEN ok % 7 = 0 THEN '0-CHANGED' ELSE group_number END AS group_number,
         CASE WHEN ok % 11 = 0 THEN CAST(od + INTERVAL '1' DAY AS DATE)
              ELSE eligibility_start_date END AS eligibility_start_date,
         last_name, first_name, ok
  FROM base WHERE ok % 23 <> 0 AND ck % 19 <> 0),
enroll_prod AS (
  SELECT member_id, umi_id, group_number, eligibility_start_date, last_name, first_name
  FROM prod_once
  UNION ALL
  SELECT member_id, umi_id, group_number, eligibility_start_date, last_name, first_name
  FROM prod_once WHERE ok % 29 = 0),
dev_n AS (
  SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY umi_id NULLS LAST,
         group_number NULLS LAST, eligibility_start_date NULLS LAST, last_name NULLS LAST,
         first_name NULLS LAST) AS rn
  FROM enroll_dev WHERE member_id IS NOT NULL),
prod_n AS (
  SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY umi_id NULLS LAST,
         group_number NULLS LAST, eligibility_start_date NULLS LAST, last_name NULLS LAST,
         first_name NULLS LAST) AS rn
  FROM enroll_prod WHERE member_id IS NOT NULL),
counts AS (
  SELECT COALESCE(d.member_id, p.member_id) AS member_id,
         COALESCE(d.dev_count, 0) AS dev_count, COALESCE(p.prod_count, 0) AS prod_count
  FROM (SELECT member_id, count(*) AS dev_count FROM enroll_dev
        WHERE member_id IS NOT NULL GROUP BY member_id) d
  FULL OUTER JOIN (SELECT member_id, count(*) AS prod_count FROM enroll_prod
        WHERE member_id IS NOT NULL GROUP BY member_id) p ON d.member_id = p.member_id),
count_diffs AS (
  SELECT member_id, dev_count, prod_count, abs(dev_count - prod_count) AS count_difference,
         CASE WHEN dev_count > prod_count THEN 'MORE_IN_DEV'
              ELSE 'MORE_IN_PROD' END AS difference_type
  FROM counts WHERE dev_count <> prod_count),
pairs AS (
  SELECT d.member_id, d.rn,
         d.umi_id AS d_umi_id, d.group_number AS d_group_number,
         d.eligibility_start_date AS d_date, d.last_name AS d_last_name,
         d.first_name AS d_first_name,
         p.umi_id AS p_umi_id, p.group_number AS p_group_number,
         p.eligibility_start_date AS p_date
  FROM dev_n d JOIN prod_n p ON d.member_id = p.member_id AND d.rn = p.rn),
cells AS (
  SELECT member_id, d_umi_id AS umi_id, d_group_number AS group_number,
         d_date AS eligibility_start_date, d_last_name AS last_name, d_first_name AS first_name,
         rn AS dev_row_number, rn AS prod_row_number, 'umi_id' AS mismatch_column,
         CAST(d_umi_id AS VARCHAR) AS left_value, CAST(p_umi_id AS VARCHAR) AS right_value
  FROM pairs WHERE d_umi_id IS DISTINCT FROM p_umi_id
  UNION ALL
  SELECT member_id, d_umi_id, d_group_number, d_date, d_last_name, d_first_name, rn, rn,
         'group_number', d_group_number, p_group_number
  FROM pairs WHERE d_group_number IS DISTINCT FROM p_group_number
  UNION ALL
  SELECT member_id, d_umi_id, d_group_number, d_date, d_last_name, d_first_name, rn, rn,
         'eligibility_start_date', CAST(d_date AS VARCHAR), CAST(p_date AS VARCHAR)
  FROM pairs WHERE d_date IS DISTINCT FROM p_date),
dev_only AS (
  SELECT DISTINCT member_id, umi_id, group_number, eligibility_start_date FROM enroll_dev d
  WHERE NOT EXISTS (SELECT 1 FROM enroll_prod p WHERE p.member_id = d.member_id)),
prod_only AS (
  SELECT DISTINCT member_id, umi_id, group_number, eligibility_start_date FROM enroll_prod p
  WHERE NOT EXISTS (SELECT 1 FROM enroll_dev d WHERE d.member_id = p.member_id)),
summary AS (
  SELECT 'enroll_dev' AS dev_table, 'enroll_prod' AS prod_table,
         (SELECT count(*) FROM enroll_dev) AS total_dev_rows,
         (SELECT count(*) FROM enroll_prod) AS total_prod_rows,
         (SELECT count(*) FROM dev_only) AS rows_only_in_dev,
         (SELECT count(*) FROM prod_only) AS rows_only_in_prod,
         (SELECT count(*) FROM cells) AS mismatched_data_points,
         (SELECT count(*) FROM count_diffs) AS member_ids_with_count_differences,
         'umi_id, group_number, eligibility_start_date' AS comparison_columns,
         CAST(6 AS BIGINT) AS common_columns_count),
summary_status AS (
  SELECT *, CASE WHEN rows_only_in_dev + rows_only_in_prod + mismatched_data_points
                      + member_ids_with_count_differences = 0 THEN 'PASSED' ELSE 'FAILED' END
              AS status,
         rows_only_in_dev + rows_only_in_prod + mismatched_data_points
           + member_ids_with_count_differences AS total_issues
  FROM summary),
lg AS (
  SELECT member_id, umi_id, group_number, eligibility_start_date, last_name, first_name,
         count(*) AS left_rows
  FROM enroll_dev GROUP BY ALL),
lg_pairs AS (
  SELECT lg.*, p.umi_id AS p_umi_id, p.group_number AS p_group_number,
         p.eligibility_start_date AS p_date
  FROM lg JOIN enroll_prod p ON lg.member_id IS NOT DISTINCT FROM p.member_id),
cross_cells AS (
  SELECT member_id, umi_id, group_number, eligibility_start_date, last_name, first_name,
         'umi_id' AS mismatch_column, CAST(umi_id AS VARCHAR) AS left_value, left_rows,
         count(*) AS right_rows,
         CAST(sum(CASE WHEN umi_id IS DISTINCT FROM p_umi_id THEN 1 ELSE 0 END) AS BIGINT)
           AS differing_partners
  FROM lg_pairs GROUP BY ALL
  UNION ALL
  SELECT member_id, umi_id, group_number, eligibility_start_date, last_name, first_name,
         'group_number', group_number, left_rows, count(*),
         CAST(sum(CASE WHEN group_number IS DISTINCT FROM p_group_number THEN 1 ELSE 0 END)
              AS BIGINT)
  FROM lg_pairs GROUP BY ALL
  UNION ALL
  SELECT member_id, umi_id, group_number, eligibility_start_date, last_name, first_name,
         'eligibility_start_date', CAST(eligibility_start_date AS VARCHAR), left_rows, count(*),
         CAST(sum(CASE WHEN eligibility_start_date IS DISTINCT FROM p_date THEN 1 ELSE 0 END)
              AS BIGINT)
  FROM lg_pairs GROUP BY ALL),
sentinel_cross AS (
  SELECT 'umi_id' AS column_name, count(*) AS mismatch_count
  FROM enroll_dev d JOIN enroll_prod p
    ON COALESCE(CAST(d.member_id AS VARCHAR), 'NULL') = COALESCE(CAST(p.member_id AS VARCHAR), 'NULL')
  WHERE COALESCE(CAST(d.umi_id AS VARCHAR), 'NULL') <> COALESCE(CAST(p.umi_id AS VARCHAR), 'NULL')
  UNION ALL
  SELECT 'group_number', count(*)
  FROM enroll_dev d JOIN enroll_prod p
    ON COALESCE(CAST(d.member_id AS VARCHAR), 'NULL') = COALESCE(CAST(p.member_id AS VARCHAR), 'NULL')
  WHERE COALESCE(CAST(d.group_number AS VARCHAR), 'NULL')
        <> COALESCE(CAST(p.group_number AS VARCHAR), 'NULL')
  UNION ALL
  SELECT 'eligibility_start_date', count(*)
  FROM enroll_dev d JOIN enroll_prod p
    ON COALESCE(CAST(d.member_id AS VARCHAR), 'NULL') = COALESCE(CAST(p.member_id AS VARCHAR), 'NULL')
  WHERE COALESCE(CAST(d.eligibility_start_date AS VARCHAR), 'NULL')
        <> COALESCE(CAST(p.eligibility_start_date AS VARCHAR), 'NULL')),
total_matches AS (
  SELECT count(*) AS total_matches FROM enroll_dev d JOIN enroll_prod p
    ON d.member_id IS NOT DISTINCT FROM p.member_id)
"""

FEED = """
WITH feed_left AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         o_orderkey % 5 AS left_extra
  FROM orders WHERE o_orderkey % 41 <> 0),
feed_right AS (
  SELECT o_orderkey, CAST(o_custkey AS INT) AS o_custkey,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate,
         CASE WHEN o_orderkey % 7 = 0 THEN '0-CHANGED' ELSE o_orderpriority END AS o_orderpriority,
         'R' AS right_extra
  FROM orders WHERE o_orderkey % 23 <> 0),
j AS (
  SELECT l.o_orderkey AS l_key, r.o_orderkey AS r_key,
         l.o_orderkey IS NOT NULL AS in_l, r.o_orderkey IS NOT NULL AS in_r,
         l.o_custkey AS l_custkey, r.o_custkey AS r_custkey,
         l.o_orderstatus AS l_status, r.o_orderstatus AS r_status,
         l.o_totalprice AS l_price, r.o_totalprice AS r_price,
         l.o_orderdate AS l_date, r.o_orderdate AS r_date,
         l.o_orderpriority AS l_prio, r.o_orderpriority AS r_prio
  FROM feed_left l FULL OUTER JOIN feed_right r ON l.o_orderkey = r.o_orderkey),
classified AS (
  SELECT COALESCE(l_key, r_key) AS o_orderkey, *,
         CASE WHEN in_l AND in_r AND (l_custkey IS DISTINCT FROM r_custkey
                OR l_status IS DISTINCT FROM r_status OR l_price IS DISTINCT FROM r_price
                OR l_date IS DISTINCT FROM r_date OR l_prio IS DISTINCT FROM r_prio)
              THEN 'CHANGED'
              WHEN in_l AND NOT in_r THEN 'LEFT_ONLY'
              WHEN in_r AND NOT in_l THEN 'RIGHT_ONLY' END AS status
  FROM j),
mismatched AS (SELECT * FROM classified WHERE status IS NOT NULL),
structure AS (
  SELECT 'row_count_mismatch' AS type, CAST(NULL AS VARCHAR) AS column_name,
         CAST(l AS VARCHAR) AS table1_value, CAST(r AS VARCHAR) AS table2_value,
         abs(l - r) AS difference
  FROM (SELECT (SELECT count(*) FROM feed_left) AS l, (SELECT count(*) FROM feed_right) AS r)
  WHERE l <> r
  UNION ALL
  SELECT *, NULL FROM (VALUES ('columns_missing_in_table2', 'left_extra', NULL, NULL),
                              ('columns_missing_in_table1', 'right_extra', NULL, NULL),
                              ('column_type_mismatch', 'o_custkey', 'bigint', 'int'))
                       t(type, column_name, table1_value, table2_value))
"""

LINES = """
WITH line_left AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem WHERE l_partkey % 41 <> 0),
line_right AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
         CASE WHEN l_suppkey % 7 = 0 THEN 'X' ELSE l_linestatus END AS l_linestatus,
         l_shipdate
  FROM lineitem WHERE l_partkey % 23 <> 0),
lg AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate,
         count(*) AS left_rows
  FROM line_left GROUP BY ALL),
lp AS (
  SELECT lg.*, r.l_partkey AS r_partkey, r.l_suppkey AS r_suppkey,
         r.l_returnflag AS r_returnflag, r.l_linestatus AS r_linestatus,
         r.l_shipdate AS r_shipdate
  FROM lg JOIN line_right r ON lg.l_orderkey IS NOT DISTINCT FROM r.l_orderkey
                          AND lg.l_linenumber IS NOT DISTINCT FROM r.l_linenumber),
cells AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate,
         'l_partkey' AS mismatch_column, CAST(l_partkey AS VARCHAR) AS left_value, left_rows,
         count(*) AS right_rows,
         CAST(sum(CASE WHEN l_partkey IS DISTINCT FROM r_partkey THEN 1 ELSE 0 END) AS BIGINT)
           AS differing_partners
  FROM lp GROUP BY ALL
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate,
         'l_suppkey', CAST(l_suppkey AS VARCHAR), left_rows, count(*),
         CAST(sum(CASE WHEN l_suppkey IS DISTINCT FROM r_suppkey THEN 1 ELSE 0 END) AS BIGINT)
  FROM lp GROUP BY ALL
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate,
         'l_returnflag', l_returnflag, left_rows, count(*),
         CAST(sum(CASE WHEN l_returnflag IS DISTINCT FROM r_returnflag THEN 1 ELSE 0 END) AS BIGINT)
  FROM lp GROUP BY ALL
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate,
         'l_linestatus', l_linestatus, left_rows, count(*),
         CAST(sum(CASE WHEN l_linestatus IS DISTINCT FROM r_linestatus THEN 1 ELSE 0 END) AS BIGINT)
  FROM lp GROUP BY ALL
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate,
         'l_shipdate', CAST(l_shipdate AS VARCHAR), left_rows, count(*),
         CAST(sum(CASE WHEN l_shipdate IS DISTINCT FROM r_shipdate THEN 1 ELSE 0 END) AS BIGINT)
  FROM lp GROUP BY ALL)
"""

# DuckDB prints these doubles in their shortest form without exponent, as the
# Spark side does.
_DBL = "CAST({x} AS VARCHAR)"

_ENROLL_COLS = "member_id, umi_id, group_number, eligibility_start_date, last_name, first_name"
_NL = "NULLS LAST"

ORACLE: dict[str, str] = {
    "sample_rows": ENROLL + f"""
SELECT {_ENROLL_COLS} FROM enroll_dev
ORDER BY member_id {_NL}, umi_id {_NL}, group_number {_NL}, eligibility_start_date {_NL},
         last_name {_NL}, first_name {_NL}
LIMIT 100""",

    "table_row_counts": ENROLL + """
SELECT 'dev' AS side, count(*) AS row_count FROM enroll_dev
UNION ALL SELECT 'prod', count(*) FROM enroll_prod""",

    "table_schema": FEED + """
SELECT v.*, (SELECT count(*) FROM feed_left) AS row_count FROM (VALUES
  (CAST(1 AS BIGINT), 'o_orderkey', 'bigint', true),
  (2, 'o_custkey', 'bigint', true),
  (3, 'o_orderstatus', 'string', true),
  (4, 'o_totalprice', 'double', true),
  (5, 'o_orderdate', 'timestamp_ntz', true),
  (6, 'o_orderpriority', 'string', true),
  (7, 'left_extra', 'bigint', true)) v(position, column_name, type, nullable)""",

    "common_columns": FEED + """
SELECT v.*, (SELECT count(*) FROM feed_left) AS table1_rows,
       (SELECT count(*) FROM feed_right) AS table2_rows FROM (VALUES
  (CAST(1 AS BIGINT), 'o_orderkey'), (2, 'o_custkey'), (3, 'o_orderstatus'),
  (4, 'o_totalprice'), (5, 'o_orderdate'), (6, 'o_orderpriority')) v(position, column_name)""",

    "required_column_issues": FEED + """
SELECT t.*, CASE WHEN t.table_name = 'feed_left' THEN (SELECT count(*) FROM feed_left)
                 ELSE (SELECT count(*) FROM feed_right) END AS table_rows
FROM (VALUES
  ('missing_comparison_columns_left', 'feed_left', 'missing_col', 'CRITICAL'),
  ('missing_comparison_columns_right', 'feed_right', 'left_extra, missing_col', 'CRITICAL'),
  ('missing_output_columns_left', 'feed_left', 'right_extra', 'WARNING'))
  t(type, table_name, missing_columns, severity)""",

    "structure_diff": FEED + "SELECT * FROM structure",

    "key_ordinals": ENROLL + f"SELECT {_ENROLL_COLS}, rn FROM dev_n",

    "left_only": ENROLL + """
SELECT member_id, umi_id, group_number, eligibility_start_date FROM enroll_dev d
WHERE NOT EXISTS (SELECT 1 FROM enroll_prod p WHERE p.member_id = d.member_id)""",

    "right_only": ENROLL + """
SELECT member_id, umi_id, group_number, eligibility_start_date FROM enroll_prod p
WHERE NOT EXISTS (SELECT 1 FROM enroll_dev d WHERE d.member_id = p.member_id)""",

    "left_only_distinct": ENROLL + "SELECT * FROM dev_only",

    "right_only_distinct": ENROLL + "SELECT * FROM prod_only",

    "key_occurrences": ENROLL + """
SELECT 'dev' AS side, member_id, count(*) AS occurrence_count FROM enroll_dev
WHERE member_id IS NOT NULL GROUP BY member_id
UNION ALL
SELECT 'prod', member_id, count(*) FROM enroll_prod
WHERE member_id IS NOT NULL GROUP BY member_id""",

    "count_differences": ENROLL + "SELECT * FROM count_diffs",

    "top_count_differences": ENROLL + """
SELECT * FROM count_diffs ORDER BY count_difference DESC, member_id LIMIT 50""",

    "duplicate_histogram": ENROLL + """
SELECT side, occurrence_count, count(*) AS member_id_count,
       count(*) * occurrence_count AS total_rows
FROM (SELECT 'dev' AS side, dev_count AS occurrence_count FROM counts
      UNION ALL SELECT 'prod', prod_count FROM counts)
WHERE occurrence_count > 1
GROUP BY side, occurrence_count""",

    "duplicate_totals": ENROLL + """
SELECT s.side, CAST(COALESCE(sum(c.n), 0) AS BIGINT) AS duplicate_member_ids
FROM (VALUES ('dev'), ('prod')) s(side)
LEFT JOIN (SELECT 'dev' AS side, count(*) AS n FROM counts WHERE dev_count > 1
           UNION ALL SELECT 'prod', count(*) FROM counts WHERE prod_count > 1) c
  ON s.side = c.side
GROUP BY s.side""",

    "count_difference_patterns": ENROLL + """
SELECT count_difference, difference_type, count(*) AS member_id_count,
       round(avg(dev_count), 4) AS avg_dev_count, round(avg(prod_count), 4) AS avg_prod_count
FROM count_diffs GROUP BY count_difference, difference_type""",

    "count_difference_totals": ENROLL + """
SELECT count(*) AS total,
       CAST(COALESCE(sum(CASE WHEN difference_type = 'MORE_IN_DEV' THEN 1 END), 0) AS BIGINT)
         AS more_in_dev,
       CAST(COALESCE(sum(CASE WHEN difference_type = 'MORE_IN_PROD' THEN 1 END), 0) AS BIGINT)
         AS more_in_prod
FROM count_diffs""",

    "changed_paired": ENROLL + """
SELECT member_id, d_umi_id AS umi_id, d_group_number AS group_number,
       d_date AS eligibility_start_date, d_last_name AS last_name, d_first_name AS first_name, rn,
       d_umi_id AS dev_umi_id, p_umi_id AS prod_umi_id,
       d_group_number AS dev_group_number, p_group_number AS prod_group_number,
       d_date AS dev_eligibility_start_date, p_date AS prod_eligibility_start_date
FROM pairs
WHERE d_umi_id IS DISTINCT FROM p_umi_id OR d_group_number IS DISTINCT FROM p_group_number
   OR d_date IS DISTINCT FROM p_date""",

    "changed_sentinel": ENROLL + """
SELECT member_id, d_umi_id AS umi_id, d_group_number AS group_number,
       d_date AS eligibility_start_date, d_last_name AS last_name, d_first_name AS first_name, rn,
       d_umi_id AS dev_umi_id, p_umi_id AS prod_umi_id,
       d_group_number AS dev_group_number, p_group_number AS prod_group_number,
       d_date AS dev_eligibility_start_date, p_date AS prod_eligibility_start_date
FROM pairs
WHERE COALESCE(CAST(d_umi_id AS VARCHAR), 'NULL') <> COALESCE(CAST(p_umi_id AS VARCHAR), 'NULL')
   OR COALESCE(d_group_number, 'NULL') <> COALESCE(p_group_number, 'NULL')
   OR COALESCE(CAST(d_date AS VARCHAR), 'NULL') <> COALESCE(CAST(p_date AS VARCHAR), 'NULL')""",

    "changed_cross": ENROLL + """
SELECT member_id, umi_id, group_number, eligibility_start_date, last_name, first_name, left_rows,
       count(*) AS right_rows,
       CAST(sum(CASE WHEN umi_id IS DISTINCT FROM p_umi_id
                       OR group_number IS DISTINCT FROM p_group_number
                       OR eligibility_start_date IS DISTINCT FROM p_date THEN 1 ELSE 0 END)
            AS BIGINT) AS differing_partners
FROM lg_pairs GROUP BY ALL HAVING differing_partners > 0""",

    "mismatch_cells": ENROLL + "SELECT * FROM cells",

    "mismatch_cells_cross": ENROLL + "SELECT * FROM cross_cells WHERE differing_partners > 0",

    "unmatched_ordinals": ENROLL + """
SELECT COALESCE(d.member_id, p.member_id) AS member_id, COALESCE(d.rn, p.rn) AS rn,
       CASE WHEN d.member_id IS NOT NULL THEN 'missing_in_prod' ELSE 'missing_in_dev' END AS type
FROM dev_n d FULL OUTER JOIN prod_n p ON d.member_id = p.member_id AND d.rn = p.rn
WHERE d.member_id IS NULL OR p.member_id IS NULL""",

    "cross_matches": ENROLL + "SELECT * FROM total_matches",

    "mismatch_counts_by_column": ENROLL + "SELECT * FROM sentinel_cross",

    "mismatch_percentages": ENROLL + """
SELECT column_name, mismatch_count, total_matches,
       round(COALESCE(CAST(mismatch_count AS DOUBLE) * 100 / NULLIF(total_matches, 0), 0.0), 2)
         AS percentage
FROM sentinel_cross, total_matches""",

    "sample_mismatches": ENROLL + """
SELECT c.* FROM cells c
JOIN (SELECT DISTINCT member_id, dev_row_number FROM cells
      ORDER BY member_id, dev_row_number LIMIT 10) f
  ON c.member_id = f.member_id AND c.dev_row_number = f.dev_row_number""",

    "spot_check": ENROLL + """,
keys AS (SELECT member_id FROM count_diffs),
sd AS (SELECT * FROM dev_n WHERE member_id IN (SELECT member_id FROM keys)),
sp AS (SELECT * FROM prod_n WHERE member_id IN (SELECT member_id FROM keys))
SELECT COALESCE(d.member_id, p.member_id) AS member_id, COALESCE(d.rn, p.rn) AS rn,
       CASE WHEN d.member_id IS NOT NULL THEN 'missing_in_prod' ELSE 'missing_in_dev' END AS type,
       CAST(NULL AS VARCHAR) AS mismatch_column, CAST(NULL AS VARCHAR) AS left_value,
       CAST(NULL AS VARCHAR) AS right_value
FROM sd d FULL OUTER JOIN sp p ON d.member_id = p.member_id AND d.rn = p.rn
WHERE d.member_id IS NULL OR p.member_id IS NULL
UNION ALL
SELECT member_id, dev_row_number, 'data_differences', mismatch_column, left_value, right_value
FROM cells WHERE member_id IN (SELECT member_id FROM keys)""",

    "duplicate_details": ENROLL + f""",
keys AS (SELECT member_id FROM count_diffs)
SELECT 'dev' AS side, {_ENROLL_COLS}, rn,
       count(*) OVER (PARTITION BY member_id) AS occurrence_count
FROM dev_n WHERE member_id IN (SELECT member_id FROM keys)
UNION ALL
SELECT 'prod', {_ENROLL_COLS}, rn, count(*) OVER (PARTITION BY member_id)
FROM prod_n WHERE member_id IN (SELECT member_id FROM keys)""",

    "generic_changed": FEED + """
SELECT o_orderkey, l_custkey AS t1_o_custkey, l_status AS t1_o_orderstatus,
       l_price AS t1_o_totalprice, l_date AS t1_o_orderdate, l_prio AS t1_o_orderpriority,
       r_custkey AS t2_o_custkey, r_status AS t2_o_orderstatus, r_price AS t2_o_totalprice,
       r_date AS t2_o_orderdate, r_prio AS t2_o_orderpriority
FROM classified WHERE status = 'CHANGED'""",

    "generic_full_diff": FEED + "SELECT o_orderkey, status FROM mismatched",

    "generic_mismatch_long": FEED + """,
kv AS (SELECT *, 'o_orderkey=' || CAST(o_orderkey AS VARCHAR) AS key_values FROM mismatched),
cells AS (
  SELECT key_values, 'o_orderkey' AS "column", CAST(l_key AS VARCHAR) AS table1_value,
         CAST(r_key AS VARCHAR) AS table2_value FROM kv WHERE l_key IS DISTINCT FROM r_key
  UNION ALL
  SELECT key_values, 'o_custkey', CAST(l_custkey AS VARCHAR), CAST(r_custkey AS VARCHAR)
  FROM kv WHERE l_custkey IS DISTINCT FROM r_custkey
  UNION ALL
  SELECT key_values, 'o_orderstatus', l_status, r_status
  FROM kv WHERE l_status IS DISTINCT FROM r_status
  UNION ALL
  SELECT key_values, 'o_totalprice', """ + _DBL.format(x="l_price") + ", "
    + _DBL.format(x="r_price") + """
  FROM kv WHERE l_price IS DISTINCT FROM r_price
  UNION ALL
  SELECT key_values, 'o_orderdate', CAST(l_date AS VARCHAR), CAST(r_date AS VARCHAR)
  FROM kv WHERE l_date IS DISTINCT FROM r_date
  UNION ALL
  SELECT key_values, 'o_orderpriority', l_prio, r_prio
  FROM kv WHERE l_prio IS DISTINCT FROM r_prio)
SELECT 'feed_left' AS table1, 'feed_right' AS table2, 'o_orderkey' AS key_columns, key_values,
       "column", table1_value, table2_value
FROM cells""",

    "row_fingerprint_diff": FEED + "SELECT o_orderkey FROM classified WHERE status = 'CHANGED'",

    "keyless_diff": FEED + """,
l AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
      FROM feed_left),
r AS (SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice,
             o_orderdate, o_orderpriority FROM feed_right)
SELECT 'feed_left' AS side, * FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r)
UNION ALL
SELECT 'feed_right', * FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l)""",

    "business_key_changed": LINES + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate,
       left_rows, count(*) AS right_rows,
       CAST(sum(CASE WHEN l_partkey IS DISTINCT FROM r_partkey
                       OR l_suppkey IS DISTINCT FROM r_suppkey
                       OR l_returnflag IS DISTINCT FROM r_returnflag
                       OR l_linestatus IS DISTINCT FROM r_linestatus
                       OR l_shipdate IS DISTINCT FROM r_shipdate THEN 1 ELSE 0 END) AS BIGINT)
         AS differing_partners
FROM lp GROUP BY ALL HAVING differing_partners > 0""",

    "business_mismatch_cells": LINES + "SELECT * FROM cells WHERE differing_partners > 0",

    "run_summary": ENROLL + "SELECT * FROM summary",

    "run_status": ENROLL + "SELECT status, total_issues FROM summary_status",

    "status_line": ENROLL + """
SELECT status || ': ' || CAST(total_issues AS VARCHAR) || ' issues ('
       || 'rows_only_in_dev=' || CAST(rows_only_in_dev AS VARCHAR)
       || ', rows_only_in_prod=' || CAST(rows_only_in_prod AS VARCHAR)
       || ', mismatched_data_points=' || CAST(mismatched_data_points AS VARCHAR)
       || ', member_ids_with_count_differences='
       || CAST(member_ids_with_count_differences AS VARCHAR) || ')' AS status_line
FROM summary_status""",

    "validation_report": ENROLL + """
SELECT section, metric, value FROM summary_status,
LATERAL (VALUES
  ('tables', 'dev_table', dev_table),
  ('tables', 'prod_table', prod_table),
  ('row_counts', 'total_dev_rows', CAST(total_dev_rows AS VARCHAR)),
  ('row_counts', 'total_prod_rows', CAST(total_prod_rows AS VARCHAR)),
  ('results', 'rows_only_in_dev', CAST(rows_only_in_dev AS VARCHAR)),
  ('results', 'rows_only_in_prod', CAST(rows_only_in_prod AS VARCHAR)),
  ('results', 'mismatched_data_points', CAST(mismatched_data_points AS VARCHAR)),
  ('results', 'member_ids_with_count_differences',
   CAST(member_ids_with_count_differences AS VARCHAR)),
  ('details', 'comparison_columns', comparison_columns),
  ('details', 'common_columns_count', CAST(common_columns_count AS VARCHAR)),
  ('status', 'status', status),
  ('status', 'total_issues', CAST(total_issues AS VARCHAR))) v(section, metric, value)""",

    "validation_log": FEED + """
SELECT '2024-05-01 12:30:00' AS "timestamp", type AS validation_type, 'FAILED' AS status,
       'feed_left' AS table1, 'feed_right' AS table2,
       'column=' || COALESCE(column_name, '') || ', table1_value=' || COALESCE(table1_value, '')
       || ', table2_value=' || COALESCE(table2_value, '') AS details
FROM structure
UNION ALL
SELECT '2024-05-01 12:30:00', 'data_rows', CASE WHEN n = 0 THEN 'PASSED' ELSE 'FAILED' END,
       'feed_left', 'feed_right',
       'total_mismatched_rows=' || CAST(n AS VARCHAR) || ', key_columns=o_orderkey'
FROM (SELECT count(*) AS n FROM mismatched)""",

    "run_status_cross": ENROLL + """,
x AS (SELECT (SELECT count(*) FROM dev_only) + (SELECT count(*) FROM prod_only)
             + (SELECT COALESCE(sum(left_rows * differing_partners), 0) FROM cross_cells) AS t)
SELECT CASE WHEN t = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, CAST(t AS BIGINT) AS total_issues
FROM x""",

    "run_status_business": LINES + """,
lo AS (SELECT DISTINCT * FROM line_left l WHERE NOT EXISTS (SELECT 1 FROM line_right r
       WHERE r.l_orderkey = l.l_orderkey AND r.l_linenumber = l.l_linenumber)),
ro AS (SELECT DISTINCT * FROM line_right r WHERE NOT EXISTS (SELECT 1 FROM line_left l
       WHERE r.l_orderkey = l.l_orderkey AND r.l_linenumber = l.l_linenumber)),
x AS (SELECT (SELECT count(*) FROM lo) + (SELECT count(*) FROM ro)
             + (SELECT COALESCE(sum(left_rows * differing_partners), 0) FROM cells) AS t)
SELECT CASE WHEN t = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, CAST(t AS BIGINT) AS total_issues
FROM x""",

    "run_status_generic": FEED + """,
x AS (SELECT (SELECT count(*) FROM structure) + (SELECT count(*) FROM mismatched) AS t)
SELECT CASE WHEN t = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, CAST(t AS BIGINT) AS total_issues
FROM x""",

    "sink_clean_names": ENROLL + """
SELECT member_id AS Member_Id, umi_id AS Umi_Id, group_number AS Group_Number,
       eligibility_start_date AS Eligibility_Start_Date, last_name AS Last_Name,
       first_name AS First_Name, dev_row_number AS Dev_Row_Number,
       prod_row_number AS Prod_Row_Number, mismatch_column AS Differing_Compared_Column,
       left_value AS Value_Dev, right_value AS Value_Prod
FROM cells""",

    "sink_table_roundtrip": ENROLL + "SELECT * FROM count_diffs",

    "sink_csv_headless": ENROLL + "SELECT * FROM count_diffs",

    "views_sql_text": ENROLL + """
SELECT mismatch_column, count(*) AS cells FROM cells WHERE dev_row_number >= 2
GROUP BY mismatch_column""",

    "generic_without_keys": FEED + """,
l AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
      FROM feed_left),
r AS (SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice,
             o_orderdate, o_orderpriority FROM feed_right)
SELECT *, 'LEFT_ONLY' AS status FROM l WHERE NOT EXISTS (
  SELECT 1 FROM r WHERE r.o_orderkey = l.o_orderkey AND r.o_custkey = l.o_custkey
    AND r.o_orderstatus = l.o_orderstatus AND r.o_totalprice = l.o_totalprice
    AND r.o_orderdate = l.o_orderdate AND r.o_orderpriority = l.o_orderpriority)
UNION ALL
SELECT *, 'RIGHT_ONLY' FROM r WHERE NOT EXISTS (
  SELECT 1 FROM l WHERE r.o_orderkey = l.o_orderkey AND r.o_custkey = l.o_custkey
    AND r.o_orderstatus = l.o_orderstatus AND r.o_totalprice = l.o_totalprice
    AND r.o_orderdate = l.o_orderdate AND r.o_orderpriority = l.o_orderpriority)""",

    "sink_csv_roundtrip": ENROLL + """
SELECT *, CAST(eligibility_start_date AS TIMESTAMP)
          + to_microseconds(umi_id % 1000000) AS seen,
       '[' || COALESCE('"' || group_number || '"', 'null') || ',null,"a, b"]' AS tags
FROM dev_only""",

    "run_status_cross_sentinel": ENROLL + """,
x AS (SELECT (SELECT count(*) FROM dev_only) + (SELECT count(*) FROM prod_only)
             + (SELECT sum(mismatch_count) FROM sentinel_cross) AS t)
SELECT CASE WHEN t = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, CAST(t AS BIGINT) AS total_issues
FROM x""",

    "sample_mismatches_cross": ENROLL + """
SELECT * FROM cross_cells WHERE differing_partners > 0
ORDER BY member_id NULLS LAST, mismatch_column, left_value NULLS LAST, umi_id NULLS LAST,
         group_number NULLS LAST, eligibility_start_date NULLS LAST, last_name NULLS LAST,
         first_name NULLS LAST
LIMIT 10""",

    "spot_check_outcomes": ENROLL + """,
per AS (SELECT c_custkey AS member_id, COALESCE(d.n, 0) AS dev_count,
               COALESCE(p.n, 0) AS prod_count, COALESCE(c.n, 0) AS n
        FROM customer
        LEFT JOIN (SELECT member_id, count(*) AS n FROM dev_n GROUP BY 1) d ON d.member_id = c_custkey
        LEFT JOIN (SELECT member_id, count(*) AS n FROM prod_n GROUP BY 1) p ON p.member_id = c_custkey
        LEFT JOIN (SELECT member_id, count(*) AS n FROM cells GROUP BY 1) c ON c.member_id = c_custkey)
SELECT member_id, dev_count, prod_count,
       CASE WHEN dev_count + prod_count = 0 THEN 'NOT_FOUND'
            WHEN prod_count = 0 THEN 'ONLY_IN_DEV' WHEN dev_count = 0 THEN 'ONLY_IN_PROD'
            WHEN dev_count = prod_count AND n = 0 THEN 'EQUAL' ELSE 'DIFFERENT' END AS outcome
FROM per""",

    "generic_mismatch_nested": FEED + """,
kv AS (SELECT *, 'o_orderkey=' || CAST(o_orderkey AS VARCHAR) AS key_values FROM mismatched),
cells AS (
  SELECT key_values, 'o_orderkey' AS c, CAST(l_key AS VARCHAR) AS a, CAST(r_key AS VARCHAR) AS b
  FROM kv WHERE l_key IS DISTINCT FROM r_key
  UNION ALL SELECT key_values, 'o_custkey', CAST(l_custkey AS VARCHAR), CAST(r_custkey AS VARCHAR)
  FROM kv WHERE l_custkey IS DISTINCT FROM r_custkey
  UNION ALL SELECT key_values, 'o_orderstatus', l_status, r_status
  FROM kv WHERE l_status IS DISTINCT FROM r_status
  UNION ALL SELECT key_values, 'o_totalprice', CAST(l_price AS VARCHAR), CAST(r_price AS VARCHAR)
  FROM kv WHERE l_price IS DISTINCT FROM r_price
  UNION ALL SELECT key_values, 'o_orderdate', CAST(l_date AS VARCHAR), CAST(r_date AS VARCHAR)
  FROM kv WHERE l_date IS DISTINCT FROM r_date
  UNION ALL SELECT key_values, 'o_orderpriority', l_prio, r_prio
  FROM kv WHERE l_prio IS DISTINCT FROM r_prio)
SELECT 'feed_left' AS table1, 'feed_right' AS table2, key_values,
       string_agg(c || '=' || COALESCE(a, 'NULL') || ' / ' || COALESCE(b, 'NULL'), '; ' ORDER BY c)
         AS differences
FROM cells GROUP BY key_values""",

    "mismatch_cells_mixed": ENROLL + """
SELECT c.* FROM cells c JOIN pairs p ON c.member_id = p.member_id AND c.dev_row_number = p.rn
WHERE COALESCE(CAST(d_umi_id AS VARCHAR), 'NULL') <> COALESCE(CAST(p_umi_id AS VARCHAR), 'NULL')
   OR COALESCE(d_group_number, 'NULL') <> COALESCE(p_group_number, 'NULL')
   OR COALESCE(CAST(d_date AS VARCHAR), 'NULL') <> COALESCE(CAST(p_date AS VARCHAR), 'NULL')""",

    "cross_right_values": ENROLL + """,
differing AS (SELECT DISTINCT member_id, mismatch_column FROM cross_cells
              WHERE differing_partners > 0),
vals AS (
  SELECT member_id, 'umi_id' AS mismatch_column, CAST(umi_id AS VARCHAR) AS right_value
  FROM enroll_prod
  UNION ALL SELECT member_id, 'group_number', group_number FROM enroll_prod
  UNION ALL SELECT member_id, 'eligibility_start_date', CAST(eligibility_start_date AS VARCHAR)
  FROM enroll_prod)
SELECT v.member_id, v.mismatch_column, v.right_value, count(*) AS right_rows
FROM vals v JOIN differing d ON v.member_id IS NOT DISTINCT FROM d.member_id
                            AND v.mismatch_column = d.mismatch_column
GROUP BY ALL""",
}

# --- the same columns in different types ---------------------------------------
EXACT = """
WITH raw AS (
  SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(19,2)) + 1000000000000000 AS amount,
         o_orderdate AS noon, o_orderpriority AS prio,
         CAST(o_orderkey AS DECIMAL(38,0)) + 9007199254740992 AS key_id
  FROM orders),
exact_left AS (
  SELECT CAST(key_id AS VARCHAR) AS key_id, CAST(CAST(amount AS DECIMAL(20,2)) AS VARCHAR) AS amount,
         k AS rate, noon + to_microseconds(k % 1000000) AS seen, noon AS mark, k AS id, prio
  FROM raw WHERE k % 41 <> 0),
exact_right AS (
  SELECT CAST(key_id AS VARCHAR) AS key_id,
         CAST(CAST(amount + CASE WHEN k % 13 = 0 THEN 0.01 ELSE 0 END AS DECIMAL(20,2)) AS VARCHAR)
           AS amount,
         k + CASE WHEN k % 11 = 0 THEN 1 ELSE 0 END AS rate,
         noon + to_microseconds(k % 1000000 + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END) AS seen,
         noon + to_microseconds(CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END) AS mark, k AS id,
         CASE WHEN k % 19 <> 0 THEN prio END AS prio
  FROM raw WHERE k % 23 <> 0),
left_text AS (
  SELECT key_id, amount,
         rtrim(CAST(CAST(rate AS DECIMAL(20,0)) * CAST('0.00000000001' AS DECIMAL(12,11)) AS VARCHAR),
               '0') AS rate, CAST(seen AS VARCHAR) AS seen,
         '["' || strftime(mark, '%Y-%m-%dT%H:%M:%S.%f') || '",null]' AS marks,
         '{"id":' || CAST(id AS VARCHAR) || ',"priority":"' || prio || '"}' AS box
  FROM exact_left),
right_text AS (
  SELECT key_id, amount,
         rtrim(CAST(CAST(rate AS DECIMAL(20,0)) * CAST('0.00000000001' AS DECIMAL(12,11)) AS VARCHAR),
               '0') AS rate, CAST(seen AS VARCHAR) AS seen,
         '["' || strftime(mark, '%Y-%m-%dT%H:%M:%S.%f') || '",null]' AS marks,
         '{"id":' || CAST(id AS VARCHAR) || ',"priority":' || COALESCE('"' || prio || '"', 'null')
           || '}' AS box
  FROM exact_right),
left_cells AS (UNPIVOT left_text ON amount, rate, seen, marks, box
               INTO NAME mismatch_column VALUE left_value),
right_cells AS (UNPIVOT right_text ON amount, rate, seen, marks, box
                INTO NAME mismatch_column VALUE right_value),
cells AS (
  SELECT l.key_id, l.mismatch_column, l.left_value, r.right_value
  FROM left_cells l JOIN right_cells r ON l.key_id = r.key_id
                                      AND l.mismatch_column = r.mismatch_column
  WHERE l.left_value <> r.right_value),
one_sided AS (
  SELECT (SELECT count(*) FROM left_text WHERE key_id NOT IN (SELECT key_id FROM right_text)) AS l,
         (SELECT count(*) FROM right_text WHERE key_id NOT IN (SELECT key_id FROM left_text)) AS r)
"""

ORACLE |= {
    "key_counts_mixed_types": EXACT + """
SELECT key_id, CAST(sum(l) AS BIGINT) AS left_count, CAST(sum(r) AS BIGINT) AS right_count
FROM (SELECT key_id, 1 AS l, 0 AS r FROM left_text
      UNION ALL SELECT key_id, 0, 1 FROM right_text)
GROUP BY key_id""",

    "mismatch_cells_mixed_types": EXACT + "SELECT * FROM cells",

    "mismatch_cells_cross_mixed_types": EXACT + """
SELECT key_id, mismatch_column, left_value, CAST(1 AS BIGINT) AS left_rows,
       CAST(1 AS BIGINT) AS right_rows, CAST(1 AS BIGINT) AS differing_partners
FROM cells""",

    "cross_right_values_mixed_types": EXACT + """
SELECT key_id, mismatch_column, right_value, CAST(1 AS BIGINT) AS right_rows FROM cells""",

    "keyless_mixed_types": EXACT + """,
differing AS (SELECT DISTINCT key_id FROM cells)
SELECT 'left' AS side, key_id, amount, seen FROM exact_left
WHERE key_id IN (SELECT key_id FROM differing)
   OR key_id NOT IN (SELECT key_id FROM exact_right)
UNION ALL
SELECT 'right', key_id, amount, seen FROM exact_right
WHERE key_id IN (SELECT key_id FROM differing)
   OR key_id NOT IN (SELECT key_id FROM exact_left)""",

    "fingerprint_mixed_types": EXACT + "SELECT DISTINCT key_id FROM cells",

    "run_status_mixed_types": EXACT + """,
x AS (SELECT 2 * l + 2 * r + (SELECT count(*) FROM cells) AS t FROM one_sided)
SELECT CASE WHEN t = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, CAST(t AS BIGINT) AS total_issues
FROM x""",
}

# --- many compared columns: one branch for each ---------------------------------
_MADE = {m: f"l_partkey * {i} % 97" for i, m in enumerate(WIDE_MADE, 1)}
_PLAIN = WIDE_COMPARE[:-len(WIDE_MADE)]
_TIES = ", ".join(f"{c} NULLS LAST" for c in WIDE_COMPARE)
WIDE = f"""
WITH raw AS (
  SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                         JOIN customer ON o_custkey = c_custkey),
wide_left AS (
  SELECT l_orderkey, l_linenumber, {", ".join(_PLAIN)},
         {", ".join(f"{e} AS {m}" for m, e in _MADE.items())}
  FROM raw WHERE l_partkey % 41 <> 0),
wide_right AS (
  SELECT l_orderkey, l_linenumber, {", ".join(_PLAIN)},
         {", ".join(f"{e} + CASE WHEN l_partkey % {i + 30} = 0 THEN 1 ELSE 0 END AS {m}"
                    for i, (m, e) in enumerate(_MADE.items(), 1))}
  FROM raw WHERE l_partkey % 23 <> 0),
numbered_left AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_TIES}) AS rn
  FROM wide_left),
numbered_right AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_TIES}) AS rn
  FROM wide_right)
"""


def _wide_cells(column: str) -> str:
    return f"""
SELECT l_orderkey, l_linenumber, l.c_name AS c_name, rn AS left_row_number,
       rn AS right_row_number, '{column}' AS mismatch_column,
       CAST(l.{column} AS VARCHAR) AS left_value, CAST(r.{column} AS VARCHAR) AS right_value
FROM numbered_left l JOIN numbered_right r USING (l_orderkey, l_linenumber, rn)
WHERE l.{column} IS DISTINCT FROM r.{column}"""


def _wide_cross(column: str) -> str:
    return f"""
SELECT l_orderkey, l_linenumber, l.c_name AS c_name, '{column}' AS mismatch_column,
       CAST(v AS VARCHAR) AS left_value, left_rows, count(*) AS right_rows,
       CAST(sum(CASE WHEN v IS DISTINCT FROM r.{column} THEN 1 ELSE 0 END) AS BIGINT)
         AS differing_partners
FROM (SELECT l_orderkey, l_linenumber, c_name, {column} AS v, count(*) AS left_rows
      FROM wide_left GROUP BY ALL) l
JOIN (SELECT l_orderkey, l_linenumber, {column} FROM wide_right) r USING (l_orderkey, l_linenumber)
GROUP BY ALL HAVING differing_partners > 0"""


ORACLE |= {
    "wide_mismatch_cells": WIDE + " UNION ALL ".join(map(_wide_cells, WIDE_COMPARE)),
    "wide_mismatch_cells_cross": WIDE + " UNION ALL ".join(map(_wide_cross, WIDE_COMPARE)),
}

# --- rows by the sentinel rule, cells null-safely, every pair --------------------
MIXED_CROSS = ENROLL + """,
picked AS (
  SELECT *, COALESCE(CAST(umi_id AS VARCHAR), 'NULL') <> COALESCE(CAST(p_umi_id AS VARCHAR), 'NULL')
         OR COALESCE(group_number, 'NULL') <> COALESCE(p_group_number, 'NULL')
         OR COALESCE(CAST(eligibility_start_date AS VARCHAR), 'NULL')
            <> COALESCE(CAST(p_date AS VARCHAR), 'NULL') AS picked
  FROM lg_pairs),
mixed_cells AS (
""" + " UNION ALL ".join(f"""
  SELECT member_id, umi_id, group_number, eligibility_start_date, last_name, first_name,
         '{c}' AS mismatch_column, CAST({c} AS VARCHAR) AS left_value, left_rows,
         count(*) AS right_rows, count(*) FILTER (picked AND {c} IS DISTINCT FROM {p})
           AS differing_partners
  FROM picked GROUP BY ALL""" for c, p in (
    ("umi_id", "p_umi_id"), ("group_number", "p_group_number"),
    ("eligibility_start_date", "p_date"))) + ")"

# --- equal values in types far apart: compared as numbers, by a join for each column -----
TYPED = """
WITH typed_left AS (
  SELECT o_orderkey AS id, CAST(o_orderkey % 100 AS INTEGER) AS units,
         CAST(o_totalprice AS DECIMAL(12,2)) AS price, o_custkey AS code,
         CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS note
  FROM orders WHERE o_orderkey % 41 <> 0),
typed_right AS (
  SELECT o_orderkey AS id,
         CAST(o_orderkey % 100 AS DOUBLE) + CASE WHEN o_orderkey % 29 = 0 THEN 0.5 ELSE 0 END AS units,
         CAST(CAST(o_totalprice AS DECIMAL(12,2)) + CASE WHEN o_orderkey % 31 = 0 THEN 1 ELSE 0 END
              AS DOUBLE) AS price,
         CASE WHEN o_orderkey % 37 = 0 THEN 'none' ELSE CAST(o_custkey AS VARCHAR) END AS code,
         CASE WHEN o_orderkey % 26 = 0 THEN 'NULL'
              WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS note
  FROM orders WHERE o_orderkey % 23 <> 0),
both_ AS (SELECT l.id, l.units AS lu, r.units AS ru, l.price AS lp, r.price AS rp, l.code AS lc,
                 r.code AS rc, l.note AS ln, r.note AS rn,
                 l.units <> r.units AS du, CAST(l.price AS DOUBLE) <> r.price AS dp,
                 CAST(l.code AS VARCHAR) <> r.code AS dc,
                 COALESCE(l.note, 'NULL') <> COALESCE(r.note, 'NULL') AS ds,
                 l.note IS DISTINCT FROM r.note AS dn
          FROM typed_left l JOIN typed_right r ON l.id = r.id),
typed_cells AS (
  SELECT id, 'units' AS c, CAST(lu AS VARCHAR) AS a, CAST(ru AS VARCHAR) AS b, du AS s, du AS m
  FROM both_
  UNION ALL SELECT id, 'price', CAST(lp AS VARCHAR), CAST(rp AS VARCHAR), dp, dp FROM both_
  UNION ALL SELECT id, 'code', CAST(lc AS VARCHAR), rc, dc, dc FROM both_
  UNION ALL SELECT id, 'note', ln, rn, ds, dn AND (du OR dp OR dc OR ds) FROM both_)
"""


def _typed(rule: str, cross: bool) -> str:
    ones = ", ".join(f"CAST(1 AS BIGINT) AS {c}" for c in
                     ("left_rows", "right_rows", "differing_partners"))
    return TYPED + f"""SELECT CAST(id AS VARCHAR) AS order_id, c AS mismatch_column, a AS left_value,
       {ones if cross else "b AS right_value"} FROM typed_cells WHERE {rule}"""


def _asked(text: str, key: str) -> str:
    return TYPED + f""",
asked AS (SELECT DISTINCT {text} AS order_id, {key} AS id FROM orders),
differing AS (SELECT DISTINCT id FROM typed_cells WHERE s OR m
              UNION SELECT id FROM both_ WHERE dn),
per AS (SELECT a.order_id, count(l.id) AS left_count, count(r.id) AS right_count,
               count(d.id) AS n
        FROM asked a LEFT JOIN typed_left l ON l.id = a.id LEFT JOIN typed_right r ON r.id = a.id
        LEFT JOIN differing d ON d.id = a.id GROUP BY a.order_id)
SELECT order_id, left_count, right_count,
       CASE WHEN left_count + right_count = 0 THEN 'NOT_FOUND'
            WHEN right_count = 0 THEN 'ONLY_IN_LEFT' WHEN left_count = 0 THEN 'ONLY_IN_RIGHT'
            WHEN n = 0 THEN 'EQUAL' ELSE 'DIFFERENT' END AS outcome
FROM per"""


ORACLE |= {
    "mismatch_cells_cross_mixed": MIXED_CROSS + """
SELECT * FROM mixed_cells WHERE differing_partners > 0""",

    "mismatch_counts_cross_mixed": MIXED_CROSS + """
SELECT mismatch_column AS column_name,
       CAST(sum(left_rows * differing_partners) AS BIGINT) AS mismatch_count,
       CAST(sum(left_rows * right_rows) AS BIGINT) AS total_matches
FROM mixed_cells GROUP BY 1""",

    "run_status_cross_mixed": MIXED_CROSS + """,
x AS (SELECT (SELECT count(*) FROM dev_only) + (SELECT count(*) FROM prod_only)
             + (SELECT COALESCE(sum(left_rows * differing_partners), 0) FROM mixed_cells) AS t)
SELECT CASE WHEN t = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, CAST(t AS BIGINT) AS total_issues
FROM x""",

    "changed_sentinel_mixed_types": _typed("s", False),
    "changed_mixed_mixed_types": _typed("m", False),
    "cross_sentinel_mixed_types": _typed("s", True),
    "cross_mixed_mixed_types": _typed("m", True),
    "spot_check_asked_types": _asked("""CASE
  WHEN o_orderkey % 5 = 0 THEN '0' || o_orderkey WHEN o_orderkey % 7 = 0 THEN o_orderkey || '.5'
  WHEN o_orderkey % 11 = 0 THEN 'none' ELSE CAST(o_orderkey AS VARCHAR) END""", """CASE
  WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 THEN o_orderkey END"""),
    "spot_check_wider_keys": _asked(
        "o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN '.5' ELSE '.0' END",
        "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END"),
}


# --- all results of a run, each row as text ---------------------------------------
def _texts(parts: dict[str, tuple[str, list[str]]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{kind}' AS kind, concat_ws('|', " + ", ".join(
            f"COALESCE(CAST({c} AS VARCHAR), 'NULL')" for c in columns) + f") AS row_text FROM {source}"
        for kind, (source, columns) in parts.items())


_OWN = ["member_id", "umi_id", "group_number", "eligibility_start_date"]
_REPORTED = [*_OWN, "last_name", "first_name"]
_CELL = ["mismatch_column", "left_value"]
_RUN_PARTS = {
    "left_only": ("dev_only", _OWN), "right_only": ("prod_only", _OWN),
    "count_differences": (f"({ORACLE['count_differences'].removeprefix(ENROLL)})",
                          ["member_id", "dev_count", "prod_count", "count_difference",
                           "difference_type"])}
_CROSS_CELLS = [*_REPORTED, *_CELL, "left_rows", "right_rows", "differing_partners"]

ORACLE |= {
    "run_outputs": ENROLL + _texts(_RUN_PARTS | {
        "mismatches": ("cells", [*_REPORTED, "dev_row_number", "prod_row_number", *_CELL,
                                 "right_value"]),
        "unmatched_ordinals": (f"({ORACLE['unmatched_ordinals'].removeprefix(ENROLL)})",
                               ["member_id", "rn", "type"])}),
    "run_outputs_cross": ENROLL + _texts(_RUN_PARTS | {
        "mismatches": ("cross_cells WHERE differing_partners > 0", _CROSS_CELLS)}),
    "run_outputs_cross_mixed": MIXED_CROSS + _texts(_RUN_PARTS | {
        "mismatches": ("mixed_cells WHERE differing_partners > 0", _CROSS_CELLS)}),
    "published_run": ENROLL + "SELECT result, n AS rows, n AS rows_read FROM (" + " UNION ALL ".join(
        f"SELECT '{kind}' AS result, count(*) AS n FROM {source}" for kind, source in {
            **{k: v[0] for k, v in _RUN_PARTS.items()}, "mismatches": "cells",
            "unmatched_ordinals": f"({ORACLE['unmatched_ordinals'].removeprefix(ENROLL)})"}.items())
    + " UNION ALL SELECT 'summary', 1)",
}

ORACLE |= {
    # rows are read in the order of the file
    "file_preview": "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem LIMIT 1000",

    "catalog_profile": """
SELECT position, column_name, type, nullable, default_value, is_key,
       (SELECT count(*) FROM orders) AS row_count
FROM (VALUES (CAST(1 AS BIGINT), 'o_orderkey', 'bigint', true, NULL, true),
             (2, 'o_custkey', 'bigint', true, NULL, false),
             (3, 'o_orderstatus', 'varchar(10)', true, '''O''', false),
             (4, 'o_orderpriority', 'char(20)', true, NULL, false),
             (5, 'o_totalprice', 'double', true, '0.5', false))
     v(position, column_name, type, nullable, default_value, is_key)""",

    "declared_structure_diff": """
WITH c AS (SELECT count(*) AS a, count(*) FILTER (o_orderkey % 7 <> 0) AS b FROM orders)
SELECT 'row_count_mismatch' AS type, CAST(NULL AS VARCHAR) AS column_name,
       CAST(a AS VARCHAR) AS table1_value, CAST(b AS VARCHAR) AS table2_value, a - b AS difference
FROM c
UNION ALL SELECT 'column_type_mismatch', 'o_orderstatus', 'varchar(10)', 'varchar(20)', NULL""",
}
