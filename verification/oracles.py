"""Expected results in SQL, computed straight from the given tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Events as the log recipe reads them; errors are the broken texts.
LOGS = """
WITH logs AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS mid,
         CASE WHEN event_id % 2 = 0 THEN '1' ELSE '0' END AS flag,
         event_type AS kind, CAST(event_id % 3 + 1 AS INTEGER) AS n_items,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(ts AS DATE) AS day
  FROM events),
good AS (SELECT * FROM logs WHERE kind <> 'error'),
fixed AS (
  SELECT *, flag = '1' AND row_number() OVER (PARTITION BY mid, flag ORDER BY seq) > 1 AS repaired
  FROM good),
flags AS (SELECT *, CASE WHEN repaired THEN '0' ELSE flag END AS is_new FROM fixed),
starts AS (SELECT * FROM flags WHERE kind IN ('signup', 'click')),
pages AS (SELECT * FROM flags WHERE kind IN ('view', 'click', 'purchase')),
shown AS (SELECT seq, unnest(range(n_items)) AS item FROM flags WHERE kind = 'view')
"""

RECORD = """
  seq, mid, is_new,
  CASE WHEN kind IN ('signup', 'click') THEN kind END AS entry,
  CASE WHEN kind IN ('view', 'click', 'purchase') THEN kind END AS page_id,
  k,
  CASE kind WHEN 'view' THEN n_items WHEN 'purchase' THEN 0 ELSE -1 END AS n_displays
"""

COUNTS = """
SELECT 'dwd_start_log' AS topic, count(*) AS n FROM starts
UNION ALL SELECT 'dwd_page_log', count(*) FROM pages
UNION ALL SELECT 'dwd_display_log', count(*) FROM shown
UNION ALL SELECT 'dead_letter', count(*) FROM logs WHERE kind = 'error'
"""

ORACLES["log_valid"] = LOGS + "SELECT seq, mid, flag AS is_new FROM good"
ORACLES["log_dirty"] = LOGS + """
SELECT seq, '{"event_id": ' || CAST(seq AS VARCHAR) AS value, 'bad_json' AS reason,
       'parse_logs' AS stage
FROM logs WHERE kind = 'error'"""
ORACLES["is_new_batch"] = LOGS + "SELECT seq, mid, is_new, repaired FROM flags"
ORACLES["route_start"] = LOGS + f"SELECT {RECORD} FROM starts"
ORACLES["route_page"] = LOGS + f"SELECT {RECORD} FROM pages"
ORACLES["route_display"] = LOGS + """
SELECT seq, CAST(item AS INTEGER) AS item, 'view' AS page_id, false AS has_common FROM shown"""
ORACLES["topic_counts"] = LOGS + COUNTS
ORACLES["log_topic_sink"] = LOGS + """
SELECT topic, count(*) AS n, count(*) AS keys, CAST(sum(v) AS BIGINT) AS total FROM (
  SELECT 'dwd_start_log' AS topic, coalesce(k, 0) + 1000 * CAST(is_new AS BIGINT) AS v FROM starts
  UNION ALL SELECT 'dwd_page_log', coalesce(k, 0) + 1000 * CAST(is_new AS BIGINT) FROM pages
  UNION ALL SELECT 'dwd_display_log', item FROM shown
  UNION ALL SELECT 'dead_letter', seq FROM logs WHERE kind = 'error') GROUP BY topic"""
ORACLES["log_job_stream"] = ORACLES["log_topic_sink"]
ORACLES["topic_dedup_stream"] = ORACLES["log_topic_sink"]
ORACLES["log_files_growing"] = LOGS + """
SELECT CASE WHEN kind <> 'error' THEN mid END AS mid, CASE WHEN kind <> 'error' THEN flag END AS is_new,
       CASE WHEN kind = 'error' THEN 'bad_json' END AS reason, count(*) AS n
FROM logs GROUP BY 1, 2, 3"""
ORACLES["json_functions"] = LOGS + """
SELECT seq, mid,
       CASE WHEN kind IN ('view', 'click', 'purchase') THEN kind END AS page_id,
       kind IN ('signup', 'click') AS start_nonempty,
       kind = 'view' AS displays_nonempty,
       kind IN ('view', 'purchase') AS has_displays,
       kind IN ('signup', 'click') AS has_start_key,
       CASE WHEN kind IN ('signup', 'click') THEN kind ELSE 'none' END AS entry,
       'p' AS new_page,
       CAST(k AS VARCHAR) AS k
FROM good"""
ORACLES["text_functions"] = """
WITH named AS (
  SELECT *, list_concat([lower(p_type)], string_split(replace(p_name, ' ', ','), ',')) AS names
  FROM part)
SELECT p_partkey, CAST(len(names) AS INTEGER) AS n_names, names[1] AS first_name,
       names[len(names)] AS last_name, list_contains(names, 'bolt') AS has_bolt,
       lower(p_brand) AS brand, lower(p_type) AS kind
FROM named"""
ORACLES["log_files"] = LOGS + """
SELECT day, count(*) AS n_lines, count(*) FILTER (WHERE kind <> 'error') AS n_good,
       arg_max_null(CASE WHEN kind <> 'error' THEN mid END, seq) AS last_mid
FROM logs GROUP BY day"""
ORACLES["log_files_is_new"] = LOGS + """
SELECT mid, count(*) FILTER (WHERE is_new = '1') AS n_new,
       count(*) FILTER (WHERE repaired) AS n_repaired,
       min(CASE WHEN is_new = '1' THEN day END) AS first_day
FROM flags GROUP BY mid"""
ORACLES["is_new_stream"] = LOGS + """
SELECT 'dwd_start_log' AS topic, seq, mid, is_new FROM starts
UNION ALL SELECT 'dwd_page_log', seq, mid, is_new FROM pages"""
ORACLES["is_new_backfilled_stream"] = ORACLES["is_new_stream"]
ORACLES["log_files_stream"] = LOGS + """
SELECT topic, mid, count(*) AS n, count(*) FILTER (WHERE is_new = '1') AS n_new
FROM (SELECT 'dwd_start_log' AS topic, * FROM starts
      UNION ALL SELECT 'dwd_page_log', * FROM pages)
GROUP BY topic, mid"""

# Customer changes: the key picks the operation.
CUSTOMERS = """
WITH changes AS (
  SELECT *, c_custkey AS seq,
         CASE c_custkey % 4 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' WHEN 2 THEN 'delete'
              ELSE 'read' END AS type
  FROM customer)
"""
ORACLES["cdc_normalize"] = CUSTOMERS + """
SELECT seq, 'shop' AS database, 'customer' AS "tableName", type,
       CASE WHEN type IN ('update', 'delete') THEN 5 ELSE 0 END AS n_before,
       CASE WHEN type = 'delete' THEN 0 ELSE 5 END AS n_after,
       CASE WHEN type <> 'delete' THEN c_name END AS c_name,
       CASE WHEN type <> 'delete' THEN c_acctbal END AS c_acctbal,
       CASE WHEN type IN ('update', 'delete') THEN c_mktsegment END AS old_segment
FROM changes"""
ORACLES["cdc_snapshot_as_insert"] = CUSTOMERS + """
SELECT CASE WHEN type = 'read' THEN 'insert' ELSE type END AS type, count(*) AS n
FROM changes GROUP BY 1"""
ORACLES["cdc_envelope_text"] = CUSTOMERS + """
SELECT seq, 'shop' AS database, 'customer' AS "tableName", type,
       CASE WHEN type IN ('update', 'delete') THEN 5 ELSE 0 END AS n_before,
       CASE WHEN type = 'delete' THEN 0 ELSE 5 END AS n_after,
       CASE WHEN type <> 'delete' THEN c_name END AS c_name
FROM changes"""
ORACLES["cdc_null_columns"] = """
SELECT c_custkey * 3 AS seq, 5 AS n_kept, 5 AS n_dropped FROM customer
UNION ALL SELECT c_custkey * 3 + 1, 2, 2 FROM customer
UNION ALL SELECT c_custkey * 3 + 2, 2, 1 FROM customer WHERE c_custkey % 5 = 0"""
ORACLES["cdc_drop_deletes"] = CUSTOMERS + """
SELECT seq, type FROM changes WHERE type IS DISTINCT FROM 'delete'"""
ORACLES["cdc_dirty"] = LOGS + """
SELECT seq, '{"event_id": ' || CAST(seq AS VARCHAR) AS value, 'bad_envelope' AS reason,
       'parse_envelopes' AS stage
FROM logs WHERE kind = 'error'"""
ORACLES["capture_job_stream"] = CUSTOMERS + """
SELECT seq, 'shop' AS database, 'customer' AS "tableName", type,
       CASE WHEN type <> 'delete' THEN c_name END AS c_name
FROM changes"""

# All three business tables.
SHOP = """
WITH keys AS (
  SELECT 'orders' AS tbl, o_orderkey AS seq FROM orders
  UNION ALL SELECT 'customer', c_custkey FROM customer
  UNION ALL SELECT 'nation', CAST(n_nationkey AS BIGINT) FROM nation),
changes AS (
  SELECT tbl, seq,
         CASE seq % 4 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' WHEN 2 THEN 'delete'
              ELSE 'read' END AS type
  FROM keys),
kept AS (SELECT * FROM changes WHERE type <> 'delete'),
dead AS (
  SELECT *, CASE WHEN tbl = 'nation' AND type = 'insert' THEN 'unknown_sink_type'
                 ELSE 'no_rule' END AS reason
  FROM kept WHERE tbl = 'nation' OR type = 'read')
"""
ORACLES["change_feed_kafka_shape"] = SHOP + """
SELECT 'shop' AS database, tbl AS "tableName", type, count(*) AS n FROM changes GROUP BY tbl, type"""
ORACLES["route_topic"] = SHOP + """
SELECT CASE type WHEN 'insert' THEN 'dwd_orders' ELSE 'dwd_orders_upd' END AS topic, seq,
       CASE type WHEN 'insert' THEN 3 ELSE 2 END AS n_columns, o_orderkey,
       CASE type WHEN 'insert' THEN o_custkey END AS o_custkey,
       CASE type WHEN 'insert' THEN o_totalprice END AS o_totalprice,
       CASE type WHEN 'update' THEN o_orderstatus END AS o_orderstatus
FROM kept JOIN orders ON seq = o_orderkey
WHERE tbl = 'orders' AND type IN ('insert', 'update')"""
ORACLES["route_dim"] = SHOP + """
SELECT 'dim_customer' AS sink_table, CAST(c_custkey AS VARCHAR) AS pk, seq, 3 AS n_columns, c_name,
       CASE type WHEN 'insert' THEN c_mktsegment END AS c_mktsegment,
       CASE type WHEN 'update' THEN c_acctbal END AS c_acctbal
FROM kept JOIN customer ON seq = c_custkey
WHERE tbl = 'customer' AND type IN ('insert', 'update')"""
ORACLES["route_unmatched"] = SHOP + """
SELECT seq, reason, 'route_changes' AS stage, tbl AS "tableName", type FROM dead"""
ORACLES["change_topic_sink"] = SHOP + """
SELECT CASE type WHEN 'insert' THEN 'dwd_orders' ELSE 'dwd_orders_upd' END AS topic, count(*) AS n, count(*) AS keys,
       CAST(sum(CASE type WHEN 'insert' THEN CAST(round(o_totalprice * 100) AS BIGINT) + o_custkey ELSE ascii(o_orderstatus) END
                + seq) AS BIGINT) AS total
FROM kept JOIN orders ON seq = o_orderkey WHERE tbl = 'orders' AND type IN ('insert', 'update') GROUP BY 1
UNION ALL SELECT 'dead_letter', count(*), count(*), CAST(sum(length(reason)) AS BIGINT) FROM dead"""
ORACLES["change_job_topics"] = ORACLES["change_topic_sink"]
ORACLES["connected_job_stream"] = SHOP + """
SELECT CASE type WHEN 'insert' THEN 'dwd_orders' ELSE 'dwd_orders_upd' END AS topic, CAST(NULL AS VARCHAR) AS reason,
       count(*) AS n, count(*) AS keys
FROM kept WHERE tbl = 'orders' AND type IN ('insert', 'update') GROUP BY 1
UNION ALL SELECT 'dead_letter', reason, count(*), count(*) FROM dead GROUP BY reason
UNION ALL SELECT 'dead_letter', unnest(['pk_not_in_columns', 'bad_topic', 'bad_envelope']), 1, 1
UNION ALL SELECT 'dim_customer', NULL, count(*), count(*)
FROM kept WHERE tbl = 'customer' AND type IN ('insert', 'update')"""
ORACLES["change_job_dims"] = SHOP + """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       CASE type WHEN 'insert' THEN c_mktsegment END AS c_mktsegment,
       CASE type WHEN 'update' THEN c_acctbal END AS c_acctbal
FROM kept JOIN customer ON seq = c_custkey
WHERE tbl = 'customer' AND type IN ('insert', 'update')"""
ORACLES["dim_catalog_table"] = ORACLES["change_job_dims"]
ORACLES["route_asof"] = """
WITH changes AS (
  SELECT o_orderkey AS seq,
         CASE o_orderkey % 4 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' WHEN 2 THEN 'delete'
              ELSE 'read' END AS type
  FROM orders),
rules(seq, type, sink_type, sink_table, n) AS (
  VALUES (100, 'insert', 'topic', 'dwd_orders', 2), (700, 'insert', 'topic', 'dwd_orders_v2', 2),
         (400, 'update', 'topic', 'dwd_orders_upd', 2), (1200, 'read', 'clickhouse', 'x', 1)),
both_feeds AS (
  SELECT seq, type, sink_type, sink_table, n, true AS is_rule FROM rules
  UNION ALL SELECT seq, type, NULL, NULL, NULL, false FROM changes WHERE type <> 'delete'),
filled AS (
  SELECT seq, type, is_rule,
         last_value(sink_type IGNORE NULLS) OVER w AS sink_type,
         last_value(sink_table IGNORE NULLS) OVER w AS sink_table,
         last_value(n IGNORE NULLS) OVER w AS n
  FROM both_feeds
  WINDOW w AS (PARTITION BY type ORDER BY seq, is_rule DESC
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT seq, type, sink_table, CAST(coalesce(n, 0) AS INTEGER) AS n_columns,
       CASE WHEN n IS NULL THEN 'no_rule' WHEN sink_type <> 'topic' THEN 'unknown_sink_type'
       END AS reason
FROM filled WHERE NOT is_rule"""
ORACLES["route_connected_stream"] = ORACLES["route_asof"]
# The first rule of a key also takes the changes that waited for it.
ORACLES["unmatched_released_stream"] = (
    ORACLES["route_asof"].replace("(100, 'insert'", "(0, 'insert'").replace("(400, 'update'", "(0, 'update'").replace("(1200, 'read'", "(0, 'read'")
)

# The rule history that the part recipe writes.
RULES = """
WITH parts AS (
  SELECT p_partkey AS seq, lower(replace(p_brand, '#', '_')) AS brand,
         (['insert', 'update', 'delete'])[p_size % 3 + 1] AS op,
         (['update', 'delete', 'insert'])[p_size % 3 + 1] AS other_op,
         p_partkey % 13 = 0 AS gone
  FROM part),
bound AS (
  SELECT seq, gone, brand AS old_brand,
         CASE WHEN seq % 17 = 0 THEN other_op ELSE op END AS old_op,
         CASE WHEN NOT gone THEN brand END AS source_table,
         CASE WHEN NOT gone THEN op END AS operate_type,
         CASE WHEN NOT gone THEN (['kafka', 'hbase', 'topic', 'dim', 'clickhouse'])[seq % 5 + 1]
         END AS sink_type,
         CASE WHEN NOT gone THEN 't_' || brand END AS sink_table,
         CASE WHEN gone OR seq % 11 = 0 THEN NULL
              WHEN seq % 7 = 0 THEN 'id, p_name'
              WHEN seq % 10 = 1 THEN 'name,p_size'
              WHEN seq % 3 = 0 THEN 'id,p_name,p_size,'
              ELSE 'id,p_type,p_name' END AS sink_columns,
         CASE WHEN NOT gone AND seq % 19 = 0 THEN 'p_name' END AS sink_pk,
         CASE WHEN NOT gone AND seq % 2 = 0 THEN 'comment=parts' END AS sink_extend,
         CASE WHEN gone THEN 'delete' ELSE 'update' END AS change_type
  FROM parts),
typed AS (
  SELECT * EXCLUDE (sink_type, sink_pk, sink_extend),
         CASE WHEN sink_type IN ('kafka', 'topic') THEN 'topic'
              WHEN sink_type IN ('hbase', 'dim') THEN 'dim' ELSE sink_type END AS sink_type,
         CASE WHEN sink_type IN ('hbase', 'dim') THEN coalesce(sink_pk, 'id') ELSE sink_pk
         END AS sink_pk,
         coalesce(sink_extend, '') AS sink_extend,
         string_split(rtrim(sink_columns, ','), ',') AS cols
  FROM bound),
checked AS (
  SELECT *, CASE WHEN gone THEN 'empty_rule' WHEN cols IS NULL THEN 'no_columns'
                 WHEN sink_type = 'dim' AND NOT list_contains(cols, sink_pk)
                 THEN 'pk_not_in_columns' END AS first_reason
  FROM typed),
table_keys AS (
  SELECT sink_table, arg_min(sink_pk, seq) AS table_pk FROM checked
  WHERE first_reason IS NULL AND sink_type = 'dim' GROUP BY sink_table),
validated AS (
  SELECT c.*, CASE WHEN first_reason IS NULL AND sink_type = 'dim' AND sink_pk <> table_pk
                   THEN 'other_pk' ELSE first_reason END AS reason
  FROM checked c LEFT JOIN table_keys USING (sink_table)),
valid AS (SELECT * FROM validated WHERE reason IS NULL),
latest AS (
  SELECT *, row_number() OVER (PARTITION BY source_table, operate_type ORDER BY seq DESC) AS age
  FROM valid)
"""
CURRENT = """
SELECT source_table, operate_type, sink_type, sink_table, array_to_string(cols, ',') AS sink_columns,
       seq
"""
ORACLES["rules_bind"] = RULES + """
SELECT seq, source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend,
       change_type
FROM bound"""
ORACLES["rules_validate"] = RULES + """
SELECT seq, sink_type, sink_pk, sink_extend, reason FROM validated"""
ORACLES["rules_trim_columns"] = RULES.replace(
    "string_split(rtrim(sink_columns, ','), ',')",
    "string_split(replace(rtrim(sink_columns, ','), ' ', ''), ',')",
) + "SELECT seq, list_contains(cols, 'p_name') AS has_name, reason FROM validated"
ORACLES["rules_current"] = RULES + CURRENT + "FROM latest WHERE age = 1"
ORACLES["rules_current_deletes"] = RULES + """,
happened AS (
  SELECT source_table, operate_type, seq, false AS removed FROM valid
  UNION ALL
  SELECT old_brand, old_op, seq, true FROM validated
  WHERE gone OR (reason IS NULL AND (old_brand <> source_table OR old_op <> operate_type))),
last_event AS (
  SELECT source_table, operate_type, max(seq) AS seq, arg_max(removed, seq) AS removed
  FROM happened GROUP BY source_table, operate_type)
SELECT v.source_table, v.operate_type, v.sink_type, v.sink_table,
       array_to_string(v.cols, ',') AS sink_columns, v.seq
FROM last_event e JOIN valid v USING (source_table, operate_type, seq)
WHERE NOT e.removed"""
ORACLES["rules_dead"] = RULES + """
SELECT seq, reason, 'validate_rules' AS stage, source_table FROM validated WHERE reason IS NOT NULL"""
ORACLES["rule_feed_snapshot"] = RULES + """
SELECT source_table, operate_type, sink_type, sink_table, seq FROM latest WHERE age = 1
UNION ALL
SELECT DISTINCT lower(p_type), 'insert', 'topic', 'snap_' || lower(p_type), -1 FROM part"""
ORACLES["dim_tables"] = RULES + """,
dims AS (SELECT * FROM valid WHERE sink_type = 'dim'),
mentions AS (
  SELECT sink_table, seq, unnest(cols) AS col, generate_subscripts(cols, 1) AS pos FROM dims),
first_mentions AS (
  SELECT sink_table, col, min(seq * 100 + pos) AS place FROM mentions GROUP BY sink_table, col),
firsts AS (
  SELECT sink_table, arg_min(sink_pk, seq) AS sink_pk, arg_min(sink_extend, seq) AS sink_extend
  FROM dims GROUP BY sink_table)
SELECT m.sink_table,
       CAST(row_number() OVER (PARTITION BY m.sink_table ORDER BY place) - 1 AS INTEGER) AS position,
       col AS column, col = sink_pk AS is_pk, sink_extend
FROM first_mentions m JOIN firsts USING (sink_table)"""
ORACLES["route_by_part_rules"] = RULES + """,
now AS (SELECT * FROM latest WHERE age = 1 AND operate_type = 'insert')
SELECT p_partkey AS seq, n.sink_table,
       CASE WHEN n.sink_type = 'dim' AND n.sink_pk = 'id' THEN CAST(p_partkey AS VARCHAR)
            WHEN n.sink_type = 'dim' THEN p_name END AS pk,
       CAST(coalesce(CAST(list_contains(n.cols, 'id') AS INTEGER)
                     + CAST(list_contains(n.cols, 'p_name') AS INTEGER), 0) AS INTEGER) AS n_columns,
       CASE WHEN n.cols IS NULL THEN 'no_rule'
            WHEN n.sink_type NOT IN ('topic', 'dim') THEN 'unknown_sink_type' END AS reason
FROM part LEFT JOIN now n ON n.source_table = lower(replace(p_brand, '#', '_'))"""
ORACLES["route_asof_part_rules"] = RULES + """,
changes AS (
  SELECT p_partkey AS seq, p_name, lower(replace(p_brand, '#', '_')) AS brand,
         unnest(['insert', 'update', 'delete']) AS type
  FROM part)
SELECT c.seq, c.type, n.sink_table,
       CASE WHEN n.sink_type = 'dim' AND n.sink_pk = 'id' THEN CAST(c.seq AS VARCHAR)
            WHEN n.sink_type = 'dim' THEN p_name END AS pk,
       CAST(coalesce(CAST(list_contains(n.cols, 'id') AS INTEGER)
                     + CAST(list_contains(n.cols, 'p_name') AS INTEGER), 0) AS INTEGER) AS n_columns,
       CASE WHEN n.cols IS NULL THEN 'no_rule'
            WHEN n.sink_type NOT IN ('topic', 'dim') THEN 'unknown_sink_type' END AS reason
FROM changes c ASOF LEFT JOIN valid n
  ON n.source_table = c.brand AND n.operate_type = c.type AND c.seq >= n.seq"""
ORACLES["rules_key_after_delete"] = """
WITH p AS (SELECT CAST(p_partkey AS BIGINT) AS n, p_partkey % 2 = 1 AS odd FROM part)
SELECT n * 3 AS seq, 'insert' AS change_type, 'id' AS sink_pk, CAST(NULL AS VARCHAR) AS reason, NOT odd AS in_force FROM p
UNION ALL SELECT n * 3 + 1, 'delete', NULL, 'empty_rule', false FROM p WHERE odd
UNION ALL SELECT n * 3 + 2, 'insert', 'x', CASE WHEN NOT odd THEN 'other_pk' END, odd FROM p"""

# Three changes per customer; a NULL in has_… means the column is absent from the change.
DIM = """
WITH changes AS (
  SELECT c_custkey AS pk, c_custkey * 3 AS seq, c_name, c_nationkey, c_acctbal, c_mktsegment,
         true AS is_full, true AS has_bal, true AS has_seg
  FROM customer
  UNION ALL
  SELECT c_custkey, c_custkey * 3 + 1, NULL, NULL, -c_acctbal, NULL, false, true, false FROM customer
  UNION ALL
  SELECT c_custkey, c_custkey * 3 + 2, NULL, NULL, NULL, NULL, false, false, true
  FROM customer WHERE c_custkey % 5 = 0)
"""
ORACLES["dim_merge"] = DIM + """
SELECT CAST(pk AS VARCHAR) AS c_custkey,
       arg_max_null(c_name, seq) FILTER (WHERE is_full) AS c_name,
       CAST(arg_max_null(c_nationkey, seq) FILTER (WHERE is_full) AS VARCHAR) AS c_nationkey,
       arg_max_null(c_acctbal, seq) FILTER (WHERE has_bal) AS c_acctbal,
       arg_max_null(c_mktsegment, seq) FILTER (WHERE has_seg) AS c_mktsegment
FROM changes GROUP BY pk"""
ORACLES["dim_store_compacted"] = ORACLES["dim_merge"]
ORACLES["dim_merge_stream"] = ORACLES["dim_merge"]
ORACLES["dim_catalog_merge"] = ORACLES["dim_merge"]
ORACLES["dim_cells"] = DIM + """,
cells AS (
  SELECT pk, seq, 'c_custkey' AS col, CAST(pk AS VARCHAR) AS text FROM changes
  UNION ALL SELECT pk, seq, 'c_name', c_name FROM changes WHERE is_full
  UNION ALL SELECT pk, seq, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM changes WHERE is_full
  UNION ALL SELECT pk, seq, 'c_acctbal', NULL FROM changes WHERE has_bal
  UNION ALL SELECT pk, seq, 'c_mktsegment', c_mktsegment FROM changes WHERE has_seg)
SELECT 'dim_customer' AS sink_table, CAST(pk AS VARCHAR) AS pk, col AS column,
       arg_max_null(text, seq) AS text, max(seq) AS seq
FROM cells GROUP BY pk, col"""
ORACLES["change_job_two_runs"] = SHOP + """
SELECT CASE type WHEN 'insert' THEN 'dwd_orders' ELSE 'dwd_orders_upd' END AS topic, count(*) AS n,
       count(DISTINCT seq) AS keys, CAST(sum(seq) AS BIGINT) AS ids
FROM kept WHERE tbl = 'orders' AND type IN ('insert', 'update') GROUP BY 1
UNION ALL SELECT 'dead_letter', count(*), count(*), NULL FROM dead
UNION ALL SELECT 'dim_customer', count(*), count(*), CAST(sum(seq) AS BIGINT)
FROM kept WHERE tbl = 'customer' AND type IN ('insert', 'update')"""
ORACLES["capture_wrapped_records"] = CUSTOMERS + """
SELECT seq, 'shop' AS database, 'customer' AS "tableName", type,
       CASE WHEN type <> 'delete' THEN c_name END AS c_name, CAST(NULL AS VARCHAR) AS reason
FROM changes"""
ORACLES["rules_bad_names"] = """
WITH r AS (SELECT CAST(n_nationkey AS BIGINT) AS seq, n_nationkey % 2 = 0 AS is_topic, n_nationkey % 5 AS k FROM nation)
SELECT seq, CASE WHEN is_topic THEN 'topic' ELSE 'dim' END AS sink_type,
       CASE k WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN 'dead_letter' WHEN 3 THEN 'a/b' ELSE 'good' END AS sink_table,
       CASE WHEN is_topic AND k < 4 THEN 'bad_topic' WHEN NOT is_topic AND k < 2 THEN 'no_table'
            WHEN NOT is_topic AND k = 3 THEN 'bad_table'
            WHEN NOT is_topic AND k = 4 AND seq = 19 THEN 'column_case' END AS reason
FROM r"""
ORACLES["dead_letter_replay"] = SHOP + """
SELECT tbl || '/' || seq AS key,
       CASE WHEN type <> 'read' THEN 'dim_customer' END AS sink_table,
       CASE WHEN type <> 'read' THEN CAST(seq AS VARCHAR) END AS pk,
       CASE WHEN type <> 'read' THEN 3 ELSE 0 END AS n_columns,
       CASE WHEN type = 'read' THEN 'no_rule' END AS reason
FROM kept WHERE tbl = 'customer'
UNION ALL SELECT tbl || '/' || seq, NULL, NULL, 0, reason FROM dead WHERE tbl <> 'customer' AND reason = 'no_rule'"""

# Rules that every line of an order rewrites, read in chunks during passes 2 to 5.
LINES = """
WITH lines AS (
  SELECT DISTINCT l_orderkey AS ord, CAST(l_linenumber AS BIGINT) AS num FROM lineitem),
all_changes AS (
  SELECT *, (num * 1000000000000 + ord) * 10 AS seq, ord % 4 AS chunk, (ord + num) % 50 = 0 AS broken FROM lines),
windows AS (
  SELECT CAST(c AS BIGINT) AS chunk, (c + 2) * 10000000000000 + 5 AS low, (c + 3) * 10000000000000 + 5 AS high,
         ((c + 2) * 1000000000000 + 3000) * 10 + 5 AS read_at
  FROM range(4) t(c)),
read AS (
  SELECT c.chunk, ord, max(num) AS num FROM all_changes c JOIN windows w ON c.chunk = w.chunk AND seq < read_at
  GROUP BY c.chunk, ord HAVING max(num) <> 4)
"""
ORACLES["rule_snapshot_handover"] = LINES + """,
kept AS (
  SELECT r.*, w.low FROM read r JOIN windows w USING (chunk)
  WHERE NOT EXISTS (SELECT 1 FROM all_changes c WHERE c.ord = r.ord AND NOT broken AND c.seq > w.low AND c.seq <= w.high))
SELECT low AS seq, row_number() OVER (PARTITION BY chunk ORDER BY 'o' || ord) AS row, 'read' AS type, 'o' || ord AS source_table,
       CAST(NULL AS VARCHAR) AS old_source_table, 'x' || num AS sink_table, CASE WHEN num = 3 THEN 'no_columns' END AS reason
FROM kept
UNION ALL
SELECT seq, 0, CASE num WHEN 1 THEN 'insert' WHEN 4 THEN 'delete' ELSE 'update' END, CASE WHEN num <> 4 THEN 'o' || ord END,
       CASE WHEN num <> 1 THEN 'o' || ord END, CASE WHEN num <> 4 THEN 'x' || num END,
       CASE num WHEN 3 THEN 'no_columns' WHEN 4 THEN 'empty_rule' END
FROM all_changes WHERE NOT broken AND seq > (SELECT min(low) FROM windows)
UNION ALL SELECT seq, 0, NULL, NULL, NULL, NULL, 'bad_record' FROM all_changes WHERE broken"""
ORACLES["rule_snapshot_state"] = LINES + """,
good AS (SELECT * FROM all_changes WHERE NOT broken),
seen AS (
  SELECT ord, num, low AS seq FROM read JOIN windows w USING (chunk)
  WHERE NOT EXISTS (SELECT 1 FROM good c WHERE c.ord = read.ord AND c.seq > w.low AND c.seq <= w.high)
  UNION ALL SELECT ord, num, seq FROM good WHERE seq > (SELECT min(low) FROM windows)),
events AS (SELECT *, num = 4 AS gone FROM seen WHERE num <> 3)
SELECT 'o' || ord AS source_table, 'insert' AS operate_type, 'x' || arg_max(num, seq) AS sink_table
FROM events GROUP BY ord HAVING NOT arg_max(gone, seq)"""
ORACLES["capture_encoded_values"] = """
WITH c AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
SELECT o_orderkey AS seq, 'insert' AS type,
       CAST(CAST(CASE WHEN o_orderkey % 2 = 1 THEN -cents ELSE cents END AS DECIMAL(30, 2)) / 100 AS DECIMAL(30, 2))::VARCHAR AS price,
       regexp_replace((o_orderkey::HUGEINT * 18446744073709551616 + cents)::VARCHAR, '(.{5})$', '.\\1') AS total,
       strftime(o_orderdate, '%Y-%m-%d') AS day,
       regexp_replace(strftime(o_orderdate + to_microseconds(o_orderkey), '%Y-%m-%d %H:%M:%S.%f'), '\\.?0*$', '') AS at,
       o_orderstatus AS status, CAST(NULL AS VARCHAR) AS reason
FROM c"""
