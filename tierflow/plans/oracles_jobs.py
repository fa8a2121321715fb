"""Independent DuckDB SQL for the streaming and daily-job queries."""

from __future__ import annotations

from tierflow.plans.oracles import KPI_DAILY
from tierflow.plans.oracles_io import EV_FILE, IO_ORACLES

STREAM_BRONZE = f"""
SELECT event_id, ts, user_id, event_type, value, props, {EV_FILE} AS _source_file, 'run-20240201' AS _run_id
FROM events
"""

STREAM_UPSERT = f"""
SELECT event_id, ts, user_id, event_type,
       CASE WHEN event_type = 'error' THEN value + 1.0 ELSE value END AS value, props,
       CASE WHEN event_type = 'error' THEN 'events_corrections.jsonl' ELSE {EV_FILE} END AS _source_file
FROM events
"""

STREAM_DEDUPE = f"""
SELECT event_id, ts, user_id, event_type, value, props,
       CASE WHEN event_type = 'error' THEN 'events_resent.jsonl' ELSE {EV_FILE} END AS _source_file,
       CASE WHEN event_type = 'error' THEN 'run-resent' ELSE 'run-20240201' END AS _run_id,
       CAST(CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS BIGINT) AS copies
FROM events
"""

# the days that the second and third delivery change: all fifteenths; the tenths, and
# the days after them that lose their rows
KPI_DAYS_ANEW = """
SELECT 'run-01' AS run_id, CAST(NULL AS BIGINT) AS days
UNION ALL
SELECT 'run-02', COUNT(DISTINCT CAST(ts AS DATE)) FROM events WHERE day(ts) = 15
UNION ALL
SELECT 'run-03', COUNT(DISTINCT d) FROM (
  SELECT unnest([CAST(ts AS DATE), CAST(ts + INTERVAL 1 DAY AS DATE)]) AS d FROM events WHERE day(ts) = 10 AND event_id % 2 = 0)
"""

# customer -> orders -> lineitem after one run of the daily job
JOB_STATE = """
li AS (SELECT * FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
                        l_extendedprice DESC NULLS LAST) = 1),
c_good AS (SELECT * FROM customer WHERE NOT COALESCE(c_acctbal < 0, FALSE)),
o_good AS (SELECT * FROM orders o WHERE o_custkey IS NULL
           OR EXISTS (SELECT 1 FROM c_good c WHERE c.c_custkey = o.o_custkey)),
l_good AS (SELECT * FROM li WHERE l_orderkey IS NULL
           OR EXISTS (SELECT 1 FROM o_good o WHERE o.o_orderkey = li.l_orderkey)),
k AS (SELECT (SELECT COUNT(*) FROM customer) AS c_n, (SELECT COUNT(*) FROM orders) AS o_n,
             (SELECT COUNT(*) FROM lineitem) AS l_raw, (SELECT COUNT(*) FROM li) AS l_n,
             (SELECT COUNT(*) FROM c_good) AS c_g, (SELECT COUNT(*) FROM o_good) AS o_g,
             (SELECT COUNT(*) FROM l_good) AS l_g,
             (SELECT date_diff('day', MIN(CAST(l_shipdate AS DATE)), MAX(CAST(l_shipdate AS DATE))) + 1
              FROM l_good) AS days)
"""

RUN_SUMMARY = f"""
WITH {JOB_STATE}
SELECT 'run-1' AS run_id, CAST(0 AS INTEGER) AS seq, 'ingest' AS step, 'customer' AS table_name,
       'ingested' AS status, CAST(NULL AS BIGINT) AS rows_in, c_n AS rows_out, CAST(NULL AS BIGINT) AS quarantined
FROM k
UNION ALL SELECT 'run-1', 1, 'ingest', 'lineitem', 'ingested', NULL, l_raw, NULL FROM k
UNION ALL SELECT 'run-1', 2, 'ingest', 'orders', 'ingested', NULL, o_n, NULL FROM k
UNION ALL SELECT 'run-1', 3, 'silver', 'customer', 'ok', NULL, c_n, NULL FROM k
UNION ALL SELECT 'run-1', 4, 'quality', 'customer', 'ok', c_n, c_g, c_n - c_g FROM k
UNION ALL SELECT 'run-1', 5, 'silver', 'orders', 'ok', NULL, o_n, NULL FROM k
UNION ALL SELECT 'run-1', 6, 'quality', 'orders', 'ok', o_n, o_g, o_n - o_g FROM k
UNION ALL SELECT 'run-1', 7, 'silver', 'lineitem', 'ok', NULL, l_n, NULL FROM k
UNION ALL SELECT 'run-1', 8, 'quality', 'lineitem', 'ok', l_n, l_g, l_n - l_g FROM k
UNION ALL SELECT 'run-1', 9, 'gold', 'dim_date', 'ok', NULL, days, NULL FROM k
UNION ALL SELECT 'run-1', 10, 'gold', 'fact_lineitem', 'ok', NULL, l_g, NULL FROM k
UNION ALL SELECT 'run-1', 11, 'validate', NULL, 'pass', NULL, NULL, NULL FROM k
"""

RUN_LEDGER = f"""
WITH {JOB_STATE}
SELECT 'bronze.customer' AS table_name, 2 * c_n AS rows FROM k
UNION ALL SELECT 'bronze.orders', 2 * o_n FROM k
UNION ALL SELECT 'bronze.lineitem', 2 * l_raw FROM k
UNION ALL SELECT 'silver.customer', c_g FROM k
UNION ALL SELECT 'silver.orders', o_g FROM k
UNION ALL SELECT 'silver.lineitem', l_g FROM k
UNION ALL SELECT 'quarantine.customer', c_n - c_g FROM k
UNION ALL SELECT 'quarantine.orders', o_n - o_g FROM k
UNION ALL SELECT 'quarantine.lineitem', l_n - l_g FROM k
UNION ALL SELECT 'gold.fact_lineitem', l_g FROM k
UNION ALL SELECT 'gold.dim_date', days FROM k
"""

RUN_RULES = f"""
WITH {JOB_STATE},
w AS (SELECT (SELECT COUNT(*) FROM customer WHERE c_mktsegment IS NULL) AS seg,
             (SELECT COUNT(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')) AS st,
             (SELECT COUNT(*) FROM li WHERE l_quantity < 1 OR l_quantity > 45) AS qty)
SELECT 'customer' AS table_name, 'balance_non_negative' AS rule_id,
       CASE WHEN c_n > c_g THEN 'quarantine' ELSE 'ok' END AS status, c_n AS rows_in, c_n - c_g AS quarantined FROM k
UNION ALL SELECT 'customer', 'segment_known', CASE WHEN seg > 0 THEN 'warn' ELSE 'ok' END, c_n, seg FROM k, w
UNION ALL SELECT 'orders', 'customer_exists', CASE WHEN o_n > o_g THEN 'quarantine' ELSE 'ok' END, o_n, o_n - o_g FROM k
UNION ALL SELECT 'orders', 'status_allowed', CASE WHEN st > 0 THEN 'warn' ELSE 'ok' END, o_n, st FROM k, w
UNION ALL SELECT 'lineitem', 'order_exists', CASE WHEN l_n > l_g THEN 'quarantine' ELSE 'ok' END, l_n, l_n - l_g FROM k
UNION ALL SELECT 'lineitem', 'quantity_range', CASE WHEN qty > 0 THEN 'warn' ELSE 'ok' END, l_n, qty FROM k, w
"""

# the whole input as one delivery: where every key must be in the end
FINAL_STATE = f"""
WITH {JOB_STATE}
SELECT 'customer' AS table_name, CAST(c_custkey AS VARCHAR) AS key,
       CASE WHEN c_acctbal < 0 THEN 'quarantine' ELSE 'silver' END AS layer,
       CASE WHEN c_acctbal < 0 THEN 'balance_non_negative' END AS reason
FROM customer
UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR), CASE WHEN g.k IS NULL THEN 'quarantine' ELSE 'silver' END,
       CASE WHEN g.k IS NULL THEN 'customer_exists' END
FROM orders o LEFT JOIN (SELECT o_orderkey AS k FROM o_good) g ON g.k = o.o_orderkey
UNION ALL SELECT 'lineitem', CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR),
       CASE WHEN g.k IS NULL THEN 'quarantine' ELSE 'silver' END, CASE WHEN g.k IS NULL THEN 'order_exists' END
FROM li LEFT JOIN (SELECT DISTINCT o_orderkey AS k FROM o_good) g ON g.k = li.l_orderkey
"""

RUN_EVALUATED = f"""
WITH {JOB_STATE},
o_came AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c_good WHERE c_custkey % 2 <> 0)),
l_came AS (SELECT * FROM li WHERE l_orderkey IN (SELECT o_orderkey FROM o_came))
SELECT 'customer' AS table_name, COUNT(*) AS rows_in, COUNT(*) FILTER (NOT COALESCE(c_acctbal < 0, FALSE)) AS rows_out,
       COUNT(*) FILTER (c_acctbal < 0) AS quarantined FROM customer WHERE c_custkey % 2 <> 0
UNION ALL SELECT 'orders', COUNT(*), COUNT(*), 0 FROM o_came
UNION ALL SELECT 'lineitem', COUNT(*), COUNT(*), 0 FROM l_came
"""

# keys that are null or half null: one row for each, in quarantine, after every run
RUN_NULL_KEYS = """
WITH c AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 10 <> 0),
lost AS (SELECT COUNT(*) > 0 AS any_lost FROM customer WHERE c_custkey % 10 = 0),
o AS (SELECT o_orderkey % 9 = 0 OR (o_custkey IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM c WHERE c.c_custkey = o_custkey AND NOT COALESCE(c_acctbal < 0, FALSE))) AS bad FROM orders),
n AS (SELECT 'customer' AS table_name, (SELECT COUNT(*) FROM c WHERE NOT COALESCE(c_acctbal < 0, FALSE)) AS silver,
             (SELECT COUNT(*) FROM c WHERE c_acctbal < 0) + (SELECT CAST(any_lost AS BIGINT) FROM lost) AS quarantine
      UNION ALL SELECT 'orders', (SELECT COUNT(*) FROM o WHERE NOT bad), (SELECT COUNT(*) FROM o WHERE bad))
SELECT CAST(run AS INTEGER) AS run, table_name, silver, quarantine, 'pass' AS verdict
FROM n, (VALUES (1), (2), (3)) runs(run)
"""

_ORDERS_OF = f"""
WITH {JOB_STATE},
co AS (SELECT o_custkey AS c_custkey, COUNT(*) AS n_orders, SUM(CAST(o_totalprice AS DECIMAL(15, 2))) AS order_value,
              MAX(CAST(o_orderdate AS DATE)) AS last_order FROM o_good GROUP BY o_custkey),
sv AS (SELECT c.c_mktsegment, COUNT(*) AS n_customers, CAST(SUM(COALESCE(order_value, 0)) AS DECIMAL(18, 2)) AS total_value
       FROM c_good c LEFT JOIN co ON co.c_custkey = c.c_custkey GROUP BY c.c_mktsegment)
"""

SQL_MODEL_BEST_SEGMENTS = _ORDERS_OF + """
SELECT c_mktsegment, n_customers, CAST(total_value AS DOUBLE) AS total_value,
       CAST(CAST(ROUND(CAST(total_value AS DECIMAL(30, 10)) / n_customers, 2) AS DECIMAL(18, 2)) AS DOUBLE) AS value_per_customer
FROM sv QUALIFY total_value * SUM(n_customers) OVER () > n_customers * SUM(total_value) OVER ()
"""

JOB_ORACLES = {
    "stream_bronze": STREAM_BRONZE,
    "stream_upsert": STREAM_UPSERT,
    "stream_dedupe": STREAM_DEDUPE,
    "stream_rescue": IO_ORACLES["rescued_columns"],
    "run_summary": RUN_SUMMARY,
    "run_ledger": RUN_LEDGER,
    "run_rules": RUN_RULES,
    "run_late_parent": FINAL_STATE,
    "run_evaluated": RUN_EVALUATED,
    "run_null_keys": RUN_NULL_KEYS,
    "sql_model_customer_orders": _ORDERS_OF + "SELECT * REPLACE (CAST(order_value AS DOUBLE) AS order_value) FROM co",
    "sql_model_segment_value": _ORDERS_OF + "SELECT * REPLACE (CAST(total_value AS DOUBLE) AS total_value) FROM sv",
    "sql_model_best_segments": SQL_MODEL_BEST_SEGMENTS,
    "run_recovery": FINAL_STATE,
    "kpi_incremental": KPI_DAILY,
    "kpi_days_anew": KPI_DAYS_ANEW,
}
