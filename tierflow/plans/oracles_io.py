"""Independent DuckDB SQL for the file, silver-composite and reconciliation
queries of :mod:`tierflow.plans.driver_io` (computed from the raw driver
views; the file round trips must be lossless, so the oracle reads the source
tables directly)."""

from __future__ import annotations

from tierflow.plans.oracles import KPI_DAILY, RATES, avg2, mul2, sum2

EV_FILE = "'events_' || strftime(ts, '%Y%m%d') || '.jsonl'"
WEEKEND = "isodow(ts) IN (6, 7)"

CONTRACT_DRIFT = f"""
SELECT {EV_FILE} AS file, COUNT(*) AS rows,
       CASE WHEN {WEEKEND} THEN 'value' ELSE '' END AS missing,
       CASE WHEN {WEEKEND} THEN 'amt' ELSE '' END AS unexpected
FROM events GROUP BY 1, 3, 4
"""

CONTRACT_ALIGN = f"""
SELECT event_id, ts, user_id, event_type, CASE WHEN {WEEKEND} THEN NULL ELSE value END AS value, props,
       {EV_FILE} AS _source_file
FROM events
"""

DRIFT_POLICIES = f"""
WITH o AS (SELECT {EV_FILE} AS file, {WEEKEND} AS drifted, COUNT(*) AS n FROM events GROUP BY 1, 2),
k AS (SELECT COUNT(*) AS objects, COUNT(*) FILTER (WHERE drifted) AS drifted, CAST(SUM(n) AS BIGINT) AS every,
             CAST(COALESCE(SUM(n) FILTER (WHERE NOT drifted), 0) AS BIGINT) AS plain FROM o)
SELECT policy, CASE WHEN drifted > 0 THEN 'refused' ELSE 'ingested' END AS outcome,
       CASE WHEN drifted > 0 THEN 0 ELSE objects END AS objects, CAST(0 AS BIGINT) AS skipped,
       CASE WHEN drifted > 0 THEN 0 ELSE every END AS rows
FROM k, (VALUES ('raise'), ('abort')) p(policy)
UNION ALL SELECT 'ingest_aligned', 'ingested', objects, 0, every FROM k
UNION ALL SELECT 'skip_file', 'ingested', objects - drifted, drifted, plain FROM k
"""

RESCUED_COLUMNS = f"""
SELECT event_id,
       CASE WHEN {WEEKEND} THEN '{{"amt":"' || CAST(value AS VARCHAR) || '"}}' END AS _rescued_data,
       {EV_FILE} AS _source_file
FROM events
"""

JSON_MAP_EXPLODE = f"""
SELECT rate_date, currency, rate_to_bob, 'fx_rates_' || strftime(rate_date, '%Y%m%d') || '.json' AS _source_file
FROM (SELECT CAST(ts AS DATE) AS rate_date, event_type AS currency, {avg2('value')} AS rate_to_bob
      FROM events GROUP BY 1, 2)
"""

LANDING_INVENTORY = f"""
SELECT DISTINCT {EV_FILE} AS file_name, 'events' AS source, strftime(ts, '%Y%m%d') AS stamp, 'ndjson' AS format
FROM events
"""

ORDERS_FILE = "'orders_' || strftime(o_orderdate, '%Y') || '0101.csv'"

BRONZE_CSV = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       {ORDERS_FILE} AS _source_file
FROM orders
"""

BRONZE_JSON = f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts,
       CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(value AS VARCHAR) AS value, props,
       TIMESTAMP '2024-02-01 06:00:00' AS _ingested_at, {EV_FILE} AS _source_file,
       'run-20240201' AS _run_id
FROM events
"""

BRONZE_LINEAGE = f"""
SELECT {ORDERS_FILE} AS _source_file, 'run-20240201' AS _run_id,
       TIMESTAMP '2024-02-01 06:00:00' AS _ingested_at, COUNT(*) AS rows
FROM orders GROUP BY 1
"""

SQL_VIEWS = f"""
SELECT lower(c.c_mktsegment) AS segment, COUNT(*) AS orders, COUNT(DISTINCT o.o_custkey) AS customers,
       {sum2('o.o_totalprice')} AS balance
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY 1
"""

MERGE_UPSERT = """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderstatus = 'O' THEN 'F'
            ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority,
       CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN 'run-2' ELSE 'run-1' END AS _run_id
FROM orders
"""

SNAPSHOT_OVERWRITE = """
SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority, 'v=2' AS _snapshot
FROM orders
"""

WS = "' \t\n\r' || chr(11) || chr(12)"

SILVER_CUSTOMERS = f"""
SELECT c_custkey AS customer_id,
       trim(CASE WHEN c_mktsegment = 'BUILDING' THEN upper(c_name) ELSE c_name END, {WS}) AS full_name,
       c_nationkey AS nation_key, c_acctbal AS acctbal, lower(c_mktsegment) AS segment,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'run-20240202' ELSE 'run-20240201' END AS _run_id
FROM customer
"""

SILVER_ACCOUNTS = """
SELECT o_orderkey AS account_id, o_custkey AS customer_id, lower(o_orderpriority) AS account_type,
       CAST(o_orderdate AS DATE) AS opened_at, lower(o_orderstatus) AS status, o_totalprice AS balance,
       'run-20240201' AS _run_id
FROM orders
"""

SILVER_TRANSACTIONS = f"""
WITH r AS ({RATES}),
t AS (SELECT CAST(event_id AS VARCHAR) AS txn_id, CAST(user_id AS VARCHAR) AS account_id, ts,
             value AS amount, event_type AS currency, event_type AS txn_type, event_type AS channel,
             props AS counterparty, CAST(NULL AS VARCHAR) AS merchant_category,
             event_type = 'error' AS is_flagged, 'run-20240201' AS _run_id, CAST(ts AS DATE) AS event_date,
             CAST(ts AS DATE) < CAST(ts + INTERVAL 1 HOUR AS DATE) AS is_late
      FROM events),
j AS (SELECT t.*, r.rate_to_bob AS direct FROM t LEFT JOIN r
      ON t.event_date = r.rate_date AND t.currency = r.currency),
f AS (SELECT *, coalesce(direct, last_value(direct) OVER (PARTITION BY currency ORDER BY event_date
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS rate FROM j)
SELECT txn_id, account_id, ts, amount, currency, txn_type, channel, counterparty, merchant_category,
       is_flagged, _run_id, event_date, is_late, {mul2('amount', 'rate')} AS amount_bob
FROM f
"""

# customer -> orders -> lineitem cascade (lineitem deduplicated first)
PIPE = """
li AS (SELECT * FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
                        l_extendedprice DESC NULLS LAST) = 1),
c_good AS (SELECT * FROM customer WHERE NOT COALESCE(c_acctbal < 0, FALSE)),
o_good AS (SELECT * FROM orders o WHERE o_custkey IS NULL
           OR EXISTS (SELECT 1 FROM c_good c WHERE c.c_custkey = o.o_custkey)),
l_good AS (SELECT * FROM li WHERE l_orderkey IS NULL
           OR EXISTS (SELECT 1 FROM o_good o WHERE o.o_orderkey = li.l_orderkey)),
fact AS (SELECT l.l_orderkey, l.l_extendedprice AS amount_orig, o.o_custkey AS customer_id
         FROM l_good l LEFT JOIN o_good o ON l.l_orderkey = o.o_orderkey),
n AS (SELECT (SELECT COUNT(DISTINCT c_custkey) FROM customer) AS c_b, (SELECT COUNT(*) FROM c_good) AS c_s,
             (SELECT COUNT(*) FROM customer) - (SELECT COUNT(*) FROM c_good) AS c_q,
             (SELECT COUNT(DISTINCT o_orderkey) FROM orders) AS o_b, (SELECT COUNT(*) FROM o_good) AS o_s,
             (SELECT COUNT(*) FROM orders) - (SELECT COUNT(*) FROM o_good) AS o_q,
             (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS l_b,
             (SELECT COUNT(*) FROM l_good) AS l_s,
             (SELECT COUNT(*) FROM li) - (SELECT COUNT(*) FROM l_good) AS l_q)
"""

ROWS_SQL = """
SELECT 'row_conservation_customer' AS name, c_b = c_s + c_q AS ok,
       printf('%d keys (c_custkey) in bronze; silver has %d of them and quarantine %d', c_b, c_s, c_q) AS detail FROM n
UNION ALL
SELECT 'row_conservation_orders', o_b = o_s + o_q,
       printf('%d keys (o_orderkey) in bronze; silver has %d of them and quarantine %d', o_b, o_s, o_q) FROM n
UNION ALL
SELECT 'row_conservation_lineitem', l_b = l_s + l_q,
       printf('%d keys (l_orderkey,l_linenumber) in bronze; silver has %d of them and quarantine %d', l_b, l_s, l_q) FROM n
"""

AMOUNT_SQL = f"""
SELECT 'amount_conservation_fact' AS name, a IS NOT DISTINCT FROM b AS ok,
       printf('l_extendedprice adds up to %.2f before and, as amount_orig, to %.2f after', a, b) AS detail
FROM (SELECT (SELECT {sum2('l_extendedprice')} FROM l_good) AS a, (SELECT {sum2('amount_orig')} FROM fact) AS b)
"""

ORPHANS_SQL = """
SELECT 'fact_no_orphans' AS name, n = 0 AS ok, printf('customer_id is null in %d rows', n) AS detail
FROM (SELECT COUNT(*) FILTER (WHERE customer_id IS NULL) AS n FROM fact)
"""

BASELINE_SQL = """
SELECT 'fraud_rate_baseline' AS name, w <= 1.5 AS ok,
       printf('fraud_flag_rate_pct reaches %.2f where %.2f is allowed', w, 1.5) AS detail
FROM (SELECT COALESCE(MAX(fraud_flag_rate_pct), 0.0) AS w FROM kpi)
"""

RECON_ROWS = f"WITH {PIPE} {ROWS_SQL}"
RECON_AMOUNT = f"WITH {PIPE} {AMOUNT_SQL}"
RECON_ORPHANS = f"WITH {PIPE} {ORPHANS_SQL}"
RECON_BASELINE = f"WITH kpi AS ({KPI_DAILY}) {BASELINE_SQL}"
RECON_REPORT = (f"WITH {PIPE}, kpi AS ({KPI_DAILY}) "
                f"{ROWS_SQL} UNION ALL {AMOUNT_SQL} UNION ALL {ORPHANS_SQL} UNION ALL {BASELINE_SQL}")

RECON_VERDICT = f"""
WITH rep AS ({RECON_REPORT}),
a AS (SELECT COUNT(*) FILTER (WHERE NOT ok) AS n_bad,
             COUNT(*) FILTER (WHERE NOT ok AND (name LIKE '%conservation%' OR name LIKE '%orphan%')) AS n_int,
             string_agg(CASE WHEN NOT ok AND (name LIKE '%conservation%' OR name LIKE '%orphan%')
                             THEN detail END, '; ' ORDER BY name, detail) AS integ,
             string_agg(CASE WHEN NOT ok THEN detail END, '; ' ORDER BY name, detail) AS all_bad
      FROM rep)
SELECT CASE WHEN n_bad = 0 THEN 'pass' WHEN n_int > 0 THEN 'fail' ELSE 'pass_with_warnings' END AS verdict,
       CASE WHEN n_bad = 0 THEN 'every check holds'
            WHEN n_int > 0 THEN 'rows or amounts differ between layers: ' || integ
            ELSE 'figures outside their usual range: ' || all_bad END AS explanation,
       n_bad AS mismatches
FROM a
"""

RECON_OVERALL = f"""
SELECT COALESCE(bool_and(ok), TRUE) AS ok, COUNT(*) FILTER (WHERE NOT ok) AS mismatches,
       COALESCE(string_agg(CASE WHEN NOT ok THEN name END, ',' ORDER BY name), '') AS mismatch_names
FROM ({RECON_REPORT})
"""

# what is left when every key that ends in 07 is lost from the layers, but not from the fact
RECON_LOST_ROWS = f"""
WITH {PIPE},
k AS (SELECT (SELECT c_b FROM n) AS c_b, (SELECT o_b FROM n) AS o_b, (SELECT l_b FROM n) AS l_b,
             (SELECT COUNT(*) FROM c_good WHERE c_custkey % 100 <> 7) AS c_s,
             (SELECT COUNT(*) FROM customer WHERE c_custkey % 100 <> 7) AS c_n,
             (SELECT COUNT(*) FROM o_good WHERE o_orderkey % 100 <> 7) AS o_s,
             (SELECT COUNT(*) FROM orders WHERE o_orderkey % 100 <> 7) AS o_n,
             (SELECT COUNT(*) FROM l_good WHERE l_orderkey % 100 <> 7) AS l_s,
             (SELECT COUNT(*) FROM li WHERE l_orderkey % 100 <> 7) AS l_n,
             (SELECT {sum2('l_extendedprice')} FROM l_good WHERE l_orderkey % 100 <> 7) AS a,
             (SELECT {sum2('amount_orig')} FROM fact) AS b,
             (SELECT COUNT(*) FROM fact WHERE customer_id IS NULL) AS orphans),
rep AS (
SELECT 'row_conservation_customer' AS name, c_b = c_n AS ok,
       printf('%d keys (c_custkey) in bronze; silver has %d of them and quarantine %d', c_b, c_s, c_n - c_s) AS detail FROM k
UNION ALL SELECT 'row_conservation_orders', o_b = o_n,
       printf('%d keys (o_orderkey) in bronze; silver has %d of them and quarantine %d', o_b, o_s, o_n - o_s) FROM k
UNION ALL SELECT 'row_conservation_lineitem', l_b = l_n,
       printf('%d keys (l_orderkey,l_linenumber) in bronze; silver has %d of them and quarantine %d', l_b, l_s, l_n - l_s) FROM k
UNION ALL SELECT 'amount_conservation_fact', a IS NOT DISTINCT FROM b,
       printf('l_extendedprice adds up to %.2f before and, as amount_orig, to %.2f after', a, b) FROM k
UNION ALL SELECT 'fact_no_orphans', orphans = 0, printf('customer_id is null in %d rows', orphans) FROM k)
SELECT CASE WHEN COUNT(*) FILTER (WHERE NOT ok) > 0 THEN 'fail' ELSE 'pass' END AS verdict,
       CASE WHEN COUNT(*) FILTER (WHERE NOT ok) > 0 THEN 'rows or amounts differ between layers: ' ||
            string_agg(CASE WHEN NOT ok THEN detail END, '; ' ORDER BY name, detail)
            ELSE 'every check holds' END AS explanation,
       COUNT(*) FILTER (WHERE NOT ok) AS mismatches
FROM rep
"""

BUILD_FX_RATES = f"""
SELECT CAST(ts AS DATE) AS rate_date, event_type AS currency, {avg2('value')} AS rate_to_bob
FROM events GROUP BY 1, 2
"""

BUILD_CUSTOMERS = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS full_name, 'D' || CAST(c_custkey AS VARCHAR) AS doc_id,
       CASE WHEN c_custkey % 9 <> 0 THEN CAST(DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS DATE) END AS birth_date,
       CAST(c_nationkey AS VARCHAR) AS city, lower(c_mktsegment) AS segment,
       CASE WHEN c_acctbal < 0 THEN 'high' ELSE 'low' END AS risk_rating, CAST(NULL AS DATE) AS created_at,
       'run-20240201' AS _run_id
FROM customer
"""

BUILD_ACCOUNTS = """
SELECT CAST(o_orderkey AS VARCHAR) AS account_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       lower(o_orderpriority) AS account_type, 'BOB' AS currency, CAST(o_orderdate AS DATE) AS opened_at,
       lower(o_orderstatus) AS status, 'run-20240201' AS _run_id
FROM orders
"""

RUN_MODEL = f"SELECT account_id, customer_id, account_type, currency, opened_at, status FROM ({BUILD_ACCOUNTS})"

ODD_AMOUNTS = """
SELECT event_id, amount,
       CASE WHEN event_id % 50 IN (1, 2, 4) THEN amount * 2
            ELSE CAST(ROUND(CAST(amount AS DECIMAL(20,6)) * 2, 2) AS DOUBLE) END AS doubled
FROM (SELECT event_id, CASE event_id % 50 WHEN 1 THEN 1e14 WHEN 2 THEN 1e20 WHEN 3 THEN 0.123456789
             WHEN 4 THEN CAST('NaN' AS DOUBLE) WHEN 5 THEN NULL ELSE value END AS amount FROM events)
"""

BRONZE_CSV_QUOTED = """
SELECT doc_id, text, lang, 'documents_' || COALESCE(source, 'none') || '.csv' AS _source_file FROM documents
"""

IO_ORACLES = {
    "bronze_csv_quoted": BRONZE_CSV_QUOTED,
    "bronze_csv_blocks": BRONZE_CSV_QUOTED,
    "contract_drift": CONTRACT_DRIFT,
    "contract_align": CONTRACT_ALIGN,
    "drift_policies": DRIFT_POLICIES,
    "rescued_columns": RESCUED_COLUMNS,
    "json_map_explode": JSON_MAP_EXPLODE,
    "landing_inventory": LANDING_INVENTORY,
    "bronze_csv": BRONZE_CSV,
    "bronze_json": BRONZE_JSON,
    "bronze_lineage": BRONZE_LINEAGE,
    "sql_views": SQL_VIEWS,
    "merge_upsert": MERGE_UPSERT,
    "merge_upsert_partitioned": MERGE_UPSERT,
    "snapshot_overwrite": SNAPSHOT_OVERWRITE,
    "silver_customers": SILVER_CUSTOMERS,
    "silver_accounts": SILVER_ACCOUNTS,
    "silver_transactions": SILVER_TRANSACTIONS,
    "recon_rows": RECON_ROWS,
    "recon_amount": RECON_AMOUNT,
    "recon_orphans": RECON_ORPHANS,
    "recon_baseline": RECON_BASELINE,
    "recon_report": RECON_REPORT,
    "recon_verdict": RECON_VERDICT,
    "recon_overall": RECON_OVERALL,
    "recon_lost_rows": RECON_LOST_ROWS,
    "build_fx_rates": BUILD_FX_RATES,
    "build_customers": BUILD_CUSTOMERS,
    "build_accounts": BUILD_ACCOUNTS,
    "run_model": RUN_MODEL,
    "odd_amounts": ODD_AMOUNTS,
}
