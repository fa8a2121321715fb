"""Independent DuckDB SQL for every driver query (the correctness oracle).

Written against the raw driver views (region, nation, customer, ... events),
never against our Spark code. Rounded money and percentages use exact
integer half-up arithmetic so both engines agree to the last bit.
"""

from __future__ import annotations


def avg2(x: str) -> str:
    """ROUND(AVG(x), 2) exactly, half away from zero."""
    s = f"CAST(SUM(CAST({x} AS DECIMAL(20,6))) * 1000000 AS HUGEINT)"
    n = f"(COUNT({x}) * 10000)"
    return (f"CAST(SIGN({s}) * ((2 * ABS({s}) + {n}) // (2 * {n})) AS DOUBLE) / 100")


def sum2(x: str) -> str:
    return f"CAST(ROUND(SUM(CAST({x} AS DECIMAL(20,6))), 2) AS DOUBLE)"


def pct2(part: str, whole: str) -> str:
    """ROUND(100 * part / whole, 2) exactly, half away from zero (part >= 0)."""
    return (f"CASE WHEN ({whole}) = 0 THEN NULL ELSE CAST((20000 * CAST({part} AS HUGEINT) + ({whole})) "
            f"// (2 * ({whole})) AS DOUBLE) / 100 END")


def mul2(a: str, b: str) -> str:
    return f"CAST(ROUND(CAST({a} AS DECIMAL(20,6)) * CAST({b} AS DECIMAL(20,6)), 2) AS DOUBLE)"


EV_TX = """
  SELECT event_id AS txn_id, user_id AS account_id, ts, value AS amount, event_type AS currency,
         event_type AS channel, event_type = 'error' AS is_flagged,
         CAST(ts AS DATE) AS event_date,
         CAST(ts AS DATE) < CAST(ts + INTERVAL 1 HOUR AS DATE) AS is_late
  FROM events
"""

KPI_DAILY = f"""
WITH tx AS ({EV_TX}),
bad AS (SELECT * FROM tx WHERE amount IS NULL OR amount > 400),
good AS (SELECT * FROM tx WHERE amount IS NOT NULL AND amount <= 400),
q AS (SELECT COUNT(*) AS n FROM bad),
g AS (SELECT COUNT(*) AS n FROM good)
SELECT event_date,
       COUNT(*) AS txn_count,
       {sum2('amount')} AS volume_bob,
       {avg2('amount')} AS avg_txn_bob,
       COUNT(DISTINCT account_id) AS active_accounts,
       {pct2('COUNT(*) FILTER (WHERE is_flagged)', 'COUNT(*)')} AS fraud_flag_rate_pct,
       COUNT(*) FILTER (WHERE is_late) AS late_txns,
       COUNT(*) FILTER (WHERE channel = 'view') AS view_events,
       COUNT(*) FILTER (WHERE channel = 'click') AS click_events,
       COUNT(*) FILTER (WHERE channel = 'purchase') AS purchase_events,
       COUNT(*) FILTER (WHERE channel = 'signup') AS signup_events,
       COUNT(*) FILTER (WHERE channel = 'error') AS error_events,
       {pct2('(SELECT n FROM q)', '(SELECT n FROM q) + (SELECT n FROM g)')} AS quarantine_rate_pct
FROM good
GROUP BY event_date
"""

CHANNEL_MIX = """
SELECT user_id, COUNT(*) AS events,
       COUNT(*) FILTER (WHERE event_type = 'view') AS view_events,
       COUNT(*) FILTER (WHERE event_type = 'click') AS click_events,
       COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchase_events,
       COUNT(*) FILTER (WHERE event_type = 'signup') AS signup_events,
       COUNT(*) FILTER (WHERE event_type = 'error') AS error_events
FROM events GROUP BY user_id
"""

# every day between the first and the last event, from its number alone
DIM_DATE = """
WITH RECURSIVE span AS (SELECT MIN(CAST(ts AS DATE)) AS a, MAX(CAST(ts AS DATE)) AS z FROM events),
days AS (SELECT a AS day, z FROM span WHERE a IS NOT NULL
         UNION ALL SELECT CAST(day + INTERVAL 1 DAY AS DATE), z FROM days WHERE day < z),
parts AS (SELECT day, year(day) AS y, month(day) AS m, dayofmonth(day) AS d, isodow(day) AS w FROM days)
SELECT day AS date_key, y AS year, (m + 2) // 3 AS quarter, m AS month, monthname(day) AS month_name,
       d AS day, w AS iso_weekday, dayname(day) AS weekday_name, w > 5 AS is_weekend
FROM parts
"""


DIM_CUSTOMER = """
SELECT c_custkey AS customer_id, trim(c_name, ' \t\n\r' || chr(11) || chr(12)) AS full_name,
       c_nationkey AS nation_key, c_acctbal AS acctbal, lower(c_mktsegment) AS segment
FROM customer
QUALIFY row_number() OVER (PARTITION BY c_custkey
                           ORDER BY c_name DESC NULLS LAST, c_nationkey DESC NULLS LAST) = 1
"""

DIM_ACCOUNT = """
SELECT o_orderkey AS account_id, o_custkey AS customer_id, lower(o_orderpriority) AS account_type,
       CAST(o_orderdate AS DATE) AS opened_at, lower(o_orderstatus) AS status
FROM orders
"""

FACT_LOOKUP = """
SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_shipdate AS DATE) AS date_key, l.l_orderkey AS account_id,
       o.o_custkey AS customer_id, l.l_extendedprice AS amount_orig, l.l_returnflag
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

DEDUPE_LATEST = """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
                 l_extendedprice DESC NULLS LAST) = 1
"""

DEDUPE_COMPOSITE = """
SELECT *, CAST(ts AS DATE) AS event_date FROM events
QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), event_type
                           ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1
"""

SAFE_CAST = """
SELECT o_orderkey,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority_num,
       TRY_CAST(o_orderpriority AS DOUBLE) AS priority_as_double,
       o_totalprice AS totalprice,
       CAST(o_orderdate AS DATE) AS order_date,
       CAST(NULL AS DATE) AS order_date_strict,
       o_orderdate AS order_ts,
       CAST(NULL AS DATE) AS status_as_date
FROM orders
"""

CONFORM_STRINGS = """
SELECT c_custkey, c_name AS full_name, lower(c_mktsegment) AS segment, c_acctbal >= 0 AS is_positive
FROM customer
"""

LATE_FLAG = """
SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_shipdate AS DATE) AS event_date,
       'lineitem_' || strftime(o.o_orderdate, '%Y%m%d') || '.jsonl' AS _source_file,
       CAST(o.o_orderdate AS DATE) AS file_date,
       CAST(l.l_shipdate AS DATE) < CAST(o.o_orderdate AS DATE) AS is_late
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

RATES = f"""
SELECT * FROM (
  SELECT CAST(ts AS DATE) AS rate_date, event_type AS currency, {avg2('value')} AS rate_to_bob
  FROM events GROUP BY 1, 2)
WHERE rate_date >= DATE '2024-01-05' AND currency <> 'error'
  AND NOT (currency = 'view' AND rate_date = DATE '2024-01-30')
"""

FX_BASE = f"""
WITH r AS ({RATES}),
t AS (SELECT event_id AS txn_id, CAST(ts AS DATE) AS event_date, event_type AS currency, value AS amount
      FROM events),
j AS (SELECT t.*, r.rate_to_bob AS direct_rate FROM t LEFT JOIN r
      ON t.event_date = r.rate_date AND t.currency = r.currency)
"""


def fx_sql(rate_expr: str) -> str:
    return (FX_BASE + f"""
, f AS (SELECT txn_id, event_date, currency, amount, {rate_expr} AS rate_to_bob FROM j)
SELECT txn_id, event_date, currency, amount, rate_to_bob, {mul2('amount', 'rate_to_bob')} AS amount_bob
FROM f""")


FX_CONVERT = fx_sql("direct_rate")
FX_FALLBACK = fx_sql("coalesce(direct_rate, last_value(direct_rate) OVER (PARTITION BY currency "
                     "ORDER BY event_date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))")
FX_FALLBACK_KNOWN = fx_sql("coalesce(direct_rate, last_value(direct_rate IGNORE NULLS) OVER (PARTITION BY "
                           "currency ORDER BY event_date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED "
                           "FOLLOWING))")

ORACLES = {
    "kpi_daily": KPI_DAILY,
    "channel_mix": CHANNEL_MIX,
    "dim_date": DIM_DATE,
    "dim_customer": DIM_CUSTOMER,
    "dim_account": DIM_ACCOUNT,
    "fact_lookup": FACT_LOOKUP,
    "dedupe_latest": DEDUPE_LATEST,
    "dedupe_composite": DEDUPE_COMPOSITE,
    "safe_cast": SAFE_CAST,
    "conform_strings": CONFORM_STRINGS,
    "late_flag": LATE_FLAG,
    "fx_convert": FX_CONVERT,
    "fx_fallback": FX_FALLBACK,
    "fx_fallback_known": FX_FALLBACK_KNOWN,
    "fx_incremental": f"SELECT txn_id, event_date, currency, amount, amount_bob FROM ({FX_FALLBACK})",
}

# -- data quality -------------------------------------------------------------------
# lineitem rule masks, one boolean per rule, in rule order
LI_RULES = [
    ("orderkey_not_null", "not_null", "l_orderkey", "error", "l_orderkey IS NULL"),
    ("quantity_range", "range", "l_quantity", "error",
     "l_quantity IS NOT NULL AND (l_quantity < 1 OR l_quantity > 45)"),
    ("line_unique", "unique", "l_orderkey,l_linenumber", "error",
     "COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1"),
    ("returnflag_allowed", "allowed_values", "l_returnflag", "warn",
     "l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'N', 'R')"),
    ("order_exists", "foreign_key", "l_orderkey", "error",
     "l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = li.l_orderkey)"),
    ("discount_max", "fail_when", None, "error", "COALESCE(l_discount > 0.09, FALSE)"),
    ("tax_high", "fail_when", None, "warn", "COALESCE(l_tax > 0.07, FALSE)"),
]

LI_MASKED = "SELECT li.*, " + ", ".join(f"({p}) AS m_{rid}" for rid, _, _, _, p in LI_RULES) + \
    " FROM lineitem li"


def _reason(rule_ids) -> str:
    return "concat_ws(';', " + ", ".join(f"CASE WHEN m_{r} THEN '{r}' END" for r in rule_ids) + ")"


LI_ERR = [r[0] for r in LI_RULES if r[3] == "error"]

DQ_NOT_NULL = """
SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NULL
"""

DQ_UNIQUE = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
QUALIFY COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1
"""

DQ_ALLOWED = """
SELECT o_orderkey, o_orderstatus FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')
"""

DQ_RANGE = """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_quantity < 1 OR l_quantity > 45
"""

DQ_FOREIGN_KEY = """
SELECT o_orderkey, o_custkey FROM orders o
WHERE o_custkey IS NOT NULL
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0 AND c_custkey IS NOT NULL)
"""

DQ_FAIL_WHEN = """
SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_orderdate
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_shipdate < o.o_orderdate
"""

DQ_REPORT = f"""
WITH m AS ({LI_MASKED}),
a AS (SELECT COUNT(*) AS total, {", ".join(f"COUNT(*) FILTER (WHERE m_{r[0]}) AS f_{r[0]}" for r in LI_RULES)} FROM m)
""" + "\nUNION ALL\n".join(
    f"SELECT 'silver.lineitem' AS \"table\", {i} AS rule_order, '{rid}' AS rule_id, '{kind}' AS rule_type, "
    f"{('NULL' if col is None else repr(col))}::VARCHAR AS \"column\", '{sev}' AS severity, "
    f"f_{rid} AS failed_rows, total AS total_rows, f_{rid} > 0 AS failed FROM a"
    for i, (rid, kind, col, sev, _) in enumerate(LI_RULES))

LI_OUT = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag"

DQ_SAMPLES = f"""
WITH m AS ({LI_MASKED}),
x AS ({" UNION ALL ".join(f"SELECT '{r[0]}' AS rule_id, * FROM m WHERE m_{r[0]}" for r in LI_RULES)})
SELECT rule_id, row_number() OVER (PARTITION BY rule_id ORDER BY l_orderkey, l_linenumber, l_shipdate,
       l_partkey, l_suppkey, l_extendedprice) AS sample_rank, {LI_OUT}
FROM x
QUALIFY sample_rank <= 5
"""

DQ_FINDINGS = f"""
SELECT "table", rule_id, rule_type, "column", severity, failed_rows, total_rows,
       CASE WHEN severity <> 'error' THEN 'report' WHEN rule_id = 'line_unique' THEN 'warn_and_keep'
            ELSE 'quarantine' END AS action
FROM ({DQ_REPORT}) WHERE failed
"""

DQ_POLICY = f"""
WITH r AS ({DQ_REPORT}),
m AS ({LI_MASKED}),
moved AS (SELECT COUNT(*) AS n FROM m WHERE m_orderkey_not_null OR m_quantity_range OR m_order_exists
          OR m_discount_max)
SELECT rule_id, severity, failed_rows,
       CASE rule_id WHEN 'line_unique' THEN 'warn_and_keep' WHEN 'discount_max' THEN 'quarantine'
                    ELSE 'quarantine' END AS action,
       (SELECT n FROM moved) AS rows_moved
FROM r WHERE failed AND severity = 'error'
"""

REJECT_REASON = f"""
WITH m AS ({LI_MASKED})
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_reason(LI_ERR)} AS _reject_reason
FROM m WHERE {" OR ".join(f"m_{r}" for r in LI_ERR)}
"""


def _split_sql(rule_ids) -> str:
    flag = " OR ".join(f"m_{r}" for r in rule_ids)
    return f"""
WITH m AS ({LI_MASKED})
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN {flag} THEN 'quarantine' ELSE 'silver' END AS _layer,
       CASE WHEN {flag} THEN {_reason(rule_ids)} END AS _reject_reason
FROM m
"""


QUARANTINE_SPLIT = _split_sql(LI_ERR)
QUARANTINE_SUBSET = _split_sql(["quantity_range"])

FK_CASCADE = """
WITH c_good AS (SELECT * FROM customer WHERE NOT COALESCE(c_acctbal < 0, FALSE)),
o_good AS (SELECT * FROM orders o WHERE o_custkey IS NULL
           OR EXISTS (SELECT 1 FROM c_good c WHERE c.c_custkey = o.o_custkey)),
l_good AS (SELECT * FROM lineitem l WHERE l_orderkey IS NULL
           OR EXISTS (SELECT 1 FROM o_good o WHERE o.o_orderkey = l.l_orderkey))
SELECT 'customer' AS table_name, (SELECT COUNT(*) FROM c_good) AS silver_rows,
       (SELECT COUNT(*) FROM customer) - (SELECT COUNT(*) FROM c_good) AS quarantine_rows
UNION ALL
SELECT 'orders', (SELECT COUNT(*) FROM o_good), (SELECT COUNT(*) FROM orders) - (SELECT COUNT(*) FROM o_good)
UNION ALL
SELECT 'lineitem', (SELECT COUNT(*) FROM l_good),
       (SELECT COUNT(*) FROM lineitem) - (SELECT COUNT(*) FROM l_good)
"""

ORACLES.update({
    "dq_not_null": DQ_NOT_NULL,
    "dq_unique": DQ_UNIQUE,
    "dq_allowed": DQ_ALLOWED,
    "dq_range": DQ_RANGE,
    "dq_foreign_key": DQ_FOREIGN_KEY,
    "dq_fail_when": DQ_FAIL_WHEN,
    "dq_report": DQ_REPORT,
    "dq_samples": DQ_SAMPLES,
    "dq_findings": DQ_FINDINGS,
    "dq_policy": DQ_POLICY,
    "reject_reason": REJECT_REASON,
    "quarantine_split": QUARANTINE_SPLIT,
    "quarantine_subset": QUARANTINE_SUBSET,
    "fk_cascade": FK_CASCADE,
})
