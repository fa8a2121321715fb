"""Queries over the driver tables, one per operator family.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame built
from the library's operators; ``tierflow.plans.oracles`` holds an
independently written DuckDB SQL for each. Queries that exercise file I/O
(landing files, snapshots, streams) write into a fresh folder below the
session's shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.columns import (file_date, money_avg_round, safe_to_date, safe_to_double,
                                        safe_to_timestamp, strip_all, text_to_bool)
from tierflow.operators import fx
from tierflow.operators.dedupe import latest_per_key
from tierflow.operators.quarantine import split
from tierflow.operators.rules import compile_rules
from tierflow.plans import gold
from tierflow.plans.incremental import fx_state, grow_converted
from tierflow.plans.silver import latest
from tierflow.sinks.store import add_lineage, upsert
from tierflow.sources.tables import events_as_transactions, load

# The event types, used as the KPI "channels" (output -> type).
EVENT_CHANNELS = {"view_events": "view", "click_events": "click", "purchase_events": "purchase",
                  "signup_events": "signup", "error_events": "error"}

# Rules for event rows (value above 400 is treated as an outlier to quarantine).
EVENT_RULES = [
    {"id": "amount_not_null", "type": "not_null", "column": "amount"},
    {"id": "value_max", "type": "range", "column": "amount", "max": 400},
    {"id": "type_allowed", "type": "allowed_values", "column": "currency",
     "values": ["view", "click", "purchase", "signup", "error"], "severity": "warn"},
]


def silver_events(spark: SparkSession, sf: str) -> DataFrame:
    return with_event_day(events_as_transactions(load(spark, sf, "events")))


def with_event_day(tx: DataFrame) -> DataFrame:
    return (tx.withColumn("event_date", F.to_date("ts"))
              .withColumn("is_late", F.col("event_date") < file_date("_source_file"))
              .drop("_source_file"))


def kpi_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Rules -> quarantine split -> daily KPI mart over events."""
    comp = compile_rules(silver_events(spark, sf), EVENT_RULES)
    good, bad = split(comp)
    return gold.kpi_daily(good, quarantined=bad, amount_col="amount", channels=EVENT_CHANNELS)


def channel_mix(spark: SparkSession, sf: str) -> DataFrame:
    """A3: COUNT(*) FILTER per event type for each user."""
    ev = load(spark, sf, "events")
    return ev.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"),
        *[F.count_if(F.col("event_type") == F.lit(v)).alias(k) for k, v in EVENT_CHANNELS.items()])


def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar between the first and last event day."""
    return gold.dim_date(load(spark, sf, "events").select(F.to_date("ts").alias("event_date")))


# -- bronze-shaped views of the driver tables ----------------------------------
# The load metadata stamped on bronze copies of the driver tables.
LOAD_TS = "2024-02-01 06:00:00"
RUN_ID = "run-20240201"


def bronze_of(df: DataFrame, source_file: str) -> DataFrame:
    """Every column as verbatim text plus lineage, like a landing load."""
    strings = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    return add_lineage(strings, source_file=source_file, run_id=RUN_ID, ingested_at=LOAD_TS)


def silver_customer(spark: SparkSession, sf: str) -> DataFrame:
    """M2: customer as bronze text -> latest per key -> conformed silver."""
    b = bronze_of(load(spark, sf, "customer"), "customer_20240201.csv")
    return latest(b, "c_custkey").select(
        F.col("c_custkey").try_cast("bigint").alias("customer_id"),
        strip_all("c_name").alias("full_name"),
        F.col("c_nationkey").try_cast("int").alias("nation_key"),
        safe_to_double("c_acctbal").alias("acctbal"),
        F.lower("c_mktsegment").alias("segment"), F.col("_run_id"))


def silver_orders(spark: SparkSession, sf: str) -> DataFrame:
    """M3: orders as bronze text -> latest per key -> conformed silver (accounts)."""
    b = bronze_of(load(spark, sf, "orders"), "orders_20240201.csv")
    return latest(b, "o_orderkey").select(
        F.col("o_orderkey").try_cast("bigint").alias("account_id"),
        F.col("o_custkey").try_cast("bigint").alias("customer_id"),
        F.lower("o_orderpriority").alias("account_type"),
        safe_to_date("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("opened_at"),
        F.lower("o_orderstatus").alias("status"),
        safe_to_double("o_totalprice").alias("balance"), F.col("_run_id"))


def dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    """M5: SCD1 customer dimension."""
    return gold.dim_customer(silver_customer(spark, sf))


def dim_account(spark: SparkSession, sf: str) -> DataFrame:
    """M6: account dimension."""
    return gold.dim_account(silver_orders(spark, sf),
                            ("account_id", "customer_id", "account_type", "opened_at", "status"))


def fact_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Fact rows resolve their customer through the account (left join)."""
    li = load(spark, sf, "lineitem")
    orders = load(spark, sf, "orders").select(F.col("o_orderkey").alias("account_id"),
                                              F.col("o_custkey").alias("customer_id"))
    tx = li.select(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_orderkey").alias("account_id"),
                   F.to_date("l_shipdate").alias("date_key"), F.col("l_extendedprice").alias("amount_orig"),
                   F.col("l_returnflag"))
    return gold.fact_transactions(tx, orders, select=[
        "l_orderkey", "l_linenumber", "date_key", "account_id", "customer_id", "amount_orig", "l_returnflag"])


def dedupe_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Latest row per (l_orderkey, l_linenumber)."""
    li = load(spark, sf, "lineitem")
    return latest_per_key(li, ["l_orderkey", "l_linenumber"],
                          ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])


def dedupe_composite(spark: SparkSession, sf: str) -> DataFrame:
    """Latest event per (day, event_type)."""
    ev = load(spark, sf, "events").withColumn("event_date", F.to_date("ts"))
    return latest_per_key(ev, ["event_date", "event_type"], ["ts", "event_id"])


def safe_cast(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze text to double/date/timestamp; bad text -> null."""
    b = bronze_of(load(spark, sf, "orders"), "orders_20240201.csv")
    return b.select(
        F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
        safe_to_double(F.regexp_extract("o_orderpriority", r"^(\d+)-", 1)).alias("priority_num"),
        safe_to_double("o_orderpriority").alias("priority_as_double"),
        safe_to_double("o_totalprice").alias("totalprice"),
        safe_to_date("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_date"),
        safe_to_date("o_orderdate").alias("order_date_strict"),
        safe_to_timestamp("o_orderdate").alias("order_ts"),
        safe_to_date("o_orderstatus").alias("status_as_date"))


def conform_strings(spark: SparkSession, sf: str) -> DataFrame:
    """Trim all whitespace, lower case, text -> boolean."""
    c = load(spark, sf, "customer")
    padded = F.concat(F.lit(" \t"), F.col("c_name"), F.lit("\n "))
    flag_text = F.when(F.col("c_acctbal") >= 0, F.lit("True")).otherwise(F.lit("FALSE"))
    return c.select("c_custkey", strip_all(padded).alias("full_name"),
                    F.lower("c_mktsegment").alias("segment"),
                    text_to_bool(flag_text).alias("is_positive"))


def late_flag(spark: SparkSession, sf: str) -> DataFrame:
    """Date stamped in the delivering file name vs the event date."""
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    src = F.concat(F.lit("lineitem_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".jsonl"))
    out = j.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("event_date"),
                   src.alias("_source_file"))
    return (out.withColumn("file_date", file_date("_source_file"))
               .withColumn("is_late", F.col("event_date") < F.col("file_date")))


# Which derived daily rates exist (first day with rates, the
# currency never quoted, and the currency missing on the last day).
FX_FIRST_DAY = "2024-01-05"
FX_UNQUOTED = "error"
FX_GAP = ("view", "2024-01-30")


def all_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Daily 'rates' per event type = ROUND(AVG(value), 2) of that day."""
    ev = load(spark, sf, "events")
    return ev.groupBy(F.to_date("ts").alias("rate_date"), F.col("event_type").alias("currency")).agg(
        money_avg_round("value").alias("rate_to_bob"))


def derived_rates(spark: SparkSession, sf: str) -> DataFrame:
    """The daily rates with gaps, for the queries on missing rates."""
    r = all_rates(spark, sf)
    return r.where((F.col("rate_date") >= F.lit(FX_FIRST_DAY).cast("date"))
                   & (F.col("currency") != FX_UNQUOTED)
                   & ~((F.col("currency") == FX_GAP[0]) & (F.col("rate_date") == F.lit(FX_GAP[1]).cast("date"))))


def _fx(spark: SparkSession, sf: str, fallback) -> DataFrame:
    tx = silver_events(spark, sf).select("txn_id", "event_date", "currency", "amount")
    return fx.convert(tx, derived_rates(spark, sf), amount_col="amount", out_col="amount_bob",
                      keep_rate=True, fallback=fallback)


def fx_convert(spark: SparkSession, sf: str) -> DataFrame:
    """Direct rate join and decimal rounding."""
    return _fx(spark, sf, None)


def fx_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Fallback to the rate on the currency's last event day (reference code)."""
    return _fx(spark, sf, "last_row")


def fx_fallback_known(spark: SparkSession, sf: str) -> DataFrame:
    """W3 variant: fallback to the latest known rate (reference comment)."""
    return _fx(spark, sf, "last_known")


def fx_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries. The first has the days before the middle of the
    month, a rate table without its last days, and every seventh amount wrong;
    the second brings the rest and corrects these. Only rows whose rate changed
    are converted again, and all end as if converted at once."""
    tx = silver_events(spark, sf).select("txn_id", "event_date", "currency", "amount")
    rates = derived_rates(spark, sf)
    early = F.col("event_date") < F.lit(FX_SPLIT).cast("date")
    first = tx.where(early).withColumn("amount", F.when(F.col("txn_id") % 7 == 0, F.col("amount") + 1).otherwise(F.col("amount")))
    old_rates = rates.where(F.col("rate_date") < F.date_sub(F.lit(FX_SPLIT).cast("date"), 3))
    then = fx.convert(first, old_rates, amount_col="amount", out_col="amount_bob", fallback="last_row")
    state = fx_state(first, old_rates, "last_row")
    new = tx.where(~early | (F.col("txn_id") % 7 == 0))
    grown, _ = grow_converted(new, then, rates, state, ["txn_id"], "last_row")
    return upsert(then, grown, ["txn_id"]).select("txn_id", "event_date", "currency", "amount", "amount_bob")


# Fixed value: the day on which the second delivery of fx_incremental begins.
FX_SPLIT = "2024-01-16"

QUERIES = {
    "kpi_daily": kpi_daily,
    "channel_mix": channel_mix,
    "dim_date": dim_date,
    "dim_customer": dim_customer,
    "dim_account": dim_account,
    "fact_lookup": fact_lookup,
    "dedupe_latest": dedupe_latest,
    "dedupe_composite": dedupe_composite,
    "safe_cast": safe_cast,
    "conform_strings": conform_strings,
    "late_flag": late_flag,
    "fx_convert": fx_convert,
    "fx_fallback": fx_fallback,
    "fx_fallback_known": fx_fallback_known,
    "fx_incremental": fx_incremental,
}


# -- data-quality rules over the driver tables ------------------------------------
# Rule spec for lineitem rows (ids, bounds and allowed values are this
# project's own choices for the TPC-H-like data).
LINEITEM_SPEC = {
    "table": "silver.lineitem",
    "key": ["l_orderkey", "l_linenumber"],
    "rules": [
        {"id": "orderkey_not_null", "type": "not_null", "column": "l_orderkey"},
        {"id": "quantity_range", "type": "range", "column": "l_quantity", "min": 1, "max": 45},
        {"id": "line_unique", "type": "unique", "column": ["l_orderkey", "l_linenumber"]},
        {"id": "returnflag_allowed", "type": "allowed_values", "column": "l_returnflag",
         "values": ["A", "N", "R"], "severity": "warn"},
        {"id": "order_exists", "type": "foreign_key", "column": "l_orderkey", "ref": "orders",
         "ref_column": "o_orderkey"},
        {"id": "discount_max", "type": "fail_when", "expr": "l_discount > 0.09"},
        {"id": "tax_high", "type": "fail_when", "expr": "l_tax > 0.07", "severity": "warn"},
    ],
}
LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
LINEITEM_OUT = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
                "l_tax", "l_returnflag"]
# Per-rule actions for the lineitem findings; unlisted error rules default to quarantine.
LINEITEM_POLICY = {"line_unique": "warn_and_keep", "discount_max": "quarantine"}


def _failing(comp, rule_id: str, cols) -> DataFrame:
    return comp.frame.where(comp.mask(rule_id)).select(*cols)


def lineitem_rules(spark: SparkSession, sf: str):
    """The lineitem rule spec compiled over lineitem (FK to orders)."""
    from tierflow.operators.rules import Spec
    spec = Spec.from_dict(LINEITEM_SPEC)
    li = load(spark, sf, "lineitem")
    return compile_rules(li, spec.rules, {"orders": load(spark, sf, "orders")})


def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a quality label."""
    docs = load(spark, sf, "documents").select("doc_id")
    labelled = docs.join(load(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    comp = compile_rules(labelled, [{"id": "quality_not_null", "type": "not_null", "column": "quality"}])
    return _failing(comp, "quality_not_null", ["doc_id", "quality"])


def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Every copy of a duplicated (l_orderkey, l_linenumber)."""
    comp = compile_rules(load(spark, sf, "lineitem"),
                         [{"id": "line_unique", "type": "unique", "column": ["l_orderkey", "l_linenumber"]}])
    return _failing(comp, "line_unique", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"])


def dq_allowed(spark: SparkSession, sf: str) -> DataFrame:
    """D3: order status outside (F, O); nulls pass."""
    comp = compile_rules(load(spark, sf, "orders"), [
        {"id": "status_allowed", "type": "allowed_values", "column": "o_orderstatus", "values": ["F", "O"]}])
    return _failing(comp, "status_allowed", ["o_orderkey", "o_orderstatus"])


def dq_range(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity outside [1, 45]; nulls pass."""
    comp = compile_rules(load(spark, sf, "lineitem"), [
        {"id": "quantity_range", "type": "range", "column": "l_quantity", "min": 1, "max": 45}])
    return _failing(comp, "quantity_range", ["l_orderkey", "l_linenumber", "l_quantity"])


def dq_foreign_key(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose customer is not a solvent customer."""
    solvent = load(spark, sf, "customer").where(F.col("c_acctbal") >= 0)
    comp = compile_rules(load(spark, sf, "orders"), [
        {"id": "customer_exists", "type": "foreign_key", "column": "o_custkey", "ref": "customer",
         "ref_column": "c_custkey"}], {"customer": solvent})
    return _failing(comp, "customer_exists", ["o_orderkey", "o_custkey"])


def dq_fail_when(spark: SparkSession, sf: str) -> DataFrame:
    """SQL predicate rule over lineitem joined to orders."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "left").drop("o_orderkey")
    comp = compile_rules(j, [{"id": "shipped_before_order", "type": "fail_when",
                              "expr": "l_shipdate < o_orderdate"}])
    return _failing(comp, "shipped_before_order", ["l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate"])


def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    """One row per rule with failed/total counts."""
    from tierflow.operators.rules import report
    return report(lineitem_rules(spark, sf), "silver.lineitem")


def dq_samples(spark: SparkSession, sf: str) -> DataFrame:
    """O2: first five failing rows per rule, ordered by key."""
    from tierflow.operators.rules import samples
    s = samples(lineitem_rules(spark, sf), LINEITEM_ORDER, n=5, columns=LINEITEM_OUT + ["l_shipdate", "l_extendedprice"])
    return s.select("rule_id", F.col("sample_rank").cast("long").alias("sample_rank"), *LINEITEM_OUT)


def dq_findings(spark: SparkSession, sf: str) -> DataFrame:
    """Failed rules with the action the policy takes on them (warnings are
    only reported)."""
    from tierflow.operators.quarantine import decide
    rep = dq_report(spark, sf)
    actions = decide(rep, LINEITEM_POLICY).select(F.col("rule_id").alias("decided"), "action")
    found = rep.where("failed").join(actions, F.col("rule_id") == F.col("decided"), "left")
    return found.select("table", "rule_id", "rule_type", "column", "severity", "failed_rows", "total_rows",
                        F.coalesce("action", F.lit("report")).alias("action"))


def dq_policy(spark: SparkSession, sf: str) -> DataFrame:
    """Per-rule actions and the rows the policy moves."""
    from tierflow.operators.quarantine import decide
    from tierflow.operators.rules import report
    comp = lineitem_rules(spark, sf)
    decisions = decide(report(comp, "silver.lineitem"), LINEITEM_POLICY)
    chosen = [r for r in comp.rules if r.severity == "error"
              and LINEITEM_POLICY.get(r.id, "quarantine") == "quarantine"]
    moved = comp.frame.agg(F.count_if(comp.any_failed(chosen))).scalar()
    return decisions.select("rule_id", "severity", "failed_rows", "action", moved.alias("rows_moved"))


def reject_reason(spark: SparkSession, sf: str) -> DataFrame:
    """Violated error rules joined by ';' in rule order."""
    comp = lineitem_rules(spark, sf)
    _, bad = split(comp, quarantined_at=F.lit(LOAD_TS))
    return bad.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "_reject_reason")


def quarantine_split(spark: SparkSession, sf: str) -> DataFrame:
    """Every row tagged silver or quarantine with its reason."""
    from tierflow.operators.quarantine import tag_layers
    t = tag_layers(lineitem_rules(spark, sf))
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "_layer", "_reject_reason")


def quarantine_subset(spark: SparkSession, sf: str) -> DataFrame:
    """The split limited to one rule id."""
    from tierflow.operators.quarantine import tag_layers
    t = tag_layers(lineitem_rules(spark, sf), rule_ids=["quantity_range"])
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "_layer", "_reject_reason")


CASCADE = [
    ("customer", [{"id": "balance_non_negative", "type": "fail_when", "expr": "c_acctbal < 0"}]),
    ("orders", [{"id": "customer_exists", "type": "foreign_key", "column": "o_custkey",
                 "ref": "customer", "ref_column": "c_custkey"}]),
    ("lineitem", [{"id": "order_exists", "type": "foreign_key", "column": "l_orderkey",
                   "ref": "orders", "ref_column": "o_orderkey"}]),
]


def cascade_frames(spark: SparkSession, sf: str):
    """Customer -> orders -> lineitem cleaned parents first."""
    from tierflow.operators.quarantine import cascade
    return cascade([(name, load(spark, sf, name), rules) for name, rules in CASCADE])


def fk_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Silver and quarantine rows per table after the cascade, both counted
    in one pass over each table."""
    res = None
    for name, tagged in cascade_frames(spark, sf).items():
        counts = tagged.agg(F.lit(name).alias("table_name"), F.count_if(F.col("_layer") == "silver").alias("silver_rows"),
                            F.count_if(F.col("_layer") == "quarantine").alias("quarantine_rows"))
        res = counts if res is None else res.unionByName(counts)
    return res


QUERIES.update({
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_allowed": dq_allowed,
    "dq_range": dq_range,
    "dq_foreign_key": dq_foreign_key,
    "dq_fail_when": dq_fail_when,
    "dq_report": dq_report,
    "dq_samples": dq_samples,
    "dq_findings": dq_findings,
    "dq_policy": dq_policy,
    "reject_reason": reject_reason,
    "quarantine_split": quarantine_split,
    "quarantine_subset": quarantine_subset,
    "fk_cascade": fk_cascade,
})
