"""Driver queries that go through files: landing objects, bronze loads,
snapshot store upserts/overwrites, SQL views, streams; plus the silver
composites and the reconciliation checks.

Each call writes into a fresh folder below the session's shared checkpoint
folder (``spark.checkpoint.dir``) and returns a DataFrame over what was
written, so the result reflects the real round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.columns import money_mul_round, safe_to_date, safe_to_double, safe_to_timestamp, strip_all
from tierflow.operators import reconcile as rc
from tierflow.operators.dedupe import latest_per_key
from tierflow.operators.quarantine import bad_rows, cascade, good_rows
from tierflow.plans import gold
from tierflow.plans import silver as sv
from tierflow.plans.bronze import ingest_source
from tierflow.plans.driver import (CASCADE, LOAD_TS, RUN_ID, all_rates, bronze_of, derived_rates, kpi_daily,
                                   silver_customer, silver_orders)
from tierflow.session import work_dir
from tierflow.sinks.landing_writer import write_landing
from tierflow.sinks.store import TableStore, add_lineage
from tierflow.sources import contracts as ct
from tierflow.sources.csv_blocks import read_csv_blocks
from tierflow.sources.landing import data_files, list_landing_files, list_landing_objects, read_csv, read_json_map, read_ndjson, source_col
from tierflow.sources.tables import TABLES, load

# The events landing contract and the known landing sources.
EVENT_CONTRACT = ["event_id", "ts", "user_id", "event_type", "value", "props"]
LANDING_SOURCES = ["events", "orders", "fx_rates", "customer", "lineitem"]


def _events_name() -> F.Column:
    return F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMdd"), F.lit(".jsonl"))


def events_landing(spark: SparkSession, sf: str, root: str, drift: bool) -> str:
    """One NDJSON landing object per event day. With ``drift`` the weekend
    producer renames ``value`` to ``amt`` (a contract drift to detect)."""
    ev = load(spark, sf, "events")
    if drift:
        weekend = F.dayofweek("ts").isin(1, 7)
        ev = ev.select("event_id", "ts", "user_id", "event_type",
                       F.when(~weekend, F.col("value")).alias("value"),
                       F.when(weekend, F.col("value")).alias("amt"), "props")
    return write_landing(ev, root, _events_name(), "ndjson")


def _typed_events(df: DataFrame) -> DataFrame:
    return df.select(F.col("event_id").try_cast("bigint").alias("event_id"),
                     safe_to_timestamp("ts").alias("ts"),
                     F.col("user_id").try_cast("bigint").alias("user_id"), "event_type",
                     safe_to_double("value").alias("value"), "props", "_source_file")


def contract_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Per landing object, rows and sorted missing / unexpected names."""
    root = events_landing(spark, sf, work_dir(spark, "landing"), drift=True)
    rep = ct.inspect_ndjson(spark, root, EVENT_CONTRACT)
    return rep.select("file", "rows", F.array_join("missing", ",").alias("missing"),
                      F.array_join("unexpected", ",").alias("unexpected"))


def drift_policies(spark: SparkSession, sf: str) -> DataFrame:
    """What each drift policy does with the same drifted objects: how
    many it takes in and passes over, and the rows that bronze has then. A run
    that is refused has written nothing."""
    root = events_landing(spark, sf, work_dir(spark, "landing"), drift=True)
    paths, out = list_landing_objects(spark, root), []
    for policy in ("raise", "abort", "ingest_aligned", "skip_file"):
        store = TableStore(spark, work_dir(spark, f"lake-{policy}"))
        try:
            done = ingest_source(store, "events", paths, RUN_ID, EVENT_CONTRACT, on_drift=policy, ingested_at=LOAD_TS)
            outcome = "ingested"
        except ct.SchemaDriftError:
            done, outcome = [], "refused"
        bronze = store.read("bronze", "events") if store.exists("bronze", "events") else spark.range(0)
        skipped = sum(r.action == "skipped" for r in done)
        out.append(bronze.agg(F.lit(policy).alias("policy"), F.lit(outcome).alias("outcome"), F.lit(len(done) - skipped).cast("long").alias("objects"),
                              F.lit(skipped).cast("long").alias("skipped"), F.count(F.lit(1)).alias("rows")))
    return rc.combine(out)


def contract_align(spark: SparkSession, sf: str) -> DataFrame:
    """Drifted objects aligned to the contract (missing -> null, extra dropped)."""
    root = events_landing(spark, sf, work_dir(spark, "landing"), drift=True)
    aligned = ct.align(read_ndjson(spark, root), EVENT_CONTRACT, keep=("_source_file",))
    return _typed_events(aligned)


def rescued_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Unexpected keys kept as a JSON object in _rescued_data."""
    root = events_landing(spark, sf, work_dir(spark, "landing"), drift=True)
    r = ct.rescue(read_ndjson(spark, root), EVENT_CONTRACT, keep=("_source_file",))
    return r.select(F.col("event_id").try_cast("bigint").alias("event_id"), "_rescued_data", "_source_file")


def json_map_explode(spark: SparkSession, sf: str) -> DataFrame:
    """One {date, rates_to_bob} document per day -> one row per map entry."""
    rates = all_rates(spark, sf)
    docs = rates.groupBy("rate_date").agg(
        F.map_from_entries(F.collect_list(F.struct("currency", "rate_to_bob"))).alias("rates_to_bob"))
    root = work_dir(spark, "fx")
    write_landing(docs.select(F.date_format("rate_date", "yyyy-MM-dd").alias("date"), "rates_to_bob",
                              F.concat(F.lit("fx_rates_"), F.date_format("rate_date", "yyyyMMdd"),
                                       F.lit(".json")).alias("__name")),
                  root, "__name", "json")
    out = read_json_map(spark, root)
    return out.select(safe_to_date("rate_date").alias("rate_date"), "currency",
                      safe_to_double("rate_to_bob").alias("rate_to_bob"), "_source_file")


def landing_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Landing objects with their source, date stamp and format."""
    root = events_landing(spark, sf, work_dir(spark, "landing"), drift=False)
    files = list_landing_files(spark, root)
    return files.select("file_name").distinct().select(
        "file_name", source_col(F.col("file_name"), LANDING_SOURCES).alias("source"),
        F.regexp_substr("file_name", F.lit(r"\d{8}")).alias("stamp"),
        F.when(F.col("file_name").endswith(".jsonl"), "ndjson")
         .when(F.col("file_name").endswith(".csv"), "csv").otherwise("json").alias("format"))


def _orders_landing(spark: SparkSession, sf: str, root: str) -> str:
    o = load(spark, sf, "orders")
    name = F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyy"), F.lit("0101.csv"))
    return write_landing(o, root, name, "csv")


def bronze_csv(spark: SparkSession, sf: str) -> DataFrame:
    """CSV objects with header read as verbatim text, typed back."""
    root = _orders_landing(spark, sf, work_dir(spark, "landing"))
    b = read_csv(spark, root)
    return b.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
                    F.col("o_custkey").try_cast("bigint").alias("o_custkey"), "o_orderstatus",
                    safe_to_double("o_totalprice").alias("o_totalprice"),
                    safe_to_timestamp("o_orderdate").alias("o_orderdate"), "o_orderpriority",
                    "_source_file")


def bronze_csv_quoted(spark: SparkSession, sf: str) -> DataFrame:
    """S3: texts with quotes, commas and line breaks through CSV, unchanged."""
    d = load(spark, sf, "documents")
    name = F.concat(F.lit("documents_"), F.coalesce("source", F.lit("none")), F.lit(".csv"))
    root = write_landing(d.select("doc_id", "text", "lang", "source"), work_dir(spark, "landing"), name, "csv")
    return read_csv(spark, root).select(F.col("doc_id").try_cast("bigint").alias("doc_id"), "text", "lang", "_source_file")


def bronze_csv_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """S3: the same texts, each file cut into blocks that are read apart."""
    d = load(spark, sf, "documents")
    name = F.concat(F.lit("documents_"), F.coalesce("source", F.lit("none")), F.lit(".csv"))
    columns = ["doc_id", "text", "lang", "source"]
    root = write_landing(d.select(*columns), work_dir(spark, "landing"), name, "csv")
    files = [f for p in list_landing_objects(spark, root) for f in data_files(spark, p)]
    return read_csv_blocks(spark, files, columns).select(F.col("doc_id").try_cast("bigint").alias("doc_id"), "text", "lang", "_source_file")


def bronze_json(spark: SparkSession, sf: str) -> DataFrame:
    """NDJSON objects as verbatim text plus lineage columns."""
    root = events_landing(spark, sf, work_dir(spark, "landing"), drift=False)
    b = ct.align(read_ndjson(spark, root), EVENT_CONTRACT, keep=("_source_file",))
    return add_lineage(b, source_file=F.col("_source_file"), run_id=RUN_ID, ingested_at=LOAD_TS)


def bronze_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """All orders drops of the folder appended in one job; lineage per row."""
    from tierflow.plans.bronze import ingest_source
    from tierflow.sources.landing import list_landing_objects
    land = _orders_landing(spark, sf, work_dir(spark, "landing"))
    store = TableStore(spark, work_dir(spark, "lake"))
    ingest_source(store, "orders", list_landing_objects(spark, land), RUN_ID, load(spark, sf, "orders").columns,
                  ingested_at=LOAD_TS)
    b = store.read("bronze", "orders")
    return b.groupBy("_source_file", "_run_id", "_ingested_at").agg(F.count(F.lit(1)).alias("rows"))


def sql_views(spark: SparkSession, sf: str) -> DataFrame:
    """SQL over <layer>_<table> views of the snapshot store."""
    store = TableStore(spark, work_dir(spark, "lake"))
    store.write("silver", "customer", silver_customer(spark, sf), mode="overwrite")
    store.write("silver", "orders", silver_orders(spark, sf), mode="overwrite")
    return store.sql("""
        SELECT c.segment, COUNT(*) AS orders, COUNT(DISTINCT o.customer_id) AS customers,
               CAST(ROUND(SUM(CAST(o.balance AS DECIMAL(20,6))), 2) AS DOUBLE) AS balance
        FROM silver_orders o JOIN silver_customer c ON o.customer_id = c.customer_id
        GROUP BY c.segment""")


# The two overlapping order deliveries of the upsert scenario.
DAY1_BEFORE = "1998-01-01"
DAY2_FROM = "1997-01-01"


def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two overlapping deliveries upserted on the key."""
    o = load(spark, sf, "orders")
    day1 = o.where(F.col("o_orderdate") < F.lit(DAY1_BEFORE).cast("timestamp_ntz")) \
        .withColumn("_run_id", F.lit("run-1"))
    day2 = (o.where(F.col("o_orderdate") >= F.lit(DAY2_FROM).cast("timestamp_ntz"))
            .withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "O", F.lit("F"))
                        .otherwise(F.col("o_orderstatus")))
            .withColumn("_run_id", F.lit("run-2")))
    store = TableStore(spark, work_dir(spark, "lake"))
    store.merge("silver", "orders", day1, key="o_orderkey")
    store.merge("silver", "orders", day2, key="o_orderkey")
    return store.read("silver", "orders")


def merge_upsert_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """The same two deliveries into a table partitioned by order status: the
    second delivery moves keys from partition O to F, so old copies must be
    removed from partitions the source does not write."""
    o = load(spark, sf, "orders")
    day1 = o.where(F.col("o_orderdate") < F.lit(DAY1_BEFORE).cast("timestamp_ntz")) \
        .withColumn("_run_id", F.lit("run-1"))
    day2 = (o.where(F.col("o_orderdate") >= F.lit(DAY2_FROM).cast("timestamp_ntz"))
            .withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "O", F.lit("F"))
                        .otherwise(F.col("o_orderstatus")))
            .withColumn("_run_id", F.lit("run-2")))
    store = TableStore(spark, work_dir(spark, "lake"))
    store.merge("silver", "orders", day1, key="o_orderkey", partition_by="o_orderstatus")
    store.merge("silver", "orders", day2, key="o_orderkey", partition_by="o_orderstatus")
    return store.read("silver", "orders")


def snapshot_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """K3: overwrite of a table that is being read, as a new snapshot."""
    store = TableStore(spark, work_dir(spark, "lake"))
    store.write("silver", "orders", load(spark, sf, "orders"), mode="overwrite")
    v1 = store.read("silver", "orders")
    store.write("silver", "orders", v1.withColumn("o_orderstatus", F.lower("o_orderstatus")),
                mode="overwrite")
    cur = store.current("silver", "orders")
    return store.read("silver", "orders").withColumn("_snapshot", F.lit(cur.rsplit("/", 1)[-1]))


# -- silver composites -------------------------------------------------------------
# The second customer load re-delivers one segment with changed names.
RELOAD_SEGMENT = "BUILDING"
RELOAD_TS = "2024-02-02 06:00:00"


def silver_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads; the later one wins per key, then conformed."""
    c = load(spark, sf, "customer")
    first = bronze_of(c, "customer_20240201.csv")
    again = c.where(F.col("c_mktsegment") == RELOAD_SEGMENT).withColumn(
        "c_name", F.concat(F.lit("  "), F.upper("c_name"), F.lit("\t")))
    second = add_lineage(again.select(*[F.col(x).cast("string").alias(x) for x in c.columns]),
                         source_file="customer_20240202.csv", run_id="run-20240202", ingested_at=RELOAD_TS)
    b = first.unionByName(second)
    return sv.latest(b, "c_custkey").select(
        F.col("c_custkey").try_cast("bigint").alias("customer_id"), strip_all("c_name").alias("full_name"),
        F.col("c_nationkey").try_cast("int").alias("nation_key"), safe_to_double("c_acctbal").alias("acctbal"),
        F.lower("c_mktsegment").alias("segment"), F.col("_run_id"))


def silver_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """M3: orders as the account silver table."""
    return silver_orders(spark, sf)


def bank_bronze_events(spark: SparkSession, sf: str) -> DataFrame:
    """events as banking transactions in bronze (verbatim text + lineage)."""
    ev = load(spark, sf, "events")
    delivered = F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"), "yyyyMMdd")
    rows = ev.select(
        F.col("event_id").cast("string").alias("txn_id"), F.col("user_id").cast("string").alias("account_id"),
        F.col("ts").cast("string").alias("ts"), F.col("value").cast("string").alias("amount"),
        F.col("event_type").alias("currency"), F.col("event_type").alias("txn_type"),
        F.col("event_type").alias("channel"), F.col("props").alias("counterparty"),
        F.lit(None).cast("string").alias("merchant_category"),
        F.when(F.col("event_type") == "error", "true").otherwise("false").alias("is_flagged"),
        F.concat(F.lit("transactions_"), delivered, F.lit(".jsonl")).alias("_source_file"))
    return rows.withColumns({"_ingested_at": F.lit(LOAD_TS).cast("timestamp_ntz"), "_run_id": F.lit(RUN_ID)})


def silver_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """M4: latest per key, casts, late flag and FX with fallback."""
    return sv.build_transactions(bank_bronze_events(spark, sf), derived_rates(spark, sf), "last_row")


# -- reconciliation over the customer -> orders -> lineitem pipeline ------------------
LI_KEY = ["l_orderkey", "l_linenumber"]


def _staged(spark: SparkSession, names):
    """Writes the tables in ``names`` and reads them back, as the layers of a lake
    are; others are read once and stay as they are."""
    base = work_dir(spark, "recon")

    def stage(name: str, df: DataFrame) -> DataFrame:
        if name not in names:
            return df
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")
    return stage


def cascade_state(spark: SparkSession, sf: str, staged=("customer", "orders", "lineitem", "fact")):
    """Raw tables, the cleaned tables (each row once, tagged with its layer) and
    the fact; a table that the checks read more than once is ``staged``: computed
    and written once."""
    raw = {t: load(spark, sf, t) for t in ("customer", "orders", "lineitem")}
    li = latest_per_key(raw["lineitem"], LI_KEY, ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    frames = {"customer": raw["customer"], "orders": raw["orders"], "lineitem": li}
    stage = _staged(spark, staged)
    out = cascade([(name, frames[name], rules) for name, rules in CASCADE], stage=stage)
    tx = good_rows(out["lineitem"]).select(*LI_KEY, F.col("l_orderkey").alias("account_id"),
                                           F.col("l_extendedprice").alias("amount_orig"))
    acc = good_rows(out["orders"]).select(F.col("o_orderkey").alias("account_id"), F.col("o_custkey").alias("customer_id"))
    fact = stage("fact", gold.fact_transactions(tx, acc, select=[*LI_KEY, "account_id", "customer_id", "amount_orig"]))
    return raw, out, fact


def _row_checks(raw, out):
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": LI_KEY}
    return [rc.row_conservation(t, raw[t], good_rows(out[t]), bad_rows(out[t]), keys[t]) for t in keys]


def _fact_checks(out, fact):
    return [rc.amount_conservation("fact", good_rows(out["lineitem"]), fact, "l_extendedprice", "amount_orig"),
            rc.no_orphans("fact", fact, "customer_id")]


def recon_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct bronze keys = silver rows + quarantine rows, per table."""
    raw, out, _ = cascade_state(spark, sf, staged=("lineitem",))
    return rc.combine(_row_checks(raw, out))


def recon_lost_rows(spark: SparkSession, sf: str) -> DataFrame:
    """R1, R6 when they must fail: a silver layer that lost some keys and whose
    fact lost amounts is caught, and the verdict says so."""
    raw, out, fact = cascade_state(spark, sf)
    lost = {t: f.where(F.col({"customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_orderkey"}[t]) % 100 != 7)
            for t, f in out.items()}
    return rc.verdict(rc.combine([*_row_checks(raw, lost), *_fact_checks(lost, fact)]))


def recon_amount(spark: SparkSession, sf: str) -> DataFrame:
    """Rounded amount equal in silver and the fact."""
    _, out, fact = cascade_state(spark, sf, staged=("lineitem",))
    return _fact_checks(out, fact)[0]


def recon_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Facts without a customer."""
    _, out, fact = cascade_state(spark, sf, staged=())
    return _fact_checks(out, fact)[1]


def recon_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """Worst daily flagged share against expected x tolerance."""
    return rc.kpi_baseline("fraud_rate", kpi_daily(spark, sf), "fraud_flag_rate_pct", 0.5, 3.0)


def recon_report(spark: SparkSession, sf: str) -> DataFrame:
    """All checks as (name, ok, detail) rows."""
    raw, out, fact = cascade_state(spark, sf)
    return rc.combine([*_row_checks(raw, out), *_fact_checks(out, fact),
                       rc.kpi_baseline("fraud_rate", kpi_daily(spark, sf), "fraud_flag_rate_pct", 0.5, 3.0)])


def recon_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """Pass / pass_with_warnings / fail with the explanation."""
    return rc.verdict(recon_report(spark, sf))


def recon_overall(spark: SparkSession, sf: str) -> DataFrame:
    """Whether all checks hold, and the names of those that do not."""
    return rc.overall(recon_report(spark, sf))


# -- the banking builders over driver tables in the shape of their landing contracts ----------
def build_fx_rates(spark: SparkSession, sf: str) -> DataFrame:
    """M1: daily rates as bronze text, delivered twice; the later load wins."""
    r = all_rates(spark, sf).select(F.date_format("rate_date", "yyyy-MM-dd").alias("rate_date"), "currency", "rate_to_bob")
    first = bronze_of(r.withColumn("rate_to_bob", F.col("rate_to_bob") + 1), "fx_rates_20240201.json")
    again = add_lineage(r.select(*[F.col(c).cast("string").alias(c) for c in r.columns]), source_file="fx_rates_20240202.json",
                        run_id="run-20240202", ingested_at=RELOAD_TS)
    return sv.build_fx_rates(first.unionByName(again))


def build_customers(spark: SparkSession, sf: str) -> DataFrame:
    """M2: blanks around names, mixed case, dates that are none."""
    c = load(spark, sf, "customer")
    shaped = c.select(
        F.col("c_custkey").alias("customer_id"), F.concat(F.lit(" \t"), "c_name", F.lit("\n ")).alias("full_name"),
        F.concat(F.lit("D"), F.col("c_custkey").cast("string")).alias("doc_id"),
        F.when(F.col("c_custkey") % 9 == 0, "not a date").otherwise(
            F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 15000).cast("int")), "yyyy-MM-dd")).alias("birth_date"),
        F.col("c_nationkey").cast("string").alias("city"), F.initcap("c_mktsegment").alias("segment"),
        F.when(F.col("c_acctbal") < 0, "HIGH").otherwise("Low").alias("risk_rating"), F.lit("2020-02-30").alias("created_at"))
    return sv.build_customers(bronze_of(shaped, "customers_20240201.csv"))


def build_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """M3: orders in the shape of accounts."""
    o = load(spark, sf, "orders")
    shaped = o.select(F.col("o_orderkey").alias("account_id"), F.col("o_custkey").alias("customer_id"),
                      F.col("o_orderpriority").alias("account_type"), F.lit("BOB").alias("currency"),
                      F.date_format("o_orderdate", "yyyy-MM-dd").alias("opened_at"), F.col("o_orderstatus").alias("status"))
    return sv.build_accounts(bronze_of(shaped, "accounts_20240201.csv"))


def run_model(spark: SparkSession, sf: str) -> DataFrame:
    """A named model built from the store's tables and written as gold."""
    store = TableStore(spark, work_dir(spark, "lake"))
    store.write("silver", "accounts", build_accounts(spark, sf), mode="overwrite")
    return gold.run_model(store, "dim_account")


def odd_amounts(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts beyond any decimal, with nine decimals, NaN and text, by
    day: the job goes on, and exact ones stay exact."""
    ev = load(spark, sf, "events")
    text = (F.when(F.col("event_id") % 50 == 1, "1e14").when(F.col("event_id") % 50 == 2, "1e20")
            .when(F.col("event_id") % 50 == 3, "0.123456789").when(F.col("event_id") % 50 == 4, "NaN")
            .when(F.col("event_id") % 50 == 5, "n/a").otherwise(F.col("value").cast("string")))
    a = ev.select("event_id", safe_to_double(text).alias("amount"))
    return a.select("event_id", "amount", money_mul_round("amount", F.lit(2.0)).alias("doubled"))


IO_QUERIES = {
    "contract_drift": contract_drift,
    "contract_align": contract_align,
    "drift_policies": drift_policies,
    "rescued_columns": rescued_columns,
    "json_map_explode": json_map_explode,
    "landing_inventory": landing_inventory,
    "bronze_csv": bronze_csv,
    "bronze_json": bronze_json,
    "bronze_csv_quoted": bronze_csv_quoted,
    "bronze_csv_blocks": bronze_csv_blocks,
    "bronze_lineage": bronze_lineage,
    "sql_views": sql_views,
    "merge_upsert": merge_upsert,
    "merge_upsert_partitioned": merge_upsert_partitioned,
    "snapshot_overwrite": snapshot_overwrite,
    "silver_customers": silver_customers,
    "silver_accounts": silver_accounts,
    "silver_transactions": silver_transactions,
    "recon_rows": recon_rows,
    "recon_amount": recon_amount,
    "recon_orphans": recon_orphans,
    "recon_baseline": recon_baseline,
    "recon_report": recon_report,
    "recon_verdict": recon_verdict,
    "recon_overall": recon_overall,
    "recon_lost_rows": recon_lost_rows,
    "build_fx_rates": build_fx_rates,
    "build_customers": build_customers,
    "build_accounts": build_accounts,
    "run_model": run_model,
    "odd_amounts": odd_amounts,
}

__all__ = ["IO_QUERIES", "TABLES"]
