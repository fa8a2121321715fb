"""Driver queries that run whole jobs: Structured Streaming loads and the
daily batch job (ingest -> silver + quality -> gold -> reconcile) over
landing objects exported from the driver tables."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.columns import safe_to_double, safe_to_timestamp
from tierflow.operators import reconcile as rc
from tierflow.operators.dedupe import latest_per_key
from tierflow.operators.rules import Rule, Spec
from tierflow.plans import gold
from tierflow.plans.driver import EVENT_CHANNELS, EVENT_RULES, RUN_ID, with_event_day
from tierflow.plans.driver_io import EVENT_CONTRACT, events_landing
from tierflow.plans.incremental import bronze_keys
from tierflow.plans.job import JobConfig, SilverStep, run_daily
from tierflow.session import work_dir
from tierflow.sinks.landing_writer import write_landing
from tierflow.sinks.store import TableStore
from tierflow.sources.tables import events_as_transactions, load
from tierflow.streaming.bronze_stream import stream_bronze as _stream_bronze
from tierflow.streaming.bronze_stream import stream_to_store as _stream_to_store
from tierflow.streaming.bronze_stream import stream_upsert as _stream_upsert


def _typed(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(F.col("event_id").try_cast("bigint").alias("event_id"), safe_to_timestamp("ts").alias("ts"),
                     F.col("user_id").try_cast("bigint").alias("user_id"), "event_type",
                     safe_to_double("value").alias("value"), "props", "_source_file", *extra)


def stream_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """availableNow file stream -> bronze; a second run (restart) adds nothing."""
    root = events_landing(spark, sf, work_dir(spark, "landing"), drift=False)
    base = work_dir(spark, "stream")
    bronze, ckpt = f"{base}/bronze/events", f"{base}/_checkpoints/events"
    _stream_bronze(spark, root, bronze, ckpt, EVENT_CONTRACT, RUN_ID)
    _stream_bronze(spark, root, bronze, ckpt, EVENT_CONTRACT, "run-restart")
    return _typed(spark.read.parquet(bronze), "_run_id")


def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs: the first has all events, the second re-delivers every
    ``error`` event, however old by then. Bronze keeps both copies, and silver
    the later one; ``copies`` shows that none was lost on the way."""
    root = events_landing(spark, sf, work_dir(spark, "landing"), drift=False)
    base = work_dir(spark, "stream")
    store = TableStore(spark, f"{base}/lake")
    _stream_to_store(store, "events", root, f"{base}/_checkpoints/events", EVENT_CONTRACT, RUN_ID)
    ev = load(spark, sf, "events")
    write_landing(ev.where(F.col("event_type") == "error"), root, F.lit("events_resent.jsonl"), "ndjson")
    _stream_to_store(store, "events", root, f"{base}/_checkpoints/events", EVENT_CONTRACT, "run-resent")
    bronze = store.read("bronze", "events")
    copies = bronze.groupBy(F.col("event_id").try_cast("bigint").alias("event_id")).agg(F.count(F.lit(1)).alias("copies"))
    latest = latest_per_key(_typed(bronze, "_ingested_at", "_run_id"), "event_id", ["_ingested_at", "_source_file"])
    return latest.drop("_ingested_at").join(copies, "event_id")


def stream_rescue(spark: SparkSession, sf: str) -> DataFrame:
    """The weekend producer's renamed field is kept by the stream as well."""
    root = events_landing(spark, sf, work_dir(spark, "landing"), drift=True)
    base = work_dir(spark, "stream")
    store = TableStore(spark, f"{base}/lake")
    _stream_to_store(store, "events", root, f"{base}/_checkpoints/events", EVENT_CONTRACT, RUN_ID, rescue=True)
    return store.read("bronze", "events").select(F.col("event_id").try_cast("bigint").alias("event_id"),
                                                 "_rescued_data", "_source_file")


# The corrections drop re-delivers every ``error`` event with
# its value raised by one; its name sorts after the daily objects.
CORRECTIONS = "events_corrections.jsonl"


def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    root = events_landing(spark, sf, work_dir(spark, "landing"), drift=False)
    ev = load(spark, sf, "events")
    fixes = ev.where(F.col("event_type") == "error").withColumn("value", F.col("value") + F.lit(1.0))
    write_landing(fixes, root, F.lit(CORRECTIONS), "ndjson")
    base = work_dir(spark, "stream")
    store = TableStore(spark, f"{base}/lake")
    _stream_upsert(spark, root, store, "events", f"{base}/_checkpoints/events_upsert", EVENT_CONTRACT,
                   ["event_id"], transform=_typed, max_files_per_trigger=16, partition_by="event_type")
    return store.read("silver", "events").select("event_id", "ts", "user_id", "event_type", "value", "props",
                                                  "_source_file")


# -- the daily job over customer / orders / lineitem drops ---------------------------
TPCH_RUN_DATE = dt.date(2024, 2, 1)
LI_KEY = ["l_orderkey", "l_linenumber"]
#: Rows of one delivered part at most: it is compressed, so one task reads it whole.
DROP_ROWS = 500_000


def _drop(df: DataFrame, root: str, name: Column, fmt: str) -> str:
    """A landing object as large producers deliver it: in compressed parts."""
    return write_landing(df, root, name, fmt, compression="gzip", level="THREE", rows_per_file=DROP_ROWS)


def tpch_landing(spark: SparkSession, sf: str, root: str) -> str:
    stamp = f"{TPCH_RUN_DATE:%Y%m%d}"
    _drop(load(spark, sf, "customer"), root, F.lit(f"customer_{stamp}.csv"), "csv")
    _drop(load(spark, sf, "orders"), root, F.lit(f"orders_{stamp}.csv"), "csv")
    _drop(load(spark, sf, "lineitem"), root, F.lit(f"lineitem_{stamp}.jsonl"), "ndjson")
    return root


def _build_customer(s: TableStore, b: DataFrame) -> DataFrame:
    t = b.select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "c_name",
                 F.col("c_nationkey").try_cast("int").alias("c_nationkey"),
                 safe_to_double("c_acctbal").alias("c_acctbal"), "c_mktsegment", "_ingested_at", "_source_file",
                 "_run_id")
    return latest_per_key(t, "c_custkey", ["_ingested_at", "_source_file", "c_acctbal", "c_name"]) \
        .drop("_ingested_at", "_source_file")


def _build_orders(s: TableStore, b: DataFrame, key: Sequence[str] = ("o_orderkey",)) -> DataFrame:
    t = b.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
                 F.col("o_custkey").try_cast("bigint").alias("o_custkey"), "o_orderstatus",
                 safe_to_double("o_totalprice").alias("o_totalprice"),
                 safe_to_timestamp("o_orderdate").alias("o_orderdate"), "o_orderpriority",
                 "_ingested_at", "_source_file", "_run_id")
    return latest_per_key(t, list(key), ["_ingested_at", "_source_file", "o_totalprice"]) \
        .drop("_ingested_at", "_source_file")


def _build_lineitem(s: TableStore, b: DataFrame) -> DataFrame:
    t = b.select(F.col("l_orderkey").try_cast("bigint").alias("l_orderkey"),
                 F.col("l_partkey").try_cast("bigint").alias("l_partkey"),
                 F.col("l_suppkey").try_cast("bigint").alias("l_suppkey"),
                 F.col("l_linenumber").try_cast("int").alias("l_linenumber"),
                 safe_to_double("l_quantity").alias("l_quantity"),
                 safe_to_double("l_extendedprice").alias("l_extendedprice"),
                 safe_to_double("l_discount").alias("l_discount"), safe_to_double("l_tax").alias("l_tax"),
                 "l_returnflag", "l_linestatus", safe_to_timestamp("l_shipdate").alias("l_shipdate"),
                 "_ingested_at", "_source_file", "_run_id")
    return latest_per_key(t, LI_KEY, ["_ingested_at", "_source_file", "l_shipdate", "l_partkey", "l_suppkey",
                                      "l_extendedprice"]).drop("_ingested_at", "_source_file")


TPCH_SPECS = {
    "customer": Spec.from_dict({"key": "c_custkey", "rules": [
        {"id": "balance_non_negative", "type": "fail_when", "expr": "c_acctbal < 0"},
        {"id": "segment_known", "type": "not_null", "column": "c_mktsegment", "severity": "warn"}]}),
    "orders": Spec.from_dict({"key": "o_orderkey", "rules": [
        {"id": "customer_exists", "type": "foreign_key", "column": "o_custkey", "ref": "silver.customer",
         "ref_column": "c_custkey"},
        {"id": "status_allowed", "type": "allowed_values", "column": "o_orderstatus", "values": ["F", "O"],
         "severity": "warn"}]}),
    "lineitem": Spec.from_dict({"key": LI_KEY, "rules": [
        {"id": "order_exists", "type": "foreign_key", "column": "l_orderkey", "ref": "silver.orders",
         "ref_column": "o_orderkey"},
        {"id": "quantity_range", "type": "range", "column": "l_quantity", "min": 1, "max": 45,
         "severity": "warn"}]}),
}


def _tpch_gold(s: TableStore) -> dict[str, DataFrame]:
    li = s.read("silver", "lineitem")
    acc = s.read("silver", "orders").select(F.col("o_orderkey").alias("account_id"),
                                            F.col("o_custkey").alias("customer_id"))
    tx = li.select(*LI_KEY, F.col("l_orderkey").alias("account_id"), F.to_date("l_shipdate").alias("date_key"),
                   F.col("l_extendedprice").alias("amount_orig"))
    fact = gold.fact_transactions(tx, acc, select=[*LI_KEY, "date_key", "account_id", "customer_id",
                                                   "amount_orig"])
    dates = gold.dim_date(li.select(F.to_date("l_shipdate").alias("event_date")))
    return {"fact_lineitem": fact, "dim_date": dates}


def _tpch_checks(s: TableStore) -> DataFrame:
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": LI_KEY}
    checks = []
    for t, k in keys.items():
        known, once = bronze_keys(s, t, k)
        checks.append(rc.row_conservation(t, known, s.read("silver", t), s.read("quarantine", t), k, once=once))
    checks.append(rc.amount_conservation("fact", s.read("silver", "lineitem"), s.read("gold", "fact_lineitem"),
                                         "l_extendedprice", "amount_orig"))
    checks.append(rc.no_orphans("fact", s.read("gold", "fact_lineitem"), "customer_id"))
    return rc.combine(checks)


def tpch_config() -> JobConfig:
    return JobConfig(
        contracts={"customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
                   "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                              "o_orderpriority"],
                   "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                                "l_shipdate"]},
        steps=[SilverStep("customer", ["c_custkey"], _build_customer),
               SilverStep("orders", ["o_orderkey"], _build_orders),
               SilverStep("lineitem", LI_KEY, _build_lineitem)],
        specs=TPCH_SPECS, gold_models=_tpch_gold, checks=_tpch_checks)


# -- customers and orders alone: null keys, SQL models ---------------------------------
SQL_FOLDER = os.path.join(os.path.dirname(__file__), "sql")


def small_config(gold_models, order_key=("o_orderkey",), rules=()) -> JobConfig:
    """The customer and orders steps; ``rules`` are added to those of a table."""
    config, more = tpch_config(), dict(rules)
    keys = {"customer": ["c_custkey"], "orders": list(order_key)}
    specs = {t: Spec(None, k, [*(Rule.from_dict(r) for r in more.get(t, ())), *TPCH_SPECS[t].rules]) for t, k in keys.items()}

    def checks(s: TableStore) -> DataFrame:
        out = []
        for t, k in keys.items():
            known, once = bronze_keys(s, t, k)
            out.append(rc.row_conservation(t, known, s.read("silver", t), s.read("quarantine", t), k, once=once))
        return rc.combine(out)
    build = {"customer": _build_customer, "orders": lambda s, b: _build_orders(s, b, keys["orders"])}
    return JobConfig(contracts={t: config.contracts[t] for t in keys}, steps=[SilverStep(t, k, build[t]) for t, k in keys.items()],
                     specs=specs, gold_models=gold_models, checks=checks)


def run_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Customers without a key, and orders whose composite key lacks
    its date, delivered three times over: after each run, the rows of each layer
    and the verdict."""
    stamp, land, root = f"{TPCH_RUN_DATE:%Y%m%d}", work_dir(spark, "landing"), work_dir(spark, "lake")
    c, o = load(spark, sf, "customer"), load(spark, sf, "orders")
    _drop(c.withColumn("c_custkey", F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey"))), land, F.lit(f"customer_{stamp}.csv"), "csv")
    date = F.when(F.col("o_orderkey") % 9 == 0, F.lit("unknown")).otherwise(F.col("o_orderdate").cast("string"))
    _drop(o.withColumn("o_orderdate", date), land, F.lit(f"orders_{stamp}.csv"), "csv")
    config = small_config(lambda s: {}, order_key=("o_orderkey", "o_orderdate"), rules={
        "customer": [{"id": "custkey_not_null", "type": "not_null", "column": "c_custkey"}],
        "orders": [{"id": "orderdate_not_null", "type": "not_null", "column": "o_orderdate"}]})
    store, out = TableStore(spark, root), []
    for i in range(3):
        verdict = run_daily(spark, config, land, root, TPCH_RUN_DATE, run_id=f"run-{i + 1}", ingested_at=f"2024-02-01 0{6 + i}:00:00").verdict
        for t in ("customer", "orders"):
            out.append(_counted(store, t, i + 1, verdict))
    return rc.combine(out)


def _counted(store: TableStore, table: str, run: int, verdict: str) -> DataFrame:
    """Rows of both layers as they are now, whatever is written later."""
    n = {layer: store.read_at(store.current(layer, table)).count() for layer in ("silver", "quarantine")}
    return store.spark.range(1).select(F.lit(run).alias("run"), F.lit(table).alias("table_name"), F.lit(n["silver"]).cast("long").alias("silver"),
                                       F.lit(n["quarantine"]).cast("long").alias("quarantine"), F.lit(verdict).alias("verdict"))


def _sql_models(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A daily run whose gold models are a folder of SQL files, which read
    each other; one of them."""
    stamp, land, root = f"{TPCH_RUN_DATE:%Y%m%d}", work_dir(spark, "landing"), work_dir(spark, "lake")
    _drop(load(spark, sf, "customer"), land, F.lit(f"customer_{stamp}.csv"), "csv")
    _drop(load(spark, sf, "orders"), land, F.lit(f"orders_{stamp}.csv"), "csv")
    run_daily(spark, small_config(SQL_FOLDER), land, root, TPCH_RUN_DATE, run_id="run-1", ingested_at="2024-02-01 06:00:00")
    return TableStore(spark, root).read("gold", name)


def sql_model_customer_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _sql_models(spark, sf, "customer_orders")


def sql_model_segment_value(spark: SparkSession, sf: str) -> DataFrame:
    return _sql_models(spark, sf, "segment_value")


def sql_model_best_segments(spark: SparkSession, sf: str) -> DataFrame:
    return _sql_models(spark, sf, "best_segments")


# -- the daily KPI mart, brought up to date by the days that changed --------------------
def _build_events(s: TableStore, b: DataFrame) -> DataFrame:
    latest = latest_per_key(_typed(b, "_ingested_at"), "event_id", ["_ingested_at", "_source_file", "ts", "value"])
    return with_event_day(events_as_transactions(latest)).withColumnRenamed("txn_id", "event_id")


def _events_kpi(s: TableStore) -> DataFrame:
    return gold.kpi_daily(s.read("silver", "events"), quarantined=s.read("quarantine", "events"), amount_col="amount", channels=EVENT_CHANNELS)


def _grow_events_kpi(s: TableStore, days: list) -> DataFrame:
    return gold.grow_kpi(s.read("gold", "kpi_daily"), s.read("silver", "events"), days, quarantined=s.read("quarantine", "events"),
                         amount_col="amount", channels=EVENT_CHANNELS)


def events_config() -> JobConfig:
    def checks(s: TableStore) -> DataFrame:
        known, once = bronze_keys(s, "events", "event_id")
        return rc.row_conservation("events", known, s.read("silver", "events"), s.read("quarantine", "events"), "event_id", once=once)
    return JobConfig(contracts={"events": EVENT_CONTRACT}, steps=[SilverStep("events", ["event_id"], _build_events, partition_by="event_date")],
                     specs={"events": Spec.from_dict({"key": "event_id", "rules": EVENT_RULES})}, gold_models=lambda s: {"kpi_daily": _events_kpi(s)},
                     checks=checks, grown={"kpi_daily": ("events", "event_date", _grow_events_kpi)})


def _kpi_runs(spark: SparkSession, sf: str) -> TableStore:
    """Three deliveries. The first lacks the fifteenth of every month, and has the
    even events of the tenth a day late and with another value; the second brings
    the fifteenth; the third corrects the tenth, so that days lose rows too."""
    ev, land, root = load(spark, sf, "events"), work_dir(spark, "landing"), work_dir(spark, "lake")
    wrong = (F.dayofmonth("ts") == 10) & (F.col("event_id") % 2 == 0)
    first = ev.where(F.dayofmonth("ts") != 15).withColumns({
        "ts": F.when(wrong, F.col("ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("ts")),
        "value": F.when(wrong, F.col("value") * 3).otherwise(F.col("value"))})
    days = [TPCH_RUN_DATE + dt.timedelta(days=i) for i in range(3)]
    for day, rows in zip(days, (first, ev.where(F.dayofmonth("ts") == 15), ev.where(wrong))):
        _drop(rows, land, F.lit(f"events_{day:%Y%m%d}.jsonl"), "ndjson")
        run_daily(spark, events_config(), land, root, day, run_id=f"run-{day:%d}", ingested_at=f"{day} 06:00:00")
    return TableStore(spark, root)


def kpi_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """A1, A2, M9: the mart after three deliveries, of which the later ones count
    anew only the days that they change."""
    return _kpi_runs(spark, sf).read("gold", "kpi_daily")


def kpi_days_anew(spark: SparkSession, sf: str) -> DataFrame:
    """How many days each of these runs counted anew (null: all)."""
    ledger = _kpi_runs(spark, sf).read("gold", "run_ledger").where("step = 'gold'")
    return ledger.select("run_id", F.regexp_extract("detail", "^([0-9]+) days", 1).try_cast("bigint").alias("days"))


LEDGER_COLS = ["run_id", "seq", "step", "table_name", "status", "rows_in", "rows_out", "quarantined"]


def _run(spark: SparkSession, sf: str, runs: int) -> TableStore:
    land = tpch_landing(spark, sf, work_dir(spark, "landing"))
    root = work_dir(spark, "lake")
    for i in range(runs):
        run_daily(spark, tpch_config(), land, root, TPCH_RUN_DATE, run_id=f"run-{i + 1}",
                  ingested_at=f"2024-02-01 0{6 + i}:00:00")
    return TableStore(spark, root)


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    store = _run(spark, sf, 1)
    steps = ("ingest", "silver", "quality", "gold", "validate")
    return store.read("gold", "run_ledger").where(F.col("step").isin(*steps)).select(*LEDGER_COLS)


def run_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Every rule's outcome and the action taken, as ledger rows."""
    store = _run(spark, sf, 1)
    return store.read("gold", "run_ledger").where("step = 'rule'").select(
        "table_name", F.regexp_extract("detail", "^[a-z_]+", 0).alias("rule_id"), "status", "rows_in", "quarantined")


def _late_orders(spark: SparkSession, sf: str, crash: bool, incremental: bool) -> TableStore:
    """Two deliveries: on day one customers with an odd key are missing, so
    their orders are orphans; day two brings them. With ``crash`` the first run
    fails in its gold step, after ingest and silver."""
    land, root = work_dir(spark, "landing"), work_dir(spark, "lake")
    days = [TPCH_RUN_DATE, TPCH_RUN_DATE + dt.timedelta(days=1)]
    c = load(spark, sf, "customer")
    _drop(c.where("c_custkey % 2 = 0"), land, F.lit(f"customer_{days[0]:%Y%m%d}.csv"), "csv")
    _drop(load(spark, sf, "orders"), land, F.lit(f"orders_{days[0]:%Y%m%d}.csv"), "csv")
    _drop(load(spark, sf, "lineitem"), land, F.lit(f"lineitem_{days[0]:%Y%m%d}.jsonl"), "ndjson")
    _drop(c.where("c_custkey % 2 <> 0"), land, F.lit(f"customer_{days[1]:%Y%m%d}.csv"), "csv")
    config = tpch_config()
    for i, day in enumerate(days):
        broken = crash and i == 0

        def fail(store: TableStore) -> dict[str, DataFrame]:
            raise RuntimeError("the first run is lost here")
        cfg = JobConfig(config.contracts, config.steps, config.specs, fail if broken else config.gold_models, config.checks)
        try:
            run_daily(spark, cfg, land, root, day, run_id=f"run-{i + 1}", incremental=incremental,
                      ingested_at=f"2024-02-0{i + 1} 06:00:00")
        except RuntimeError:
            if not broken:
                raise
    return TableStore(spark, root)


def _state(store: TableStore) -> DataFrame:
    """Keys, layer and reason of all three tables."""
    out = []
    for t, key in (("customer", ["c_custkey"]), ("orders", ["o_orderkey"]), ("lineitem", LI_KEY)):
        k = F.concat_ws("/", *[F.col(x).cast("string") for x in key]).alias("key")
        out.append(store.read("silver", t).select(F.lit(t).alias("table_name"), k, F.lit("silver").alias("layer"),
                                                  F.lit(None).cast("string").alias("reason")))
        out.append(store.read("quarantine", t).select(F.lit(t).alias("table_name"), k, F.lit("quarantine").alias("layer"),
                                                      F.col("_reject_reason").alias("reason")))
    return rc.combine(out)


def run_late_parent(spark: SparkSession, sf: str) -> DataFrame:
    """Orphans of day one whose parents come on day two leave quarantine."""
    return _state(_late_orders(spark, sf, crash=False, incremental=True))


def run_evaluated(spark: SparkSession, sf: str) -> DataFrame:
    """What the second delivery has judged: its own rows, and the rows
    below parents that came with it."""
    store = _late_orders(spark, sf, crash=False, incremental=True)
    return store.read("gold", "run_ledger").where("run_id = 'run-2' AND step = 'quality'").select(
        "table_name", "rows_in", "rows_out", "quarantined")


def run_recovery(spark: SparkSession, sf: str) -> DataFrame:
    """What a failed run had ingested is carried on by the next one."""
    return _state(_late_orders(spark, sf, crash=True, incremental=True))


def run_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the same drop: bronze doubles, silver/quarantine/gold do not."""
    store = _run(spark, sf, 2)
    counts = [store.read(layer, t).agg(F.lit(f"{layer}.{t}").alias("table_name"),
                                        F.count(F.lit(1)).alias("rows"))
              for layer, t in (("bronze", "customer"), ("bronze", "orders"), ("bronze", "lineitem"),
                               ("silver", "customer"), ("silver", "orders"), ("silver", "lineitem"),
                               ("quarantine", "customer"), ("quarantine", "orders"), ("quarantine", "lineitem"),
                               ("gold", "fact_lineitem"), ("gold", "dim_date"))]
    return rc.combine(counts)


JOB_QUERIES = {
    "stream_bronze": stream_bronze,
    "stream_upsert": stream_upsert,
    "stream_dedupe": stream_dedupe,
    "stream_rescue": stream_rescue,
    "run_summary": run_summary,
    "run_ledger": run_ledger,
    "run_rules": run_rules,
    "run_late_parent": run_late_parent,
    "run_evaluated": run_evaluated,
    "run_null_keys": run_null_keys,
    "sql_model_customer_orders": sql_model_customer_orders,
    "sql_model_segment_value": sql_model_segment_value,
    "sql_model_best_segments": sql_model_best_segments,
    "run_recovery": run_recovery,
    "kpi_incremental": kpi_incremental,
    "kpi_days_anew": kpi_days_anew,
}
