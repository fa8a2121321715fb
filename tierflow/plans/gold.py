"""Gold layer: star-schema dimensions, the transaction fact and the daily KPI
mart, as parameterised DataFrame builders (the same builders serve the
banking pipeline and the driver tables), and the runner of named models.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import money_avg_round, money_sum_round, pct
from tierflow.sinks.store import isin_values

# Banking channels counted by the KPI mart (output column -> channel).
BANK_CHANNELS = {"atm_txns": "ATM", "pos_txns": "POS", "web_txns": "web", "branch_txns": "branch"}


def kpi_daily(tx: DataFrame, *, quarantined: DataFrame | None, date_col: str = "event_date",
              amount_col: str = "amount_bob", account_col: str = "account_id",
              flag_col: str = "is_flagged", late_col: str | None = "is_late",
              channel_col: str = "channel", channels: Mapping[str, str] = BANK_CHANNELS) -> DataFrame:
    """Per day: count, ROUND(SUM), ROUND(AVG), COUNT(DISTINCT account),
    flagged %, late count, one filtered count per channel and the global
    quarantine share q / (q + silver rows).

    One hash aggregate (partial per map task, final per day); the two global
    counts are scalar subqueries, not a cross join."""
    daily = daily_measures(tx, date_col, amount_col, account_col, flag_col, late_col, channel_col, channels)
    return _with_quarantine_rate(daily, quarantined, tx.agg(F.count(F.lit(1))).scalar())


def daily_measures(tx: DataFrame, date_col: str = "event_date", amount_col: str = "amount_bob", account_col: str = "account_id",
                   flag_col: str = "is_flagged", late_col: str | None = "is_late", channel_col: str = "channel",
                   channels: Mapping[str, str] = BANK_CHANNELS) -> DataFrame:
    """The columns of :func:`kpi_daily` that depend on the rows of their day alone."""
    n = F.count(F.lit(1))
    measures: list[Column] = [
        n.alias("txn_count"),
        money_sum_round(amount_col).alias("volume_bob"),
        money_avg_round(amount_col).alias("avg_txn_bob"),
        F.count_distinct(F.col(account_col)).alias("active_accounts"),
        pct(F.count_if(F.col(flag_col)), n).alias("fraud_flag_rate_pct"),
    ]
    if late_col:
        measures.append(F.count_if(F.col(late_col)).alias("late_txns"))
    for out, value in channels.items():
        measures.append(F.count_if(F.col(channel_col) == F.lit(value)).alias(out))
    return tx.groupBy(F.col(date_col).alias("event_date")).agg(*measures)


def _with_quarantine_rate(daily: DataFrame, quarantined: DataFrame | None, total: Column) -> DataFrame:
    q = (quarantined.agg(F.count(F.lit(1))).scalar() if quarantined is not None
         else F.lit(0).cast("long"))
    # bind each scalar subquery to a column once: the rate expression uses
    # them several times and must not re-run a subquery per reference
    return (daily.withColumns({"__q": q, "__n": total})
            .withColumn("quarantine_rate_pct", pct(F.col("__q"), F.col("__q") + F.col("__n")))
            .drop("__q", "__n"))


def grow_kpi(kpi: DataFrame, tx: DataFrame, days: Sequence, *, quarantined: DataFrame | None,
             date_col: str = "event_date", **measures) -> DataFrame:
    """The mart after the rows of ``days`` alone have changed (come, gone or moved)
    since ``kpi``: these days are counted anew and the others kept, so that of
    ``tx``, partitioned by ``date_col``, only their folders are read. None among
    ``days`` is the day of rows without a date. The quarantine share changes for
    every day; its total is the sum of the days' counts."""
    changed = isin_values(F.col("event_date"), days)
    fresh = daily_measures(tx.where(isin_values(F.col(date_col), days)), date_col, **measures)
    kept = kpi.where(~F.coalesce(changed, F.lit(False))).drop("quarantine_rate_pct")
    daily = kept.unionByName(fresh)
    total = daily.agg(F.coalesce(F.sum("txn_count"), F.lit(0))).scalar()
    return _with_quarantine_rate(daily, quarantined, total)


def dim_date(dates: DataFrame, date_col: str = "event_date") -> DataFrame:
    """Calendar with one row per day between MIN and MAX of ``date_col``
    (no rows when the input is empty). Days without activity are included."""
    bounds = dates.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    d = F.col("d")
    iso = F.extract(F.lit("DAYOFWEEK_ISO"), d)
    return days.select(
        d.alias("date_key"),
        F.year(d).cast("long").alias("year"), F.quarter(d).cast("long").alias("quarter"),
        F.month(d).cast("long").alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).cast("long").alias("day"), iso.cast("long").alias("iso_weekday"),
        F.date_format(d, "EEEE").alias("weekday_name"), iso.isin(6, 7).alias("is_weekend"))


def dim_customer(silver_customers: DataFrame) -> DataFrame:
    """SCD type 1 customer dimension (latest attributes already won in silver)."""
    cols = [c for c in silver_customers.columns if c not in ("_run_id", "created_at")]
    out = silver_customers.select(*cols, *(
        [F.col("created_at").alias("customer_since")] if "created_at" in silver_customers.columns else []))
    return out


def dim_account(silver_accounts: DataFrame,
                columns: Sequence[str] = ("account_id", "customer_id", "account_type", "currency",
                                          "opened_at", "status")) -> DataFrame:
    return silver_accounts.select(*[c for c in columns if c in silver_accounts.columns])


def fact_transactions(tx: DataFrame, accounts: DataFrame, *, key: str = "account_id",
                      customer_col: str = "customer_id", select: Sequence | None = None) -> DataFrame:
    """Left join each transaction to its account to resolve the customer.

    Accounts reduce to (key, customer) before the join, which Spark plans by
    size: as a broadcast if they fit, otherwise as a shuffle on the account key
    (AQE splits skewed partitions)."""
    acc = accounts.select(F.col(key).alias("__acc"), F.col(customer_col).alias(customer_col))
    joined = tx.where(F.col(key).isNotNull()).join(acc, F.col(key) == acc["__acc"], "left").drop("__acc")
    # rows without an account need no join, so they are never dealt to one task
    joined = joined.unionByName(tx.where(F.col(key).isNull()).withColumn(customer_col, F.lit(None).cast(
        accounts.schema[customer_col].dataType)))
    if select is None:
        select = [F.col("txn_id"), F.col("event_date").alias("date_key"), F.col("account_id"),
                  F.col(customer_col), F.col("amount").alias("amount_orig"), F.col("currency"),
                  F.col("amount_bob"), F.col("txn_type"), F.col("channel"),
                  F.col("merchant_category"), F.col("is_flagged"), F.col("is_late")]
    return joined.select(*select)


def _kpi(store) -> DataFrame:
    q = store.read("quarantine", "transactions") if store.exists("quarantine", "transactions") else None
    return kpi_daily(store.read("silver", "transactions"), quarantined=q)


def _grow_kpi(store, days: Sequence) -> DataFrame:
    q = store.read("quarantine", "transactions") if store.exists("quarantine", "transactions") else None
    return grow_kpi(store.read("gold", "kpi_daily"), store.read("silver", "transactions"), days, quarantined=q)


#: The gold models of the banking lake by name.
BANK_MODELS = {
    "dim_account": lambda s: dim_account(s.read("silver", "accounts")),
    "dim_customer": lambda s: dim_customer(s.read("silver", "customers")),
    "dim_date": lambda s: dim_date(s.read("silver", "transactions")),
    "fact_transactions": lambda s: fact_transactions(s.read("silver", "transactions"), s.read("silver", "accounts")),
    "kpi_daily": _kpi,
}


#: Models that are brought up to date by some days: (silver table, its day, builder).
BANK_GROWN = {"kpi_daily": ("transactions", "event_date", _grow_kpi)}


def available_models() -> list[str]:
    return sorted(BANK_MODELS)


def run_model(store, name: str, models: Mapping | None = None) -> DataFrame:
    """Build one named model from the store's tables, write it as
    ``gold.<name>`` (a new snapshot) and return what was written."""
    models = BANK_MODELS if models is None else models
    if name not in models:
        raise ValueError(f"unknown gold model {name!r}; there are {', '.join(sorted(models))}")
    store.write("gold", name, models[name](store), mode="overwrite")
    return store.read("gold", name)
