"""Silver builders: bronze strings -> typed, deduplicated, conformed rows.

Casts are permissive (bad text -> null) so data-quality rules, not the cast,
decide what happens to bad values. Latest-wins dedupe orders by
``_ingested_at`` then ``_source_file`` and the remaining columns, so equal
load times still resolve deterministically.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import (file_date, safe_to_date, safe_to_double, safe_to_timestamp,
                                        strip_all, text_to_bool)
from tierflow.operators.dedupe import latest_per_key
from tierflow.operators.fx import convert


def latest(bronze: DataFrame, key: str | Sequence[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in bronze.columns if c not in keys and c not in ("_ingested_at", "_source_file")]
    return latest_per_key(bronze, keys, ["_ingested_at", "_source_file", *rest])


def build_fx_rates(bronze: DataFrame) -> DataFrame:
    return latest(bronze, ["rate_date", "currency"]).select(
        safe_to_date("rate_date").alias("rate_date"), F.col("currency"),
        safe_to_double("rate_to_bob").alias("rate_to_bob"))


def build_customers(bronze: DataFrame) -> DataFrame:
    return latest(bronze, "customer_id").select(
        F.col("customer_id"), strip_all("full_name").alias("full_name"), F.col("doc_id"),
        safe_to_date("birth_date").alias("birth_date"), F.col("city"),
        F.lower("segment").alias("segment"), F.lower("risk_rating").alias("risk_rating"),
        safe_to_date("created_at").alias("created_at"), F.col("_run_id"))


def build_accounts(bronze: DataFrame) -> DataFrame:
    return latest(bronze, "account_id").select(
        F.col("account_id"), F.col("customer_id"), F.lower("account_type").alias("account_type"),
        F.col("currency"), safe_to_date("opened_at").alias("opened_at"),
        F.lower("status").alias("status"), F.col("_run_id"))


def type_transactions(bronze: DataFrame) -> DataFrame:
    """Typed transactions with event date and the late flag (event date
    before the delivery date stamped in the source file name)."""
    typed = latest(bronze, "txn_id").select(
        F.col("txn_id"), F.col("account_id"), safe_to_timestamp("ts").alias("ts"),
        safe_to_double("amount").alias("amount"), F.col("currency"), F.col("txn_type"),
        F.col("channel"), F.col("counterparty"), F.col("merchant_category"),
        text_to_bool("is_flagged").alias("is_flagged"), F.col("_source_file"), F.col("_run_id"))
    return (typed.withColumn("event_date", F.to_date("ts"))
                 .withColumn("is_late", F.col("event_date") < file_date("_source_file"))
                 .drop("_source_file"))


def build_transactions(bronze: DataFrame, fx: DataFrame, fallback: str | None = "last_row") -> DataFrame:
    return convert(type_transactions(bronze), fx, amount_col="amount", out_col="amount_bob",
                   fallback=fallback)
