"""Driver tables (parquet) and their mapping onto the pipeline's domain.

The driver tables are TPC-H-like plus an ``events`` stream. The pipeline's
operators take their domain (columns, keys, currencies) as parameters; the
views below give the driver tables the shapes the operators expect, so every
query's work grows with the tables themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Events are delivered in daily files named events_<yyyyMMdd>.jsonl
# with a one-hour delivery lag, so an event is "late" when ts + 1 hour falls on
# a later day than ts (its file's date is after its event date).
EVENT_DELIVERY_LAG = "INTERVAL 1 HOUR"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown driver table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_as_transactions(events: DataFrame) -> DataFrame:
    """events -> transaction-shaped rows (event_type doubles as currency,
    type and channel; ``error`` events are the flagged ones)."""
    delivered = F.col("ts") + F.expr(EVENT_DELIVERY_LAG)
    src = F.concat(F.lit("events_"), F.date_format(delivered, "yyyyMMdd"), F.lit(".jsonl"))
    return events.select(
        F.col("event_id").alias("txn_id"), F.col("user_id").alias("account_id"), F.col("ts"),
        F.col("value").alias("amount"), F.col("event_type").alias("currency"),
        F.col("event_type").alias("txn_type"), F.col("event_type").alias("channel"),
        (F.col("event_type") == F.lit("error")).alias("is_flagged"),
        src.alias("_source_file"))
