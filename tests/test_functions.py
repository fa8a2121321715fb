"""Scalar function semantics (permissive casts and conforming)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tierflow.functions.columns import (file_date, money_avg_round, money_mul_round, money_sum_round, pct,
                                        safe_to_date, safe_to_double, safe_to_timestamp, strip_all,
                                        text_to_bool)


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_safe_casts(spark):
    assert one(spark, safe_to_date("v"), "2026-07-01") == dt.date(2026, 7, 1)
    assert one(spark, safe_to_date("v"), "2026-07") is None            # partial date is bad, not a guess
    assert one(spark, safe_to_date("v"), "not a date") is None
    assert one(spark, safe_to_double("v"), " 7 ") == 7.0
    assert one(spark, safe_to_double("v"), "1e3") == 1000.0
    assert math.isnan(one(spark, safe_to_double("v"), "NaN"))
    assert one(spark, safe_to_double("v"), "12,5") is None
    assert one(spark, safe_to_timestamp("v"), "2026-07-01T10:11:12") == dt.datetime(2026, 7, 1, 10, 11, 12)
    assert one(spark, safe_to_timestamp("v"), "yesterday") is None


def test_conforming(spark):
    assert one(spark, strip_all("v"), " \t Name 1\n\r ") == "Name 1"
    assert one(spark, text_to_bool("v"), "TRUE") is True
    assert one(spark, text_to_bool("v"), "no") is False
    assert one(spark, text_to_bool("v"), None) is None
    assert one(spark, file_date("v"), "transactions_20260701.jsonl") == dt.date(2026, 7, 1)
    assert one(spark, file_date("v"), "transactions.jsonl") is None


def test_money_rounding_exact(spark):
    df = spark.createDataFrame([(1.005, 1.0), (2.675, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(money_mul_round("a", "b")).collect()] == [1.01, 2.68]
    agg = df.agg(money_sum_round("a").alias("s"), money_avg_round("a").alias("m"),
                 pct(F.count_if(F.col("a") > 2), F.count(F.lit(1))).alias("p")).first()
    assert (agg["s"], agg["m"], agg["p"]) == (3.68, 1.84, 50.0)
