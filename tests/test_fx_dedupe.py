"""FX fallback variants and latest-wins dedupe on small frames."""

import datetime as dt

from tierflow.operators.dedupe import latest_per_key
from tierflow.operators.fx import convert

D = dt.date


def test_fx_fallback_variants(spark):
    rates = spark.createDataFrame([(D(2026, 7, 1), "USD", 6.96), (D(2026, 7, 2), "USD", None),
                                   (D(2026, 7, 1), "EUR", 7.5)], "rate_date date, currency string, rate_to_bob double")
    tx = spark.createDataFrame([(1, D(2026, 6, 28), "USD", 10.0), (2, D(2026, 7, 1), "USD", 10.0),
                                (3, D(2026, 7, 2), "USD", 1.0), (4, D(2026, 6, 1), "EUR", 2.0),
                                (5, D(2026, 7, 1), "GBP", 3.0), (6, D(2026, 7, 1), "EUR", 1.0)],
                               "id int, event_date date, currency string, amount double")

    def run(fb):
        return {r["id"]: r["amount_bob"] for r in convert(tx, rates, fallback=fb).collect()}

    assert run(None) == {1: None, 2: 69.6, 3: None, 4: None, 5: None, 6: 7.5}
    # last row of USD (07-02) has a null rate -> no fallback, as the reference code does
    assert run("last_row") == {1: None, 2: 69.6, 3: None, 4: 15.0, 5: None, 6: 7.5}
    assert run("last_known") == {1: 69.6, 2: 69.6, 3: 6.96, 4: 15.0, 5: None, 6: 7.5}


def test_money_rounding_is_decimal(spark):
    rates = spark.createDataFrame([(D(2026, 7, 1), "X", 1.005)], "rate_date date, currency string, rate_to_bob double")
    tx = spark.createDataFrame([(1, D(2026, 7, 1), "X", 1.0)], "id int, event_date date, currency string, amount double")
    assert convert(tx, rates).first()["amount_bob"] == 1.01


def test_latest_wins_and_null_key_is_one_group(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), (None, 1, "n1"), (None, 3, "n3")],
                               "k string, t int, v string")
    out = {r["k"]: r["v"] for r in latest_per_key(df, "k", ["t"]).collect()}
    assert out == {"a": "new", None: "n3"}


def test_dedupe_plan_limits_before_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS t")
    plan = latest_per_key(df, "k", ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
