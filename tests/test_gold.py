"""Gold builders: calendar edges and exact KPI rounding."""

import datetime as dt
import re

from tierflow.plans import gold


def test_dim_date_empty_and_weekend(spark):
    empty = spark.createDataFrame([], "event_date date")
    assert gold.dim_date(empty).count() == 0
    days = spark.createDataFrame([(dt.date(2026, 7, 3),), (dt.date(2026, 7, 6),)], "event_date date")
    rows = {r["date_key"]: r for r in gold.dim_date(days).collect()}
    assert len(rows) == 4                                        # 07-03 .. 07-06, gaps filled
    sat = rows[dt.date(2026, 7, 4)]
    assert (sat["iso_weekday"], sat["is_weekend"], sat["weekday_name"], sat["month_name"]) == \
        (6, True, "Saturday", "July")
    assert rows[dt.date(2026, 7, 6)]["is_weekend"] is False


def test_kpi_rounding_is_exact_half_up(spark):
    tx = spark.createDataFrame(
        [(dt.date(2026, 7, 1), "a", 1.00, True, False, "ATM"), (dt.date(2026, 7, 1), "b", 1.01, False, True, "web"),
         (dt.date(2026, 7, 2), "a", 2.675, False, False, "POS")],
        "event_date date, account_id string, amount_bob double, is_flagged boolean, is_late boolean, channel string")
    q = spark.createDataFrame([(1,)], "x int")
    k = {r["event_date"]: r for r in gold.kpi_daily(tx, quarantined=q).collect()}
    d1 = k[dt.date(2026, 7, 1)]
    assert (d1["txn_count"], d1["volume_bob"], d1["avg_txn_bob"]) == (2, 2.01, 1.01)    # 1.005 -> 1.01
    assert (d1["fraud_flag_rate_pct"], d1["late_txns"], d1["atm_txns"], d1["web_txns"]) == (50.0, 1, 1, 1)
    assert k[dt.date(2026, 7, 2)]["avg_txn_bob"] == 2.68                               # 2.675 -> 2.68
    assert d1["quarantine_rate_pct"] == 25.0                                           # 1 / (1 + 3)


def test_growing_mart_is_the_mart_of_all(spark):
    """Days that come, go, lose rows or have no date; kept days keep all but the quarantine share."""
    schema = "event_date date, account_id string, amount_bob double, is_flagged boolean, is_late boolean, channel string"

    def day(n):
        return n and dt.date(2026, 7, n)

    def table(rows):
        return spark.createDataFrame([(day(d), a, x, False, False, "ATM") for d, a, x in rows], schema)
    before = table([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 1.0), (3, "c", 5.0), (None, "a", 1.0)])
    after = table([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 1.5), (2, "b", 1.0), (4, "c", 5.0), (None, "a", 1.0), (None, "b", 1.0)])
    held = spark.createDataFrame([(1,)], "x int")
    was = gold.kpi_daily(before, quarantined=None)
    want = sorted(map(str, gold.kpi_daily(after, quarantined=held).collect()))
    got = gold.grow_kpi(was, after, [day(2), day(3), day(4), None], quarantined=held)
    assert sorted(map(str, got.collect())) == want
    same = table([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 1.5), (None, "a", 1.0)])
    got = gold.grow_kpi(was, same, [day(2), day(3)], quarantined=held)   # rows without a date are kept
    assert sorted(map(str, got.collect())) == sorted(map(str, gold.kpi_daily(same, quarantined=held).collect()))
    none = gold.grow_kpi(was, before.limit(0), [day(1), day(2), day(3), None], quarantined=held)
    assert none.count() == 0


def test_growing_mart_reads_only_the_folders_of_its_days(spark, tmp_root):
    from tierflow.sinks.store import TableStore
    store = TableStore(spark, tmp_root)
    rows = [(dt.date(2026, 7, d), "a", 1.0, False, False, "ATM") for d in range(1, 9)]
    store.write("silver", "t", spark.createDataFrame(rows, "event_date date, account_id string, amount_bob double, is_flagged boolean, is_late boolean, channel string"),
                mode="overwrite", partition_by=["event_date"])
    tx = store.read("silver", "t")
    grown = gold.grow_kpi(gold.kpi_daily(tx, quarantined=None), tx, [dt.date(2026, 7, 2)], quarantined=None)
    plan = gold.daily_measures(tx.where(tx["event_date"].isin([dt.date(2026, 7, 2)])))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan) and grown.count() == 8
