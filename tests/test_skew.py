"""Hot keys: a third of the rows on one key must still give exact results,
and the plans must pre-aggregate / pre-limit before the shuffle."""

from pyspark.sql import functions as F

from tierflow.operators.dedupe import latest_per_key
from tierflow.operators.rules import compile_rules, report, samples

SF = "/root/testdata/sf0.001"


def skewed_lineitem(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    # every row with line number <= 2 (about a third) gets the same order key
    return li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 2, F.lit(1)).otherwise(F.col("l_orderkey")))


def test_hot_key_dedupe_matches_brute_force(spark):
    li = skewed_lineitem(spark)
    hot = li.where("l_orderkey = 1").count() / li.count()
    assert hot > 0.25
    got = latest_per_key(li, ["l_orderkey", "l_linenumber"],
                         ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    pdf = li.toPandas().sort_values(["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"],
                                    ascending=False)
    want = pdf.drop_duplicates(["l_orderkey", "l_linenumber"], keep="first")
    assert got.count() == len(want)
    g = got.toPandas().sort_values(["l_orderkey", "l_linenumber"]).reset_index(drop=True)
    w = want.sort_values(["l_orderkey", "l_linenumber"]).reset_index(drop=True)
    assert (g["l_partkey"].values == w["l_partkey"].values).all()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_hot_key_unique_and_samples(spark):
    li = skewed_lineitem(spark)
    comp = compile_rules(li, [{"id": "u", "type": "unique", "column": ["l_orderkey", "l_linenumber"]},
                              {"id": "q", "type": "range", "column": "l_quantity", "max": 45}])
    rep = {r["rule_id"]: r["failed_rows"] for r in report(comp, "t").collect()}
    pdf = li.toPandas()
    n = pdf.groupby(["l_orderkey", "l_linenumber"])["l_partkey"].transform("size")
    assert rep["u"] == int((n > 1).sum())
    assert rep["q"] == int((pdf["l_quantity"] > 45).sum())
    s = samples(comp, ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    assert s.groupBy("rule_id").count().where("count > 5").count() == 0
    # the duplicate count is a partial/final hash aggregate, not a window over the hot key
    plan = comp.frame._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Window " not in plan


def test_hot_day_kpi(spark):
    from tierflow.plans import gold
    ev = spark.read.parquet(f"{SF}/events.parquet")
    tx = ev.select(F.when(F.col("event_id") % 3 == 0, F.lit("2024-01-01").cast("date"))
                   .otherwise(F.to_date("ts")).alias("event_date"),
                   F.col("user_id").alias("account_id"), F.col("value").alias("amount_bob"),
                   (F.col("event_type") == "error").alias("is_flagged"), F.lit(False).alias("is_late"),
                   F.col("event_type").alias("channel"))
    k = gold.kpi_daily(tx, quarantined=None, channels={"view_events": "view"})
    pdf = tx.toPandas()
    want = pdf.groupby("event_date").size()
    got = {r["event_date"]: r["txn_count"] for r in k.collect()}
    assert got == {d: int(c) for d, c in want.items()}
