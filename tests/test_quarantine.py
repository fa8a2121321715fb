"""Moves to quarantine and back, split invariants and cascades."""

import datetime as dt

from pyspark.sql import functions as F

from tierflow.operators.quarantine import bad_rows, cascade, split, tag_layers
from tierflow.operators.rules import compile_rules
from tierflow.plans.job import RunSummary, apply_quality, bank_specs
from tierflow.sinks.store import TableStore

SCHEMA = ("customer_id string, full_name string, doc_id string, birth_date date, city string, "
          "segment string, risk_rating string, created_at date, _run_id string")


def people():
    """Four customers: one sound, one without a document, one without a birth
    date, and one that lacks both."""
    born, since = dt.date(1984, 2, 29), dt.date(2019, 11, 5)
    return [("K-7", "Ana", "D7", born, "Sucre", "premium", "medium", since, "r"),
            ("K-8", "Luz", None, born, "Sucre", "business", "high", since, "r"),
            ("K-9", "Teo", "D9", None, "Potosi", "retail", "low", since, "r"),
            ("K-10", "Eva", None, None, "Oruro", "retail", "low", since, "r")]


def test_failing_customers_leave_silver_and_return_when_mended(spark, tmp_root):
    store = TableStore(spark, tmp_root)
    store.write("silver", "customers", spark.createDataFrame(people(), SCHEMA), mode="overwrite")
    summary = RunSummary("r", dt.date(2026, 7, 1))
    assert apply_quality(store, "customers", bank_specs()["customers"], summary) == 3
    held = {r["customer_id"]: r["_reject_reason"] for r in store.read("quarantine", "customers").collect()}
    assert held == {"K-8": "doc_id_not_null", "K-9": "birth_date_not_null", "K-10": "doc_id_not_null;birth_date_not_null"}
    assert [r["customer_id"] for r in store.read("silver", "customers").collect()] == ["K-7"]

    # the same faulty row again stays one copy; a mended one is released
    again = [people()[1], (*people()[2][:3], dt.date(2001, 3, 4), *people()[2][4:])]
    store.merge("silver", "customers", spark.createDataFrame(again, SCHEMA), key="customer_id")
    assert apply_quality(store, "customers", bank_specs()["customers"], summary) == 1
    assert sorted(r["customer_id"] for r in store.read("quarantine", "customers").collect()) == ["K-10", "K-8"]
    assert sorted(r["customer_id"] for r in store.read("silver", "customers").collect()) == ["K-7", "K-9"]
    rules = {(r[1], r[2]) for r in summary.rules}
    assert ("doc_id_not_null", "quarantine") in rules and ("birth_date_not_null", "ok") in rules


def test_split_is_a_partition_of_the_input(spark):
    df = spark.range(1000).withColumn("v", (F.col("id") % 7) - 3)
    comp = compile_rules(df, [{"id": "pos", "type": "fail_when", "expr": "v < 0"},
                              {"id": "w", "type": "fail_when", "expr": "v = 3", "severity": "warn"}])
    good, bad = split(comp)
    assert good.count() + bad.count() == 1000
    assert good.join(bad, "id").count() == 0
    t = tag_layers(comp)
    assert t.where("_layer = 'quarantine'").count() == bad.count()
    assert bad.where("_reject_reason = 'pos'").count() == bad.count()   # warn rules never move rows


def test_cascade_orphans_children(spark):
    parents = spark.createDataFrame([(1, 10.0), (2, -5.0)], "pid long, bal double")
    kids = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "kid long, pid long")
    out = cascade([("parents", parents, [{"id": "bal_ok", "type": "fail_when", "expr": "bal < 0"}]),
                   ("kids", kids, [{"id": "parent_exists", "type": "foreign_key", "column": "pid",
                                    "ref": "parents", "ref_column": "pid"}])])
    assert bad_rows(out["parents"]).count() == 1
    assert [r["kid"] for r in bad_rows(out["kids"]).collect()] == [3]


def test_report_passed_and_keyless_quarantine_appends(spark, tmp_root):
    from tierflow.operators.rules import Spec, passed, report
    store = TableStore(spark, tmp_root)
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id long, v double")
    store.write("silver", "nums", df, mode="overwrite")
    spec = Spec.from_dict({"rules": [{"id": "v_positive", "type": "fail_when", "expr": "v <= 0"},
                                     {"id": "v_present", "type": "not_null", "column": "v", "severity": "warn"}]})
    rep = report(compile_rules(df, spec.rules), "silver.nums")
    assert rep.agg(passed(rep).alias("p")).first()["p"] is False
    ok = report(compile_rules(df, spec.select(severity="warn")), "silver.nums")
    assert ok.agg(passed(ok).alias("p")).first()["p"] is True
    summary = RunSummary("r", dt.date(2026, 7, 1))
    assert apply_quality(store, "nums", spec, summary) == 1
    assert apply_quality(store, "nums", spec, summary) == 0          # already clean
    store.write("silver", "nums", df, mode="overwrite")
    apply_quality(store, "nums", spec, summary)                      # no key: appended again
    assert store.read("quarantine", "nums").count() == 2
    assert sorted(r["id"] for r in store.read("silver", "nums").collect()) == [1, 3]


def test_evaluate_then_quarantine_subset(spark, tmp_root):
    from tierflow.plans.job import evaluate_table, quarantine_failures
    store = TableStore(spark, tmp_root)
    store.write("silver", "customers", spark.createDataFrame(people(), SCHEMA), mode="overwrite")
    spec = bank_specs()["customers"]
    rep = {r["rule_id"]: r["failed_rows"] for r in evaluate_table(store, "silver", "customers", spec).collect()}
    assert rep["doc_id_not_null"] == 2 and rep["birth_date_not_null"] == 2
    assert store.read("silver", "customers").count() == 4                   # evaluation moves nothing
    assert quarantine_failures(store, "silver", "customers", spec, rule_ids=["doc_id_not_null"]) == 2
    assert sorted(r["customer_id"] for r in store.read("silver", "customers").collect()) == ["K-7", "K-9"]
