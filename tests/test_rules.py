"""Rule semantics, one rule type at a time."""

import pytest
from pyspark.sql import functions as F

from tierflow.operators.rules import Rule, Spec, compile_rules, report, samples, samples_nested


def failed(spark, rows, schema, rule, refs=None):
    df = spark.createDataFrame(rows, schema)
    comp = compile_rules(df, [rule], refs)
    return comp.frame.where(comp.mask(rule["id"])).count()


@pytest.mark.parametrize("values,bad", [([], 0), (["", " ", "null"], 0), ([None] * 4 + ["k"], 4)])
def test_not_null_means_null_only(spark, values, bad):
    assert failed(spark, [(v,) for v in values], "city string", {"id": "r", "type": "not_null", "column": "city"}) == bad


def test_unique_flags_every_copy_and_repeated_nulls(spark):
    rows = [(7,), (7,), (7,), (8,), (None,), (None,), (9,)]
    assert failed(spark, rows, "n int", {"id": "r", "type": "unique", "column": "n"}) == 5
    assert failed(spark, [(None,), (8,)], "n int", {"id": "r", "type": "unique", "column": "n"}) == 0


def test_unique_over_two_columns(spark):
    rows = [("o1", 1), ("o1", 2), ("o2", 1), ("o2", 1), (None, 3), (None, 3), (None, None)]
    assert failed(spark, rows, "o string, l int", {"id": "r", "type": "unique", "column": ["o", "l"]}) == 4


def test_allowed_values_are_exact_and_null_passes(spark):
    rows = [("open",), ("OPEN",), ("open ",), (None,), ("shut",), ("",)]
    assert failed(spark, rows, "s string", {"id": "r", "type": "allowed_values", "column": "s", "values": ["open", "shut"]}) == 3


@pytest.mark.parametrize("limits,bad", [({"min": -3, "max": 3}, 2), ({"min": -3}, 1), ({"max": 3}, 1), ({"min": 4, "max": 3}, 5)])
def test_range_includes_its_ends_and_null_passes(spark, limits, bad):
    rows = [(-3.0,), (3.0,), (-3.0001,), (3.0001,), (0.0,), (None,)]
    assert failed(spark, rows, "t double", {"id": "r", "type": "range", "column": "t", **limits}) == bad


def test_range_without_bounds_raises():
    with pytest.raises(ValueError):
        Rule.from_dict({"id": "r", "type": "range", "column": "a"})


def test_fail_when_is_a_predicate_over_the_row_and_unknown_passes(spark):
    rows = [(3, 2), (2, 3), (None, 1), (1, None), (2, 2)]
    assert failed(spark, rows, "sent int, seen int", {"id": "r", "type": "fail_when", "expr": "seen > sent"}) == 1


def test_foreign_key_looks_at_distinct_parents_and_null_passes(spark):
    parents = spark.createDataFrame([(10,), (10,), (20,), (None,)], "k int")
    rows = [(10,), (20,), (30,), (40,), (None,)]
    rule = {"id": "r", "type": "foreign_key", "column": "p", "ref": "silver.up", "ref_column": "k"}
    assert failed(spark, rows, "p int", rule, {"silver.up": parents}) == 2
    assert failed(spark, rows, "p int", rule, {"silver.up": parents.limit(0)}) == 4


def test_foreign_key_needs_resolver(spark):
    df = spark.createDataFrame([("P1",)], "pid string")
    with pytest.raises(ValueError):
        compile_rules(df, [{"id": "r", "type": "foreign_key", "column": "pid", "ref": "x.y", "ref_column": "id"}])


def test_unknown_type_raises():
    with pytest.raises(ValueError, match="unknown rule type"):
        Rule.from_dict({"id": "r", "type": "regex", "column": "a"})


def test_report_counts_and_passed(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, "x", -1.0), (2, "y", 3.0)], "k int, s string, v double")
    spec = Spec.from_dict({"key": "k", "rules": [
        {"id": "k_unique", "type": "unique", "column": "k"},
        {"id": "s_not_null", "type": "not_null", "column": "s", "severity": "warn"},
        {"id": "v_positive", "type": "fail_when", "expr": "v <= 0"}]})
    comp = compile_rules(df, spec.rules)
    rep = {r["rule_id"]: (r["failed_rows"], r["total_rows"], r["severity"]) for r in report(comp, "t").collect()}
    assert rep == {"k_unique": (2, 3, "error"), "s_not_null": (1, 3, "warn"), "v_positive": (1, 3, "error")}
    assert comp.frame.select(comp.reason().alias("r")).where("k = 2 AND v < 0").first()["r"] == "k_unique;v_positive"


def test_samples_at_most_n_ordered(spark):
    df = spark.range(100).withColumn("v", -F.col("id"))
    comp = compile_rules(df, [{"id": "neg", "type": "fail_when", "expr": "v < 0"}])
    s = samples(comp, ["id"], n=5).orderBy("sample_rank").collect()
    assert [r["id"] for r in s] == [1, 2, 3, 4, 5]
    nested = samples_nested(comp, ["id"], n=5).first()
    assert [x["id"] for x in nested["sample"]] == [1, 2, 3, 4, 5]


def test_masks_never_null(spark):
    df = spark.createDataFrame([(None,)], "a double")
    comp = compile_rules(df, [{"id": "r", "type": "fail_when", "expr": "a > 1"},
                              {"id": "q", "type": "range", "column": "a", "min": 0}])
    row = comp.frame.first()
    assert row["__m_r"] is False and row["__m_q"] is False


def test_spec_loading():
    import os
    from tierflow.operators.rules import load_spec
    from tierflow.plans.job import RULES_DIR, bank_specs
    assert load_spec(os.path.join(RULES_DIR, "silver_fx_rates.yml")).rules == []   # no file -> no rules
    specs = bank_specs()
    assert {t: len(s.rules) for t, s in specs.items()} == {"customers": 6, "accounts": 5, "transactions": 9}
    assert specs["transactions"].key == ["txn_id"]
    fk = [r for r in specs["transactions"].rules if r.type == "foreign_key"][0]
    assert (fk.ref, fk.ref_column, fk.severity) == ("silver.accounts", "account_id", "error")
    assert [r.id for r in specs["transactions"].select(severity="warn")] == [
        "channel_allowed", "late_arrivals", "fx_rate_missing"]
