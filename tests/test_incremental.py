"""A run that looks only at what changed ends as one that looks at everything."""

import datetime as dt
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.bank_fixture import bad_txn, write_drop
from tierflow.operators import fx
from tierflow.operators.rules import Rule, Spec, compile_rules
from tierflow.plans.incremental import affected, came_or_went, covers, fx_state, grow_converted, grow_keys, present_rows
from tierflow.plans.job import bank_config, run_daily
from tierflow.sinks.store import TableStore, same_key, upsert

TX = "txn_id string, event_date date, currency string, amount double"


def day(n):
    return dt.date(2026, 7, n)


@pytest.mark.parametrize("fallback", ["last_row", "last_known", "none"])
def test_growing_conversion_is_conversion_of_all(spark, fallback):
    """Random deliveries: corrections that move a row's day or currency, late and
    corrected rates, days without rates, null keys, days and currencies."""
    rnd = random.Random(7)
    tx, rates, out, state = {}, {}, None, None
    for step in range(4):
        new = {}
        for _ in range(25):
            key = rnd.choice([None, *map(str, range(60))])
            new[key] = (key, rnd.choice([None, *map(day, range(1 + step, 5 + step))]), rnd.choice(["USD", "EUR", "BOB", None]),
                        rnd.choice([None, float(rnd.randrange(1000))]))
        tx |= new
        for _ in range(4):
            k = (day(rnd.randrange(1, 9)), rnd.choice(["USD", "EUR", "BOB"]))
            rates[k] = (*k, rnd.choice([None, rnd.randrange(1, 9) / 2]))
        r = spark.createDataFrame(list(rates.values()), "rate_date date, currency string, rate_to_bob double")
        typed = spark.createDataFrame(list(new.values()), TX)
        if out is None:
            out = fx.convert(typed, r, amount_col="amount", out_col="amount_bob", fallback=fallback)
            state = fx_state(typed, r, fallback)
        else:
            grown, state = grow_converted(typed, out, r, state, ["txn_id"], fallback)
            out = upsert(out, grown, ["txn_id"], null_safe=True)
        # as a job would: lineage ends, and the plans stay small
        out = spark.createDataFrame(out.collect(), out.schema)
        state = {k: spark.createDataFrame(v.collect(), v.schema) for k, v in state.items()}
        full = fx.convert(spark.createDataFrame(list(tx.values()), TX), r, amount_col="amount", out_col="amount_bob", fallback=fallback)
        assert sorted(map(str, out.collect())) == sorted(map(str, full.select(*out.columns).collect()))


def test_only_rows_with_another_rate_are_converted_again(spark):
    tx = spark.createDataFrame([("a", day(1), "USD", 1.0), ("b", day(2), "USD", 1.0), ("c", day(1), "EUR", 1.0), ("d", day(2), "EUR", 1.0)], TX)
    rate = "rate_date date, currency string, rate_to_bob double"
    old = spark.createDataFrame([(day(1), "USD", 7.0), (day(1), "EUR", 8.0)], rate)
    state = fx_state(tx, old, "last_known")
    filled = state["state_fx_filled"]
    none = fx.converted_anew(tx, old, filled, old, filled)
    assert none.count() == 0
    new = spark.createDataFrame([(day(1), "USD", 7.5), (day(1), "EUR", 8.0)], rate)
    again = fx.converted_anew(tx, new, fx.fallback_rates(state["state_fx_days"], new, "last_known"), old, filled)
    assert sorted(r["txn_id"] for r in again.collect()) == ["a", "b"]


def test_rows_that_depend_on_changed_rows(spark):
    schema = "id int, code string, parent int"
    rest = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, None, 3), (4, "z", None), (5, "w", 9)], schema)
    built = spark.createDataFrame([(6, "x", 1), (7, None, 5)], schema)
    old = spark.createDataFrame([(7, "w", 5)], schema)
    spec = Spec(None, ["id"], [Rule.from_dict(r) for r in (
        {"id": "u", "type": "unique", "column": "code"}, {"id": "k", "type": "unique", "column": "id"},
        {"id": "f", "type": "foreign_key", "column": "parent", "ref": "silver.p", "ref_column": "p"})])
    came = {("silver.p", "p"): spark.createDataFrame([(2,)], "value int")}
    assert sorted(r["id"] for r in affected(rest, built, old, spec, ["id"], came).collect()) == [1, 2, 3, 5]
    assert affected(rest, built, old, Spec(None, ["id"], []), ["id"], {}) is None


def test_values_that_come_or_go(spark):
    before = spark.createDataFrame([(1,), (2,), (2,), (None,)], "p int")
    after = spark.createDataFrame([(2,), (3,), (3,), (None,)], "p int")
    judged, old = spark.createDataFrame([(3,), (2,)], "p int"), spark.createDataFrame([(1,)], "p int")
    assert sorted(r["value"] for r in came_or_went(before, after, judged, old, "p").collect()) == [1, 3]
    assert sorted(r["value"] for r in came_or_went(None, after, judged, None, "p").collect()) == [2, 3]


def test_unique_counts_in_the_whole_table(spark):
    table = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "id int, code string")
    rules = [{"id": "u", "type": "unique", "column": "code"}]
    got = compile_rules(table.where("id <> 2"), rules, universe=table).frame.collect()
    assert {r["id"]: r["__m_u"] for r in got} == {1: True, 3: False}


def drops(landing):
    """Five days with gaps: sources and rates that are missing, late rates, an
    orphan whose account comes later, corrections in both directions, null keys."""
    def fx_file(name, date, **rates):
        with open(os.path.join(landing, f"fx_rates_{name}.json"), "w", encoding="utf-8") as fh:
            json.dump({"date": date, "base": "BOB", "rates_to_bob": {"BOB": 1.0, **rates}}, fh)

    def txns(stamp, *rows):
        with open(os.path.join(landing, f"transactions_{stamp}.jsonl"), "w", encoding="utf-8") as fh:
            fh.writelines(json.dumps(r) + "\n" for r in rows)

    def text(name, body):
        with open(os.path.join(landing, name), "w", encoding="utf-8") as fh:
            fh.write(body)
    usd = dict(currency="USD")
    write_drop(landing, n_txns=30, extra_txns=[bad_txn("ORPHAN", account_id="ACC-000900"), bad_txn("NEG", amount=-1.0), bad_txn(None, amount=3.0),
                                               bad_txn("EUR-1", currency="EUR", amount=10.0), bad_txn("MOVES", **usd, amount=2.0)])
    txns("20260702", bad_txn("GAP-1", **usd, ts="2026-07-02T10:00:00"), bad_txn("GAP-2", currency="EUR", ts="2026-07-02T10:00:00"))  # no rates that day
    fx_file("20260703", "2026-07-03", USD=7.0)
    fx_file("late_20260703", "2026-07-02", EUR=7.9)                                                              # late
    txns("20260703", bad_txn("MOVES", **usd, ts="2026-07-03T10:00:00", amount=4.0), bad_txn("TXN-20260701-000003", amount=-3.0), bad_txn(None, amount=5.0))
    text("accounts_20260704.csv", "account_id,customer_id,account_type,currency,opened_at,status\nACC-000900,CUST-00001,x,BOB,2021-01-01,active\n"
                                  "ACC-000002,CUST-09999,x,BOB,2021-01-01,active\n")                              # one comes, one goes with its rows
    fx_file("20260705", "2026-07-01", USD=6.5)                                                                   # a corrected rate
    txns("20260705", bad_txn("NEG", amount=1.0), bad_txn("LAST", **usd, ts="2026-07-05T10:00:00"))
    text("customers_20260705.csv", "customer_id,full_name,doc_id,birth_date,city,segment,risk_rating,created_at\n"
                                   "CUST-09999,N,1,1980-01-01,La Paz,retail,low,2020-01-01\nCUST-00003,N,,1980-01-01,La Paz,retail,low,2020-01-01\n")


def state(store, t):
    keep = [c for c in store.read("silver", t).columns]
    held = store.read("quarantine", t).select("_reject_reason", *keep) if store.exists("quarantine", t) else None
    rows = [("silver", *r) for r in store.read("silver", t).select(F.lit(None), *keep).collect()]
    return sorted(map(str, rows + ([] if held is None else [("quarantine", *r) for r in held.collect()])))


def test_five_days_with_gaps(spark):
    ends = []
    for mode in (True, False):
        base = tempfile.mkdtemp(prefix="tierflow-days-")
        landing, lake = os.path.join(base, "landing"), os.path.join(base, "lake")
        drops_made = os.makedirs(landing) or drops(landing)
        assert drops_made is None
        days = []
        for n in range(1, 6):
            s = run_daily(spark, bank_config(), landing, lake, day(n), run_id=f"day-{n}", incremental=mode, ingested_at=f"2026-07-0{n} 06:00:00")
            assert all(ok for name, ok, _ in s.checks if name.startswith("row_conservation")), s.checks
            days.append({r[4]: r[6] for r in s.ledger if r[3] == "quality"})
        store = TableStore(spark, lake)
        ends.append({t: state(store, t) for t in ("fx_rates", "customers", "accounts", "transactions")})
        ends[-1]["kpi_daily"] = sorted(map(str, store.read("gold", "kpi_daily").collect()))
        if mode:
            assert {r[9] for r in s.ledger if r[3:5] == ("gold", "kpi_daily")} != {None}     # not all days
            assert days[0]["transactions"] == 35
            # day 2 brings two rows; the last day of both currencies is now one without rates, so rows that had a fallback lose it
            assert days[1]["transactions"] < 10 and days[1]["customers"] == 0
            assert days[3]["accounts"] == 2 and 1 <= days[3]["transactions"] <= 5
        else:
            assert days[4]["transactions"] > 35
    for t in ends[0]:
        assert ends[0][t] == ends[1][t], t


def test_a_table_changed_otherwise_is_judged_whole(spark):
    base = tempfile.mkdtemp(prefix="tierflow-settle-")
    landing, lake = os.path.join(base, "landing"), os.path.join(base, "lake")
    write_drop(landing, n_txns=20)
    store = TableStore(spark, lake)
    run_daily(spark, bank_config(), landing, lake, day(1), run_id="a", ingested_at="2026-07-01 06:00:00")
    acc = store.read("silver", "accounts")
    store.write("silver", "accounts", acc.where("account_id <> 'ACC-000002'"), mode="overwrite")   # by hand
    os.rename(os.path.join(landing, "fx_rates_20260701.json"), os.path.join(landing, "fx_rates_20260702.json"))
    s = run_daily(spark, bank_config(), landing, lake, day(2), run_id="b", ingested_at="2026-07-02 06:00:00")
    assert {r[4]: r[6] for r in s.ledger if r[3] == "quality"}["transactions"] == 20
    assert [r[9] for r in s.ledger if r[3:5] == ("gold", "kpi_daily")] == [None]     # all days
    q = store.read("quarantine", "transactions")
    assert q.count() > 0 and {r["_reject_reason"] for r in q.collect()} == {"account_exists"}
    assert same_key(q, store.read("silver", "transactions"), ["txn_id"], "left_semi").count() == 0
    assert present_rows(store, "transactions", ["txn_id"], ["txn_id"]).count() == 20


def test_no_rows_are_sought_below_parents_that_stayed(spark):
    rest = spark.createDataFrame([(1, 1), (2, None)], "id int, parent int")
    spec = Spec(None, ["id"], [Rule.from_dict({"id": "f", "type": "foreign_key", "column": "parent", "ref": "silver.p", "ref_column": "p"})])
    none = spark.createDataFrame([], "value int")
    assert affected(rest, rest.limit(0), rest.limit(0), spec, ["id"], {("silver.p", "p"): none}) is None


def test_built_rows_that_have_every_key(spark):
    schema = "a int, b string"
    built = spark.createDataFrame([(1, "x"), (1, None), (None, "y"), (1, "x")], schema)
    held = spark.createDataFrame([(None, "y"), (None, "y")], schema)
    assert covers(built, [built, held], ["a", "b"])
    assert not covers(built, [built, spark.createDataFrame([(None, None)], schema)], ["a", "b"])
    assert covers(built, [built.limit(0)], ["a", "b"])


def test_keys_of_bronze_grow_by_new_ones(spark, tmp_root):
    store, schema = TableStore(spark, tmp_root), "k string, j string, other int"
    grow_keys(store, "t", spark.createDataFrame([("a", None, 1), ("a", None, 2), (None, None, 3)], schema), ["k", "j"])
    grow_keys(store, "t", spark.createDataFrame([("a", None, 4), (None, "z", 5), (None, "z", 6), (None, None, 7)], schema), ["k", "j"])
    before = sorted(os.listdir(store.current("gold", "state_keys_t").removeprefix("file:")))
    grow_keys(store, "t", spark.createDataFrame([], schema), ["k", "j"])
    assert sorted(os.listdir(store.current("gold", "state_keys_t").removeprefix("file:"))) == before
    assert sorted(map(tuple, store.read("gold", "state_keys_t").collect()), key=str) == [("a", None), (None, "z"), (None, None)]


def test_a_drop_delivered_again_rewrites_silver_without_a_join(spark, tmp_root, monkeypatch):
    """The second delivery has every key, so silver's rows are not dealt again."""
    from tierflow.plans import job
    from tierflow.plans.driver_jobs import TPCH_RUN_DATE, _drop, small_config
    land, lake, joined = f"{tmp_root}/landing", f"{tmp_root}/lake", []
    real = job.same_key
    monkeypatch.setattr(job, "same_key", lambda left, right, keys, how, *a: joined.append((how, "_run_id" in left.columns, left.columns[-1])) or real(left, right, keys, how, *a))
    c = spark.createDataFrame([(i, f"n{i}", 1, float(i - 2), "S") for i in range(9)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    o = spark.createDataFrame([(i, i % 12, "F", 2.0, "1995-01-01", "x") for i in range(40)],
                              "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string")
    _drop(c, land, F.lit("customer_20240201.csv"), "csv")
    _drop(o, land, F.lit("orders_20240201.csv"), "csv")
    ends = []
    for i in (1, 2):
        joined.clear()
        run_daily(spark, small_config(lambda s: {}), land, lake, TPCH_RUN_DATE, run_id=f"run-{i}", ingested_at=f"2024-02-01 0{i}:00:00")
        store = TableStore(spark, lake)
        ends.append([[r[:-1] for r in map(tuple, store.read("silver", t).orderBy(k).collect())] for t, k in (("customer", "c_custkey"), ("orders", "o_orderkey"))])
    assert ends[0] == ends[1] and {r["_run_id"] for r in store.read("silver", "orders").collect()} == {"run-2"}
    # what is built lazily for `rest` and `old` aside, only quarantine is joined
    assert [j for j in joined if j[0] == "left_anti" and j[2] == "_run_id"] == [("left_anti", True, "_run_id")] * 2
