"""Landing listing/routing, contract inspection, rescue, streaming restart."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tierflow.sources import contracts as ct
from tierflow.sources.landing import (format_of, list_landing_files, read_csv_grouped, read_json_map,
                                      read_ndjson, source_of)
from tierflow.streaming.bronze_stream import stream_bronze


def test_routing_and_formats():
    assert source_of("/x/customers_20260701.csv", list(ct.BANK_CONTRACTS)) == "customers"
    assert source_of("fx_rates_20260701.json", list(ct.BANK_CONTRACTS)) == "fx_rates"
    with pytest.raises(ValueError):
        source_of("weird_20260701.csv", list(ct.BANK_CONTRACTS))
    with pytest.raises(ValueError):
        format_of("customers_20260701.xlsx")


def test_listing_by_stamp(spark):
    d = tempfile.mkdtemp(prefix="tierflow-land-")
    for n in ("a_20260701.csv", "b_20260701.jsonl", "a_20260702.csv"):
        open(os.path.join(d, n), "w").write("x\n1\n")
    names = [r["file_name"] for r in list_landing_files(spark, d, "20260701").collect()]
    assert names == ["a_20260701.csv", "b_20260701.jsonl"]


def test_ndjson_verbatim_text(spark):
    d = tempfile.mkdtemp(prefix="tierflow-json-")
    with open(os.path.join(d, "transactions_20260701.jsonl"), "w") as fh:
        fh.write('{"txn_id": "T1", "amount": 100.0}\n{"txn_id": "T2", "amount": 1e3}\n'
                 '{"txn_id": "T3", "amount": 12345678901234567890}\n')
    got = {r["txn_id"]: r["amount"] for r in read_ndjson(spark, d).collect()}
    assert got == {"T1": "100.0", "T2": "1e3", "T3": "12345678901234567890"}


def test_csv_grouped_by_header_binds_by_name(spark):
    d = tempfile.mkdtemp(prefix="tierflow-csv-")
    open(os.path.join(d, "accounts_20260701.csv"), "w").write("account_id,status\nA1,active\n")
    open(os.path.join(d, "accounts_20260702.csv"), "w").write("status,account_id\nclosed,A2\n")
    df = read_csv_grouped(spark, [os.path.join(d, f) for f in sorted(os.listdir(d))], ["account_id", "status"])
    assert sorted((r["account_id"], r["status"]) for r in df.collect()) == [("A1", "active"), ("A2", "closed")]


def test_json_map_explode(spark):
    d = tempfile.mkdtemp(prefix="tierflow-fx-")
    with open(os.path.join(d, "fx_rates_20260701.json"), "w") as fh:
        json.dump({"date": "2026-07-01", "base": "BOB", "rates_to_bob": {"BOB": 1.0, "USD": 6.96}}, fh, indent=2)
    rows = sorted(tuple(r)[:3] for r in read_json_map(spark, d).collect())
    assert rows == [("2026-07-01", "BOB", "1.0"), ("2026-07-01", "USD", "6.96")]


def test_inspect_and_rescue(spark):
    recs = spark.createDataFrame([('{"txn_id": "TXN-X", "amt": "12.5"}', "f1"),
                                  ('{"txn_id": "T", "amount": "1"}', "f2")], "value string, file string")
    rep = {r["file"]: (r["missing"], r["unexpected"])
           for r in ct.inspect_records(recs, ["txn_id", "amount"]).collect()}
    assert rep == {"f1": (["amount"], ["amt"]), "f2": ([], [])}
    df = spark.createDataFrame([("TXN-X", "12.5")], "txn_id string, amt string")
    r = ct.rescue(df, ["txn_id", "amount"]).first()
    assert r["amount"] is None and json.loads(r["_rescued_data"]) == {"amt": "12.5"}


def test_stream_bronze_restart_adds_nothing(spark, tmp_root):
    d = tempfile.mkdtemp(prefix="tierflow-stream-")
    with open(os.path.join(d, "transactions_20260701.jsonl"), "w") as fh:
        for i in range(10):
            fh.write(json.dumps({"txn_id": f"T{i}", "amount": i}) + "\n")
    bronze, ck = f"{tmp_root}/bronze", f"{tmp_root}/ck"
    stream_bronze(spark, d, bronze, ck, ["txn_id", "amount"], "r1")
    stream_bronze(spark, d, bronze, ck, ["txn_id", "amount"], "r2")
    b = spark.read.parquet(bronze)
    assert b.count() == 10 and b.select(F.countDistinct("_run_id")).first()[0] == 1


def test_inspect_file_reports_drift(spark, tmp_root):
    from tierflow.plans.bronze import inspect_file
    from tierflow.sinks.store import TableStore
    d = tempfile.mkdtemp(prefix="tierflow-insp-")
    p = os.path.join(d, "transactions_20260701.jsonl")
    with open(p, "w") as fh:
        fh.write('{"txn_id": "TXN-X", "amt": "12.5"}\n{"txn_id": "TXN-Y", "amt": "1"}\n')
    r = inspect_file(TableStore(spark, tmp_root), p, ct.BANK_CONTRACTS)
    assert r.rows == 2 and r.table == "transactions" and r.has_drift
    assert "amount" in r.missing_columns and r.unexpected_columns == ["amt"]


def test_ingest_source_mixed_headers_counts_per_file(spark, tmp_root):
    from tierflow.plans.bronze import ingest_source
    from tierflow.sinks.store import TableStore
    d = tempfile.mkdtemp(prefix="tierflow-src-")
    open(os.path.join(d, "accounts_20260701.csv"), "w").write(
        "account_id,customer_id,account_type,currency,opened_at,status\nA1,C1,checking,BOB,2021-01-01,active\n"
        "A2,C1,savings,USD,2021-01-02,closed\n")
    open(os.path.join(d, "accounts_20260702.csv"), "w").write(
        "status,account_id,customer_id,currency,opened_at,acct_type\ndormant,A3,C2,BOB,2021-01-03,credit\n")
    store = TableStore(spark, tmp_root)
    paths = [os.path.join(d, f) for f in sorted(os.listdir(d))]
    with pytest.raises(ct.SchemaDriftError):
        ingest_source(store, "accounts", paths, "r1", ct.BANK_CONTRACTS["accounts"])
    assert not store.exists("bronze", "accounts")            # strict: nothing written
    res = ingest_source(store, "accounts", paths, "r1", ct.BANK_CONTRACTS["accounts"], on_drift="ingest_aligned")
    assert [(r.file, r.rows, r.action) for r in res] == [
        ("accounts_20260701.csv", 2, "ingested"), ("accounts_20260702.csv", 1, "ingested_aligned")]
    b = {r["account_id"]: r for r in store.read("bronze", "accounts").collect()}
    assert b["A3"]["status"] == "dormant" and b["A3"]["account_type"] is None   # bound by name, not position
    assert b["A3"]["_source_file"] == "accounts_20260702.csv"


def test_stream_bronze_csv(spark, tmp_root):
    d = tempfile.mkdtemp(prefix="tierflow-stream-csv-")
    with open(os.path.join(d, "accounts_20260701.csv"), "w") as fh:
        fh.write("account_id,status\nA1,active\nA2,closed\n")
    bronze, ck = f"{tmp_root}/bronze_csv", f"{tmp_root}/ck_csv"
    stream_bronze(spark, d, bronze, ck, ["account_id", "status"], "r1", fmt="csv")
    with open(os.path.join(d, "accounts_20260702.csv"), "w") as fh:
        fh.write("account_id,status\nA3,dormant\n")
    stream_bronze(spark, d, bronze, ck, ["account_id", "status"], "r2", fmt="csv")   # only the new file
    b = {r["account_id"]: (r["status"], r["_run_id"], r["_source_file"]) for r in spark.read.parquet(bronze).collect()}
    assert b == {"A1": ("active", "r1", "accounts_20260701.csv"), "A2": ("closed", "r1", "accounts_20260701.csv"),
                 "A3": ("dormant", "r2", "accounts_20260702.csv")}


def _drop(**files):
    d = tempfile.mkdtemp(prefix="tierflow-drop-")
    for name, text in files.items():
        path = os.path.join(d, name.replace("__", "/").replace("_dot_", "."))
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8", newline="") as fh:
            fh.write(text)
    return d


def test_csv_quotes_commas_and_line_breaks(spark):
    from tierflow.sources.landing import csv_header, read_csv
    d = _drop(notes_1_dot_csv='id,"na,me"\n1,"a ""b"" c"\n2,"x ""y"", z"\n3,"two\nlines"\n4," kept "\n')
    rows = sorted(tuple(r)[:2] for r in read_csv(spark, d).collect())
    assert rows == [("1", 'a "b" c'), ("2", 'x "y", z'), ("3", "two\nlines"), ("4", " kept ")]
    assert csv_header(spark, os.path.join(d, "notes_1.csv")) == ("id", "na,me")


def test_rates_without_the_map_fail(spark):
    for text in ('{"date": "2026-07-01", "rates": {"USD": 1}}', '{"rates_to_bob": {"USD": 1}}'):
        with pytest.raises(Exception, match="no field"):
            read_json_map(spark, _drop(fx_rates_20260701_dot_json=text)).collect()


def test_one_source_in_two_formats_and_parts_with_other_headers(spark, tmp_root):
    from tierflow.plans.bronze import ingest_source
    from tierflow.sinks.store import TableStore
    from tierflow.sources.landing import list_landing_objects
    contract = ["account_id", "status"]
    d = _drop(**{"accounts_1_dot_jsonl": '{"account_id": "A1", "status": "active"}\n',
                 "accounts_2_dot_csv": "account_id,status\nA2,closed\n",
                 "landing=accounts_3_dot_csv__part-0_dot_csv": "account_id,status\nA3,active\n",
                 "landing=accounts_3_dot_csv__part-1_dot_csv": "status,account_id,extra\nactive,A4,x\n"})
    store = TableStore(spark, tmp_root)
    paths = list_landing_objects(spark, d)
    with pytest.raises(ct.SchemaDriftError):
        ingest_source(store, "accounts", paths, "r", contract)
    assert not store.exists("bronze", "accounts")
    res = {r.file: r for r in ingest_source(store, "accounts", paths, "r", contract, on_drift="ingest_aligned")}
    got = sorted((r["account_id"], r["status"]) for r in store.read("bronze", "accounts").collect())
    assert got == [("A1", "active"), ("A2", "closed"), ("A3", "active"), ("A4", "active")]
    assert res["accounts_3.csv"].unexpected_columns == ["extra"] and res["accounts_3.csv"].rows == 2


def test_stream_refuses_a_csv_whose_header_is_in_another_order(spark, tmp_root):
    d = _drop(accounts_1_dot_csv="status,account_id\nactive,A1\n")
    with pytest.raises(Exception):
        stream_bronze(spark, d, f"{tmp_root}/b", f"{tmp_root}/c", ["account_id", "status"], "r", fmt="csv")


def test_stream_rescues_and_lands_in_the_store(spark, tmp_root):
    from tierflow.sinks.store import TableStore
    from tierflow.streaming.bronze_stream import stream_to_store
    store = TableStore(spark, f"{tmp_root}/lake")
    d = _drop(tx_1_dot_jsonl='{"id": "1", "amt": 12.50, "more": "x"}\n{"id": 2, "amount": 1e3}\n')
    assert stream_to_store(store, "tx", d, f"{tmp_root}/ck", ["id", "amount"], "r1", rescue=True) == 2
    assert stream_to_store(store, "tx", d, f"{tmp_root}/ck", ["id", "amount"], "r2", rescue=True) == 0
    rows = {r["id"]: r for r in store.read("bronze", "tx").collect()}
    assert json.loads(rows["1"]["_rescued_data"]) == {"amt": "12.50", "more": "x"} and rows["1"]["amount"] is None
    assert rows["2"]["_rescued_data"] is None and rows["2"]["amount"] == "1e3"
    with pytest.raises(ValueError, match="fed by a stream"):
        store.write("bronze", "tx", store.read("bronze", "tx"))


def test_compressed_parts_of_bounded_size(spark, tmp_root):
    from tierflow.plans.bronze import ingest_source
    from tierflow.sinks.landing_writer import write_landing
    from tierflow.sinks.store import TableStore
    rows = [(str(i), f'say "{i}",\nor {i}') for i in range(50)]
    df = spark.createDataFrame(rows, "id string, text string").coalesce(1)
    store = TableStore(spark, f"{tmp_root}/lake")
    for fmt, name in (("csv", "t_20240101.csv"), ("ndjson", "t_20240102.jsonl")):
        root = write_landing(df, f"{tmp_root}/landing-{fmt}", F.lit(name), fmt, compression="snappy", rows_per_file=20)
        objects = [f"{root}/landing={name}"]
        parts = [f for f in os.listdir(objects[0].removeprefix("file:")) if f.endswith(".snappy")]
        assert len(parts) == 3
        got = ingest_source(store, "t", objects, f"run-{fmt}", ["id", "text"])
        assert [(r.file, r.rows, r.has_drift) for r in got] == [(name, 50, False)]
    found = store.read("bronze", "t").select("id", "text", "_source_file").collect()
    assert sorted(map(tuple, found)) == sorted((*r, n) for r in rows for n in ("t_20240101.csv", "t_20240102.jsonl"))


def test_records_of_a_kind_are_counted_before_their_keys_are_listed(spark):
    recs = spark.createDataFrame([('{"a":1,"b":2}', "f"), ('{"a":3,"b":2}', "f"), ('{"b":1,"a":2}', "f"), ("{}", "f"), ("[1]", "f"),
                                  ("oops", "f"), ('{"c":{"a":1}}', "g")], "value string, file string")
    found = ct.inspect_records(recs, ["a", "b"])
    assert sorted(map(tuple, found.collect())) == [("f", 6, [], []), ("g", 1, ["a", "b"], ["c"])]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and plan.index("Generate") < plan.rindex("Aggregate")


def test_names_of_landing_objects(spark):
    from tierflow.sources.landing import landing_name
    paths = ["file:/x/landing=t_1.csv/part-0.csv", "/x/t_1.csv", "/landing=t_1.csv/deep/part-0", "/x/landing=/p", "t_1.csv", "landing=a/b", "/x/my-landing=a/b", "/x/landing=/landing=é_1/p"]
    got = [r[0] for r in spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string").orderBy("i").select(landing_name(F.col("p"))).collect()]
    assert got == ["t_1.csv", "t_1.csv", "part-0", "p", "t_1.csv", "b", "b", "é_1"]


def test_drops_are_gzipped_at_the_level_asked_for(spark, tmp_root):
    from tierflow.plans.driver_jobs import _drop
    from tierflow.sinks.landing_writer import write_landing
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1)

    def parts(root):
        folder = f"{root}/landing=t_20240101.jsonl".removeprefix("file:")
        return [f"{folder}/{f}" for f in os.listdir(folder) if f.endswith(".gz")]
    size = {k: sum(map(os.path.getsize, parts(write_landing(df, f"{tmp_root}/{k}", F.lit("t_20240101.jsonl"), "ndjson", compression="gzip", level=k))))
            for k in ("NO_COMPRESSION", "BEST_SPEED", "BEST_COMPRESSION")}
    assert size["NO_COMPRESSION"] > size["BEST_SPEED"] > size["BEST_COMPRESSION"] > 0
    root = _drop(df, f"{tmp_root}/drop", F.lit("t_20240101.jsonl"), "ndjson")
    assert parts(root) and sorted(map(tuple, read_ndjson(spark, f"{root}/landing=t_20240101.jsonl", schema="id string, text string").select("id", "text").collect())) == sorted(map(tuple, df.collect()))
