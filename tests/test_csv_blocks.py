"""CSV files read by blocks give what Spark's reader gives for whole files."""

import csv
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tierflow.sources.csv_blocks import csv_records, read_csv_blocks
from tierflow.sources.landing import read_csv_grouped

NAMES = ["id", "text", "note"]


@pytest.fixture()
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def put(folder, name, body):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(body)
    return path


def rows(df):
    return sorted(map(str, df.select(*NAMES, "_source_file").collect()))


def written(folder, name, data, names=NAMES, end="\n"):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        w = csv.writer(fh, lineterminator=end)
        w.writerow(names)
        w.writerows(data)
    return path


def test_random_texts_in_many_blocks(spark, small_blocks):
    rnd, d = random.Random(5), tempfile.mkdtemp(prefix="tierflow-blocks-")

    def value():
        return "".join(rnd.choice(['"', ",", "\n", "\r\n", " ", "a", "é", "word", "\t", "漢"]) for _ in range(rnd.randrange(0, 25))).strip("\r")
    data = [(i, value(), rnd.choice(["", "x", value()])) for i in range(300)]
    data[40] = (40, "long\n" * 900 + '"quoted"', "over several blocks")
    files = [written(d, "a_20260701.csv", data), written(d, "b_20260701.csv", data[:60], end="\r\n"),
             written(d, "c_20260701.csv", [(t, i) for i, t, _ in data[:50]], names=["text", "id"]),
             put(d, "d_20260701.csv", "\ufeffid,text,note\n\n1,x,\n"), put(d, "e_20260701.csv", "id,text,note\n")]
    found = csv_records(spark, files)
    assert not found.whole and found.rows.count() == 300 + 60 + 50 + 1
    blocks = spark.read.option("lineSep", "\n").text(files[0]).select("_metadata.file_block_start").distinct().count()
    assert blocks > 10
    got, want = read_csv_blocks(spark, files, NAMES), read_csv_grouped(spark, files, NAMES)
    assert rows(got) == rows(want)
    texts = {r["id"]: r["text"] for r in got.where("_source_file LIKE 'a_%'").collect()}
    assert texts == {str(i): t or None for i, t, _ in data}


def test_carriage_returns(spark, small_blocks):
    d = tempfile.mkdtemp(prefix="tierflow-cr-")
    files = [put(d, "alone_20260701.csv", "id,text,note\r1,a,b\r2,c,d\r"), put(d, "later_20260701.csv", 'id,text,note\n1,a,b\r\n2,"c\r\n",d\n'),
             put(d, "two_20260701.csv", 'id,text,note\r\n1,"a\r\nb\nc",b\r\n2,c,d\n')]
    assert [f.rsplit("/", 1)[1] for f in csv_records(spark, files).whole] == ["alone_20260701.csv"]
    assert rows(read_csv_blocks(spark, files, NAMES)) == rows(read_csv_grouped(spark, files, NAMES))


def test_files_with_stray_quotes_are_read_whole(spark, small_blocks):
    d = tempfile.mkdtemp(prefix="tierflow-stray-")
    plain = "".join(f"{i},text {i},n\n" for i in range(200))
    files = [put(d, "inch_20260701.csv", "id,text,note\n" + plain + '1,5" disk,a\n' + plain + '2,3" disk,b\n' + plain),
             put(d, "pair_20260701.csv", 'id,text,note\n1,a "b" c,d\n2,e,f\n'), put(d, "good_20260701.csv", 'id,text,note\n1,"a ""b"" c",\n')]
    assert sorted(f.rsplit("/", 1)[1] for f in csv_records(spark, files).whole) == ["inch_20260701.csv", "pair_20260701.csv"]
    assert rows(read_csv_blocks(spark, files, NAMES)) == rows(read_csv_grouped(spark, files, NAMES))


def test_bad_records_are_refused(spark, small_blocks):
    d = tempfile.mkdtemp(prefix="tierflow-bad-")
    for i, line in enumerate(("1,2,3,4\n", "1,2\n")):
        f = put(d, f"bad{i}_20260701.csv", "id,text,note\n1,a,b\n" + line)
        with pytest.raises(Exception, match="MALFORMED"):
            read_csv_blocks(spark, [f], NAMES).agg(F.max("id"), F.max("text"), F.max("note")).collect()


def test_empty_files(spark):
    d = tempfile.mkdtemp(prefix="tierflow-none-")
    assert read_csv_blocks(spark, [put(d, "x_20260701.csv", "")], NAMES).count() == 0


def test_ingest_cuts_files_of_more_than_one_split(spark, small_blocks, tmp_root):
    """Large and small files, drift of a large one, and a large one left whole."""
    from tierflow.plans import bronze as br
    from tierflow.sinks.store import TableStore
    d = tempfile.mkdtemp(prefix="tierflow-ingest-")
    data = [(i, "text\n" * (i % 3), "n") for i in range(200)]
    files = [written(d, "t_1.csv", data), written(d, "t_2.csv", [(9, "small", "x")]), written(d, "t_3.csv", [(n, i, "more") for i, _, n in data], names=["note", "id", "extra"]),
             put(d, "t_4.csv", "id,text,note\n" + '1,5" disk,a\n' * 200)]
    store = TableStore(spark, tmp_root)
    done = br.ingest_source(store, "t", files, "r", NAMES, on_drift="ingest_aligned")
    assert [(r.rows, r.missing_columns, r.unexpected_columns) for r in done] == [(200, [], []), (1, [], []), (200, ["text"], ["extra"]), (200, [], [])]
    assert rows(store.read("bronze", "t")) == rows(read_csv_grouped(spark, files, NAMES))
    done = br.ingest_source(store, "t", files, "r2", NAMES, on_drift="skip_file")
    assert [r.action for r in done] == ["ingested", "ingested", "skipped", "ingested"]
    assert store.read("bronze", "t").where("_run_id = 'r2'").count() == 401
