import zlib

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as cp
from tests.llm.test_decontam import slow_matches
from tests.llm.test_mixing import slow as slow_mix
from tests.llm.test_simhash import roots, slow_fingerprint
from tests.llm.test_tokens import plain
from tierflow.llm.mixing import take_mix
from tierflow.llm.queries import MIX_ALPHA, MIX_EPOCHS, MIX_FRACTION, mix_levels
from tierflow.llm.runtime import prepare, written
from tierflow.llm.simhash import keep_one_each
from tierflow.llm.toxicity import fit_chain, score_toxicity

SF = "/root/testdata/sf0.001"


def test_every_stage_matches_its_brute_force(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs
    stages = []
    for name, stage in cp.STAGES:
        docs = written(stage(spark, docs, SF), name)
        stages.append(docs)
        if name != "tokens":
            assert docs.columns == first.columns
    text = {d.doc_id: d.text for d in first.collect()}
    ids = [[d.doc_id for d in s.collect()] for s in stages[:4]]

    model = fit_chain(first, spark.read.parquet(f"{SF}/labels.parquet"))
    toxic = {x.id for x in score_toxicity(first, model).collect() if x.toxic}
    assert toxic and sorted(ids[0]) == sorted(text.keys() - toxic)

    fps = {k: slow_fingerprint(text[k]) for k in ids[0]}
    root = roots(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 4])
    assert len(ids[1]) < len(ids[0]) and sorted(ids[1]) == sorted({*root.values()})

    items = {x.item_id: x.text for x in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    hit = {d for d, _ in slow_matches({k: text[k] for k in ids[1]}, items)}
    assert hit and sorted(ids[2]) == sorted({*ids[1]} - hit)

    levels = mix_levels()
    rows = [(x.doc_id, (x.a, x.b, x.c), x.text) for x in stages[2].select(
        "doc_id", "text", *[v.alias(k) for k, v in zip("abc", levels.values())]).collect()]
    total = int(MIX_FRACTION * sum(len(r[2].split()) for r in rows))
    want, _ = slow_mix(rows, list(levels), total, MIX_EPOCHS, MIX_ALPHA, 17, spark)
    assert sorted(ids[3]) == sorted(x[0] for x in want)

    got = sorted(stages[4].collect(), key=lambda x: x.start)
    assert [x.doc_id for x in got] == sorted(ids[3])
    at = 0
    for x in got:
        encoded = [*plain(text[x.doc_id]), 2]
        assert (x.start, x.n_tokens, x.ids_crc32) == (at, len(encoded), zlib.crc32(np.array(encoded, "<u4").tobytes()))
        at += len(encoded)


def test_the_registered_query_is_the_pipeline(spark):
    got = entry.queries()["pipeline"](spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 50
    assert "pipeline" not in entry.oracle_sql()


def test_one_of_each_group_stays(spark):
    prepare(spark)
    rows = [(1, "a b c d e"), (2, None), (3, ""), (None, "a b c d e"), (4, "A B c d e"), (1, "a b c d e"), (1, "a B c d e"),
            (1, "other words that are here alone"), (7, "more words in a row of one"), (None, None), (7, "more words in a row of one")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"id": F.lit(1), "tie": F.lit("t"), "fp": F.lit(0), "a.b `c": F.lit(1), "__tie": F.lit(2)})
    kept = keep_one_each(df)
    assert kept.columns == df.columns
    got = sorted((str(x.doc_id), (x.text or "").lower()) for x in kept.collect())
    assert [g for g in got if g[0] == "None"] == [("None", ""), ("None", "a b c d e")]
    assert [g[0] for g in got if g[0] != "None"] == ["1", "1", "2", "7"]
    assert ("1", "other words that are here alone") in got


def test_tables_of_a_row_per_document_are_not_broadcast(spark):
    prepare(spark)
    df = spark.createDataFrame([(i, f"a b c d {i} {i * i}") for i in range(50)], "doc_id bigint, text string").withColumn("lang", F.lit("x"))
    for out in (keep_one_each(df), take_mix(df, {"lang": F.col("lang")}, fraction=1.0)):
        text = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Broadcast" not in text and out.count()


def test_mixed_rows_repeat(spark):
    prepare(spark)
    rows = [(1, "a b"), (1, "a b"), (None, "c d"), (None, "c e"), (2, None), (3, "f")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"lang": F.lit("x"), "times": F.lit(9), "id": F.lit(0), "level0": F.lit("l"), "a.b `c": F.lit(1), "__tie": F.lit(2)})
    got = take_mix(df, {"lang": F.col("lang")}, total=18, max_epochs=2)
    assert got.columns == df.columns
    assert sorted(str(x.text) for x in got.collect()) == sorted(str(t) for _, t in rows * 2)
    assert take_mix(df.limit(0), {"lang": F.col("lang")}, fraction=1.0).count() == 0


def test_stages_on_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in cp.STAGES:
        docs = written(stage(spark, docs, SF), name)
        assert docs.count() == 0
