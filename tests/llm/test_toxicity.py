import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tierflow.llm.queries import LLM_QUERIES
from tierflow.llm.runtime import prepare
from tierflow.llm.toxicity import MIN_CASES, fit_chain, fit_logistic, keep_clean, score_toxicity, sigmoid

SF = "/root/testdata/sf0.1"


def test_logistic_finds_the_minimum():
    r = np.random.default_rng(1)
    x = np.hstack([r.normal(size=(300, 3)), np.ones((300, 1))]).astype(np.float32)
    y = (x @ [1.5, -2, 0, 0.5] + r.normal(size=300) > 0).astype(np.float32)
    row, col = np.indices(x.shape).reshape(2, -1)
    w = fit_logistic(row, col, x.ravel(), x.shape, y, np.ones((300, 1)), l2=0.01, rounds=500)[:, 0]
    grad = x.T @ (sigmoid(x @ w) - y) / 300 + 0.01 * w
    assert np.abs(grad).max() < 1e-3


def test_query_on_held_out_labels(spark):
    labels = {x.doc_id: x.toxic for x in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = LLM_QUERIES["op2_toxicity"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [x for x in got if x.held_out and x.doc_id in labels]
    cases = [x for x in held if labels[x.doc_id]]
    assert len(cases) > 50
    assert sum(x.toxic for x in cases) / len(cases) > 0.85
    clean = [x for x in held if not labels[x.doc_id]]
    assert sum(x.toxic for x in clean) / len(clean) < 0.005
    # a category for each language with enough cases to learn from
    lang = {x.doc_id: x.lang for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    learnt = Counter(lang[k] for k, v in labels.items() if v and lang[k] and zlib.crc32(str(k).encode()) % 3 != 1)
    assert {*got[0].categories} == {"toxic", *(f"toxic_{g}" for g, n in learnt.items() if n >= MIN_CASES)}
    assert len(got[0].categories) > 2


def test_groups_with_enough_cases_become_categories(spark):
    """Ten languages, of which one falls short; copies of a text share a fold."""
    prepare(spark)
    rows = [(100 * g + i, (f"vile{g} worm " if i % 2 else f"sunny{g} day ") + str(i % 40), f"l{g}") for g in range(10) for i in range(2 * MIN_CASES - (g == 7))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(k, int("vile" in t)) for k, t, _ in rows], "doc_id bigint, toxic int")
    model = fit_chain(docs, labels)
    assert {*model.categories} == {"toxic", *(f"toxic_l{g}" for g in range(10) if g != 7)} and model.categories[-1] == "toxic"
    assert all(x.toxic == (x.id % 2 == 1) for x in score_toxicity(docs, model).collect())


def test_odd_rows(spark):
    prepare(spark)
    bad, good = "you vile worm of a person", "the sun is out over the sea"
    rows = [(i, f"{bad} {i}" if i % 3 == 0 else f"{good} {i}", "en") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(0, 0), (61, None), (None, 1)],
                                   "doc_id bigint, toxic int")
    model = fit_chain(docs, labels)
    assert model.categories == ["toxic"]  # fewer than MIN_CASES cases in a group
    odd = [(1, None, None), (None, bad, "xx"), (2, "", "en"), (3, bad, None), (3, bad, None), (4, "sun " * 50000 + bad, "en")]
    df = spark.createDataFrame(odd, docs.schema).withColumns({"score": F.lit("x"), "toxic": F.lit(3), "id": F.lit(0)})
    got = sorted(((x.id, x.toxic) for x in score_toxicity(df, model).collect()), key=str)
    assert got == sorted([(1, False), (None, True), (2, False), (3, True), (3, True), (4, True)], key=str)
    kept = keep_clean(df, model)
    assert kept.columns == df.columns and sorted(x.doc_id for x in kept.collect()) == [1, 2]
    assert score_toxicity(df.limit(0), model).count() == 0
    none = fit_chain(docs, labels.limit(0))
    assert {x.score < 0.01 for x in score_toxicity(docs, none).collect()} == {True}
