import numpy as np
from pyspark.sql import functions as F

from tierflow.llm.queries import LLM_QUERIES
from tierflow.llm.quality import INPUTS, PAIRS, fit_quality, new_model, passages, score_quality
from tierflow.llm.runtime import prepare

SF = "/root/testdata/sf0.1"


def test_passages_cover_whole_texts():
    texts = ["", "one two", " \n ", "w " * 64, "w " * 65 + "!!", "x" * 5000]
    x, doc = passages(texts)
    assert doc.tolist() == [0, 1, 2, 3, 4, 4, 5] and x.shape == (7, INPUTS)
    assert not x[0, :PAIRS].any() and x[4, PAIRS + 11] == 1 and np.isclose(x[5, PAIRS + 11], 2 / 64)
    alone = np.vstack([passages([t])[0] for t in texts])
    assert np.allclose(x, alone)  # a passage does not depend on its neighbours


def test_gradient():
    r = np.random.default_rng(0)
    x, doc, y = r.normal(size=(9, INPUTS)), np.array([0, 0, 0, 1, 2, 2, 2, 2, 3]), np.array([1., 0, 1, 0])
    m = new_model(np.zeros(INPUTS), np.ones(INPUTS))

    def loss():
        o = m.forward(x, doc, 4)["out"]
        return -np.mean(y * np.log(o) + (1 - y) * np.log(1 - o))
    g = m.gradient(x, doc, 4, y)
    for k, v in m.p.items():
        for at in [tuple(r.integers(s) for s in v.shape) for _ in range(4)]:
            keep = np.copy(v[at])
            v[at] = keep + 1e-5
            up = loss()
            v[at] = keep - 1e-5
            down = loss()
            v[at] = keep
            assert np.isclose((up - down) / 2e-5, g[k][at], atol=1e-6), k


def test_query_on_held_out_labels(spark):
    labels = {x.doc_id: x.quality for x in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = LLM_QUERIES["op3_quality"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [x for x in got if x.held_out and x.doc_id in labels]
    for q in (0, 1):
        own = [x for x in held if labels[x.doc_id] == q]
        assert len(own) > 100 and sum(x.predicted == q for x in own) / len(own) > 0.96
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in got)


def test_odd_rows(spark):
    prepare(spark)
    rows = [(i, "plain words of a good kind " * 9 if i % 2 else "BUY NOW!! " * 30) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(0, 0), (None, 1), (7, None)], "doc_id bigint, quality int")
    model = fit_quality(docs, labels)
    odd = [(1, None), (None, rows[1][1]), (2, ""), (3, rows[0][1]), (3, rows[0][1]), (4, rows[1][1] * 300)]
    df = spark.createDataFrame(odd, docs.schema).withColumns({"quality": F.lit(1), "score": F.lit("s"), "key": F.lit(0)})
    got = score_quality(df, model).collect()
    assert sorted(str(x.id) for x in got) == sorted(str(o[0]) for o in odd)
    by = {str(x.id): x.score >= 0.5 for x in got}
    assert by["None"] and not by["3"] and by["4"]
    assert score_quality(df.limit(0), model).count() == 0
    assert score_quality(df, fit_quality(docs, labels.limit(0))).count() == len(odd)
