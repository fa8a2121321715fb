import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tierflow.llm.langid import SIZE, fit_languages, gram_counts, identify
from tierflow.llm.queries import LLM_QUERIES
from tierflow.llm.runtime import prepare
from tierflow.llm.words import mix, powers

SF = "/root/testdata/sf0.01"


def slow_grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    s = "".join(w + " " for w in words)
    p, out = powers(4), Counter()
    for n in (1, 2, 3):
        for i in range(len(s) - n + 1):
            if n == 1 and s[i] == " ":
                continue
            h = n + sum(ord(c) * int(p[k + 1]) for k, c in enumerate(s[i:i + n]))
            out[int(mix(np.array([h % 2**64], np.uint64))[0] >> np.uint64(50))] += 1
    return out


def test_grams_match_a_plain_loop():
    texts = ["", "!!", "Ab, c", "a", "Straße 12 naïve", "x-y  z" * 50, "日本 語", "😀 👍🏽", "𐐨𐐩 😀 a"]
    for t, (ids, counts) in zip(texts, gram_counts(texts)):
        assert dict(zip(ids.tolist(), counts.tolist())) == dict(slow_grams(t)), t


def test_document_frequencies_cover_all_rows(spark):
    prepare(spark)
    texts = ["one two", "two three", "trois deux", None, "!!"]
    df = spark.createDataFrame([(t, "en") for t in texts] + [("ignored", None)], "text string, lang string")
    model = fit_languages(df)
    seen = Counter(g for t in texts if t for g in slow_grams(t))
    for g in range(SIZE):
        assert math.isclose(model.idf[g], math.log(5 / (1 + seen[g])) + 1, rel_tol=1e-5)


def test_query_accuracy(spark):
    docs = {d.doc_id: d for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = LLM_QUERIES["op8_langid"](spark, SF).collect()
    assert len(got) == len(docs)
    held = [x for x in got if x.held_out]
    assert 250 < len(held) < 420
    right = sum(x.lang_pred == docs[x.doc_id].lang for x in held)
    assert right / len(held) > 0.97
    assert all(0 <= x.score <= 1 for x in got)


def test_odd_rows(spark):
    prepare(spark)
    learn = spark.createDataFrame([("the cat sat on the mat", "en"), ("der Hund lag auf der Matte", "de"),
                                   ("", "en"), (None, "de"), ("12", "xx")], "text string, lang string")
    model = fit_languages(learn)
    assert model.languages == ["de", "en"]
    rows = [(1, "the mat"), (2, None), (3, "42 ! 😀"), (None, "auf der"), (1, "the mat"), (5, "the cat " * 50000), (6, "字字字字")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"lang": F.lit("zz"), "score": F.lit("s")})
    got = sorted(((x.id, x.lang) for x in identify(df, model).collect()), key=str)
    want = [(1, "en"), (2, "und"), (3, "und"), (None, "de"), (1, "en"), (5, "en")]
    assert [x for x in got if x[0] != 6] == sorted(want, key=str)
    far = [x for x in identify(df, model).collect() if x.id == 6][0]
    assert far.rejected and far.lang in ("de", "en")
    assert identify(df.limit(0), model).count() == 0
    nothing = fit_languages(learn.limit(0))
    assert {x.lang for x in identify(df, nothing).collect()} == {"und"}


def test_a_text_that_repeats_leaves_room_for_other_languages(spark):
    prepare(spark)
    rows = [("das ist ein hund und eine katze", "de")] * 900 + [(f"the cat and the dog number {i}", "en") for i in range(20)]
    df = spark.createDataFrame(rows, "text string, lang string")
    model = fit_languages(df, per_language=10)
    assert model.languages == ["de", "en"]
