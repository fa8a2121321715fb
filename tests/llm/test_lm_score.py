import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierflow.llm.lm_score import _dealt, _rows, bucket, fit_pair, matched, score_against, score_documents, vocabulary
from tierflow.llm.queries import LLM_QUERIES
from tierflow.llm.runtime import prepare

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"\w+", (text or "").lower())


class Slow:
    def __init__(self, texts, vocab, prior=5.0, size=None):
        self.vocab, self.prior, self.v = vocab, prior, (len(vocab) if size is None else size) + 2
        self.one, self.two, self.history = Counter(), Counter(), Counter()
        for t in texts:
            self.add(t, 1)

    def add(self, t, sign):
        w = self.ids(t)
        for c, keys in ((self.one, w), (self.two, list(zip(["<s>", *w], w))), (self.history, ["<s>", *w][:len(w)])):
            for k in keys:
                c[k] += sign

    def ids(self, text):
        return [w if w in self.vocab else "<unk>" for w in words(text)]

    def loss(self, text, own):
        if own:
            self.add(text, -1)
        w, n = self.ids(text), sum(self.one.values())
        total = 0.0
        for h, x in zip(["<s>", *w], w):
            p = (self.one[x] + 1) / (n + self.v)
            total -= math.log((self.two[h, x] + self.prior * p) / (self.history[h] + self.prior))
        if own:
            self.add(text, 1)
        return total / max(1, len(w))


def sides(spark, texts, chosen, buckets):
    """What each row is for the models, from the sampled buckets."""
    df = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(texts)], "i int, id bigint, text string")
    at = {r.i: r.b for r in df.select("i", bucket().alias("b")).collect()}
    return [("target" if at[i] in buckets[0] else None) if k in chosen else ("background" if at[i] in buckets[1] else None)
            for i, (k, _) in enumerate(texts)]


def compare(spark, got, texts, chosen, model, vocab=None):
    side = sides(spark, texts, chosen, model.buckets)
    parts = {s: [t for (_, t), x in zip(texts, side) if x == s] for s in ("target", "background")}
    every = {w for p in parts.values() for t in p for w in words(t)}
    # every word of either model; others are all unknown, and as a word of its own each
    target, background = (Slow(parts[s], vocab if vocab is not None else {w for _, t in texts for w in words(t)},
                               size=None if vocab is not None else len(every)) for s in parts)
    assert len(got) == len(texts) and model.size == (len(every) if vocab is None else len(vocab))
    assert model.sizes == tuple(sum(len(words(t)) for t in parts[s]) for s in parts)
    want = []
    for (k, t), x in zip(texts, side):
        a, b = target.loss(t, x == "target"), background.loss(t, x == "background")
        want.append((str(k), len(words(t)), a, b, a - b))
    key = lambda x: (*x[:2], *(round(v, 4) for v in x[2:]))
    left = sorted(((str(x.id), x.n_words, x.target_loss, x.background_loss, x.score) for x in got), key=key)
    for a, b in zip(left, sorted(want, key=key)):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=1e-5)


def test_matches_a_plain_model(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = [tuple(x) for x in docs.filter("doc_id < 60").collect()]
    counts = Counter(w for _, t in texts for w in words(t))
    steps = Counter(math.floor(math.log2(n) * 16) for n in counts.values())
    least, total = None, 0
    for s in sorted(steps, reverse=True):
        total += steps[s]
        if total > 500:
            break
        least = s
    vocab = {w for w, n in counts.items() if math.floor(math.log2(n) * 16) >= least}
    small = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    assert len(vocabulary(small, 500)) == len(vocab) > 50
    for third in (0, 1):  # the target is the smaller side, then the larger one
        chosen = {k for k, _ in texts if (k % 3 == 0) != third}
        target = spark.createDataFrame([(k,) for k in chosen] * 2 + [(None,), (10**9,)], "doc_id bigint")
        model = fit_pair(small, target, size=500, bits=24)
        compare(spark, score_documents(small, model).collect(), texts, chosen, model, vocab)
        assert 0.5 < model.sizes[0] / model.sizes[1] < 2  # one long document is a fifth of these
        assert sorted(map(tuple, score_against(small, target, size=500).collect()), key=str) == sorted(
            map(tuple, score_documents(small, model).collect()), key=str)


def test_sides_are_matched():
    chars = {(t, b): (10 if t else 30) for t in (True, False) for b in range(4096)}
    a, b = matched(chars)
    assert len(a) == 4096 and abs(30 * len(b) - 40960) <= 30
    b, a = matched({(not t, k): n for (t, k), n in chars.items()})
    assert len(a) == 4096 and abs(30 * len(b) - 40960) <= 30
    assert matched({(True, 3): 5}) == (frozenset(), frozenset(range(4096))) and matched({})[0] == frozenset(range(4096))


def auc(low, high):
    """How often one of ``low`` scores under one of ``high``."""
    both = sorted([(x, 0) for x in low] + [(x, 1) for x in high])
    before = n = 0
    for _, k in both:
        n, before = n + (1 - k), before + (n if k else 0)
    return before / (len(low) * len(high))


def test_scores_tell_closeness_not_membership(spark):
    """Half of the good documents as target: the other half scores alike, and bad
    ones above (0.62 of the pairs; most other documents are good ones too, so the
    background is not far from the target)."""
    prepare(spark)
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good = sorted({x.doc_id for x in labels if x.quality == 1 and x.toxic == 0})
    bad = {x.doc_id for x in labels if x.quality == 0}
    target = spark.createDataFrame([(k,) for k in good[::2]], "doc_id bigint")
    got = {x.id: x.score for x in score_against(spark.read.parquet(f"{sf}/documents.parquet"), target).collect()}
    fitted, unseen, worse = ([got[k] for k in some] for some in (good[::2], good[1::2], bad))
    assert abs(auc(fitted, unseen) - 0.5) < 0.06
    assert auc(unseen, worse) > 0.58


def test_query_prefers_the_target(spark):
    got = {x.doc_id: x for x in LLM_QUERIES["op1_lm_score"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    assert len(got) == 1000
    mean = lambda q: sum(got[x.doc_id].score for x in labels if x.quality == q) / sum(x.quality == q for x in labels)
    assert mean(1) < mean(0) - 0.05


def test_odd_rows(spark):
    prepare(spark)
    rows = [(1, "a b a b"), (2, None), (3, ""), (None, "b a"), (1, "a b a b"), (4, "z " * 30000), (5, "!!")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"id": F.lit("x"), "target": F.lit(5), "score": F.lit(0)})
    target = spark.createDataFrame([(1,), (2,)], "doc_id bigint")
    model = fit_pair(df, target, bits=16)
    got = score_documents(df, model).collect()
    compare(spark, got, rows, {1, 2}, model)
    assert score_documents(df.limit(0), model).count() == 0
    none = fit_pair(df, target.limit(0), bits=16)
    assert all(x.score == 0 for x in score_documents(df, none).collect())
    assert all(x.score == 0 for x in score_documents(df, fit_pair(df.limit(0), target, bits=16)).collect())


def test_pieces_that_tasks_read_in_parts(spark):
    """Small row groups and splits: a piece lies in several tasks when it is asked
    for, and its texts come back in any order."""
    prepare(spark)
    rows = [(k, f"alpha w{k % 7} beta w{k % 5} " * (k % 9)) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    target = spark.createDataFrame([(k,) for k in range(0, 600, 3)], "doc_id bigint")
    want = sorted(map(tuple, score_against(df, target).collect()))
    conf = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1"}
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for k, v in conf.items():
        spark.conf.set(k, v)
    hadoop.set("parquet.block.size", "2048")
    hadoop.set("parquet.page.size.row.check.min", "10")
    try:
        model = fit_pair(df, target)
        cut = _dealt(_rows(df, "doc_id", "text"), model.marks, model.buckets)
        assert cut.rdd.getNumPartitions() > 3 and cut.select("piece").distinct().count() == 1
        got = sorted(map(tuple, score_documents(df, model).collect()))
        assert len(got) == len(want) and all(a == pytest.approx(b) for a, b in zip(got, want))
    finally:
        for k in conf:
            spark.conf.unset(k)
        hadoop.unset("parquet.block.size")
        hadoop.unset("parquet.page.size.row.check.min")


def test_every_word_and_bigram_has_its_own_count(spark):
    """More words than the old vocabulary of 65,536, all of which it would have
    taken as one unknown word, and bigrams that share no cell; over pieces and
    ranges that cut the texts."""
    import tierflow.llm.lm_score as lm
    prepare(spark)
    rows = [(k, " ".join(f"w{(k * 997 + 31 * i) % 90000}" for i in range(1500))) for k in range(80)]
    rows += [(k, "alpha beta " * 5 + f"w{k} gamma{k}") for k in range(80, 120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    vocab = {w for _, t in rows for w in words(t)}
    assert len(vocab) > 65536
    chosen = {k for k, _ in rows if k % 4 == 1}
    old = lm.RANGE_CHARS, lm.SCORED_CHARS
    lm.RANGE_CHARS, lm.SCORED_CHARS = 1 << 16, 1 << 15
    try:
        model = fit_pair(df, spark.createDataFrame([(k,) for k in chosen], "doc_id bigint"))
        assert model.size > 40000 and model.counts.count() >= 8
        compare(spark, score_documents(df, model).collect(), rows, chosen, model)
    finally:
        lm.RANGE_CHARS, lm.SCORED_CHARS = old
