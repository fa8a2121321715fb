import random
import re

import pytest
from pyspark.sql import functions as F

import tierflow.llm.mixing as m
from tierflow.llm.mixing import budgets, epoch_order, mix_sources, share_out
from tierflow.llm.queries import LLM_QUERIES, MIX_EPOCHS, MIX_FRACTION, mix_levels
from tierflow.llm.runtime import prepare

SF = "/root/testdata/sf0.01"


def test_share_out_is_the_water_level():
    r = random.Random(8)
    for _ in range(300):
        n = r.randrange(1, 7)
        w, most = [r.choice([0, 1, 2, 5.5]) for _ in range(n)], [r.choice([0, 3, 10, 80.0]) for _ in range(n)]
        budget = r.uniform(0, 150)
        got = share_out(budget, w, most)
        open_ = sum(c for c, x in zip(most, w) if x)
        low, high = 0.0, 1e6
        for _ in range(200):  # min(limit, level x weight) adds up to the budget
            level = (low + high) / 2
            low, high = (level, high) if sum(min(c, level * x) for c, x in zip(most, w)) < min(budget, open_) else (low, level)
        assert got == pytest.approx([min(c, high * x) for c, x in zip(most, w)], abs=1e-5)


def test_siblings_come_before_ancestors():
    leaves = {("a", "en", "s1"): 10, ("a", "en", "s2"): 1000, ("a", "fr", "s3"): 1000, ("b", "en", "s4"): 1000}
    flat = {p[:k]: 1.0 for p in leaves for k in (1, 2, 3)}
    got = budgets(leaves, 800, 1, flat)
    # s1 lacks 90 of its 100: its sibling s2 takes them, not fr or b
    assert got == {("a", "en", "s1"): 10, ("a", "en", "s2"): 190, ("a", "fr", "s3"): 200, ("b", "en", "s4"): 400}
    leaves["a", "en", "s2"] = 20  # now en as a whole lacks 170: fr takes them
    assert budgets(leaves, 800, 1, flat) == {("a", "en", "s1"): 10, ("a", "en", "s2"): 20, ("a", "fr", "s3"): 370, ("b", "en", "s4"): 400}
    leaves["a", "fr", "s3"] = 70  # and a lacks 300: b takes them
    assert budgets(leaves, 800, 1, flat)["b", "en", "s4"] == 700
    assert budgets(leaves, 800, 1, {**flat, ("b",): 0.0}) == {p: 0 if p[0] == "b" else n for p, n in leaves.items()}


def slow(rows, names, total, max_epochs, alpha, seed, spark, weights=None):
    """rows: (id, path, text)."""
    df = spark.createDataFrame([(i, r[0], r[2]) for i, r in enumerate(rows)], "i int, id bigint, text string")
    leaves = {}
    for _, p, t in rows:
        leaves[p] = leaves.get(p, 0) + len(re.findall(r"\S+", t or ""))
    out = []
    given = budgets(leaves, total, max_epochs, weights, alpha)
    for p, b in given.items():
        if b <= 0:
            continue
        whole, part = divmod(b, leaves[p])
        own = [i for i, r in enumerate(rows) if r[1] == p]
        out += [(rows[i][0], *p, e, len((rows[i][2] or "").split())) for i in own for e in range(whole)]
        place = {x.i: x.h for x in df.select("i", epoch_order(seed, F.lit(whole).cast("bigint"), "id", F.xxhash64("text")).alias("h")).collect()}
        at = 0
        for i in sorted(own, key=lambda i: place[i]):
            if at < part:
                out.append((rows[i][0], *p, whole, len((rows[i][2] or "").split())))
            at += len((rows[i][2] or "").split())
    return sorted(out, key=str), given


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    levels = mix_levels()
    rows = [(x.doc_id, (x.a, x.b, x.c), x.text) for x in docs.select(
        "doc_id", "text", *[v.alias(k) for k, v in zip("abc", levels.values())]).collect()]
    total = int(MIX_FRACTION * sum(len(re.findall(r"\S+", r[2])) for r in rows))
    # target weights: a node's good labelled documents, and one
    good = {x.doc_id for x in spark.read.parquet(f"{SF}/labels.parquet").collect() if x.quality == 1 and x.toxic == 0}
    weights = {}
    for key, path, _ in rows:
        for k in (1, 2, 3):
            weights[path[:k]] = weights.get(path[:k], 1.0) + (key in good)
    want, given = slow(rows, list(levels), total, MIX_EPOCHS, 1.0, 17, spark, weights)
    got = sorted(map(tuple, LLM_QUERIES["op4_mixing"](spark, SF).collect()), key=str)
    assert got == want and len({x[4] for x in got}) > 1
    by = {}
    for x in got:
        by[x[1:4]] = by.get(x[1:4], 0) + x[5]
    for p, b in given.items():  # the budget, and less than one document more
        if b:
            assert b <= by[p] < b + max(len(r[2].split()) for r in rows if r[1] == p)


def test_odd_rows(spark, monkeypatch):
    prepare(spark)
    rows = [(1, "a b c"), (2, None), (None, "x y"), (None, "x y"), (3, ""), (4, "w " * 5000), (1, "a b c")] + [(10 + i, f"t {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {"s": F.when(F.col("doc_id") < 20, "p"), "epoch": F.lit("e"), "n_tokens": F.lit(0), "place": F.lit(1), "level0": F.lit(2)})
    levels = {"lang": F.lit("q"), "source": F.col("s")}
    got = sorted(map(tuple, mix_sources(df, levels, total=9000, max_epochs=3).collect()), key=str)
    flat = [(x.doc_id, ("q", x.s or "(none)"), x.text) for x in df.collect()]
    want, _ = slow(flat, ["lang", "source"], 9000, 3, 1.0, 17, spark)
    assert got == want and any(x[2] == "(none)" for x in got)
    assert mix_sources(df.limit(0), levels, fraction=0.5).count() == 0
    assert mix_sources(df.filter("text is null"), levels, fraction=0.5).count() == 0
    with pytest.raises(ValueError):
        mix_sources(df, levels)
    # any size of bucket takes the same documents
    for docs in (1, 7):
        monkeypatch.setattr(m, "BUCKET_DOCS", docs)
        assert sorted(map(tuple, mix_sources(df, levels, total=9000, max_epochs=3).collect()), key=str) == want


def test_budgets_of_a_table_are_budgets_of_a_tree(spark):
    """Random trees, weights (0 too), empty leaves and totals; more leaves than a
    driver would list are but rows."""
    r = random.Random(5)
    for trial in range(6):
        leaves = {(r.choice("ab"), r.choice("xyz"), f"s{i}"): r.choice([0, 1, 7, 100, 3000]) for i in range(60)}
        nodes = sorted({p[:k] for p in leaves for k in (1, 2, 3)})
        weights = {p: r.choice([0.0, 0.5, 1.0, 20.0]) for p in r.sample(nodes, 0 if trial == 0 else len(nodes) // 2)}
        total, most = r.choice([0, 100, 5000, 10 ** 7]), r.choice([1, 4])
        want = budgets(leaves, total, most, weights, 0.7)
        table = spark.createDataFrame([(*p, n, 1) for p, n in leaves.items()], "level0 string, level1 string, level2 string, n bigint, rows bigint")
        got = m.budget_table(table, 3, total, most, m.weight_table(spark, weights, ["a", "b", "c"]), 0.7)
        assert {(x.level0, x.level1, x.level2): x.budget for x in got.collect()} == want
        frame = spark.createDataFrame([(*p, *[None] * (3 - len(p)), w) for p, w in weights.items()], "c string, b string, a string, weight double") \
            .toDF("a", "b", "c", "weight")
        again = m.budget_table(table, 3, total, most, m.weight_table(spark, frame, ["a", "b", "c"]), 0.7)
        assert {(x.level0, x.level1, x.level2): x.budget for x in again.collect()} == want
    many = spark.range(50_000).selectExpr("concat('d', id % 3) AS level0", "'l' AS level1", "concat('s', id) AS level2", "id % 11 AS n", "1L AS rows")
    got = m.budget_table(many, 3, 100_000, 4, m.weight_table(spark, None, ["a", "b", "c"]), 1.0)
    assert got.count() == 50_000 and got.filter("budget > 4 * n").count() == 0
