import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tierflow.llm.hard_negatives as hn
from tierflow.llm.hard_negatives import NONE, best, bounds, dot, hard_negatives, matrix, small
from tierflow.llm.hilbert import curve_key
from tierflow.llm.queries import LLM_QUERIES
from tierflow.llm.runtime import prepare

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, every, low=80, high=100, n=5):
    """By definition, over rows (id, vector, label); anchors are ids divisible by ``every``."""
    able = [(i, [int(np.floor(256 * x)) for x in v], c) for i, v, c in rows
            if i is not None and c is not None and v and None not in v and np.isfinite(v).all() and max(abs(256 * x) for x in v) < 1 << 24]
    out = []
    for a, u, c in able:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(u, v)), i, d) for i, v, d in able if len(v) == len(u))
        for s, p, d in [x for x in scored if x[2] == c and x[1] != a][:n]:
            hard = [(t, i) for t, i, e in scored if e != c and low * -s <= high * -t <= high * -s][:n]
            out += [(a, p, k, i, -s, -t) for k, (t, i) in enumerate(hard, 1)]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


@pytest.mark.parametrize("dims,bits", [(1, 5), (2, 4), (3, 3), (5, 2), (7, 1)])
def test_curve_goes_through_neighbours(dims, bits):
    grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    key = curve_key(grid, bits)
    assert sorted(key) == list(range(len(grid)))
    steps = np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_curve_key_fits():
    assert curve_key(np.full((1, 15), 15), 4)[0] >= 0
    with pytest.raises(ValueError):
        curve_key(np.zeros((1, 16), int), 4)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(1, 6), st.sampled_from([3, 1000, 1 << 23]))
def test_bounds_hold(seed, dims, size):
    r = np.random.default_rng(seed)
    a, x = r.integers(-size, size, (4, dims)), r.integers(-size, size, (9, dims))
    least, most = bounds(a, x.min(0)[None], x.max(0)[None])
    s = dot(a, x)
    assert (s == a @ x.T).all() and (least <= s).all() and (s <= most).all()
    assert (matrix(small(x), 9, dims) == x).all()


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(1, 40), st.integers(1, 6))
def test_best_is_a_sort(seed, width, n):
    r = np.random.default_rng(seed)
    s = r.choice([NONE, -2, 0, 1, 5], (3, width))
    ids = r.permutation(width)[None].repeat(3, 0)
    got, who = best(s, ids, n)
    for i in range(3):
        want = sorted((-v, k) for v, k in zip(s[i].tolist(), ids[i].tolist()) if v != NONE)[:n]
        assert [(-v, k) for v, k in zip(got[i].tolist(), who[i].tolist()) if v != NONE] == want


def test_query_is_brute_force(spark):
    rows = [(r.vec_id, list(r.embedding), (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = rows_of(LLM_QUERIES["op12_hard_negatives"](spark, SF))
    assert got and got == brute(rows, 100)


@pytest.mark.parametrize("block,chunk,cut,reads", [(512, 512, 1024, 64), (16, 3, 4, 2), (1, 7, 1, 1)])
def test_any_blocks(spark, monkeypatch, block, chunk, cut, reads):
    prepare(spark)
    for name, v in (("BLOCK", block), ("CHUNK", chunk), ("SLICE", cut), ("READS", reads)):
        monkeypatch.setattr(hn, name, v)
    r = np.random.default_rng(3)
    rows = [(i, (r.normal(size=6) * r.choice([0.1, 1, 30])).round(1).tolist(), int(r.integers(3))) for i in range(150)]
    rows += [(i, rows[i % 7][1], int(i % 4)) for i in range(150, 200)]  # ties
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(hard_negatives(df, F.col("vec_id") % 10 == 0)) == brute(rows, 10)


def test_bounds_leave_blocks_unread(spark, monkeypatch):
    """Clusters, with labels across them: windows read a part of the blocks."""
    prepare(spark)
    monkeypatch.setattr(hn, "BLOCK", 20)
    chosen = []
    choose = hn._choose
    monkeypatch.setattr(hn, "_choose", lambda *a: chosen.append(choose(*a)) or chosen[-1])
    r = np.random.default_rng(4)
    centres = r.normal(size=(12, 8)) * 2
    rows = [(i, (centres[i % 12] + r.normal(size=8) * 0.02).tolist(), int(i % 2 if i % 24 < 12 else 2)) for i in range(2400)]
    got = rows_of(hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0))
    assert got and got == brute(rows, 100)
    anchors, blocks = 24, 2400 // 20
    for c in chosen:
        assert c.agg(F.sum(F.size("anchors"))).first()[0] < 0.3 * anchors * blocks


def test_odd_rows(spark):
    prepare(spark)
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0], 0), (1, [1.0, 1.0], 0), (2, [1.0, 1.0], 1), (3, None, 0), (4, [], 0), (5, [1.0, None], 0), (6, [inf, 1.0], 0),
            (7, [nan, 1.0], 1), (None, [9.0, 9.0], 0), (8, [9.0, 9.0], None), (9, [1e300, 1.0], 1), (10, [1.0], 0), (20, [2.0], 0), (21, [1.7], 1),
            (30, [0.0, 0.0], 2), (31, [0.0, 0.0], 2), (40, [-1.0, -1.0], 3), (41, [1.0, 1.0], 3), *[(50, [1.0, 0.9], 0)] * 2, *[(51, [0.9, 0.9], 1)] * 3]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit(1), "place": F.lit("x"), "block": F.lit(2), "vec": F.lit(3)})
    got = rows_of(hard_negatives(df.repartition(3), F.col("vec_id") % 10 == 0))
    assert got == brute(rows, 10)


def test_empty_table(spark):
    prepare(spark)
    for rows in ([], [(1, [1.0], 0)], [(10, [1.0], 0)]):
        assert rows_of(hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0)) == []
