import numpy as np
import pytest
from pyspark.sql import functions as F

import tierflow.llm.multi_index as mi
from tierflow.llm.multi_index import Grid, codebook, near_vectors
from tierflow.llm.queries import LLM_QUERIES
from tierflow.llm.runtime import prepare

SF = "/root/testdata/sf0.01"


def slow(rows, cosine=0.93):
    """rows: (id, vector, label) -> id -> (links, component, kept)."""
    ok = [(i, np.array(v, float) / np.linalg.norm(np.array(v, float)), g) for i, v, g in rows]
    root = {i: i for i, _, _ in ok}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    links = dict.fromkeys(root, 0)
    for k, (i, x, g) in enumerate(ok):
        for j, y, h in ok[k + 1:]:
            if g == h and len(x) == len(y) and float(x @ y) >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (links[i], find(i), find(i) == i) for i in root}


def test_traverse_is_the_sorted_grid():
    r = np.random.default_rng(4)
    x = r.normal(size=(50, 6))
    grid = Grid(codebook(x[:, :3], 7), codebook(x[:, 3:], 9))
    for grid.visits in (1, 5, 20, 63, 100):
        a, b = grid.parts(x)
        cells, reach = grid.traverse(a, b)
        every = (a[:, :, None] + b[:, None]).reshape(50, -1)
        want = np.argsort(every, axis=1, kind="stable")[:, :cells.shape[1]]
        assert cells.shape[1] == min(grid.visits, 63)
        assert (cells == want).all() and (reach == np.take_along_axis(every, want[:, -1:], 1)[:, 0]).all()
        for k in range(cells.shape[1]):
            assert (grid.distance_to(x, cells[:, k]) == np.take_along_axis(every, cells[:, k:k + 1], 1)[:, 0]).all()


def test_query_matches_brute_force(spark):
    rows = [(x.vec_id, x.embedding, x.label) for x in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in LLM_QUERIES["op7_multi_index"](spark, SF).collect()}
    assert got == slow(rows)


def test_recall_on_loose_pairs(spark):
    """The table has no pairs at 0.93: at the 300th closest pair it must still
    find nearly all, though such pairs lie far apart in the grid."""
    prepare(spark)
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(x.vec_id, x.embedding, x.label) for x in df.collect()]
    x = np.array([v for _, v, _ in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([g for _, _, g in rows])
    cos = np.sort((x @ x.T)[np.triu(label[:, None] == label[None], 1)])[-300] - 1e-9
    want = slow(rows, cos)
    got = {r.id: r.n_links for r in near_vectors(df, cosine=float(cos)).collect()}
    links = sum(w[0] for w in want.values())
    assert links >= 600 and all(got[k] <= want[k][0] for k in want)
    assert sum(got.values()) >= 0.95 * links


@pytest.mark.parametrize("block", [128, 7])
def test_groups_of_near_copies(spark, monkeypatch, block):
    """Loose groups, wide enough to lie across cells, and blocks that cut them."""
    prepare(spark)
    monkeypatch.setattr(mi, "BLOCK", block)
    monkeypatch.setattr(mi, "CELL_VECTORS", 4)
    r = np.random.default_rng(9)
    rows = []
    for g in range(12):
        centre = r.normal(size=16)
        for _ in range(25):
            v = centre + r.normal(size=16) * r.choice([0, 0.05, 0.25])
            rows.append((len(rows), (v * r.choice([1, 1, 3])).tolist(), g % 3))
    rows += [(len(rows) + k, rows[3][1], rows[3][2]) for k in range(40)]
    want = slow(rows)
    got = {x.id: (x.n_links, x.component_id, x.kept) for x in near_vectors(
        spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    assert all(got[k][0] <= want[k][0] for k in want)
    assert sum(g[0] for g in got.values()) >= 0.99 * sum(w[0] for w in want.values())


def test_odd_rows(spark):
    prepare(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
            (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [], 1), (None, [1.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1),
            (12, [1e300, 0.0], 1), (13, [1e-310, 0.0], 1), (2, [1.0, 0.1], 1), (14, [-1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumns(
        {"id": F.lit(1), "node": F.lit(1), "digest": F.lit("d"), "n_links": F.lit("n")})
    got = sorted(((x.id, x.n_links, x.component_id, x.kept) for x in near_vectors(df).collect()), key=str)
    group = [1, 2, 2, 12, 13]
    want = [(i, 4, 1, i == 1) for i in group] + [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 14)] + [(None, 0, None, False)]
    assert got == sorted(want, key=str)
    assert near_vectors(df.limit(0)).count() == 0
    assert near_vectors(df.filter("vec_id = 5")).count() == 1


def test_rare_loose_links_beside_a_large_group(spark, monkeypatch):
    """Few pairs at the very cosine, which no sampled query has, and a group of
    close copies that has nearly all links: the pairs must be found too."""
    prepare(spark)
    monkeypatch.setattr(mi, "QUERIES", 8)
    monkeypatch.setattr(mi, "CELL_VECTORS", 2)
    r = np.random.default_rng(11)
    x = r.normal(size=(2400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pairs = mi.planted(x[:300], 0.931, 0, 64, seed=12)
    close = x[-1] + r.normal(size=(300, 64)) * 0.002
    df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate([*x, *pairs, *close])], "vec_id bigint, embedding array<double>, label int")
    got = {y.id: y.n_links for y in near_vectors(df).collect()}
    assert sum(got[k] >= 1 for k in range(300)) >= 297
    assert got[2399] >= 300 and not any(got[k] for k in range(300, 2399))


def test_sql_of_the_query_on_planted_links(spark, tmp_path):
    import duckdb

    from tierflow.llm.queries import LLM_ORACLES
    r, rows = np.random.default_rng(8), []
    for k in range(30):
        centre = r.normal(size=16)
        rows += [(len(rows) + j, (centre + r.normal(size=16) * 0.15 * (k % 4)).tolist(), k % 3) for j in range(6)]
    rows += [(900, [0.0] * 16, 1), (901, None, 1), (902, [float("nan")] * 16, 1), (903, rows[0][1], None), (904, [None] * 16, 2)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = sorted(con.execute(LLM_ORACLES["op7_multi_index"]).fetchall())
    got = LLM_QUERIES["op7_multi_index"](spark, str(tmp_path)).select("vec_id", "n_links", "component_id", "kept")
    assert sorted(map(tuple, got.collect())) == want and sum(x[1] for x in want) > 100
