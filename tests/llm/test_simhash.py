import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tierflow.llm.components import connected_components
from tierflow.llm.queries import LLM_QUERIES
from tierflow.llm.runtime import prepare
from tierflow.llm.simhash import fingerprint, near_links, simhash_dedup

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def slow_fingerprint(text):
    words, word = [], ""
    for c in text + " ":
        if c in SPACE:
            if word:
                words.append(word)
            word = ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


@pytest.mark.parametrize("text", ["", " \n\t", "One", "a b c", "A b\tC d", "x " * 999, "É É é a b \x1c c d e f", "a b c d e " * 40])
def test_fingerprint(text):
    assert fingerprint(text) == signed(slow_fingerprint(text))


def test_same_hash_as_spark(spark):
    got = spark.sql("select xxhash64('a b c d')").first()[0]
    assert got == signed(xxhash.xxh64(b"a b c d", seed=42).intdigest())


def test_links_match_brute_force(spark):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1, 1 << 63]
    near = [x ^ sum({1 << r.randrange(64) for _ in range(k)}) for x in base for k in range(7)]
    fps = sorted({signed(x) for x in base + near})
    got = sorted(map(tuple, near_links(spark.createDataFrame([(f,) for f in fps], "fp bigint")).collect()))
    want = [(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    assert got == want and len(want) > 100


def test_signatures_are_never_broadcast(spark):
    # 64 rows for every one that Spark counts: a small estimate says nothing
    fps = spark.range(1000).select(F.xxhash64("id").alias("fp"))
    links = near_links(fps)
    assert links.count() == 0
    for plan in (links, links.filter("a <> b").distinct()):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Broadcast" not in text


def test_too_large_a_radius_is_refused(spark):
    with pytest.raises(ValueError):
        near_links(spark.createDataFrame([(1,)], "fp bigint"), 5)


def test_components(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(100, 140)] + [(7, x) for x in range(200, 260)] + [(5, 5), (8, 7)]
    links += [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)]
    df = spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint")
    got = {x.node: x.root for x in connected_components(df).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == roots(nodes, [x for x in links if x[0] != x[1]])
    assert connected_components(df.limit(0)).count() == 0


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = {d.doc_id: slow_fingerprint(d.text or "") for d in docs}
    links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 4]
    want = roots(fps, links)
    got = LLM_QUERIES["op5_simhash"](spark, SF).collect()
    assert len(got) == len(docs) and links
    for x in got:
        assert x.fingerprint == f"{fps[x.doc_id]:016x}" and x.component_id == want[x.doc_id]


def test_odd_rows(spark):
    prepare(spark)
    rows = [(1, "a b c d e"), (2, None), (3, ""), (None, "a b c d e"), (4, "A B\nc d e"), (4, "A B\nc d e"),
            (None, "lonely words stand here alone"), (9, "z " * 50000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {"fp": F.lit("x"), "id": F.lit(1), "kept": F.lit(None)})
    got = sorted(((x.id, x.component_id, x.kept) for x in simhash_dedup(df).collect()), key=str)
    assert got == sorted([(1, 1, True), (2, 2, True), (3, 2, False), (None, 1, False), (4, 1, False), (4, 1, False),
                          (None, None, False), (9, 9, True)], key=str)
    assert simhash_dedup(df.limit(0)).count() == 0
