import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import tierflow.llm.decontam as d
from tierflow.llm.decontam import _Class, _running, _window_prints, contaminated, keep_uncontaminated, size_class
from tierflow.llm.queries import LLM_QUERIES
from tierflow.llm.runtime import prepare

SF = "/root/testdata/sf0.01"


def slow_shingles(words):
    n = min(5, len(words))
    return [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]


def slow_matches(docs, items, least=0.8):
    """Best similarity over all windows of the item's size (clipped at both ends)."""
    words = {k: re.findall(r"\w+", (t or "").lower()) for k, t in items.items()}
    df = Counter(s for w in words.values() for s in set(slow_shingles(w)) if w)
    weight = lambda s: 1 + math.log(len(items) / df.get(s, 1))
    out = {}
    for doc, text in docs.items():
        w = re.findall(r"\w+", (text or "").lower())
        have = set(slow_shingles(w)) if len(w) >= 5 else None
        for item, iw in words.items():
            a = Counter(slow_shingles(iw)) if iw else Counter()
            if not a or (have is not None and len(iw) >= 5 and not have & a.keys()):
                continue
            best = 0.0
            for s in range(-len(iw) // 5, max(1, len(w) - len(iw) + len(iw) // 5 + 1)):
                part = w[max(0, s):max(0, s + len(iw))]
                b = Counter(slow_shingles(part)) if part else Counter()
                both = a.keys() | b.keys()
                best = max(best, sum(min(a[x], b[x]) * weight(x) for x in both) / sum(max(a[x], b[x]) * weight(x) for x in both))
            if best >= least:
                out[doc, item] = best
    return out


def test_window_prints_match_a_plain_loop():
    h = np.random.default_rng(2).integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for k in (1, 2, 7, 300):
        got = _window_prints(_running(h, k), k)
        want = [sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h[i:i + k]) > k) for i in range(len(h) - k + 1)]
        assert got.tolist() == want


def test_blocks_find_all_within_the_radius():
    r = random.Random(1)
    own = [r.getrandbits(64) for _ in range(30)]
    probe = [x ^ sum({1 << r.randrange(64) for _ in range(k)}) for x in own for k in range(18)]
    c = _Class(10, np.array(own, "<u8"), np.arange(30), np.zeros(30, int))
    c.index()
    row, entry = c.search(np.array(probe, "<u8"))
    want = [(i, j) for i, x in enumerate(probe) for j, y in enumerate(own) if (x ^ y).bit_count() <= 13]
    assert sorted(zip(row.tolist(), entry.tolist())) == want
    for bits in itertools.product(range(17), repeat=4):  # the pigeonhole behind it
        if sum(bits) <= d.RADIUS:
            assert any(a <= b for a, b in zip(bits, d.BLOCK_BITS))


def test_size_class():
    assert [size_class(n) for n in (1, 2, 3, 5, 6, 7, 12)] == [1, 2, 3, 5, 6, 6, 10]
    for n in range(8, 500):
        assert 0.68 * n <= size_class(n) <= math.ceil(0.85 * n)


def test_windows_of_an_item():
    for n in range(1, 600):
        size, at = d.window_size(n), d.offsets(n)
        assert 1 <= size <= n and at[0] == 0 and at[-1] == n - size and len(at) <= d.STAGGER
        if n >= 16:
            assert 0.36 * n <= size <= 0.5 * n
            # wherever one word changes, some window does not hold it
            assert all(any(not a <= k < a + size for a in at) for k in range(n))
            # cut to four fifths at either end, two windows are left whole
            assert sum(a + size <= 0.8 * n for a in at) >= 2 and sum(a >= 0.2 * n for a in at) >= 2


def test_query_finds_what_brute_force_finds(spark):
    docs = {x.doc_id: x.text for x in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {x.item_id: x.text for x in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = slow_matches(docs, items)
    got = {(x.doc_id, x.item_id): x.similarity for x in LLM_QUERIES["op6_decontam"](spark, SF).collect()}
    assert len(want) > 10 and got.keys() <= want.keys()
    assert len(got) >= 0.97 * len(want)
    assert all(got[k] <= want[k] + 1e-9 for k in got)


def test_edited_passages(spark):
    prepare(spark)
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 9)))
    items = {i: " ".join(word() for _ in range(r.randrange(15, 60))) for i in range(60)}
    docs, n = {}, 0
    for i, t in items.items():
        for edits in range(4):
            w = t.split()
            for _ in range(edits):
                at = r.randrange(len(w))
                w[at:at + 1] = r.choice([[], [word()], [word(), word()]])
            docs[n] = " ".join([*(word() for _ in range(r.randrange(80))), *w, *(word() for _ in range(r.randrange(80)))])
            n += 1
    want = slow_matches(docs, items)
    got = {(x.id, m.item_id) for x in contaminated(
        spark.createDataFrame(list(docs.items()), "doc_id bigint, text string"),
        spark.createDataFrame(list(items.items()), "item_id bigint, text string")).collect() for m in x.matches}
    assert got <= want.keys() and len(got) >= 0.95 * len(want) and len(want) > 70


def test_odd_rows(spark, monkeypatch):
    prepare(spark)
    long = " ".join(f"w{i}" for i in range(300))
    items = spark.createDataFrame([(1, "one two three four five six seven eight"), (2, "Tiny item"), (3, None), (4, ""),
                                   (5, "one two three four five six seven eight"), (None, long)], "item_id bigint, text string")
    rows = [(1, "zero ONE two, three four five six seven eight nine"), (2, None), (3, ""), (None, f"x {long} y"),
            (4, "a tiny ITEM here"), (4, "a tiny ITEM here"), (6, "nothing of that kind"), (7, "tiny"), (8, "q " * 50000 + long)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"matches": F.lit(1), "id": F.lit("i"), "h": F.lit(0)})
    want = sorted([(1, (1, 5)), (None, (None,)), (4, (2,)), (4, (2,)), (8, (None,))], key=str)

    def run():
        return sorted(((x.id, tuple(m.item_id for m in x.matches)) for x in contaminated(df, items).collect()), key=str)
    assert run() == want
    kept = keep_uncontaminated(df, items)
    assert kept.columns == df.columns and sorted(x.doc_id for x in kept.collect()) == [2, 3, 6, 7]
    clean_null = df.unionByName(df.filter("doc_id = 6").withColumn("doc_id", F.lit(None).cast("bigint")))
    assert sorted(str(x.doc_id) for x in keep_uncontaminated(clean_null, items).collect()) == ["2", "3", "6", "7", "None"]
    assert contaminated(df.limit(0), items).count() == 0 and contaminated(df, items.limit(0)).count() == 0
    monkeypatch.setattr(d, "ITEMS_A_PASS", 2)
    assert sorted((k, m) for k, ms in run() for m in ms if m) == sorted((k, m) for k, ms in want for m in ms if m)
    assert sorted(x.doc_id for x in keep_uncontaminated(df, items).collect()) == [2, 3, 6, 7]


def test_windows_reach_the_recall_alone(spark):
    """Exact copies, copies cut short, and copies with words replaced, inserted
    or lost throughout, as far as they are similar: what the windows find, of
    what brute force finds."""
    prepare(spark)
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(3, 9)))
    items = {i: [word() for _ in range(r.choice([30, 60, 100, 160, 260]))] for i in range(80)}
    docs, kind = {}, {}
    for i, w in items.items():
        around = lambda x: [*(word() for _ in range(r.randrange(60))), *x, *(word() for _ in range(r.randrange(60)))]
        edited = list(w)
        for _ in range(max(1, len(w) // 45)):
            at = r.randrange(len(edited))
            edited[at:at + 1] = r.choice([[], [word()], [word(), word()]])
        cut = -(-len(w) * 82 // 100)
        for name, x in (("exact", around(w)), ("cut", r.choice([w[:cut], w[-cut:]])), ("edited", around(edited))):
            kind[len(docs)] = name
            docs[len(docs)] = " ".join(x)
    items = {i: " ".join(w) for i, w in items.items()}
    want = slow_matches(docs, items)
    got = {(x.id, m.item_id) for x in contaminated(
        spark.createDataFrame(list(docs.items()), "doc_id bigint, text string"),
        spark.createDataFrame(list(items.items()), "item_id bigint, text string")).collect() for m in x.matches}
    assert got <= want.keys()
    for name, least in (("exact", 1.0), ("cut", 1.0), ("edited", 0.97)):
        own = [k for k in want if kind[k[0]] == name]
        assert len(own) > 50 and sum(k in got for k in own) >= least * len(own), name


def test_nothing_similar_is_missed(spark):
    """Documents that are items cut short of their window, and items with one
    word replaced, which lie outside the radius now and then: each is found."""
    prepare(spark)
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(3, 9)))
    items = {i: [word() for _ in range(n)] for i, n in enumerate([178, 149, 255, *[49, 50] * 20])}
    docs = [items[i][:n] for i, n in ((0, 145), (0, 150), (1, 121), (1, 125), (2, 206), (2, 216))]
    docs += [items[0][-146:], [*(word() for _ in range(40)), *items[1][:123]], [*items[2][-208:], *(word() for _ in range(90))]]
    for i in range(3, len(items)):
        docs.append([*(word() for _ in range(30)), *items[i][:24], word(), *items[i][25:], *(word() for _ in range(30))])
    docs = {k: " ".join(w) for k, w in enumerate(docs)}
    items = {i: " ".join(w) for i, w in items.items()}
    want = slow_matches(docs, items)
    got = {(x.id, m.item_id): m.similarity for x in contaminated(
        spark.createDataFrame(list(docs.items()), "doc_id bigint, text string"),
        spark.createDataFrame(list(items.items()), "item_id bigint, text string")).collect() for m in x.matches}
    cut, replaced = ({k for k in want if (k[0] < 9) == short} for short in (True, False))
    assert len(cut) == 9 and len(replaced) == 40
    assert got == pytest.approx(want)
