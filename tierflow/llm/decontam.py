"""Benchmark decontamination by SimHash over item-sized windows.

Words are runs of letters, digits and underscores, lower-cased; shingles are
five words. The windows of an item are ``STAGGER`` stretches of it, spread evenly
from its beginning to its end, of a size class (sizes a fifth apart) just under
half of the item, so that one change leaves at least one of them as it was, and
an item that is cut short at either end still holds some whole. Every window of
that size in every document is fingerprinted too, and a multi-index over four
16-bit Hamming blocks finds all item windows at most 13 bits away: if the blocks
differed in more than 3, 3, 2 and 2 bits it would be 14 or more. These are the
only candidates. Where an item is 0.8 similar to a place in a document, a ninth
of the shingles on either side has no match, which turns 9.7 of 64 bits on
average; of the item's windows some have less than their share of it, and one
within the radius is enough. Every window of the item's own size, clipped at the
document's edges, is then compared by exact weighted-shingle (Jaccard)
similarity, best bound first.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.runtime import map_texts, written
from tierflow.llm.words import Piece, sequences

SHINGLE = 5
SIMILARITY = 0.8
BLOCK_BITS = (3, 3, 2, 2)
RADIUS = sum(BLOCK_BITS) + len(BLOCK_BITS) - 1
#: Windows of an item.
STAGGER = 4
#: Items, and characters of items, that one pass over the documents searches
#: for; more take more passes.
ITEMS_A_PASS, CHARS_A_PASS = 2000, 1 << 24
#: Windows that one step of the arithmetic takes: their counts stay in cache.
_ROWS = 2048


def size_class(n: int) -> int:
    """The largest of the sizes 1, 2, ... 5, 6, 7, 8, 9, 10, 12 ... (a fifth
    apart) that is at most 0.85 of ``n``, rounded up."""
    most, size = max(1, -(-n * 85 // 100)), 1
    while True:
        after = max(size + 1, size * 6 // 5)
        if after > most:
            return size
        size = after


def window_size(n: int) -> int:
    """Words of the windows of an item of ``n`` words: 0.36 to 0.45 of it (to 0.5
    of few words), but five at least, or all of it."""
    size = size_class(max(-(-n * 53 // 100), min(n, SHINGLE + 1)))
    return min(size, n // 2) if n >= 2 * SHINGLE else size


def offsets(n: int) -> list[int]:
    """Where the windows of an item of ``n`` words begin."""
    last = n - window_size(n)
    return sorted({last * k // (STAGGER - 1) for k in range(STAGGER)})


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of all five-word shingles; fewer words: of the whole sequence."""
    return sequences(words, min(SHINGLE, len(words))) if len(words) else words


def _running(h: np.ndarray, most: int) -> np.ndarray:
    """Per bit, how many of the hashes before each place have it: (places, 8)
    words of eight counts each, or (places, 64) counts if a window may hold
    more than 255 hashes.

    Running words overflow from one count into the next, but subtraction undoes
    that: the difference of two is the sum of the words between, and in a
    window no count exceeds its eight bits.
    """
    bits = np.unpackbits(h.astype("<u8").view(np.uint8), bitorder="little")
    step = bits.view("<u8").reshape(-1, 8) if most < 256 else bits.reshape(-1, 64).astype(np.uint32)
    total = np.zeros((len(h) + 1, step.shape[1]), step.dtype)
    np.cumsum(step, axis=0, dtype=step.dtype, out=total[1:])
    return total


def _window_prints(total: np.ndarray, k: int) -> np.ndarray:
    """SimHash of every ``k`` consecutive shingle hashes, from their running
    counts: a bit is set where more than half of them have it."""
    n = len(total) - k
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty((n, 8), np.uint8)
    count, above = np.empty((min(n, _ROWS), total.shape[1]), total.dtype), np.empty((min(n, _ROWS), 64), bool)
    for a in range(0, n, _ROWS):
        z = min(n, a + _ROWS)
        c, b = count[:z - a], above[:z - a]
        np.subtract(total[a + k:z + k], total[a:z], out=c)
        c = c.view(np.uint8) if total.shape[1] == 8 else c
        np.greater(c, c.dtype.type(k // 2), out=b)
        out[a:z] = np.packbits(b.reshape(-1), bitorder="little").reshape(-1, 8)
    return out.view("<u8")[:, 0]


def _near_values(bits: int) -> np.ndarray:
    """All 16-bit numbers with at most ``bits`` bits set."""
    v = np.arange(1 << 16, dtype=np.uint32)
    return v[np.bitwise_count(v) <= bits]


@dataclass
class _Class:
    """Item windows of one size: fingerprints, items, offsets in the item, and
    per block the windows whose block is near each 16-bit value."""

    size: int
    prints: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    tables: list = field(default_factory=list)

    def index(self) -> None:
        parts = self.prints.view("<u2").reshape(-1, 4)
        for b, bits in enumerate(BLOCK_BITS):
            near = _near_values(bits)
            value = (parts[:, b, None].astype(np.uint32) ^ near[None]).ravel()
            entry = np.repeat(np.arange(len(parts), dtype=np.int32), len(near))
            order = np.argsort(value, kind="stable")
            count = np.bincount(value, minlength=1 << 16)
            self.tables.append((count > 0, np.concatenate([[0], np.cumsum(count)]).astype(np.int32), entry[order]))

    def search(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``prints``, entry) of all pairs within the radius."""
        parts = prints.view("<u2").reshape(-1, 4)
        rows, entries = [], []
        for b, (some, at, entry) in enumerate(self.tables):
            column = np.ascontiguousarray(parts[:, b])
            hit = np.flatnonzero(some[column]).astype(np.int32)
            v = column[hit].astype(np.int32)
            n = at[v + 1] - at[v]
            ends = np.cumsum(n, dtype=np.int32)
            e = entry[np.repeat(at[v] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
            near = np.flatnonzero(np.bitwise_count(np.repeat(prints[hit], n) ^ self.prints[e]) <= RADIUS)
            rows.append(hit[np.searchsorted(ends, near, side="right")].astype(np.int64))
            entries.append(e[near])
        both = np.unique(np.concatenate(rows) * len(self.prints) + np.concatenate(entries))
        return both // len(self.prints), both % len(self.prints)


class Benchmark:
    """Items to search for. ``weight(h)`` of a shingle: 1 + ln(items / items
    that have it); one that no item has counts as if one had."""

    def __init__(self, ids: list, texts: list[str], shared: dict[int, int], n_items: int):
        self.ids, self.n_items = ids, max(1, n_items)
        known = np.array(sorted(shared), np.uint64)
        self.shared = known, np.array([shared[x] for x in known.tolist()], float)
        p = Piece(texts)
        h = p.hashes()
        ends = np.cumsum(p.words_per_doc())
        self.words = [h[a:z] for a, z in zip([0, *ends[:-1].tolist()], ends.tolist())]
        self.shingles = [shingles(w) for w in self.words]
        by: dict[int, list] = {}
        for i, w in enumerate(self.words):
            if len(w):
                size = window_size(len(w))
                for offset in offsets(len(w)):
                    part = shingles(w[offset:offset + size])
                    by.setdefault(size, []).append((_window_prints(_running(part, len(part)), len(part))[0], i, offset))
        self.classes = []
        for size, rows in sorted(by.items()):
            c = _Class(size, np.array([r[0] for r in rows], "<u8"), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
            c.index()
            self.classes.append(c)
        self.distinct = [np.unique(x, return_counts=True) for x in self.shingles]
        self.every = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.shingles]))

    def _known(self, h: np.ndarray) -> np.ndarray:
        if not len(self.every):
            return np.zeros(len(h), bool)
        return self.every[np.minimum(np.searchsorted(self.every, h), len(self.every) - 1)] == h

    def weights(self, h: np.ndarray) -> np.ndarray:
        known, count = self.shared
        if not len(known):
            return np.full(len(h), 1 + np.log(self.n_items))
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        return 1 + np.log(self.n_items / np.where(known[at] == h, count[at], 1.0))

    def similarity(self, item: int, window: np.ndarray) -> float:
        """Weighted Jaccard of two shingle multisets."""
        both, inverse = np.unique(np.concatenate([self.shingles[item], window]), return_inverse=True)
        n = len(self.shingles[item])
        a, b = np.bincount(inverse[:n], minlength=len(both)), np.bincount(inverse[n:], minlength=len(both))
        w = self.weights(both)
        return float((np.minimum(a, b) * w).sum() / (np.maximum(a, b) * w).sum())

    def best(self, item: int, words: np.ndarray, least: float) -> tuple[float, int] | None:
        """Similarity and first word of the window of ``words`` that is most
        similar to the item, the first of several, if it reaches ``least`` (as
        far as sums of doubles tell)."""
        size = len(self.words[item])
        n = min(SHINGLE, size)
        h = sequences(words, n)
        own, count = self.distinct[item]
        weight = self.weights(own) * count
        if weight[np.isin(own, h)].sum() < least * weight.sum() - 1e-9:
            return None
        running = np.zeros((2, len(h) + 1))  # of all shingles, and of those that the item has
        running[0, 1:] = np.cumsum(w := self.weights(h))
        running[1, 1:] = np.cumsum(w * np.isin(h, own))
        begin = np.arange(n - size, len(words) - n + 1)
        a, z = np.maximum(0, begin), np.minimum(len(words), begin + size) - n + 1
        every, both = running[:, z] - running[:, a]
        both = np.minimum(both, weight.sum())
        bound = both / (weight.sum() + every - both)  # a shingle that repeats may count too often here
        out = None
        hit = np.flatnonzero(bound >= least - 1e-9)
        for k in hit[np.argsort(-bound[hit], kind="stable")].tolist():
            if out and bound[k] < out[0] - 1e-9:
                break
            s = self.similarity(item, h[a[k]:z[k]])
            if s >= least - 1e-9 and (out is None or (s, -a[k]) > (out[0], -out[1])):
                out = s, int(a[k])
        return out

    def find(self, texts: list[str], least: float) -> list[tuple[int, int, float, int]]:
        """(text, item, similarity, first word) of the best window for each
        text and item that reaches ``least``."""
        p = Piece(texts)
        h = p.hashes()
        ends = np.cumsum(p.words_per_doc())
        starts = ends - p.words_per_doc()
        most = max((c.size for c in self.classes), default=0)
        total = {n: _running(sequences(h, n), most) for n in {min(SHINGLE, c.size) for c in self.classes}}
        seen: set[tuple[int, int]] = set()
        known = {n: np.concatenate([[0], np.cumsum(self._known(sequences(h, n)))]) for n in total}
        for c in self.classes:
            n = min(SHINGLE, c.size)
            prints = _window_prints(total[n], c.size - n + 1)
            # windows in one text; one without a shingle of any item is near it by chance alone, and is not looked up
            row = np.flatnonzero((p.doc[:len(prints)] == p.doc[c.size - 1:]) & (known[n][c.size - n + 1:] > known[n][:len(prints)]))
            if len(row):
                hit, entry = c.search(prints[row])
                seen.update(zip(p.doc[row[hit]].tolist(), c.item[entry].tolist()))
        found = ((doc, item, self.best(item, h[starts[doc]:ends[doc]], least)) for doc, item in sorted(seen))
        return [(doc, item, *best) for doc, item, best in found if best]


def _shingles_of(texts, cols):
    p = Piece(texts)
    h, ends = p.hashes(), np.cumsum(p.words_per_doc())
    out = [np.unique(shingles(h[a:z])).view(np.int64) for a, z in zip([0, *ends[:-1].tolist()], ends.tolist())]
    return {"h": np.concatenate(out) if out else [], "part": np.repeat(np.array(cols["part"].to_pylist(), np.int64), [len(x) for x in out])}


def _passes(items: DataFrame, item_col: str, item_text_col: str) -> list:
    """Broadcast indexes that hold all items, ``ITEMS_A_PASS`` items of
    ``CHARS_A_PASS`` characters each on average. What is collected for one is
    its items and the counts of their own shingles."""
    spark = items.sparkSession
    bench = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).filter(F.col("text").isNotNull())
    n_items, chars = bench.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    passes, out = max(1, -(-n_items // ITEMS_A_PASS), -(-chars // CHARS_A_PASS)), []
    part = F.pmod(F.xxhash64("text", "item_id"), F.lit(passes)).cast("int")
    bench = written(bench.withColumn("part", part), "benchmark")
    of = written(map_texts(bench.select("text", "part"), _shingles_of, "h bigint, part int"), "item-shingles")
    often = of.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
    shared = written(of.distinct().join(often, "h"), "shared-shingles")
    for k in range(passes):
        got = sorted(bench.filter(F.col("part") == k).collect(), key=lambda r: (r["item_id"] is not None, r["item_id"], r["text"]))
        counts = {r["h"] % (1 << 64): r["n"] for r in shared.filter(F.col("part") == k).collect()}
        out.append(spark.sparkContext.broadcast(Benchmark([r["item_id"] for r in got], [r["text"] for r in got], counts, n_items)))
    return out


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``(id, matches array<struct<item_id, similarity, first_word>>)``: the rows
    of ``docs`` that hold a window at least ``similarity`` similar to an item.

    Every row of ``docs`` that matches gives one row in each pass (repeats
    repeat, null ids stay); matches are ordered by item. Null and empty texts, and items without
    a word, match nothing; repeated items match each under its id. Items are
    read in passes of ``ITEMS_A_PASS`` and ``CHARS_A_PASS`` by a hash of their
    text, which bounds what is broadcast; an empty table on either side gives an
    empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    match = f"array<struct<item_id:{items.schema[item_col].dataType.simpleString()},similarity:double,first_word:int>>"
    out = None
    for index in _passes(items, item_col, item_text_col):
        def search(texts, cols, index=index):
            import pyarrow as pa
            b = index.value
            by: dict[int, list] = {}
            for doc, item, s, a in b.find(texts, similarity):
                by.setdefault(doc, []).append((item, {"item_id": b.ids[item], "similarity": s, "first_word": a}))
            at = sorted(by)
            return {"id": cols["id"].take(pa.array(at, pa.int64())),
                    "matches": [[m for _, m in sorted(by[d], key=lambda x: x[0])] for d in at]}

        found = map_texts(rows, search, f"id {kind}, matches {match}")
        out = found if out is None else out.unionByName(found)
    return out


def keep_uncontaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                        item_text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose own text holds no
    window that ``contaminated`` would report."""
    from pyspark.sql.functions import pandas_udf
    out = docs
    for index in _passes(items, item_col, item_text_col):
        @pandas_udf("boolean")
        def clean(texts, index=index):
            import pandas as pd

            from tierflow.llm.runtime import pieces
            texts = [t or "" for t in texts]
            ok = np.ones(len(texts), bool)
            for a, z in pieces(texts):
                ok[[a + doc for doc, *_ in index.value.find(texts[a:z], similarity)]] = False
            return pd.Series(ok)
        out = out.filter(clean(F.col(text_col)))
    return out
