"""Hard negatives by zone maps over Hilbert-ordered blocks.

Vectors of whole numbers are sorted by label and their place on a Hilbert curve
and written as Parquet blocks, each with the minimum and maximum of every
dimension. For an anchor, interval arithmetic over a block's minima and maxima
bounds the scores in it from above and below; the bounds, with the scores an
anchor must reach, choose the blocks that its positives and then its windows
have to read. Blocks not chosen are not read; what is read is scored exactly.

Anchors travel in slices and zone maps in chunks of bounded size, dealt over a
grid; a task holds some blocks and one slice. The number of scores that bounds
can't avoid grows with anchors times rows, as it does for any exact search.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.hilbert import curve_key
from tierflow.llm.runtime import written

#: Rows of a block, anchors of a slice, zone maps of a chunk, blocks that one
#: task scores against one slice (the last two on average).
BLOCK, SLICE, CHUNK, READS = 512, 1024, 512, 64
#: The curve runs through the dimensions of greatest variance.
CURVE_DIMS, CURVE_BITS = 15, 4
#: Larger components (in absolute value) would overflow a score.
LARGEST = 1 << 24
NONE = np.iinfo(np.int64).min


def small(x: np.ndarray) -> bytes:
    """Rows of whole numbers, in two bytes each if they fit, else in four."""
    return x.astype("<i2" if not len(x) or np.abs(x).max() < 1 << 15 else "<i4").tobytes()


def matrix(raw: bytes, rows: int, dims: int) -> np.ndarray:
    return np.frombuffer(raw, "<i2" if len(raw) == 2 * rows * dims else "<i4").reshape(rows, dims)


def dot(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows with rows."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * a.shape[1]
    if most < 2.0 ** 53:  # every partial sum is a whole number that doubles hold
        return (a.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ x.astype(np.int64).T


def bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that rows between ``lo`` and ``hi`` can have
    with each anchor: a negative component turns the interval round."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return dot(up, lo) + dot(down, hi), dot(up, hi) + dot(down, lo)


def best(score: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the ``n`` highest scores and their ids, ties by smaller id;
    ``NONE`` is no score."""
    k = min(n, score.shape[1])
    if score.shape[1] > 4 * n:  # only columns at or above the n-th highest can be among the first
        least = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
        keep = (score >= least[:, None]) & (score > NONE)
        width = int(keep.sum(axis=1).max(initial=0))
        first = np.argsort(~keep, axis=1, kind="stable")[:, :max(width, k)]
        score, ids = np.take_along_axis(np.where(keep, score, NONE), first, 1), np.take_along_axis(ids, first, 1)
    order = np.lexsort((ids, -np.maximum(score, NONE + 1), score == NONE), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


def _whole(scale: int):
    """Rows (id, label, vector, anchor) -> those that take part, as whole numbers."""
    def run(batches):
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            keep, raw, size = [], [], []
            for at, (i, label, v) in enumerate(zip(*cols[:3])):
                if i is None or label is None or not v or None in v:
                    continue
                x = np.array(v, np.float64)
                if not np.isfinite(x).all():
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(scale * x)
                if np.abs(x).max() < LARGEST:
                    keep.append(at), raw.append(x.astype("<i4").tobytes()), size.append(len(v))
            pick = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pick), b.column(1).take(pick), b.column(3).take(pick),
                                              pa.array(size, pa.int32()), pa.array(raw, pa.binary())],
                                             names=["id", "label", "anchor", "dims", "vec"])
    return run


def _moments(batches):
    """Per length and dimension of one task: rows, sum and sum of squares."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for d, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x = np.frombuffer(v, "<i4").astype(np.float64)
            total.setdefault(d, np.zeros((3, d)))
            total[d] += [np.ones(d), x, x * x]
    for d, t in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), *[pa.array(r) for r in t]],
                                         names=["dims", "at", "n", "s", "q"])


def _curves(rows: DataFrame) -> dict[int, tuple]:
    """Per vector length: the dimensions of the curve, where its grid begins in
    each, and how wide a step is (15 rows a length)."""
    sums = rows.select("dims", "vec").mapInArrow(_moments, "dims int, at int, n double, s double, q double").groupBy("dims", "at").agg(
        *[F.sum(c).alias(c) for c in ("n", "s", "q")])
    sums = sums.select("dims", "at", (F.col("s") / F.col("n")).alias("mean"),
                       F.greatest(F.col("q") / F.col("n") - F.pow(F.col("s") / F.col("n"), 2), F.lit(0.0)).alias("var"))
    first = F.row_number().over(Window.partitionBy("dims").orderBy(F.desc("var"), "at"))
    curves: dict[int, list] = {}
    for r in sums.withColumn("rank", first).filter(F.col("rank") <= CURVE_DIMS).orderBy("dims", "rank").collect():
        curves.setdefault(r["dims"], []).append((r["at"], r["mean"] - 2 * r["var"] ** 0.5, 4 * r["var"] ** 0.5 / (1 << CURVE_BITS)))
    return {d: tuple(np.array(x) for x in zip(*c)) for d, c in curves.items()}


def _place(curves: dict[int, tuple]):
    """Adds each row's place on the curve of its length."""
    def run(batches):
        for b in batches:
            dims, raw = np.array(b.column(3).to_pylist(), np.int64), b.column(4).to_pylist()
            place = np.zeros(len(dims), np.int64)
            for d in np.unique(dims).tolist():
                own = np.flatnonzero(dims == d)
                x = np.frombuffer(b"".join([raw[i] for i in own]), "<i4").reshape(len(own), d)
                at, low, step = curves[d]
                grid = np.floor((x[:, at.astype(int)] - low) / np.where(step > 0, step, 1))
                place[own] = curve_key(np.clip(grid, 0, (1 << CURVE_BITS) - 1), CURVE_BITS)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place)], names=[*b.schema.names, "place"])
    return run


_BLOCK = ("block bigint, dims int, n int, ids binary, labels array<string>, vecs binary, lo binary, hi binary, "
          "anchors array<int>, seeds array<bigint>")


def _cut_blocks(positives: int):
    """Sorted rows of one task -> blocks. An anchor's seed is a score that its
    last positive reaches: the one that it has in its own block."""
    def run(batches):
        part, seq, held = TaskContext.get().partitionId(), 0, []

        def block():
            nonlocal seq
            dims, n = held[0][3], len(held)
            x = np.frombuffer(b"".join([r[4] for r in held]), "<i4").reshape(n, dims)
            ids, labels = np.array([r[0] for r in held], np.int64), np.array([r[1] for r in held], object)
            anchors = np.flatnonzero([r[2] for r in held])
            s = dot(x[anchors], x)
            s[(labels[anchors][:, None] != labels) | (ids[anchors][:, None] == ids)] = NONE
            s, _ = best(s, np.broadcast_to(ids, s.shape), positives)
            seeds = s[:, -1] if s.shape[1] == positives else np.full(len(anchors), NONE)
            out = pa.RecordBatch.from_arrays([
                pa.array([part << 32 | seq], pa.int64()), pa.array([dims], pa.int32()), pa.array([n], pa.int32()),
                pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.array([labels.tolist()], pa.list_(pa.string())), pa.array([small(x)], pa.binary()),
                pa.array([small(x.min(0))], pa.binary()), pa.array([small(x.max(0))], pa.binary()),
                pa.array([anchors.tolist()], pa.list_(pa.int32())), pa.array([seeds.tolist()], pa.list_(pa.int64()))],
                names=["block", "dims", "n", "ids", "labels", "vecs", "lo", "hi", "anchors", "seeds"])
            seq += 1
            return out
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if held and (len(held) >= BLOCK or row[3] != held[0][3]):
                    yield block()
                    held = []
                held.append(row)
        if held:
            yield block()
    return run


_SLICE = "slice bigint, dims int, n int, ids binary, labels array<string>, vecs binary, seeds array<bigint>"


def _cut_slices(batches):
    """Blocks with anchors, in order -> slices of anchors."""
    part, seq, held, size, dims = TaskContext.get().partitionId(), 0, [], 0, None

    def made():
        x = np.concatenate([h[2] for h in held])
        return pa.RecordBatch.from_arrays([
            pa.array([part << 32 | seq], pa.int64()), pa.array([dims], pa.int32()), pa.array([len(x)], pa.int32()),
            pa.array([np.concatenate([h[0] for h in held]).tobytes()], pa.binary()),
            pa.array([[y for h in held for y in h[1]]], pa.list_(pa.string())), pa.array([small(x)], pa.binary()),
            pa.array([[y for h in held for y in h[3]]], pa.list_(pa.int64()))], names=["slice", "dims", "n", "ids", "labels", "vecs", "seeds"])
    for b in batches:
        for r in b.to_pylist():
            at = r["anchors"]
            if held and (size + len(at) > SLICE or r["dims"] != dims):
                yield made()
                held, size, seq = [], 0, seq + 1
            dims = r["dims"]
            held.append((np.frombuffer(r["ids"], "<i8")[at], [r["labels"][i] for i in at], matrix(r["vecs"], r["n"], dims)[at], r["seeds"]))
            size += len(at)
    if held:
        yield made()


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i8")


class _Anchors:
    """One row of slices."""

    def __init__(self, r: dict):
        self.slice, self.ids, self.labels = r["slice"], _numbers(r["ids"]), np.array(r["labels"], object)
        self.x = matrix(r["vecs"], r["n"], r["dims"])
        self.seeds = np.array(r["seeds"], np.int64) if "seeds" in r else None
        if "p_scores" in r:  # anchors x positives, NONE where there is none
            self.p_ids, self.p_scores = _numbers(r["p_ids"]).reshape(r["n"], -1), _numbers(r["p_scores"]).reshape(r["n"], -1)


def _wanted_positives(a: _Anchors, zones: dict) -> tuple[np.ndarray, np.ndarray]:
    _, high = bounds(a.x, zones["lo"], zones["hi"])
    near = (zones["first"][None] <= a.labels[:, None]) & (a.labels[:, None] <= zones["last"][None])
    return near & (high >= a.seeds[:, None]), high


def _least(p: np.ndarray, low: int, high: int) -> np.ndarray:
    """The least score of each window: low * p <= high * score, rounded up."""
    return -((-low * p) // high)


def _window_wants(low: int, high: int, negatives: int):
    def wanted(a: _Anchors, zones: dict) -> tuple[np.ndarray, np.ndarray]:
        least, most = bounds(a.x, zones["lo"], zones["hi"])
        foreign = (zones["last"][None] < a.labels[:, None]) | (a.labels[:, None] < zones["first"][None])
        alike = (zones["first"] == zones["last"])[None] & (zones["first"][None] == a.labels[:, None])
        out = np.zeros(least.shape, bool)
        for p in a.p_scores.T:
            there = (p != NONE)[:, None]
            bottom = _least(np.where(p == NONE, 0, p), low, high)[:, None]
            # blocks that lie in the window whole: once they hold enough rows, blocks below all of them can't matter
            sure = there & foreign & (least >= bottom) & (most <= p[:, None])
            if sure.any():
                floor = np.where(sure, least, NONE)
                order = np.argsort(-np.maximum(floor, NONE + 1), axis=1, kind="stable")
                rows = np.cumsum(np.where(np.take_along_axis(sure, order, 1), zones["n"][order], 0), axis=1) >= negatives
                enough = np.take_along_axis(np.take_along_axis(floor, order, 1), rows.argmax(axis=1)[:, None], 1)
                bottom = np.where(rows.any(axis=1)[:, None], np.maximum(bottom, enough), bottom)
            out |= there & ~alike & (most >= bottom) & (least <= p[:, None])
        return out, most
    return wanted


def _choose(slices: DataFrame, zones: DataFrame, wanted) -> DataFrame:
    """(slice, block, anchors, bound): the blocks that anchors of a slice must
    read, with the greatest score possible there. Slices and zone maps are dealt
    over a grid, each cell of which holds about one slice and one chunk."""
    n = slices.count()
    across = max(1, -(-zones.count() // CHUNK))
    deal = lambda key, k: F.pmod(F.xxhash64(key), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = slices.withColumn("across", every(across)).withColumn("down", deal("slice", max(1, n)))
    right = zones.withColumn("down", every(max(1, n))).withColumn("across", deal("block", across))

    def cell(left, right):
        out: list[list] = [[], [], [], []]
        blocks = right.to_pylist()
        for d in {r["dims"] for r in blocks}:
            own = [r for r in blocks if r["dims"] == d]
            z = {"lo": np.stack([matrix(r["lo"], 1, d)[0] for r in own]), "hi": np.stack([matrix(r["hi"], 1, d)[0] for r in own]),
                 "first": np.array([r["first"] for r in own], object), "last": np.array([r["last"] for r in own], object),
                 "n": np.array([r["n"] for r in own], np.int64)}
            for r in left.to_pylist():
                if r["dims"] == d:
                    a = _Anchors(r)
                    want, bound = wanted(a, z)
                    for j in np.flatnonzero(want.any(axis=0)).tolist():
                        at = np.flatnonzero(want[:, j])
                        for c, v in zip(out, (a.slice, own[j]["block"], at.tolist(), bound[at, j].tolist())):
                            c.append(v)
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())))],
                        names=["slice", "block", "anchors", "bound"])
    return left.groupBy("across", "down").cogroup(right.groupBy("across", "down")).applyInArrow(
        cell, "slice bigint, block bigint, anchors array<int>, bound array<bigint>")


def _read(chosen: DataFrame, blocks: DataFrame, slices: DataFrame, score, schema: str) -> DataFrame:
    """Score the chosen blocks: ``score(anchors, blocks)`` gives a table for the
    blocks of one task, those with the greatest bounds first."""
    parts = chosen.groupBy("slice").agg(F.ceil(F.count("*") / READS).cast("int").alias("parts"))
    at = F.pmod(F.xxhash64("block"), "parts").cast("int")
    reads = chosen.join(parts, "slice").withColumn("part", at).join(blocks.select("block", "dims", "n", "ids", "labels", "vecs"), "block")
    copies = slices.join(parts, "slice").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    copies = copies.withColumnsRenamed({"slice": "of", "part": "copy"})

    def task(left, right):
        rows = sorted(left.to_pylist(), key=lambda r: (-max(r["bound"]), r["block"]))
        (own,) = right.to_pylist()
        return score(_Anchors({**own, "slice": own["of"]}), rows)
    return reads.drop("parts").groupBy("slice", "part").cogroup(copies.groupBy("of", "copy")).applyInArrow(task, schema)


def _merge(top: tuple, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
    """Put scores of some anchors among the best so far."""
    n = top[0].shape[1]
    s, i = best(np.concatenate([top[0][at], score], axis=1), np.concatenate([top[1][at], ids], axis=1), n)
    top[0][at], top[1][at] = s, i


def _empty(rows: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.full((rows, n), NONE), np.zeros((rows, n), np.int64)


def _positives(n: int):
    def score(a: _Anchors, blocks: list[dict]) -> pa.Table:
        top = _empty(len(a.ids), n)
        for r in blocks:
            at = np.array(r["anchors"])[np.array(r["bound"]) >= top[0][r["anchors"], -1]]  # equal scores may have smaller ids
            if len(at):
                ids = _numbers(r["ids"])
                s = dot(a.x[at], matrix(r["vecs"], r["n"], r["dims"]))
                s[(a.labels[at][:, None] != np.array(r["labels"], object)) | (a.ids[at][:, None] == ids)] = NONE
                _merge(top, at, *best(s, np.broadcast_to(ids, s.shape), n))
        i, j = np.nonzero(top[0] != NONE)
        return pa.table([pa.array(np.full(len(i), a.slice)), pa.array(i, pa.int32()), pa.array(top[0][i, j]), pa.array(top[1][i, j])],
                        names=["slice", "anchor", "score", "id"])
    return score


def _negatives(n: int, low: int, high: int):
    def score(a: _Anchors, blocks: list[dict]) -> pa.Table:
        tops = [_empty(len(a.ids), n) for _ in a.p_scores.T]
        for r in blocks:
            last = np.array([t[0][r["anchors"], -1] for t in tops]).min(axis=0, initial=np.iinfo(np.int64).max)
            at = np.array(r["anchors"])[np.array(r["bound"]) >= last]
            if not len(at):
                continue
            ids = _numbers(r["ids"])
            s = dot(a.x[at], matrix(r["vecs"], r["n"], r["dims"]))
            s[a.labels[at][:, None] == np.array(r["labels"], object)] = NONE
            for p, top in zip(a.p_scores[at].T, tops):
                bottom = _least(np.where(p == NONE, 0, p), low, high)
                w = np.where((s <= p[:, None]) & (s >= bottom[:, None]), s, NONE)  # without a positive: nothing is below NONE
                some = np.flatnonzero((w != NONE).any(axis=1))
                if len(some):
                    _merge(top, at[some], *best(w[some], np.broadcast_to(ids, w[some].shape), n))
        out: list[list] = [[], [], [], [], [], [], []]
        for k, (s, ids) in enumerate(tops):
            i, j = np.nonzero(s != NONE)
            for c, v in zip(out, (np.full(len(i), a.slice), i, np.full(len(i), k), a.ids[i], a.p_ids[i, k], a.p_scores[i, k], s[i, j])):
                c.append(v)
            out.append(ids[i, j])
        ids = np.concatenate(out[7:]) if out[7:] else np.zeros(0, np.int64)
        cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out[:7]]
        return pa.table([pa.array(c, pa.int64()) for c in (*cols, ids)],
                        names=["slice", "anchor", "k", "anchor_id", "positive_id", "positive_score", "negative_score", "negative_id"])
    return score


def hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label",
                   scale: int = 256, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)`` for every anchor (rows for which ``anchor`` holds) and each
    of its positives: the first ``negatives`` rows of other labels with
    ``low * positive_score <= high * negative_score <= high * positive_score``.

    A component x counts as floor(scale * x); a score is the inner product with
    the anchor, exactly, as a whole number. Higher scores come first, ties by
    smaller id. An anchor's positives are its first ``positives`` rows of the
    same label and another id. Fewer are returned where fewer exist.

    Rows with a null id, label or vector, an empty vector, or any null or
    non-finite component, or one of 2**24 or more after scaling, take no part; a
    null anchor condition is false. Only vectors of one length have scores with
    each other. Repeated rows are rows: each copy stands for itself, as an anchor
    and as a candidate. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), label.cast("string").alias("label"), F.col(vector_col).alias("vec"),
                          F.coalesce(anchor, F.lit(False)).alias("anchor"))
    whole = written(rows.mapInArrow(_whole(scale), "id bigint, label string, anchor boolean, dims int, vec binary"), "whole")
    placed = whole.mapInArrow(_place(_curves(whole)), "id bigint, label string, anchor boolean, dims int, vec binary, place bigint")
    ordered = placed.repartitionByRange("dims", "label", "place", "id").sortWithinPartitions("dims", "label", "place", "id")
    blocks = written(ordered.select("id", "label", "anchor", "dims", "vec").mapInArrow(_cut_blocks(positives), _BLOCK), "blocks")
    zones = blocks.select("block", "dims", "n", "lo", "hi", F.array_min("labels").alias("first"), F.array_max("labels").alias("last"))
    having = blocks.filter(F.size("anchors") > 0).select("block", "dims", "n", "ids", "labels", "vecs", "anchors", "seeds")
    n = blocks.agg(F.sum(F.size("anchors"))).first()[0]
    if not n:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                         "positive_score bigint, negative_score bigint")
    slices = written(having.repartitionByRange(-(-n // SLICE), "block").sortWithinPartitions("block").mapInArrow(_cut_slices, _SLICE), "slices")

    chosen = written(_choose(slices, zones, _wanted_positives), "positive-reads")
    found = _read(chosen, blocks, slices, _positives(positives), "slice bigint, anchor int, score bigint, id bigint")
    first = F.row_number().over(Window.partitionBy("slice", "anchor").orderBy(F.desc("score"), "id"))
    found = found.withColumn("rank", first).filter(F.col("rank") <= positives)

    def with_windows(left, right):
        (r,) = left.to_pylist()
        s, ids = _empty(r["n"], positives)
        at = [right.column(c).to_numpy() for c in ("anchor", "rank", "score", "id")]
        s[at[0], at[1] - 1], ids[at[0], at[1] - 1] = at[2], at[3]
        return pa.table([*left.drop_columns(["seeds"]).columns, pa.array([ids.tobytes()], pa.binary()), pa.array([s.tobytes()], pa.binary())],
                        names=["slice", "dims", "n", "ids", "labels", "vecs", "p_ids", "p_scores"])
    windows = written(slices.groupBy("slice").cogroup(found.withColumnRenamed("slice", "of").groupBy("of")).applyInArrow(
        with_windows, "slice bigint, dims int, n int, ids binary, labels array<string>, vecs binary, p_ids binary, p_scores binary"), "windows")

    chosen = written(_choose(windows, zones, _window_wants(low, high, negatives)), "window-reads")
    mined = _read(chosen, blocks, windows, _negatives(negatives, low, high), (
        "slice bigint, anchor bigint, k bigint, anchor_id bigint, positive_id bigint, positive_score bigint, "
        "negative_score bigint, negative_id bigint"))
    rank = F.row_number().over(Window.partitionBy("slice", "anchor", "k").orderBy(F.desc("negative_score"), "negative_id"))
    return mined.withColumn("rank", rank).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
