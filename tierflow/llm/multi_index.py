"""Near-duplicate embeddings by an inverted multi-index.

Each half of a vector has its own codebook; a pair of codewords is a cell of
the product grid, and every vector is listed in the cell of its two nearest
codewords. A vector visits cells in the order of their distance (the sum over
both halves) and is compared there exactly, in double precision. It visits as
many cells as reach the target recall on the loosest links there can be: sampled
vectors with a partner planted at the very cosine that links, whose difference
lies in both halves or in either one, so rare links and large groups of close
copies do not change what is measured; more, if the loosest links of sampled
vectors ask for more. Only counts and spanning links
leave a comparison, never all pairs of a group.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.components import connected_components
from tierflow.llm.runtime import written
from tierflow.llm.sampling import at_most

COSINE = 0.93
#: Distinct vectors that codebooks are fitted on, and queries that measure how
#: many cells a recall takes: by their own links, and by planted links of each
#: kind (hash samples; every vector is indexed).
SAMPLE, QUERIES, PLANTED = 8192, 256, 4096
RECALL = 0.999
#: Vectors of the largest group for each cell of the grid, on average (groups
#: share the grid, not the cells); codewords of a half at most.
CELL_VECTORS, CODEWORDS = 32, 256
LEAST_CELLS = 4
#: Vectors of one cell that are compared as one block with one other block.
BLOCK = 128


def unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def codebook(x: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """k-means centres of the rows of ``x``, distinct, ``k`` at most."""
    c = np.unique(x[np.random.default_rng(seed).permutation(len(x))[:k]], axis=0)
    for _ in range(rounds):
        own = distances(x, c).argmin(axis=1)
        c = np.unique(np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))]), axis=0)
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distance of each row to each centre, the same to the last bit
    whichever rows and centres are taken together."""
    out = np.empty((len(x), len(c)))
    for j in range(len(c)):
        out[:, j] = ((x - c[j]) ** 2).sum(axis=1)
    return out


@dataclass
class Grid:
    first: np.ndarray
    second: np.ndarray
    visits: int = LEAST_CELLS

    @property
    def half(self) -> int:
        return self.first.shape[1]

    def parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return distances(x[:, :self.half], self.first), distances(x[:, self.half:], self.second)

    def own(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a.argmin(axis=1) * len(self.second) + b.argmin(axis=1)

    def distance_to(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Of each row to one cell each."""
        i, j = cell // len(self.second), cell % len(self.second)
        return ((x[:, :self.half] - self.first[i]) ** 2).sum(axis=1) + ((x[:, self.half:] - self.second[j]) ** 2).sum(axis=1)

    def rank(self, a: np.ndarray, b: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Of each row, how many cells are nearer than one cell each."""
        out = np.empty(len(a), np.int64)
        for at in range(0, len(a), 64):  # 64 x CODEWORDS ** 2 distances at once
            far = (a[at:at + 64, :, None] + b[at:at + 64, None]).reshape(len(a[at:at + 64]), -1)
            out[at:at + 64] = (far < np.take_along_axis(far, cell[at:at + 64, None], 1)).sum(axis=1)
        return out

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many cells lie before the one that a visit finds the other in,
        from the side of each pair that needs fewer."""
        (a, b), (c, d) = self.parts(x), self.parts(y)
        return np.minimum(self.rank(a, b, self.own(c, d)), self.rank(c, d, self.own(a, b)))

    def traverse(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ``visits`` nearest cells of each row, nearest first, and the
        distance of the last one: cells that far away count as visited.

        The multi-sequence rule: the cell of the i-th and j-th nearest codewords
        comes after the i x j cells of nearer ones, so only ranks with
        (i + 1)(j + 1) <= visits can be among the first.
        """
        t = min(self.visits, a.shape[1] * b.shape[1])
        ia, ib = np.argsort(a, axis=1, kind="stable")[:, :t], np.argsort(b, axis=1, kind="stable")[:, :t]
        i, j = np.divmod(np.arange(ia.shape[1] * ib.shape[1]), ib.shape[1])
        near = (i + 1) * (j + 1) <= t
        i, j = i[near], j[near]
        far = np.take_along_axis(a, ia[:, i], 1) + np.take_along_axis(b, ib[:, j], 1)
        cell = ia[:, i] * b.shape[1] + ib[:, j]
        order = np.lexsort((cell, far), axis=1)[:, :t]
        return np.take_along_axis(cell, order, 1), np.take_along_axis(far, order[:, -1:], 1)[:, 0]


def _pack(width: int):
    """Rows (id, part, vector) -> their group, the vector as doubles padded to
    ``width``, and a digest of both; no group for vectors that cannot link."""
    def run(batches):
        for b in batches:
            group, raw, digest = [], [], []
            labels, vectors = b.column(1).to_pylist(), b.column(2).to_pylist()
            for label, v in zip(labels, vectors):
                x = None
                if label is not None and v and None not in v:
                    x = np.array(v, np.float64)
                    with np.errstate(over="ignore"):
                        if not np.isfinite(x).all() or not x.any():
                            x = None
                        else:  # scale first: squares of huge or tiny values stay finite
                            x = x / np.abs(x).max()
                if x is None:
                    group.append(None), raw.append(None), digest.append(None)
                    continue
                key = f"{len(v)}:{label}"
                data = np.pad(x, (0, width - len(x))).astype("<f8").tobytes()
                group.append(key), raw.append(data)
                digest.append(hashlib.blake2b(key.encode() + b"\0" + data, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(group, pa.string()), pa.array(raw, pa.binary()),
                                              pa.array(digest, pa.binary())], names=["id", "grp", "vec", "digest"])
    return run


def _loosest(grid: Grid, queries: dict[str, list], cosine: float):
    """Of each query, the loosest link in this task: its cosine, and how many
    cells lie before the one it is found in."""
    def run(batches):
        least: dict[bytes, tuple] = {}
        for b in batches:
            rows: dict[str, list] = {}
            for d, g, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if g in queries:
                    rows.setdefault(g, []).append((d, v))
            for g, own in rows.items():
                x = unit([v for _, v in own])
                q = unit([v for _, v in queries[g]])
                for k, (d, _) in enumerate(queries[g]):
                    cos = x @ q[k]
                    hit = np.flatnonzero((cos >= cosine) & np.array([e != d for e, _ in own]))
                    if len(hit):
                        far = hit[np.argmin(cos[hit])]
                        least[d] = min(least.get(d, (2.0, 0)), (float(cos[far]), int(grid.apart(q[k:k + 1], x[far:far + 1])[0])))
        if least:
            yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.binary()), pa.array([c for c, _ in least.values()]),
                                              pa.array([r for _, r in least.values()], pa.int64())], names=["digest", "cos", "rank"])
    return run


def planted(x: np.ndarray, cosine: float, first: int, last: int, seed: int = 6) -> np.ndarray:
    """A vector at ``cosine`` to each unit row, which differs from it in the
    components ``first`` to ``last`` alone, but for its length."""
    d = np.zeros_like(x)
    d[:, first:last] = np.random.default_rng(seed).normal(size=(len(x), last - first))
    part = x[:, first:last]
    size = (part * part).sum(axis=1, keepdims=True)
    d[:, first:last] -= part * np.divide((d[:, first:last] * part).sum(axis=1, keepdims=True), size, out=np.zeros_like(size), where=size > 0)
    size = np.sqrt((d * d).sum(axis=1, keepdims=True))
    d = np.divide(d, size, out=np.zeros_like(d), where=size > 1e-9)  # one component cannot turn: its partner is the row
    y = cosine * x + np.sqrt(max(0.0, 1 - cosine * cosine)) * d
    return y / np.sqrt((y * y).sum(axis=1, keepdims=True))


def _needed(ranks: np.ndarray, recall: float) -> int:
    """The fewest visits that find ``recall`` of the links."""
    return int(np.sort(ranks)[max(0, int(np.ceil(recall * len(ranks))) - 1)]) + 1 if len(ranks) else 0


def build_grid(distinct: DataFrame, cosine: float, recall: float = RECALL) -> Grid | None:
    """Codebooks from a bounded sample of ``distinct(digest, grp, vec)``, and
    the number of cells to visit: the fewest in which ``recall`` is reached on
    planted links of every kind, and on the loosest link of each sampled vector
    that has one (one vote each)."""
    n = distinct.groupBy("grp").count().agg(F.max("count")).first()[0]
    if not n:
        return None
    got = sorted((bytes(r["digest"]), bytes(r["vec"])) for r in at_most(distinct, SAMPLE, "digest").collect())
    x = unit([v for _, v in got] or [bytes(r["vec"]) for r in distinct.limit(1).collect()])
    k = int(np.clip(np.sqrt(n / CELL_VECTORS), 2, CODEWORDS))
    half = (x.shape[1] + 1) // 2
    grid = Grid(codebook(x[:, :half], k), codebook(x[:, half:], k))
    queries: dict[str, list] = {}
    for r in at_most(distinct, QUERIES, "digest", "grp").collect():
        queries.setdefault(r["grp"], []).append((bytes(r["digest"]), bytes(r["vec"])))
    own = distinct.select("digest", "grp", "vec").mapInArrow(_loosest(grid, queries, cosine), "digest binary, cos double, rank bigint")
    own = own.groupBy("digest").agg(F.min_by("rank", "cos").alias("rank")).collect()  # a row for each query at most
    # digests are in order of their hash, so the first ones are a sample too; a small table is planted on several times
    q = np.resize(x[:PLANTED], (PLANTED, x.shape[1]))
    kinds = [grid.apart(q, planted(q, cosine, a, z)) for a, z in ((0, x.shape[1]), (0, half), (half, x.shape[1]))]
    grid.visits = max(LEAST_CELLS, _needed(np.array([r["rank"] for r in own], np.int64), recall), *(_needed(r, recall) for r in kinds))
    return grid


def _listed(shared):
    """Each distinct vector with its cell, and how far its visits reach."""
    def run(batches):
        grid = shared.value
        for b in batches:
            a, c = grid.parts(unit(b.column(b.schema.get_field_index("vec")).to_pylist()))
            cells, reach = grid.traverse(a, c)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(b.schema.get_field_index(k)) for k in ("node", "copies", "grp", "vec")],
                 pa.array(grid.own(a, c), pa.int32()), pa.array(list(cells), pa.list_(pa.int32())), pa.array(reach)],
                names=["node", "copies", "grp", "vec", "cell", "visits", "reach"])
    return run


_LISTED = "node bigint, copies bigint, grp string, vec binary, cell int, visits array<int>, reach double"


def _compare(shared, cosine: float):
    """Rows of one task, sorted by task key: members and visitors of a block
    pair. Gives (node, n): links counted, and (node, other): spanning links."""
    def block(rows: dict) -> tuple[list, list, list]:
        grid = shared.value
        side = np.array(rows["member"], bool)
        x = unit(rows["vec"])
        node, copies = np.array(rows["node"], np.int64), np.array(rows["copies"], np.int64)
        cell, reach = np.array(rows["cell"], np.int64), np.array(rows["reach"])
        m, p = np.flatnonzero(side), np.flatnonzero(~side)
        if not len(m) or not len(p):
            return [], [], []
        i, j = np.nonzero(x[p] @ x[m].T >= cosine - 1e-9)
        i, j = p[i], m[j]
        keep = (node[i] != node[j]) & (np.einsum("ij,ij->i", x[i], x[j]) >= cosine)
        i, j = i[keep], j[keep]
        if not len(i):
            return [], [], []
        # the other way round is counted by the member's own visit, if it makes one
        alone = grid.distance_to(x[j], cell[i]) > reach[j]
        count = np.bincount(i, weights=copies[j], minlength=len(x)) + np.bincount(j[alone], weights=copies[i[alone]], minlength=len(x))
        low = node.copy()
        while True:  # smallest node that links inside this block reach
            new = low.copy()
            np.minimum.at(new, i, low[j])
            np.minimum.at(new, j, new[i])
            if (new == low).all():
                break
            low = new
        at = np.flatnonzero((count > 0) | (low < node))
        return node[at].tolist(), count[at].astype(np.int64).tolist(), low[at].tolist()

    def run(batches):
        names = ["key", "node", "copies", "vec", "cell", "reach", "member"]
        held: dict[str, list] = {k: [] for k in names}

        def done():
            out = block(held)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["node", "n", "low"])
        for b in batches:
            cols = {k: b.column(b.schema.get_field_index(k)).to_pylist() for k in names}
            keys = cols["key"]
            a = 0
            while a < len(keys):
                z = a
                while z < len(keys) and keys[z] == keys[a]:
                    z += 1
                if held["key"] and held["key"][0] != keys[a]:
                    yield from done()
                    held = {k: [] for k in names}
                for k in names:
                    held[k] += cols[k][a:z]
                a = z
        if held["key"]:
            yield from done()
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str | None = "label",
                 cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row.

    Rows of one group (null: none) are linked if the cosine of their vectors is
    ``cosine`` or more, in double precision; only vectors of one length can
    link. Vectors that are null, empty, zero, or hold null or non-finite
    components link with nothing, nor do rows with a null id (their component is
    null, and they are not kept). ``n_links`` counts the other rows linked
    directly, copies included; repeated rows are rows. No link is made below
    ``cosine``; some above may be missed, as ``recall`` says. An empty table
    gives an empty result.
    """
    spark = vectors.sparkSession
    group = F.col(group_col).cast("string") if group_col else F.lit("")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), group.alias("label"), F.col(vector_col).alias("vec"))
    width = rows.agg(F.max(F.size("vec"))).first()[0] or 1
    packed = written(rows.mapInArrow(_pack(max(2, width)), "id bigint, grp string, vec binary, digest binary"), "vectors")
    able = packed.filter("digest is not null and id is not null")
    # copies collapse before any comparison: one row for each distinct vector
    distinct = written(able.groupBy("digest").agg(F.min("id").alias("node"), F.count("*").alias("copies"),
                                                  F.first("grp").alias("grp"), F.first("vec").alias("vec")), "distinct")
    grid = build_grid(distinct, cosine, recall)
    if grid is None:
        classes = distinct.select("digest", "copies", "node", F.lit(0).cast("bigint").alias("n"), F.col("node").alias("root"))
    else:
        shared = spark.sparkContext.broadcast(grid)  # 2 x CODEWORDS half vectors at most
        listed = written(distinct.select("node", "copies", "grp", "vec").mapInArrow(_listed(shared), _LISTED), "listed")
        # a full cell is cut into blocks, and so are its visitors; each pair of blocks is compared on its own
        blocks = lambda n: F.ceil(n / BLOCK).cast("int")
        members = listed.groupBy("grp", "cell").agg(blocks(F.count("*")).alias("members"))
        calls = listed.select("grp", F.explode("visits").alias("at"))
        visitors = calls.groupBy("grp", "at").agg(blocks(F.count("*")).alias("visitors"))
        sizes = written(members.join(visitors, (members.grp == visitors.grp) & (members.cell == visitors.at)).select(
            members.grp.alias("grp"), F.col("cell").alias("at"), "members", "visitors"), "sizes")
        narrow = ["node", "copies", "vec", "cell", "reach"]
        own = listed.select("grp", F.col("cell").alias("at"), F.lit(True).alias("member"), *narrow)
        visit = listed.select("grp", F.explode("visits").alias("at"), F.lit(False).alias("member"), *narrow)
        both = own.unionByName(visit).join(sizes, ["grp", "at"])
        mine = F.pmod(F.xxhash64("node"), F.when(F.col("member"), F.col("members")).otherwise(F.col("visitors"))).cast("int")
        other = F.sequence(F.lit(0), F.when(F.col("member"), F.col("visitors")).otherwise(F.col("members")) - 1)
        both = both.withColumn("mine", mine).withColumn("other", F.explode(other))
        a, b = (F.when(F.col("member"), F.col(x)).otherwise(F.col(y)) for x, y in (("mine", "other"), ("other", "mine")))
        both = both.withColumn("key", F.concat_ws("/", "grp", "at", a, b)).select("key", "member", *narrow)
        found = written(both.repartition("key").sortWithinPartitions("key").mapInArrow(
            _compare(shared, cosine), "node bigint, n bigint, low bigint"), "found")
        counts = found.groupBy("node").agg(F.sum("n").alias("n"))
        roots = connected_components(found.select(F.col("node").alias("a"), F.col("low").alias("b")))
        classes = distinct.select("digest", "copies", "node").join(counts, "node", "left").join(roots, "node", "left").select(
            "digest", "copies", "node", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("root", "node").alias("root"))
    classes = written(classes, "classes")
    linked = able.select("id", "digest").join(classes, "digest").select(
        "id", (F.col("copies") - 1 + F.col("n")).alias("n_links"), F.col("root").alias("component_id"))
    rest = packed.filter("digest is null or id is null").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(rest).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
