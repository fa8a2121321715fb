"""Mixing sources to target weights by hierarchical budgeting.

Documents are the leaves' content in a tree (domain, language, source). A token
budget flows down: every node shares its budget among its children by weight,
never giving a child more than the tokens below it times ``max_epochs``. What a
child cannot take goes to its siblings by weight; only what none of them can
take is left to the siblings of the parent, and so on up. A leaf reads its
documents in seeded epochs, each in its own random order, and takes the prefix
that fills its budget.

The tree is a table for each level, and budgets flow by joins and windows over
the children of a node; only the number of all tokens comes to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.llm.runtime import columns_of, fresh, written

#: Value that stands for null in a level.
NONE = "(none)"
#: Documents of a leaf for each bucket of an epoch's order, on average; the one
#: bucket in which a budget ends is sorted by a single task.
BUCKET_DOCS = 4096


def share_out(budget: float, weights: list[float], most: list[float]) -> list[float]:
    """Split ``budget`` by weight with upper limits: limits that bind are filled
    and the rest is shared again among the others."""
    out, left = [0.0] * len(weights), min(budget, sum(most))
    free = [i for i in range(len(weights)) if weights[i] > 0 and most[i] > 0]
    while free and left > 0:
        total = sum(weights[i] for i in free)
        full = [i for i in free if left * weights[i] / total >= most[i]]
        if not full:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = most[i]
        left -= sum(most[i] for i in full)
        free = [i for i in free if i not in set(full)]
    return out


def budgets(leaves: Mapping[tuple[str, ...], int], total: float, max_epochs: float,
            weights: Mapping[tuple[str, ...], float] | None = None, alpha: float = 1.0) -> dict[tuple[str, ...], int]:
    """Whole-token budget of every leaf, for a tree that the caller holds (the
    same rules as :func:`budget_table`). ``leaves``: tokens by path; ``weights``:
    of any nodes, by path; a node without one weighs its tokens to the power
    ``alpha``. A weight of 0 shuts a node."""
    weights = weights or {}
    tokens: dict[tuple[str, ...], int] = {}
    below: dict[tuple[str, ...], set] = {}
    for path, n in leaves.items():
        for k in range(len(path) + 1):
            tokens[path[:k]] = tokens.get(path[:k], 0) + n
            if k < len(path):
                below.setdefault(path[:k], set()).add(path[:k + 1])
    most: dict[tuple[str, ...], float] = {}
    for path in sorted(tokens, key=len, reverse=True):  # a shut node, or one of shut nodes, takes nothing
        own = sum(most[c] for c in below[path]) if path in below else tokens[path] * max_epochs
        most[path] = 0 if weights.get(path, 1) <= 0 else own
    given: dict[tuple[str, ...], float] = {(): total}
    for path in sorted(below, key=lambda p: (len(p), p)):
        children = sorted(below[path])
        w = [weights.get(c, float(tokens[c]) ** alpha if tokens[c] else 0.0) for c in children]
        given.update(zip(children, share_out(given[path], w, [most[c] for c in children])))
    return {p: int(given[p] + 1e-6) for p in leaves}


def epoch_order(seed: int, epoch, *columns) -> Column:
    """Place (0 to 2**63 - 1) of a document in the order of an epoch."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch, *columns), 1)


def weight_table(spark: SparkSession, weights, names: Sequence[str]) -> DataFrame:
    """Weights as ``(level0, level1 ..., weight)``: from a mapping of paths, or
    from a table with the columns ``names`` and ``weight``, in which a node's
    lower levels are null."""
    keys = [f"level{i}" for i in range(len(names))]
    schema = ", ".join(f"{k} string" for k in keys) + ", weight double"
    if isinstance(weights, DataFrame):
        return weights.select(*[F.col(n).cast("string").alias(k) for n, k in zip(names, keys)], F.col("weight").cast("double").alias("weight"))
    rows = [(*path, *[None] * (len(names) - len(path)), float(w)) for path, w in (weights or {}).items()]
    return spark.createDataFrame(rows, schema)


def budget_table(leaves: DataFrame, depth: int, total: float, max_epochs: float, weights: DataFrame, alpha: float) -> DataFrame:
    """``leaves(level0 ..., n, rows)`` with ``budget``, the whole tokens of each.

    ``weights`` as :func:`weight_table` has them; a node without one weighs its
    tokens to the power ``alpha``, one of 0 or less takes nothing. A node that
    can't take its share (limits count from the leaves up, ``max_epochs`` times
    their tokens) is filled, and its siblings share the rest by weight: sorted by
    limit per weight, the filled ones come first.
    """
    keys = [f"level{i}" for i in range(depth)]
    nodes: dict[int, DataFrame] = {}
    below = leaves.select(*keys, F.col("n").cast("double").alias("tokens"), (F.col("n") * float(max_epochs)).alias("most"), "n", "rows")
    for k in range(depth, 0, -1):
        own = weights.filter(F.col(keys[k - 1]).isNotNull())
        if k < depth:
            own = own.filter(F.col(keys[k]).isNull())
            below = nodes[k + 1].groupBy(*keys[:k]).agg(F.sum("tokens").alias("tokens"), F.sum("most").alias("most"))
        own = own.groupBy(*keys[:k]).agg(F.max("weight").alias("given_weight"))
        node = below.join(own, keys[:k], "left")
        usual = F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(float(alpha)))).otherwise(0.0)
        shut = F.coalesce("given_weight", F.lit(1.0)) <= 0
        nodes[k] = node.withColumns({"weight": F.coalesce("given_weight", usual), "most": F.when(shut, 0.0).otherwise(F.col("most"))}).drop("given_weight")
    given = None
    for k in range(1, depth + 1):
        node = nodes[k].withColumn("budget", F.lit(float(total))) if given is None else nodes[k].join(given, keys[:k - 1])
        free = (F.col("weight") > 0) & (F.col("most") > 0)
        node = node.withColumns({"most": F.when(free, F.col("most")).otherwise(0.0), "weight": F.when(free, F.col("weight")).otherwise(0.0)})
        siblings = Window.partitionBy(*keys[:k - 1]) if k > 1 else Window.partitionBy(F.lit(0))
        order = siblings.orderBy(F.col("ratio").asc_nulls_first(), keys[k - 1])
        node = node.withColumn("ratio", F.try_divide("most", "weight"))
        node = node.withColumns({
            "left": F.least("budget", F.sum("most").over(siblings)),
            "before": F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("most"),
            "rest": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))})
        node = node.withColumn("full", (F.col("weight") > 0) & ((F.col("left") - F.col("before")) * F.col("weight") >= F.col("most") * F.col("rest")))
        filled = F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(siblings)
        open_ = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(siblings)
        node = node.withColumns({"filled": filled, "open": open_})
        share = F.when(F.col("full"), F.col("most")).otherwise(
            F.coalesce(F.try_divide((F.col("left") - F.col("filled")) * F.col("weight"), "open"), F.lit(0.0)))
        node = node.withColumn("budget", F.greatest(share, F.lit(0.0)))
        given = node.select(*keys[:k], "budget", *(["n", "rows"] if k == depth else []))
    return given.withColumn("budget", F.floor(F.col("budget") + 1e-6).cast("bigint"))


def _reads(docs: DataFrame, levels: Mapping[str, Column], fraction: float | None = None, total: int | None = None,
           weights: Mapping[tuple[str, ...], float] | DataFrame | None = None, alpha: float = 1.0, max_epochs: int = 4,
           seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``mix_sources`` reads, with levels as ``level0`` ... and ``tie``, a hash of the text."""
    spark = docs.sparkSession
    if (fraction is None) == (total is None):
        raise ValueError("give either a fraction or a total")
    names = list(levels)
    keys = [f"level{i}" for i in range(len(names))]
    kind = docs.schema[id_col].dataType.simpleString()
    rows = written(docs.select(
        F.col(id_col).alias("id"), *[F.coalesce(levels[n].cast("string"), F.lit(NONE)).alias(k) for n, k in zip(names, keys)],
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"\S+")), F.lit(0)).cast("bigint").alias("n_tokens"),
        F.xxhash64(F.col(text_col)).alias("tie")), "mixing")
    leaves = written(rows.groupBy(*keys).agg(F.sum("n_tokens").alias("n"), F.count("*").alias("rows")), "leaves")
    total = int(fraction * (leaves.agg(F.sum("n")).first()[0] or 0)) if total is None else total
    budget = budget_table(leaves, len(keys), total, max_epochs, weight_table(spark, weights, names), alpha)
    # a leaf's epoch is cut into buckets of its order: as many bits of a place as give BUCKET_DOCS rows or so
    bits = F.greatest(F.lit(0), F.least(F.lit(40), F.ceil(F.log2(F.col("rows") / BUCKET_DOCS)))).cast("int")
    plan = written(budget.filter("budget > 0 AND n > 0").select(
        *keys, F.floor(F.col("budget") / F.col("n")).alias("whole"), (F.col("budget") % F.col("n")).alias("part"), bits.alias("bits")), "budgets")
    placed = rows.join(plan, keys).withColumn("place", epoch_order(seed, "whole", "id", "tie"))
    placed = placed.withColumn("bucket", F.expr("shiftright(place, 63 - bits)"))

    # the bucket of the order in which a leaf's budget ends: sums by bucket first, single documents only there
    sums = placed.filter("part > 0").groupBy(*keys, "part", "bucket").agg(F.sum("n_tokens").alias("n"))
    running = F.sum("n").over(Window.partitionBy(*keys).orderBy("bucket")) - F.col("n")
    last = sums.withColumn("before", running).filter("before < part").groupBy(*keys).agg(
        F.max("bucket").alias("last"), F.max("before").alias("before"))
    last = written(last, "last")
    ended = placed.filter("part > 0").join(last, keys)
    inner = ended.filter("bucket < last")
    # rows that are alike share a place, so they are counted, not listed
    alike = ended.filter("bucket = last").groupBy(*keys, "whole", "part", "before", "place", "id", "tie", "n_tokens").agg(F.count("*").alias("copies"))
    begin = F.col("before") - F.col("copies") * F.col("n_tokens") + F.sum(F.col("copies") * F.col("n_tokens")).over(
        Window.partitionBy(*keys).orderBy("place", "id", "tie").rowsBetween(Window.unboundedPreceding, 0))
    taken = F.when(F.col("n_tokens") == 0, F.col("copies")).otherwise(
        F.least("copies", F.ceil((F.col("part") - F.col("at")) / F.col("n_tokens"))))
    edge = alike.withColumn("at", begin).filter("at < part").withColumn("nth", F.explode(F.sequence(F.lit(1).cast("bigint"), taken.cast("bigint"))))
    columns = ["id", *keys, F.col("whole").alias("epoch"), "n_tokens", "tie"]
    partial = inner.select(*columns).unionByName(edge.select(*columns))
    again = placed.filter("whole > 0").select("id", *keys, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("whole") - 1)).alias("epoch"), "n_tokens", "tie")
    return again.unionByName(partial).withColumns({"id": F.col("id").cast(kind), "epoch": F.col("epoch").cast("int")})


def mix_sources(docs: DataFrame, levels: Mapping[str, Column], **options) -> DataFrame:
    """``(id, <levels>, epoch, n_tokens)``: each document as often as it is read.

    Options: ``fraction`` or ``total``, ``weights`` (of nodes: a mapping by path,
    or a table as :func:`weight_table` reads it), ``alpha`` (of weights not
    given), ``max_epochs``, ``seed``, ``id_col``, ``text_col``. ``total`` tokens (or ``fraction`` of those there are) are budgeted over the
    tree of ``levels``; a token is a run of other than white space. A leaf with
    budget B reads B // tokens whole epochs, then of one more epoch, in its
    order, every document that begins before the budget ends. Null levels are a
    value of their own, ``(none)``; null and empty texts have no tokens and come
    with whole epochs; rows with a null id, and repeated rows, count like any
    other (rows that are alike in all have one place, in any order). An empty
    table gives an empty result.
    """
    reads = _reads(docs, levels, **options)
    return reads.select("id", *[F.col(f"level{i}").alias(n) for i, n in enumerate(levels)], "epoch", "n_tokens")


def take_mix(docs: DataFrame, levels: Mapping[str, Column], id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, each as often as
    ``mix_sources`` reads it. Rows alike in id, levels and text count as one
    document that is read as often as all of them."""
    reads = _reads(docs, levels, id_col=id_col, text_col=text_col, **options)
    names = [f"level{i}" for i in range(len(levels))]
    own = fresh(docs, *[f"__{n}" for n in names], "__tie")
    read_id, *read_keys, count, nth = fresh(docs, *own, "__read_id", *[f"__read_{n}" for n in names], "__read_tie", "__times", "__nth")[len(own):]
    times = reads.groupBy("id", *names, "tie").agg(F.count("*").alias("times")).toDF(read_id, *read_keys, count)
    times = written(times, "reads")
    values = [*[F.coalesce(c.cast("string"), F.lit(NONE)) for c in levels.values()], F.xxhash64(F.col(text_col))]
    marked = docs.withColumns(dict(zip(own, values))).dropDuplicates([id_col, *own])
    same = F.col(id_col).eqNullSafe(F.col(read_id))
    for mine, read in zip(own, read_keys):
        same &= F.col(mine) == F.col(read)
    # merged, not broadcast: a twentieth of the table's size in memory is what its file has
    joined = marked.join(times.hint("merge"), same).withColumn(nth, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(count))))
    return joined.select(*columns_of(docs))
