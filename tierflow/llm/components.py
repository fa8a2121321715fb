"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.runtime import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``(node, root)``: every linked node with the smallest
    node that it can reach. Self links and repeats are ignored, null ends too;
    no links: no rows.

    Each round joins nodes with their smallest neighbour and hangs neighbours
    on it (large star, then small star), until nothing changes. All tables are
    written to the shared folder, so a round reads two plain Parquet tables:
    Spark may split a hub's rows, and a lost executor costs one stage.
    """
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = written(ordered.filter("a <> b").distinct(), "links")
    state = _state(edges)
    while True:
        # large star: larger neighbours of a node go to its smallest neighbour
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("low")), "low")
        large = written(both.filter("b > a").join(low, "a").filter("b <> low")
                        .select(F.col("low").alias("a"), "b").distinct(), "large")
        # small star: a node and its smaller neighbours go to the smallest one
        low = written(large.groupBy("b").agg(F.min("a").alias("low")), "low")
        hung = large.join(low, "b").filter("a <> low").select(F.col("low").alias("a"), F.col("a").alias("b"))
        edges = written(hung.unionByName(low.select(F.col("low").alias("a"), "b")).distinct(), "links")
        now = _state(edges)
        if now == state:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        state = now
