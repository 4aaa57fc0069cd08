"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import map_batches, staged


def _contracted(edges: DataFrame) -> DataFrame:
    """Each batch's edges replaced by stars that connect the same nodes: at most as many, duplicates gone."""

    def stars(batch) -> dict:  # noqa: ANN001
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (p := root.setdefault(x, x)) != x:
                root[x] = x = root[p] if p in root else p
            return x

        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
        pairs = [(find(x), x) for x in list(root)]
        return {"u": [a for a, x in pairs if a != x], "v": [x for a, x in pairs if a != x]}

    return map_batches(edges, stars, "u long, v long")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: neighbours above (large) or up to a node (small) move to its least neighbour.

    The least neighbour comes from an aggregate and a join, not a window, and is
    written in between: so both sides of the join come straight from a shuffle, and
    the adaptive planner can split a hub's edges among tasks.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    joined = both.join(least, "u")
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("m").alias("u"), "v")
    else:
        moved = joined.select(F.col("m").alias("u"), "v").unionByName(least.select(F.col("m").alias("u"), F.col("u").alias("v")))
    return moved.where(F.col("u") != F.col("v")).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root): each node that has an edge to another, with the smallest node it reaches.

    Self-loops, repeated edges and edges with a null end count for nothing.
    """
    edges = edges.select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col("u") != F.col("v")))
    edges = staged(_contracted(edges).distinct(), "edges")
    before = None
    while True:
        edges = staged(_star(_star(edges, large=True), large=False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
        before = now
