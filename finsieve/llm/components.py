"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from finsieve.session import stage


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges``(a, b); root is the smallest node reachable.

    ``a`` and ``b`` share one orderable type. Every round is written to the shared folder,
    so a lost executor costs a re-read. Minima are aggregated before they are joined back,
    so a node with very many edges is split like any skewed join side.
    """
    edges = stage(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lows = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.join(lows, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a != b").distinct()
        )
        large = stage(large, "large_star")
        lows = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(lows, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").unionByName(
            lows.select("a", F.col("m").alias("b"))
        ).distinct()
        edges, before = stage(small, "small_star"), mark
        mark = _mark(edges)
        if mark == before:
            break
    # A star per component: every node but the root points at the root.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
