"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecall.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of every node on its smallest neighbour; the minimum is a partial aggregate joined back."""
    if large:
        sides = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sides.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("_a"), F.least("a", "m").alias("m"))
        joined = sides.join(least, F.col("a") == F.col("_a"))
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("_a"), "m")
        joined = down.join(least, F.col("a") == F.col("_a"))
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("_a").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """node, component (its smallest node) of every node of the edges (a, b); a node without edges is not listed."""
    edges = staged(edges.select("a", "b").filter("a <> b").distinct(), f"{name}-edges")
    state = None
    for i in range(rounds):
        edges = staged(_star(_star(edges, True), False), f"{name}-round{i}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.max("a")).first()
        if state == now:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
