"""Connected components of a distributed link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import materialize


def _least(links: DataFrame) -> DataFrame:
    """Each node with the least of itself and its neighbours; ``links`` holds (u, v)."""
    return links.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (columns u, v; ids that order).

    A component's id is its least node. Alternating star contraction: every node hands its
    larger neighbours, then its smaller ones, to the least node it sees, until nothing
    changes; the number of rounds grows with the logarithm of the largest component. Minima
    are partial aggregates, so the centre of a star is not one task, and each round is
    checkpointed in the shared folder.
    """
    edges = materialize(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_least(both.select("u", "v")), "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        small = large.join(_least(large), "u")
        edges = materialize(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .union(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
