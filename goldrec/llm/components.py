"""Connected components of a distributed edge list (alternating large and small stars).

Each round replaces every edge by edges to the smallest known neighbour.  Only
``groupBy(..).min`` (combined before the shuffle) and equi-joins that Spark may
split are used; each round is written to the shared folder, so lineage stays
short and a lost executor costs one round.  Nothing is gathered on the driver
but one row of counts per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; any order, repeats and loops allowed).

    ``root`` is the component's smallest node.  Nodes without edges do not
    appear; an empty edge list gives an empty table.
    """
    edges = scratch.save(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select("v", "u"))
        low = scratch.save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.save(large.distinct(), "large")
        low = scratch.save(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = scratch.save(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "small")
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
