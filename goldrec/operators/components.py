"""Connected components of a table of links.

Every round points each node at the smallest node it knows of, its own
neighbours' and theirs (alternating stars), so the number of rounds grows with
the logarithm of the longest chain.  A round is two aggregations that combine
before the shuffle and two equi-joins; it is checkpointed into the shared folder
(``spark.checkpoint.dir``), and one row of sums a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.session import ensure_checkpoint_dir


def _sums(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("big", "small")), F.sum(F.pmod(F.xxhash64("small", "big"), F.lit(1 << 40)))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (columns a, b; any order, loops and repeats allowed); the root is the smallest node.

    A node that is linked with nothing but itself does not appear; no links give an empty table.
    """
    ensure_checkpoint_dir(links.sparkSession)
    links = links.where("a <> b").select(F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small")).distinct().checkpoint()
    state = _sums(links)
    while state[0]:
        # larger neighbours are linked to the smallest one known
        both = links.unionByName(links.select(F.col("small").alias("big"), F.col("big").alias("small")))
        least = both.groupBy("big").agg(F.least(F.min("small"), F.first("big")).alias("least"))
        links = both.join(least, "big").where("small > big").select(F.col("small").alias("big"), F.col("least").alias("small")).distinct().checkpoint()
        # a node's smaller neighbours, and itself, to the smallest of them
        least = links.groupBy("big").agg(F.min("small").alias("least"))
        moved = links.join(least, "big").where("small <> least").select(F.col("small").alias("big"), F.col("least").alias("small"))
        links = moved.unionByName(least.select("big", F.col("least").alias("small"))).distinct().checkpoint()
        before, state = state, _sums(links)
        if state == before:
            break
    nodes = links.select(F.col("big").alias("node"), F.col("small").alias("root"))
    return nodes.unionByName(links.select(F.col("small").alias("node"), F.col("small").alias("root")).distinct())
