"""Exact top-k search by distributed histogram selection.

Queries and candidates are cut to blocks; every pair of blocks is one unit of
work that scores itself with one matrix product.  A first pass counts scores in
wide buckets per query; the summed counts show the bucket of each query's k-th
score, which the next pass splits 64-fold, until the k-th score itself is
known.  A last pass keeps the scores above it and, of those equal to it, the
smallest ids.  No pass holds more than two blocks, and only counts and the
winners are shuffled.

A block leaves out buckets below its own k-th score: the whole table's k-th
score cannot be lower.

Defined results: vectors that are null or hold null or non-finite components
take no part, neither do rows with a null id; vectors of unlike length are not
compared; a query with fewer than k candidates gets all; rows that repeat an id
are candidates of their own, but never of a query with their id; scores beyond
a long count as the largest or smallest long but one; query rows that
repeat an id are all searched, and the k best of what they find together are the
id's; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldrec.llm.common import Scratch, ship

K = 20
SCALE = 64
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
FANOUT = 64
BOUND = (1 << 63) - 1  # of a score: a long holds no more


def usable(vector: Column) -> Column:
    """The vector in double precision, or null if a component is null or not finite."""
    d = vector.cast("array<double>")
    fine = ~F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(fine, d)


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(id, len, v): floor(scale * x) of every component of the vectors that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), usable(F.col("embedding")).alias("d")).where("id is not null and d is not null")
    return rows.select("id", F.size("d").alias("len"), F.transform("d", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def _blocks(rows: int, size: int) -> int:
    return max(1, math.ceil(rows / size))


def _scores(q, c):
    """Integer scores, queries by candidates: in doubles where these hold every sum, else in whole numbers, held to +-BOUND."""
    import numpy as np

    if not len(q) or not len(c):
        return np.zeros((len(q), len(c)), np.int64)
    qm, cm = np.stack(q.v.tolist()).reshape(len(q), -1), np.stack(c.v.tolist()).reshape(len(c), -1)
    most = np.abs(qm.astype(np.float64)).max(initial=0) * np.abs(cm.astype(np.float64)).max(initial=0) * qm.shape[1]
    if most < 2**52:
        return (qm.astype(np.float64) @ cm.astype(np.float64).T).astype(np.int64)
    return np.clip(qm.astype(object) @ cm.astype(object).T, -BOUND, BOUND).astype(np.int64)


def _histogram(width: int, k: int):
    """Counts by query row and bucket of ``width``; with a bucket known (column wide), only inside it."""

    def run(q, c):
        import numpy as np
        import pandas as pd

        scores, out = _scores(q, c), []
        ids = c.id.to_numpy()
        for i, (key, qid, lo, hi) in enumerate(zip(q.key, q.id, q.lo, q.hi)):
            mine = scores[i][ids != qid]
            if len(mine) > k:  # no lower than the k-th here
                kth = np.partition(mine, len(mine) - k)[len(mine) - k]
                mine = mine[mine >= (kth // width) * width]
            mine = mine[(mine >= lo) & (mine <= hi)]
            buckets, counts = np.unique(mine // width, return_counts=True)
            out += [(key, int(b), int(n)) for b, n in zip(buckets, counts)]
        return pd.DataFrame(out, columns=["key", "bucket", "n"])

    return run


def _winners(k: int):
    """Candidates above the k-th score, and of those equal to it the ``ties`` smallest ids."""

    def run(q, c):
        import numpy as np
        import pandas as pd

        scores, out = _scores(q, c), []
        ids = c.id.to_numpy()
        for i, (qid, kth, ties) in enumerate(zip(q.id, q.kth, q.ties)):
            other = ids != qid
            above = np.flatnonzero(other & (scores[i] > kth))
            equal = np.flatnonzero(other & (scores[i] == kth))
            equal = equal[np.argsort(ids[equal], kind="stable")][:ties]
            out += [(qid, int(ids[j]), int(scores[i][j])) for j in (*above, *equal)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query id, over all its rows; both tables as ``scaled`` gives them."""
    spark = candidates.sparkSession
    scratch = Scratch(spark)
    queries, candidates = scratch.save(queries.withColumn("key", F.monotonically_increasing_id()), "queries"), scratch.save(candidates, "candidates")
    length = F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    n_q, most_q = queries.agg(F.count("*"), length).first()
    n_c, most_c = candidates.agg(F.count("*"), length).first()
    g, h = _blocks(n_q, query_block), _blocks(n_c, candidate_block)
    bound = min(BOUND, int(math.sqrt(most_q or 0) * math.sqrt(most_c or 0) * 1.0001) + 2)  # Cauchy-Schwarz
    levels = max(1, math.ceil(math.log(2 * bound, FANOUT)))

    # equal blocks whatever the ids are: dealt by a hash of id and vector, and of a query's row
    spread = F.xxhash64("id", "v")
    c_blocks = candidates.select("id", "len", "v", F.pmod(spread, F.lit(h)).alias("cb"), F.explode(F.sequence(F.lit(0), F.lit(g - 1))).alias("qb"))
    c_blocks = c_blocks.withColumn("qb", F.col("qb").cast("long")).groupBy("len", "qb", "cb")

    def meet(with_state: DataFrame, run, schema: str) -> DataFrame:
        q = with_state.withColumn("qb", F.pmod(F.xxhash64("key"), F.lit(g))).withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(h - 1).cast("long"))))
        return q.groupBy("len", "qb", "cb").cogroup(c_blocks).applyInPandas(run, schema)

    state = queries.select("key", "id", "len", "v").withColumns({"lo": F.lit(-BOUND), "hi": F.lit(BOUND), "above": F.lit(0).cast("long"), "kth": F.lit(None).cast("long")})
    for level in range(levels - 1, -1, -1):
        width = FANOUT**level
        counts = meet(state, _histogram(width, k), "key long, bucket long, n long").groupBy("key", "bucket").agg(F.sum("n").alias("n"))
        so_far = F.sum("n").over(Window.partitionBy("key").orderBy(F.desc("bucket")))
        ranked = counts.withColumn("until", so_far).join(state.select("key", "above"), "key")
        last = ranked.groupBy("key").agg(
            F.max(F.when(F.col("above") + F.col("until") >= k, F.col("bucket"))).alias("at"),
            F.min("bucket").alias("least"),
            F.max_by(F.col("until") - F.col("n"), F.when(F.col("above") + F.col("until") >= k, F.col("bucket"))).alias("over"),
        )
        last = scratch.save(last, "last")
        # fewer than k candidates in all: everything from the lowest bucket on is wanted
        state = state.drop("kth").join(last, "key", "left")
        state = state.select(
            "key", "id", "len", "v",
            F.when(F.col("at").isNotNull(), F.col("at") * width).otherwise(F.col("lo")).alias("lo"),
            F.when(F.col("at").isNotNull(), F.col("at") * width + (width - 1)).otherwise(F.col("hi")).alias("hi"),
            (F.col("above") + F.coalesce("over", F.lit(0))).alias("above"),
            F.when(F.col("at").isNotNull(), F.col("at")).alias("kth"),
        )
        state = scratch.save(state, "state")
    final = state.withColumn("ties", F.when(F.col("kth").isNull(), 0).otherwise(k - F.col("above")))
    final = final.withColumn("kth", F.coalesce("kth", F.lit(-BOUND - 1)))
    found = meet(final, _winners(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scratch.save(found, "found").withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ship(__name__)
