"""Exact Indel-ratio joins inside blocks, without emitting a block's pairs.

Both sides hold distinct strings per block.  A side of a block is cut to
chunks of CHUNK strings; every pair of chunks is a unit of work of its own, so
a block of any size spreads over tasks and nothing is capped.  Inside a unit
the bound that follows from lengths and common characters rejects most pairs
in one matrix operation, the rest are measured exactly, and only pairs that
reach the cutoff leave the task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.functions.similarity import _lcs_bits

CHUNK = 1024


def _candidates(left: list[str], right: list[str], cutoff: float) -> tuple:
    """The sorted-token forms, and the places of the pairs that lengths and common characters leave."""
    import numpy as np

    a = [" ".join(sorted(s.split())) for s in left]
    b = [" ".join(sorted(s.split())) for s in right]
    letters = {c: i for i, c in enumerate(sorted(set("".join(a)) | set("".join(b))))}

    def counts(texts: list[str]):
        out = np.zeros((len(texts), len(letters)), np.int32)
        for i, t in enumerate(texts):
            for c in t:
                out[i, letters[c]] += 1
        return out

    ca, cb = counts(a), counts(b)
    total = ca.sum(axis=1)[:, None] + cb.sum(axis=1)[None, :]
    common = np.zeros(total.shape, np.int32)
    for k in range(len(letters)):  # letter by letter: memory stays at a unit's pairs
        common += np.minimum(ca[:, k][:, None], cb[:, k][None, :])
    return a, b, zip(*(x.tolist() for x in np.nonzero(200 * common >= cutoff * total - 1e-9)))


def _ratio(a: str, b: str) -> float:
    """The same operations as the ratio of functions.similarity, of sorted forms."""
    n = len(a) + len(b)
    return 100.0 if not n else 100.0 * (1.0 - (n - 2 * _lcs_bits(a, b)) / n)


def _measure(left: list[str], right: list[str], cutoff: float) -> list[tuple[str, str, float]]:
    """Pairs whose token-sort Indel ratio reaches ``cutoff``."""
    if not left or not right:
        return []
    a, b, pairs = _candidates(left, right, cutoff)
    found = ((left[i], right[j], _ratio(a[i], b[j])) for i, j in pairs)
    return [f for f in found if f[2] >= cutoff]


def _forest(left: list[str], right: list[str], cutoff: float) -> list[tuple[str, str, float]]:
    """Of those pairs a spanning forest: strings that are connected already are not measured again."""
    if not left or not right:
        return []
    parent: dict[str, str] = {}

    def root(x: str) -> str:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    a, b, pairs = _candidates(left, right, cutoff)
    out = []
    for i, j in pairs:
        u, w = root(left[i]), root(right[j])
        if u != w and (ratio := _ratio(a[i], b[j])) >= cutoff:
            parent[max(u, w)] = min(u, w)
            out.append((left[i], right[j], ratio))
    return out


def _units(block: list[str], cutoff: float, measure=_measure):
    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        names = [*block, "l", "r", "ratio"]

        def measured(key: tuple, rows: list) -> list:
            found = measure([t for side, t in rows if not side], [t for side, t in rows if side], cutoff)
            return [(*key[: len(block)], *f) for f in found]

        key, rows = None, []
        for pdf in batches:
            out = []
            for *unit, side, text in zip(*(pdf[c] for c in [*block, "i", "j", "side", "text"])):
                if tuple(unit) != key:
                    if rows:
                        out += measured(key, rows)
                    key, rows = tuple(unit), []
                rows.append((side, text))
            yield pd.DataFrame(out, columns=names)
        if rows:
            yield pd.DataFrame(measured(key, rows), columns=names)

    return run


def similar_pairs(left: DataFrame, right: DataFrame, block: list[str], ltext: str, rtext: str, cutoff: float, chunk: int = CHUNK) -> DataFrame:
    """(block..., ltext, rtext, ratio) of all pairs of a block that reach ``cutoff``.

    ``block`` columns are strings without nulls; rows are made distinct here.
    """
    left = left.select(*block, F.col(ltext).alias("text")).distinct()
    right = right.select(*block, F.col(rtext).alias("text")).distinct()
    sizes = left.select(*block, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(*block, F.lit(0).alias("l"), F.lit(1).alias("r")))
    sizes = sizes.groupBy(*block).agg(F.ceil(F.sum("l") / chunk).cast("int").alias("nl"), F.ceil(F.sum("r") / chunk).cast("int").alias("nr"))
    sizes = sizes.where("nl > 0 and nr > 0")

    def dealt(df: DataFrame, mine: str, other: str, own: str, theirs: str, side: int) -> DataFrame:
        df = df.join(sizes, block).withColumn(own, F.pmod(F.xxhash64("text"), F.col(mine)).cast("int"))
        df = df.withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return df.select(*block, "i", "j", F.lit(side).alias("side"), "text")

    unit = [*block, "i", "j"]
    rows = dealt(left, "nl", "nr", "i", "j", 0).unionByName(dealt(right, "nr", "nl", "j", "i", 1))
    rows = rows.repartition(*unit).sortWithinPartitions(*unit)
    schema = ", ".join(f"{c} string" for c in block) + ", l string, r string, ratio double"
    return rows.mapInPandas(_units(block, cutoff), schema).withColumnsRenamed({"l": ltext, "r": rtext})


def similar_links(names: DataFrame, block: list[str], text: str, cutoff: float, chunk: int = CHUNK) -> DataFrame:
    """(block..., l, r, ratio): links enough to connect what pairs that reach ``cutoff`` connect, inside each block.

    A unit returns a forest, at most one link a string, so a block of alike
    strings does not return its pairs.  ``block`` columns are strings without nulls.
    """
    names = names.select(*block, F.col(text).alias("text")).distinct()
    sizes = names.groupBy(*block).agg(F.count("*").alias("n")).where("n > 1").select(*block, F.ceil(F.col("n") / chunk).cast("int").alias("n"))
    dealt = names.join(sizes, block).withColumn("own", F.pmod(F.xxhash64("text"), F.col("n")).cast("int"))
    left = dealt.select(*block, F.col("own").alias("i"), F.explode(F.sequence("own", F.col("n") - 1)).alias("j"), F.lit(0).alias("side"), "text")
    right = dealt.select(*block, F.explode(F.sequence(F.lit(0), F.col("own"))).alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"), "text")
    unit = [*block, "i", "j"]
    rows = left.unionByName(right).repartition(*unit).sortWithinPartitions(*unit)
    schema = ", ".join(f"{c} string" for c in block) + ", l string, r string, ratio double"
    return rows.mapInPandas(_units(block, cutoff, _forest), schema)


# by value: workers need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
