"""Embedding near-duplicates by randomised-rotation binary codes.

Unit vectors are turned by random rotations; the signs are the binary code, and
with it is stored how much of the vector the code holds (the correction factor
<code, vector>).  <code, other vector> / factor is an unbiased estimate of the
cosine; its error is below EPSILON deviations for all but a vanishing share of
pairs.  Pairs whose upper bound misses the threshold are out; all others are
recomputed exactly in double precision, and only those link.

Pairs meet in buckets: bits of the codes are cut to ``tables`` keys, as many
as leave a pair at the threshold unmet with probability MISS (closer pairs meet
more surely).  Equal vectors are one row with a count.  A bucket beyond BLOCK
rows is cut to chunks whose pairs are units of work of their own, so no bucket
is capped and none lands in one task.  Units return counts per vector and the
edges of a spanning forest, never their pairs.

Defined results: vectors that are null, zero or hold null or non-finite
components, and rows with a null label, link with nothing and stand alone;
vectors of unlike length do not link; a row with null vec_id counts for others
but names no component; an empty table gives an empty result; other columns do
not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import Scratch, lean, release, ship
from goldrec.llm.components import connected_components

THRESHOLD = 0.93
MISS = 1e-4  # share of pairs at the threshold that meet in no table
BUCKET = 512  # rows aimed at in a bucket
BLOCK = 1024  # rows of a chunk
EPSILON = 4.5
SEED = 20


def plan_tables(rows: int, threshold: float) -> tuple[int, int]:
    """(bits of a key, number of tables) for so many vectors."""
    bits = max(4, math.ceil(math.log2(max(rows, 2) / BUCKET)))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISS) / math.log1p(-meet)))


def _rotations(dim: int, count: int):
    import numpy as np

    rng = np.random.default_rng([SEED, dim])
    return np.concatenate([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(count)])  # (count * dim, dim)


def _units(vectors):
    """Rows scaled to length one, in double precision."""
    import numpy as np

    m = np.stack(vectors).astype(np.float64)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _encode(bits: int, tables: int):
    """(cid, v) -> keys of the tables, code, correction factor."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        known: dict = {}
        for pdf in batches:
            for dim, part in pdf.groupby(pdf.v.map(len)):
                if dim not in known:
                    known[dim] = _rotations(dim, math.ceil(bits * tables / dim))
                turned = _units(part.v.tolist()) @ known[dim].T
                signs = turned > 0
                weights = 1 << np.arange(bits)
                keys = signs[:, : bits * tables].reshape(len(part), tables, bits) @ weights
                factor = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
                yield pd.DataFrame(
                    {
                        "cid": part.cid.to_numpy(),
                        "keys": list(keys.astype(np.int32)),
                        "code": [x.tobytes() for x in np.packbits(signs, axis=1)],
                        "factor": factor / np.sqrt(turned.shape[1] / dim),
                    }
                )

    return run


def _link(threshold: float, bits: int, tables: int):
    """Rows of units (ordered by unit) -> (cid, links, to): new links of each vector, an edge of the unit's forest."""

    def unit(rows, out: list) -> None:
        import numpy as np

        if len(rows) < 2:
            return
        left, right = rows, rows
        if rows.i.iloc[0] != rows.j.iloc[0]:
            left, right = rows[rows.chunk == rows.i], rows[rows.chunk == rows.j]
            if not len(left) or not len(right):
                return
        x, y = _units(left.v.tolist()), _units(right.v.tolist())
        dim = x.shape[1]
        turns = _rotations(dim, math.ceil(bits * tables / dim))
        n = len(turns)
        signs = np.unpackbits(np.stack([np.frombuffer(c, np.uint8) for c in left.code]), axis=1)[:, :n] * 2.0 - 1.0
        factor = left.factor.to_numpy()[:, None]
        # mean of the rotations' estimates <code, y> / <code, x>
        estimate = (signs / math.sqrt(dim) @ turns) @ y.T / (factor * (n // dim))
        spread = np.sqrt(np.maximum(0, 1 - factor**2)) / factor / math.sqrt(max(1, dim - 1)) / math.sqrt(n // dim)
        a, b = np.nonzero(estimate + EPSILON * spread >= threshold)
        if left is right:
            a, b = a[a < b], b[a < b]
        linked = np.einsum("ij,ij->i", x[a], y[b]) >= threshold
        a, b = a[linked], b[linked]
        if not len(a):
            return
        t = int(rows.tbl.iloc[0])
        kx, ky = np.stack(left["keys"].tolist())[:, :t], np.stack(right["keys"].tolist())[:, :t]
        new = ~(kx[a] == ky[b]).any(axis=1) if t else np.ones(len(a), bool)
        ids, others = left.cid.to_numpy(), right.cid.to_numpy()
        for mine, theirs, at, to in ((left, right, a, b), (right, left, b, a)):
            add = np.zeros(len(mine), np.int64)
            np.add.at(add, at[new], theirs.copies.to_numpy()[to[new]])
            some = np.flatnonzero(add)
            out += [(int(c), int(k), int(c)) for c, k in zip(mine.cid.to_numpy()[some], add[some])]
        parent: dict = {}

        def root(z):
            while parent.setdefault(z, z) != z:
                parent[z] = z = parent[parent[z]]
            return z

        for u, w in zip(ids[a].tolist(), others[b].tolist()):
            u, w = root(u), root(w)
            if u != w:
                parent[max(u, w)] = min(u, w)
        out += [(z, 0, root(z)) for z in list(parent) if root(z) != z]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        held = None
        key = ["grp", "tbl", "key", "i", "j"]
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            k = pdf[key].to_numpy()
            cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
            edges, out = [0, *cuts.tolist()], []
            for s, e in zip(edges, edges[1:]):
                unit(pdf.iloc[s:e], out)
            held = pdf.iloc[edges[-1] :]
            yield pd.DataFrame(out, columns=["cid", "links", "to"])
        if held is not None and len(held):
            out = []
            unit(held, out)
            yield pd.DataFrame(out, columns=["cid", "links", "to"])

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    wide = F.col("embedding").cast("array<double>")
    fit = F.col("label").isNotNull() & ~F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(wide, lambda x: x != 0)
    vector = F.when(fit, F.transform("embedding", lambda x: x + F.lit(0).cast(vectors.schema["embedding"].dataType.elementType)))  # -0 is 0
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", vector.alias("v"))
    names = [F.xxhash64("label", F.size("v"), "v").alias("k1"), F.xxhash64(F.lit(7), "v", "label").alias("k2")]
    rows = rows.select("vec_id", "label", "v", *names)
    classes = rows.where("v is not null").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("v").alias("v"), F.first("label").alias("label")
    )
    classes = classes.select(F.monotonically_increasing_id().alias("cid"), "k1", "k2", "first", "copies", "v", F.xxhash64("label", F.size("v")).alias("grp"))
    classes = scratch.save(classes, "classes")
    bits, tables = plan_tables(classes.count(), threshold)
    codes = classes.select("cid", "v").mapInPandas(lean(_encode(bits, tables)), "cid long, keys array<int>, code binary, factor double")
    coded = scratch.save(classes.select("cid", "grp", "copies", "v").join(codes, "cid"), "coded")

    sizes = coded.select("grp", F.posexplode("keys").alias("tbl", "key")).groupBy("grp", "tbl", "key").agg(F.count("*").alias("n")).where("n > 1")
    sizes = scratch.save(sizes.select("grp", "tbl", "key", F.ceil(F.col("n") / block).cast("int").alias("chunks")), "sizes")
    met = coded.select("*", F.posexplode("keys").alias("tbl", "key")).join(sizes.hint("merge"), ["grp", "tbl", "key"])
    met = met.withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = met.select(
        "grp", "tbl", "key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "cid", "copies", "v", "keys", "code", "factor"
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unit = ["grp", "tbl", "key", "i", "j"]
    met = met.repartition(parts, *unit).sortWithinPartitions(*unit)
    found = scratch.save(met.mapInPandas(lean(_link(threshold, bits, tables)), "cid long, links long, to long"), "found")
    release(spark)

    roots = connected_components(found.where("cid <> to").select(F.col("cid").alias("a"), F.col("to").alias("b")), scratch)
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    known = classes.select("cid", "k1", "k2", "first", "copies").join(links, "cid", "left").join(scratch.save(roots.withColumnRenamed("node", "cid"), "roots"), "cid", "left")
    known = scratch.save(known.withColumn("root", F.coalesce("root", "cid")), "known")
    firsts = known.groupBy("root").agg(F.min("first").alias("component_id"))
    links = (F.coalesce("links", F.lit(0).cast("long")) + F.col("copies") - 1).alias("n_links")
    known = scratch.save(known.join(firsts, "root").select("k1", "k2", links, "component_id", F.lit(True).alias("fit")), "answers")
    out = rows.select("vec_id", "k1", "k2", F.col("v").isNotNull().alias("fit")).join(known, ["k1", "k2", "fit"], "left")
    component = F.when(F.col("fit"), F.col("component_id")).otherwise(F.col("vec_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


ship(__name__)
