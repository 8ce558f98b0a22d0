"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits in two segments of 32.  Two fingerprints that differ
in at most 3 bits differ in at most one bit in one of the segments, so each
fingerprint probes the Hamming ball of radius 1 (33 keys) of both segments
against a table of the segments themselves, and every match is verified by its
whole distance.  No link is lost and no bucket is capped.  Equal fingerprints
are one row of the tables, and a fingerprint has a bounded number of
neighbours, so a group of copies of any size costs one row.

Defined results: a null or empty text has fingerprint zero and links like any
other; repeated rows keep their number; a null doc_id is never the smallest
(its component is named by the others, or null if there is none); columns other
than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import Scratch, lean, release, ship
from goldrec.llm.components import connected_components

SHINGLE = 3
BITS = 3
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of one text; whole text, repeats counted."""
    import numpy as np
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    k = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: len(words) - k] + 1).tolist()]
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist())]
    ones, step = np.zeros(64, np.int64), 1 << 16
    for at in range(0, len(hashes), step):  # long texts in parts: memory stays bounded
        part = np.array(hashes[at : at + step], ">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, tkey, fp) for every row; tkey is a hash of the text."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            out = [fingerprint(t.as_py(), shingle) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.int64())], names=["doc_id", "tkey", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), F.col("text").cast("string"))
    return rows.mapInArrow(lean(run), "doc_id long, tkey long, fp long")


def links(fps: DataFrame, max_bits: int = BITS) -> DataFrame:
    """Pairs (a < b) of different fingerprints within ``max_bits`` (at most 3) bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments probed with radius 1 find distances up to 3")
    segments = F.array(
        F.struct(F.lit(0).alias("seg"), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("key")),
        F.struct(F.lit(1).alias("seg"), F.shiftrightunsigned("fp", 32).alias("key")),
    )
    base = fps.select("fp", F.explode(segments).alias("s")).select("s.seg", "s.key", F.col("fp").alias("b"))
    ball = F.array(*[F.lit(0).cast("long")], *[F.lit(1 << j).cast("long") for j in range(32)])
    probes = fps.select("fp", F.explode(segments).alias("s"))
    probes = probes.select("s.seg", F.explode(F.transform(ball, lambda m: m.bitwiseXOR(F.col("s.key")))).alias("key"), F.col("fp").alias("a"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    # by sort and merge: Spark sizes the exploded sides by the table before and would broadcast them
    return probes.join(base.hint("merge"), ["seg", "key"]).where(near).select("a", "b")


def _rooted(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """(doc_id, tkey, fp, root, component_id) for every row; root is one fingerprint of the component."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    prints = scratch.save(fingerprints(docs, shingle), "fingerprints")
    classes = scratch.save(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    edges = scratch.save(links(classes.select("fp"), max_bits), "links")
    release(spark)
    roots = scratch.save(connected_components(edges, scratch), "roots")
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = scratch.save(named, "named")
    firsts = named.groupBy("root").agg(F.min("first").alias("component_id"))
    names = scratch.save(named.join(firsts, "root").select("fp", "root", "component_id"), "names")
    release(spark)
    return prints.join(names, "fp").select("doc_id", "tkey", "fp", "root", "component_id")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = BITS) -> DataFrame:
    """(doc_id, tkey, fp, component_id) for every row; component_id is the smallest doc_id reachable by links."""
    return _rooted(docs, shingle, max_bits).drop("root")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = BITS) -> DataFrame:
    """``docs`` with one row of each component: the first by doc_id (nulls last), hash of the text and whole row."""
    found = _rooted(docs.select("doc_id", "text"), shingle, max_bits).groupBy("root", "doc_id", "tkey").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tkey", "n")
    first = found.groupBy("root").agg(F.min(order).alias("first")).select("first.*")
    first = Scratch(docs.sparkSession).save(first.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).alias("id"), "tkey", "n"), "first")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("-")).alias("id"), F.xxhash64("text").alias("tkey"))
    rows = rows.join(first, ["id", "tkey"])
    repeated = rows.where("n > 1").groupBy("id", "tkey").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return rows.where("n = 1").select("row.*").unionByName(repeated.select("row.*"))


ship(__name__)
