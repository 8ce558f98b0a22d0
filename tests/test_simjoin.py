"""Similar pairs of blocks against brute force, with chunks far smaller than the blocks."""

import random

import pytest

from goldrec.functions.similarity import _ratio_py
from goldrec.operators.resolve import match_fallback
from goldrec.operators.simjoin import similar_pairs
from goldrec.schemas import fields_struct


@pytest.mark.parametrize("cutoff", [75, 80])
def test_all_pairs_found(spark, cutoff):
    rnd = random.Random(cutoff)
    words = ["".join(rnd.choice("aabbcdeeio xy") for _ in range(rnd.randint(0, 14))) for _ in range(160)]
    left = [(str(b), w) for b in range(4) for w in set(words[b * 40 : (b + 1) * 40])]
    right = sorted({(b, w + "s" * (i % 3 == 0)) for i, (b, w) in enumerate(left)} | {(b, w[::-1]) for b, w in left} | {("only right", "x")})
    want = {(b, x, y, _ratio_py(x, y)) for b, x in left for c, y in right if b == c and _ratio_py(x, y) >= cutoff}
    ldf, rdf = spark.createDataFrame(left * 2, "blk string, a string"), spark.createDataFrame(right, "blk string, b string")
    for chunk in (7, 1024):
        got = [tuple(r) for r in similar_pairs(ldf, rdf, ["blk"], "a", "b", cutoff, chunk).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_hot_phone(spark):
    """Thousands of names at one phone: every one finds its best match, ties to the smallest key."""
    from pyspark.sql import functions as F

    n = 1500
    ids = spark.range(n)
    name = F.concat(F.lit("Person "), F.translate(F.lpad(F.col("id").cast("string"), 4, "0"), "0123456789", "abcdefghij"), F.lit(" Of Town"))
    known = ids.select(F.concat(F.lit("k"), "id").alias("record_id"), F.concat(F.lit("m"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("entity_key"),
                       fields_struct(full_name=name, phones=F.array(F.lit("+1 415 555 2671"))).alias("fields"))
    probes = ids.where("id % 3 = 0").select(F.concat(F.lit("p"), "id").alias("record_id"), F.lit(None).cast("string").alias("entity_key"),
                                            fields_struct(full_name=F.lower(name), phones=F.array(F.lit("415 555 2671"))).alias("fields"))
    got = {r.record_id: r.entity_key for r in match_fallback(known.unionByName(probes)).where("record_id like 'p%'").collect()}
    assert got == {f"p{i}": f"m{i:04d}" for i in range(0, n, 3)}
