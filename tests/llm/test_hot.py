"""Hot groups: one bucket, ties throughout, thousands of repeated rows, periodic texts."""

from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from goldrec.llm.substring import dedup_substrings
from goldrec.llm.topk import top_k
from goldrec.llm.vectors import near_vectors


def test_top_k_where_all_tie(spark):
    df = spark.range(4000).select("id", F.lit(2).alias("len"), F.array(F.lit(3).cast("long"), F.lit(-4).cast("long")).alias("v"))
    rows = top_k(df.where("id % 400 = 0"), df, k=20, query_block=4, candidate_block=256).collect()
    assert len(rows) == 10 * 20 and {r.score for r in rows} == {25}
    for q in range(0, 4000, 400):
        assert sorted(r.vec_id for r in rows if r.query_id == q) == [i for i in range(21) if i != q][:20]


def test_a_bucket_of_near_equal_vectors(spark):
    rng = np.random.default_rng(1)
    middle = rng.standard_normal(16)
    rows = [(i, (middle + rng.standard_normal(16) * 0.02).tolist(), 1) for i in range(1500)]
    rows += [(2000 + i, rng.standard_normal(16).tolist(), 1) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in near_vectors(df, block=128).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    links = (x @ x.T >= 0.93).sum(axis=1) - 1
    assert [got[r[0]].n_links for r in rows] == links.tolist()
    assert {got[i].component_id for i in range(1500)} == {0}


def test_ten_thousand_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text)] * 5000 + [(6, text)] * 5000 + [(1, "other words " + text)]
    got = dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    found = {(r.doc_id, r.n_words, r.n_removed, r["count"]) for r in got.groupBy("doc_id", "n_words", "n_removed").count().collect()}
    assert found == {(5, 40, 40, 5000), (6, 40, 40, 5000), (1, 42, 0, 1)}


def test_periodic_texts(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["a", "b", "c"] * rng.randint(400, 900))) for i in range(30)] + [(99, "a b c a b")]
    got = {r.doc_id: r for r in dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].n_removed == 0 and got[99].n_removed == 0
    assert all(got[i].n_removed == got[i].n_words and got[i].kept_sha256 == hashlib.sha256(b"").hexdigest() for i in range(1, 30))
