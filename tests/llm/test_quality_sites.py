"""Site posteriors of the quality classifier against a plain recomputation."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from goldrec.llm.common import Scratch
from goldrec.llm.quality import STRENGTH, classify, site_posteriors


def strength(groups):
    """groups: (variance of a row, parent's share, [(n, share)])."""
    found = room = 0.0
    for v, mean, kids in groups:
        n, n2, k = sum(m for m, _ in kids), sum(m * m for m, _ in kids), len(kids)
        found += sum(m * (s - mean) ** 2 for m, s in kids) - v * (k - 1)
        room += v * (n - n2 / n - k + 1)
    if room <= 1e-9 or found <= 0:
        return STRENGTH[1]
    return min(max(room / found - 1, STRENGTH[0]), STRENGTH[1])


def plain(rows):
    """rows: (host, path, log-odds) -> (k_host, k_path, [posterior])."""
    p = [1 / (1 + math.exp(-o)) for _, _, o in rows]
    paths, hosts = defaultdict(list), defaultdict(list)
    for (h, q, _), x in zip(rows, p):
        paths[h, q].append(x)
        hosts[h].append(x)
    share = sum(p) / len(p)
    k_host = strength([(share * (1 - share), share, [(len(x), sum(x) / len(x)) for x in hosts.values()])])
    groups = []
    for h, mine in hosts.items():
        mean = sum(mine) / len(mine)
        groups.append((mean * (1 - mean), mean, [(len(x), sum(x) / len(x)) for (g, _), x in paths.items() if g == h]))
    k_path = strength(groups)
    out = []
    for (h, q, o), x in zip(rows, p):
        host = (k_host * share + sum(hosts[h]) - x) / (k_host + len(hosts[h]) - 1)
        left = (k_path * host + sum(paths[h, q]) - x) / (k_path + len(paths[h, q]) - 1)
        total = o + math.log(left / (1 - left)) - math.log(share / (1 - share))
        out.append(1 / (1 + math.exp(-total)))
    return k_host, k_path, out


def sites(spark, rows):
    df = spark.createDataFrame([(h, q, 1 / (1 + math.exp(-o))) for h, q, o in rows], "host string, path string, p double")
    return site_posteriors(df, Scratch(spark))


def random_rows(seed, n, hosts, differ):
    rng = random.Random(seed)
    lean = [rng.gauss(0, differ) for _ in range(hosts)]
    rows = []
    for _ in range(n):
        h = rng.randrange(hosts)
        q = rng.choice(["a", "b", None])
        rows.append((f"h{h}" if h else None, q, lean[h] + (differ if q == "a" else 0) + rng.gauss(0, 3)))
    return rows


@pytest.mark.parametrize(("seed", "hosts", "differ"), [(1, 8, 2.0), (2, 60, 0.0), (3, 3, 1.0)])
def test_strengths(spark, seed, hosts, differ):
    rows = random_rows(seed, 600, hosts, differ)
    _, k_host, k_path, _ = sites(spark, rows)
    want = plain(rows)
    assert k_host == pytest.approx(want[0]) and k_path == pytest.approx(want[1])


def test_posteriors(spark):
    """Of every row, by the classifier itself: its evidence is taken, the rest is recomputed."""
    rng = random.Random(6)
    good = ["Some plain words of a text, and more of them here.", "Another text with quite ordinary sentences in it."]
    bad = ["BUY NOW!!! CHEAP!!! | | | 9999", "!!!! $$$ 11111 | WIN | WIN | WIN !!!"]
    docs, labels = [], []
    for i in range(200):
        kind = rng.random() < 0.6
        docs.append((i, f"{rng.choice(good if kind else bad)} {i}", rng.choice(["en", "de"]), f"s{rng.randrange(12)}"))
        labels += [(i, int(kind))] if i % 2 else []
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in classify(df, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    _, _, want = plain([(s, lang, got[i].evidence) for i, _, lang, s in docs])
    for i, x in enumerate(want):
        assert got[i].posterior == pytest.approx(x, rel=1e-6, abs=1e-9) and got[i].kept == (x >= 0.5)


def test_sites_of_one_document_say_nothing(spark):
    """Shares of 0.98 and 0.02 on 20,000 hosts of one document each are noise: all hosts are drawn to the global share."""
    df = spark.range(20_000).select(
        F.concat(F.lit("h"), "id").alias("host"), F.lit("p").alias("path"), F.when(F.col("id") % 2 == 0, 0.98).otherwise(0.02).alias("p")
    )
    _, k_host, k_path, share = site_posteriors(df, Scratch(spark))
    assert k_host == k_path == STRENGTH[1] and share == pytest.approx(0.5)
    assert abs((k_host * share + 0.98) / (k_host + 1) - share) < 0.001


def test_sites_that_differ_keep_their_share(spark):
    df = spark.range(20_000).select(
        F.concat(F.lit("h"), F.col("id") % 20).alias("host"), F.lit("p").alias("path"), F.when(F.col("id") % 2 == 0, 0.98).otherwise(0.02).alias("p")
    )
    assert site_posteriors(df, Scratch(spark))[1] == STRENGTH[0]
