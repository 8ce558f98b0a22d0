"""Product codes and hard negatives against plain means."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldrec.llm.hard_negatives import Tree, mine_negatives, tiles
from goldrec.llm.vector_codes import CellCodes, compress, part_bounds

SCHEMA = "vec_id long, embedding array<double>, label int, code string, score string"


def plain_codes(rows, parts=8, k=16, rounds=6, scale=4096):
    """Rows (vec_id, vector, label) of one length, all usable."""
    rows = [(i, [math.floor(x * scale) for x in v], label) for i, v, label in rows]
    bounds = part_bounds(len(rows[0][1]), parts)
    start = sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))[:k]
    books = [[r[1][a:z] for r in start] for a, z in bounds]

    def nearest(p, x):
        return min((sum((u - w) ** 2 for u, w in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        held = [[[] for _ in b] for b in books]
        for _, v, _ in rows:
            for p, (a, z) in enumerate(bounds):
                held[p][nearest(p, v[a:z])[1]].append(v[a:z])
        books = [[[sum(c) // len(m) for c in zip(*m)] if m else old for m, old in zip(h, b)] for h, b in zip(held, books)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out, per = [], {}
    for i, v, label in rows:
        best = [nearest(p, v[a:z]) for p, (a, z) in enumerate(bounds)]
        error = sum(d for d, _ in best)
        per[label] = per.get(label, 0) + error
        out.append((i, label, "".join(f"{e:02x}" for _, e in best), error))
    return sorted([(i, code, error, per[label], digest) for i, label, code, error in out], key=str)


def codes(spark, rows, **how):
    df, _ = compress(spark.createDataFrame([(i, v, label, "a", "b") for i, v, label in rows], SCHEMA).repartition(3), **how)
    return sorted([(r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()], key=str)


def vectors(seed, n, dim, spread=1.0):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, spread) for _ in range(dim)] for _ in range(6)]
    return [(i, [m + rng.gauss(0, 0.2) for m in middles[i % 6]], i % 4) for i in range(n)]


@pytest.mark.parametrize(("n", "dim", "cell"), [(150, 16, 512), (150, 16, 37), (9, 8, 512), (60, 11, 4096)])
def test_codes_against_plain_means(spark, n, dim, cell):
    rows = vectors(n + dim, n, dim)
    rows += [rows[2], rows[2], (rows[3][0], rows[4][1], None), (None, rows[5][1], None), (-5, [0.0] * dim, 1)]
    assert codes(spark, rows, cell=cell) == plain_codes(rows)


def test_codes_drop_unusable_rows_and_part_lengths(spark):
    good = vectors(3, 40, 8)
    odd = [(100, None, 1), (101, [1.0] * 7 + [None], 1), (102, [float("nan")] * 8, 1), (103, [float("inf")] + [0.0] * 7, 1)]
    short = [(200 + i, [i / 7, 1.5], 9) for i in range(20)]
    assert codes(spark, good + odd) == plain_codes(good)
    got = codes(spark, good + odd + short)
    assert got == sorted(plain_codes(good) + plain_codes(short), key=str)
    assert codes(spark, [(1, [], 2)])[0][:4] == (1, "00" * 8, 0, 0)
    assert codes(spark, odd) == [] and codes(spark, []) == []


def test_codes_of_very_large_components(spark):
    rows = [(i, [10.0**20 * (i % 3) + i, -(10.0**18), 0.5, i * 1.0] * 2, i % 2) for i in range(40)]
    got = {r[0]: r[1] for r in codes(spark, rows)}
    assert got == {r[0]: r[1] for r in plain_codes(rows)}


def test_cells_leave_out_dominated_entries_only():
    rng = np.random.default_rng(4)
    entries, x = rng.integers(-3000, 3000, (16, 8)), rng.integers(-3000, 3000, (3000, 8))
    for cell in (16, 256, 2048):
        coder = CellCodes(entries.astype(object), cell)
        entry, d = coder.assign(x)
        every = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert (entry == every.argmin(axis=1)).all() and (d == every.min(axis=1)).all()
    assert CellCodes(entries.astype(object), 16)._candidates(x[:100] // 16 * 16).sum() < 300  # most entries go


def plain_negatives(rows, low=30, high=90, positives=5, negatives=10, every=10, scale=256):
    rows = [(i, [math.floor(x * scale) for x in v], label) for i, v, label in rows]
    out = []
    for a, va, la in rows:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, v, label in rows if i != a and len(v) == len(va))
        for p, pid, _ in [s for s in scored if s[2] == la][:positives]:
            fit = [s for s in scored if s[2] != la and low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out += [(a, pid, r, i, -p, -s) for r, (s, i, _) in enumerate(fit, 1)]
    return sorted(out)


def negatives(spark, rows, every=10, **how):
    df = spark.createDataFrame([(i, v, label, "a", "b") for i, v, label in rows], SCHEMA).repartition(3)
    out = mine_negatives(df, F.col("vec_id") % every == 0, **how).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in out)


@pytest.mark.parametrize("shard", [8192, 40])
def test_negatives_against_plain_means(spark, shard):
    rows = vectors(8, 230, 8, 0.4) + [(1000 + i, [0.5] * 8, i % 3) for i in range(60)] + [(2000, [0.0] * 8, 1), (2010, [1.0], 2), (2011, [3.0], 2), (2012, [2.0], 3)]
    odd = [(3000, None, 1), (3010, [float("nan")] * 8, 1), (None, [1.0] * 8, 1), (3020, [1.0] * 8, None)]
    want = plain_negatives(rows)
    assert want and negatives(spark, rows + odd, shard_rows=shard) == want


def test_negatives_of_repeated_rows_and_empty_tables(spark):
    rows = vectors(9, 60, 6, 0.4)
    rows += [rows[10], rows[10], (20, rows[21][1], 1), rows[33]]
    assert negatives(spark, rows, shard_rows=16) == plain_negatives(rows)
    assert negatives(spark, []) == []


def test_negatives_of_very_large_components(spark):
    rows = [(i, [2.0**40 * (1 + i % 5), float(i), -1.0], i % 3) for i in range(30)]
    want = [r if abs(r[4]) < 2**63 else (*r[:4], None, None if abs(r[5]) >= 2**63 else r[5]) for r in plain_negatives(rows)]
    assert negatives(spark, rows) == sorted(want)


def test_tree_opens_few_boxes_of_separated_groups():
    rng = np.random.default_rng(1)
    middles = rng.integers(-2000, 2000, (8, 4))
    x = (middles[np.arange(4000) % 8] + rng.integers(-9, 9, (4000, 4))).astype(np.int64)
    assert sorted(np.concatenate(list(tiles(x, 64))).tolist()) == list(range(4000))
    tree = Tree(np.arange(4000), np.arange(4000) % 8, x, leaf=64)
    (best,) = tree.search(x[0], 0, True, [(None, None)], 5, 0)
    scores = x @ x[0]
    want = sorted((-int(scores[i]), i) for i in range(8, 4000, 8))[:5]
    assert best == [(-s, i) for s, i in want]
    assert tree.opened <= 12  # of 64 leaves and more
