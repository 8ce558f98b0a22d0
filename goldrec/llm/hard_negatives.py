"""Hard-negative mining over STR-packed R-trees.

An anchor's positives are its best rows of the same label; its hard negatives
are, for every positive, the best rows of other labels whose score lies in a
window of percents of the positive's score.  A score is the integer inner
product of floor(scale * x).

*Packing.*  Rows are cut to shards by ranges of (length, label, first component,
hash), so equal vectors spread over shards too.  In a shard they are sorted and
tiled recursively (STR): by label, then by the components that vary most, to
leaves of ``LEAF`` rows; runs of ``FANOUT`` boxes make the boxes above.

*Search.*  A box gives every component an interval, and so bounds of the inner
product: sums of the larger and the smaller end of q * [low, high].  A queue takes
the box with the largest upper bound first.  A box is left out when it lies
outside all score windows, holds no row of the wanted label, or is strictly
below the k-th score of every window it meets; boxes that tie are opened, so ties
by id stay right.

*Flow.*  The rows of a shard come first to the task that holds it, then the
anchors stream past its tree: a task keeps one shard and one batch of anchors.
What a shard finds are at most k rows an anchor and window; the k best of these
are the answer.  The positives of all shards are merged before negatives are
searched.

Numbers are exact: scores are computed in 64 bits where these hold every sum,
else in whole numbers without bound, and merged as 38 digits.

Defined results: rows with a null id, label or vector and rows with a null or
non-finite component take no part; vectors of unlike length are not compared; a
row is no partner of rows with its own id; rows that repeat an id are rows of
their own, as anchors (each is searched), positives and negatives; a positive
score below zero gives an empty window, zero one of zero alone; scores beyond a
long come back null, and beyond 38 digits count as the largest of these; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldrec.llm.common import Scratch, lean, ship
from goldrec.llm.topk import usable
from goldrec.llm.vector_codes import whole

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # percent of the positive's score
SHARD_ROWS = 8192
LEAF = 128
FANOUT = 16
TILED = 3  # components to tile by
DIGITS = 38


def tiles(x, leaf: int) -> Iterator:
    """Row numbers of ``x``, sorted and tiled by the components that vary most, in leaves."""
    import numpy as np

    near = x.astype(np.float64)
    dims = np.argsort(-near.var(axis=0), kind="stable")[:TILED].tolist()

    def cut(rows, dims: list) -> Iterator:
        if len(rows) <= leaf or not dims:
            for at in range(0, len(rows), leaf):
                yield rows[at : at + leaf]
            return
        leaves = math.ceil(len(rows) / leaf)
        slabs = math.ceil(leaves ** (1 / len(dims)))
        size = leaf * math.ceil(leaves / slabs)
        rows = rows[np.argsort(near[rows, dims[0]], kind="stable")]
        for at in range(0, len(rows), size):
            yield from cut(rows[at : at + size], dims[1:])

    yield from cut(np.arange(len(x)), dims)


class Tree:
    """R-tree of the rows (ids, labels' numbers, whole-number components) of one vector length."""

    def __init__(self, ids, labels, x, leaf: int = LEAF, fanout: int = FANOUT):
        import numpy as np

        leaves = []
        for label in np.unique(labels).tolist():
            mine = np.flatnonzero(labels == label)
            leaves += [mine[t] for t in tiles(x[mine], leaf)]
        order = np.concatenate(leaves)
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        stop = np.cumsum([len(t) for t in leaves])
        start = stop - [len(t) for t in leaves]
        low, high, first, last = (np.array([f(a, z) for a, z in zip(start.tolist(), stop.tolist())], dtype=kind) for f, kind in (
            (lambda a, z: self.x[a:z].min(axis=0), x.dtype), (lambda a, z: self.x[a:z].max(axis=0), x.dtype),
            (lambda a, z: self.labels[a], np.int64), (lambda a, z: self.labels[z - 1], np.int64)))
        self.leaves = len(leaves)
        self.start, self.stop, self.low, self.high, self.first, self.last = start.tolist(), stop.tolist(), [low], [high], [first], [last]
        below, n = 0, len(leaves)
        while n > 1:
            cuts = range(0, n, fanout)
            ends = [min(n, a + fanout) for a in cuts]
            low, high = self.low[-1], self.high[-1]
            first, last = self.first[-1], self.last[-1]
            self.low.append(np.array([low[a:z].min(axis=0) for a, z in zip(cuts, ends)], dtype=x.dtype))
            self.high.append(np.array([high[a:z].max(axis=0) for a, z in zip(cuts, ends)], dtype=x.dtype))
            self.first.append(np.array([first[a:z].min() for a, z in zip(cuts, ends)]))
            self.last.append(np.array([last[a:z].max() for a, z in zip(cuts, ends)]))
            self.start += [below + a for a in cuts]
            self.stop += [below + z for z in ends]
            below, n = below + n, len(ends)
        self.root = below
        self.low, self.high = np.concatenate(self.low), np.concatenate(self.high)
        self.first, self.last = np.concatenate(self.first), np.concatenate(self.last)
        self.most = max((int(abs(a).max()) for a in (self.low, self.high) if a.size), default=0)
        self.opened = 0  # boxes that searches opened

    def search(self, q, label: int, same: bool, windows: list, k: int, own: int) -> list[list]:
        """For every window (low, high; None: no limit) its k best (score, id), rows with id ``own`` left out."""
        import numpy as np

        most = max((int(abs(q).max()) if q.size else 0), 1)
        kind = np.int64 if self.most * most * max(1, len(q)) < 2**62 else object
        q = q.astype(kind)
        found: list = [[] for _ in windows]
        lows = [-math.inf if w[0] is None else w[0] for w in windows]
        highs = [math.inf if w[1] is None else w[1] for w in windows]
        kth = [-math.inf] * len(windows)

        def bounds(a: int, z: int):
            one, other = self.low[a:z].astype(kind, copy=False) * q, self.high[a:z].astype(kind, copy=False) * q
            return np.minimum(one, other).sum(axis=1), np.maximum(one, other).sum(axis=1)

        def alive(least, largest) -> bool:
            return any(largest >= lo and least <= hi and min(largest, hi) >= t for lo, hi, t in zip(lows, highs, kth))

        def open_box(a: int, z: int) -> None:
            if same:
                fits = (self.first[a:z] <= label) & (self.last[a:z] >= label)
            else:
                fits = (self.first[a:z] != label) | (self.last[a:z] != label)
            least, largest = bounds(a, z)
            for i in np.flatnonzero(fits).tolist():
                if alive(least[i], largest[i]):
                    heapq.heappush(queue, (-largest[i], a + i, least[i]))

        queue: list = []
        open_box(self.root, self.root + 1)
        while queue:
            largest, box, least = heapq.heappop(queue)
            if all(-largest < max(lo, t) for lo, t in zip(lows, kth)):
                break  # all that follow are no larger
            if not alive(least, -largest):
                continue
            a, z = self.start[box], self.stop[box]
            self.opened += 1
            if box >= self.leaves:
                open_box(a, z)
                continue
            scores = self.x[a:z].astype(kind, copy=False) @ q
            fits = (self.ids[a:z] != own) & ((self.labels[a:z] == label) == same)
            for w, (lo, hi) in enumerate(zip(lows, highs)):
                at = np.flatnonzero(fits & (scores >= max(lo, kth[w])) & (scores <= hi))
                if not len(at):
                    continue
                best = found[w] + [(-int(s), int(i)) for s, i in zip(scores[at], self.ids[a:z][at])]
                found[w] = heapq.nsmallest(k, best)
                if len(found[w]) == k:
                    kth[w] = -found[w][-1][0]
        return [[(-s, i) for s, i in f] for f in found]


FOUND = f"key long, base decimal({DIGITS},0), id long, score decimal({DIGITS},0)"


def _shards(same: bool, k: int, scale: int, low: int, high: int):
    """Rows (shard, anchor, key, id, label, v, bases), a shard's rows before its anchors -> FOUND.

    Each base (a positive's score) of an anchor gives a window; without bases there is one without limits.
    """

    def window(base):
        return (None, None) if base is None else (-(-low * base // 100), high * base // 100)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        top = 10**DIGITS - 1
        shard, rows, trees, names = None, [], None, {}

        def build() -> dict:
            nonlocal names
            ids, labels, vectors = (list(c) for c in zip(*rows))
            names = {x: i for i, x in enumerate(sorted(set(labels)))}
            sizes = np.array([len(v) for v in vectors])
            ids, numbers = np.array(ids, np.int64), np.array([names[x] for x in labels])
            out = {}
            for n in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == n)
                out[n] = Tree(ids[at], numbers[at], whole([vectors[i] for i in at], scale))
            return out

        for b in batches:
            found = []
            v = b.column(5)
            offsets, values = np.asarray(v.offsets), np.asarray(v.values)
            shards, anchor, keys, ids, labels = (b.column(i).to_pylist() for i in range(5))
            bases = b.column(6).to_pylist()
            for i in range(b.num_rows):
                if shards[i] != shard:
                    shard, rows, trees = shards[i], [], None
                x = values[offsets[i] : offsets[i + 1]]
                if not anchor[i]:
                    rows.append((ids[i], labels[i], x.copy()))
                    continue
                if not rows:
                    continue
                if trees is None:
                    trees = build()
                tree, label = trees.get(len(x)), names.get(labels[i], -1)
                if tree is None or (same and label < 0):
                    continue
                mine = [None] if bases[i] is None else sorted({int(p) for p in bases[i]})
                for base, best in zip(mine, tree.search(whole([x], scale)[0], label, same, [window(p) for p in mine], k, ids[i])):
                    found += [(keys[i], base, j, max(-top, min(top, s))) for s, j in best]
            kinds = [pa.int64(), pa.decimal128(DIGITS, 0), pa.int64(), pa.decimal128(DIGITS, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*found)) or [[]] * 4, kinds)], names=["key", "base", "id", "score"])

    return run


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine_negatives(
    vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``vectors`` has vec_id, label and embedding.

    ``anchors`` is the condition, on vec_id, that makes a row an anchor.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), usable(F.col("embedding")).alias("v"))
    rows = rows.where("vec_id is not null and label is not null and v is not null").withColumn("anchor", F.coalesce(anchors, F.lit(False)))
    rows = rows.withColumnRenamed("vec_id", "id")
    rows = scratch.save(rows, "rows")
    count = max(1, math.ceil(rows.count() / shard_rows))
    spread = [F.size("v"), "label", F.get("v", F.lit(0)), F.xxhash64("v", "id")]
    packed = rows.repartitionByRange(count, *spread)
    packed = scratch.save(packed.select(F.spark_partition_id().alias("shard"), F.monotonically_increasing_id().alias("key"), "*"), "packed")
    last = packed.agg(F.max("shard")).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = F.explode(F.sequence(F.lit(0), F.lit(last)))
    none = F.lit(None).cast(f"array<decimal({DIGITS},0)>")

    def search(queries: DataFrame, same: bool, k: int) -> DataFrame:
        columns = ["shard", "asks", "key", "id", "label", "v", "bases"]
        held = packed.select("shard", F.lit(False).alias("asks"), "key", "id", "label", "v", none.alias("bases"))
        asked = queries.select(every.alias("shard"), F.lit(True).alias("asks"), "key", "id", "label", "v", "bases")
        met = held.select(columns).unionByName(asked.select(columns)).repartition(parts, "shard").sortWithinPartitions("shard", "asks")
        return scratch.save(met.mapInArrow(lean(_shards(same, k, scale, low, high)), FOUND), "found")

    queries = packed.where("anchor").select("key", "id", "label", "v")
    best = _best(search(queries.withColumn("bases", none), True, positives), ["key"], positives)
    best = scratch.save(best.select("key", F.col("id").alias("positive_id"), F.col("score").alias("base")), "positives")
    bases = best.groupBy("key").agg(F.collect_set("base").alias("bases"))
    worst = _best(search(queries.join(bases, "key"), False, negatives), ["key", "base"], negatives)
    worst = worst.select("key", "base", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").try_cast("long").alias("negative_score"))
    out = best.join(worst, ["key", "base"]).join(queries.select("key", F.col("id").alias("anchor_id")), "key")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", F.col("base").try_cast("long").alias("positive_score"), "negative_score")


ship(__name__)
