"""Quality classifier with hierarchical empirical Bayes.

1. A logistic regression on a dozen shape features of the whole text is fitted
   on at most MAX_FIT labelled rows, chosen by hashes of doc_id; its log-odds are
   a document's own evidence.
2. Over all documents, expected good shares are summed by host (source) and
   path (source and language).  Hosts are drawn towards the global share, paths
   towards their host.  How strongly follows from how much they differ beyond
   what so many rows differ by chance (method of moments, sites weighing as many
   as they have rows), so sparse sites say little.
3. A document is kept when its evidence and the odds of its path, without its
   own share in the path's and the host's, make good more likely than not.

Defined results: a null text counts as empty; null hosts and languages are
sites of their own; repeated rows each return; labels that contradict each
other all count; without labels of both kinds the evidence is nil and every
document is kept; an empty table gives an empty result; other columns do not
matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import PandasUDFType

from goldrec.llm.common import Scratch, lean, ship

MAX_FIT = 20_000
RIDGE = 1.0
FEATURES = 12
STRENGTH = (1.0, 1000.0)  # least and most rows that a prior weighs
MOST_ODDS = 12.0


def _classes():
    import numpy as np

    kind = np.zeros(256, np.uint8)  # 0 other
    kind[[9, 10, 11, 12, 13, 32]] = 1
    kind[97:123] = 2
    kind[128:] = 2
    kind[65:91] = 3
    kind[48:58] = 4
    kind[[ord(c) for c in ".,;:'\"()-?"]] = 5
    kind[ord("!")] = 6
    kind[ord("|")] = 7
    return kind


def features(text: str | None, kinds=None):
    """The FEATURES numbers of one text."""
    import numpy as np

    kinds = _classes() if kinds is None else kinds
    raw = (text or "").encode()
    n = np.bincount(kinds[np.frombuffer(raw, np.uint8)], minlength=8).astype(float)
    words = raw.split()
    w = max(len(words), 1)
    size = max(len(raw), 1)
    lines = [x for x in raw.split(b"\n") if x]
    again = sum(a == b for a, b in zip(words, words[1:])) / w
    return np.array(
        [
            n[3] / max(n[2] + n[3], 1),
            n[0] / size,
            n[6] / size,
            n[7] / size,
            n[4] / size,
            n[5] / size,
            again,
            1 - len(set(words)) / w,
            1 - len(set(lines)) / max(len(lines), 1),
            min(size / w, 40) / 10,
            math.log1p(len(words)) / 5,
            min(n[0] / w, 3),
        ]
    )


def _feature_rows(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    kinds = _classes()
    for b in batches:
        rows = [features(t.as_py(), kinds) for t in b.column(b.num_columns - 1)]
        flat = pa.array(np.concatenate(rows) if rows else np.zeros(0))
        offsets = pa.array(np.arange(0, FEATURES * (len(rows) + 1), FEATURES, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.ListArray.from_arrays(offsets, flat)], names=[*b.schema.names[:-1], "x"])


def fit(x, y) -> list[float]:
    """Weights (the constant last) of a ridge-penalised logistic regression on standardised features, for plain ones; Newton's method."""
    import numpy as np

    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, penalty = np.zeros(z.shape[1]), np.eye(z.shape[1]) * RIDGE
    penalty[-1, -1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    plain = w[:-1] / scale
    return [*plain.tolist(), float(w[-1] - plain @ mean)]


def train(feature_rows: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT) -> list[float] | None:
    """Weights from at most ``max_fit`` labelled rows; None without rows of both kinds."""
    import numpy as np

    labelled = feature_rows.select("doc_id", "x").join(labels.where("quality in (0, 1)").select("doc_id", "quality"), "doc_id")
    n, steps = labelled.count(), 1 << 30
    if n > max_fit:  # thinned by hash first: a sorted limit alone would send max_fit rows from every task to the driver
        labelled = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(steps)) < int(steps * 0.9 * max_fit / n))
    rows = labelled.select(F.xxhash64("doc_id").alias("h"), "doc_id", "x", "quality").orderBy("h", "doc_id", "quality", "x").limit(max_fit).collect()
    y = np.array([r["quality"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return None
    return fit(np.array([r["x"] for r in rows]), y)


def log_odds(x: Column, weights: list[float] | None) -> Column:
    if weights is None:
        return F.lit(0.0)
    w = F.array(*map(F.lit, weights[:-1]))
    total = F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(weights[-1]), lambda s, v: s + v)
    return F.greatest(F.least(total, F.lit(MOST_ODDS)), F.lit(-MOST_ODDS))


def _strength(groups: DataFrame, v: Column) -> float:
    """Rows that a parent's share weighs against its children's own.

    ``groups``, a row a parent: k children with n rows in all, n2 the sum of their
    squared rows, s the sum of rows x (child's share - parent's)^2; ``v`` is the
    variance of a row.  The children's rows are alike to the degree rho, where
    s is expected at v (k - 1 + rho (n - n2 / n - k + 1)); strength is 1 / rho - 1.
    """
    free = F.col("k") - 1
    found, room = groups.agg(F.sum(F.col("s") - v * free), F.sum(v * (F.col("n") - F.col("n2") / F.col("n") - free))).first()
    if not room or room <= 1e-9 or found <= 0:
        return STRENGTH[1]
    return min(max(room / found - 1, STRENGTH[0]), STRENGTH[1])


def site_posteriors(scored: DataFrame, scratch: Scratch) -> tuple[DataFrame, float, float, float]:
    """Sites (host, path, good, n, h_good, h_n), the strengths of hosts' and of paths' priors, the global share.

    ``scored``: host, path, p (expected good).
    """
    paths = scratch.save(scored.groupBy("host", "path").agg(F.sum("p").alias("good"), F.count("*").alias("n")), "paths")
    hosts = scratch.save(paths.groupBy("host").agg(F.sum("good").alias("h_good"), F.sum("n").alias("h_n")), "hosts")
    good, n = hosts.agg(F.sum("h_good"), F.sum("h_n")).first()
    share = (good / n) if n else 0.5
    share = min(max(share, 1e-6), 1 - 1e-6)
    gap = F.col("h_good") / F.col("h_n") - share
    whole = hosts.agg(F.count("*").alias("k"), F.sum("h_n").alias("n"), F.sum(F.col("h_n") * F.col("h_n")).alias("n2"), F.sum(F.col("h_n") * gap * gap).alias("s"))
    k_host = _strength(whole, F.lit(share * (1 - share)))
    sites = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).select(paths["host"], "path", "good", "n", "h_good", "h_n")
    sites = scratch.save(sites, "sites")
    mean = F.col("h_good") / F.col("h_n")
    gap = F.col("good") / F.col("n") - mean
    by_host = sites.groupBy("host", "h_good", "h_n").agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("n2"), F.sum(F.col("n") * gap * gap).alias("s"))
    return sites, k_host, _strength(by_host, mean * (1 - mean)), share


def _share(k_host: float, k_path: float, share: float, own: Column) -> Column:
    """The posterior share of a path, ``own`` taken out of its sums and its host's (a share of one row, or 0 of none)."""
    rows = F.when(own.isNotNull(), 1).otherwise(0)
    p = F.coalesce(own, F.lit(0.0))
    host = (k_host * share + F.col("h_good") - p) / (k_host + F.col("h_n") - rows)
    return (k_path * host + F.col("good") - p) / (k_path + F.col("n") - rows)


def posterior(odds: Column, p: Column, k_host: float, k_path: float, share: float) -> Column:
    """Probability of good from own evidence and the path's share without the row itself."""
    left = F.greatest(F.least(_share(k_host, k_path, share, p), F.lit(1 - 1e-6)), F.lit(1e-6))
    total = odds + F.log(left / (1 - left)) - math.log(share / (1 - share))
    return 1 / (1 + F.exp(-total))


def _sigmoid(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT) -> tuple:
    """(rows with doc_id, host, path, odds; weights; sites; strengths of hosts and paths; global share)."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select("doc_id", F.col("source").cast("string").alias("host"), F.col("lang").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    kind = T.StructType([*rows.schema.fields[:3], T.StructField("x", T.ArrayType(T.DoubleType()))])
    rows = scratch.save(rows.mapInArrow(lean(_feature_rows), kind), "features")
    weights = train(rows.select("doc_id", "x"), labels, max_fit)
    scored = rows.select("doc_id", "host", "path", log_odds(F.col("x"), weights).alias("odds"))
    sites, k_host, k_path, share = site_posteriors(scored.select("host", "path", _sigmoid(F.col("odds")).alias("p")), scratch)
    return scored, weights, sites, k_host, k_path, share


def _site(host: str, path: str) -> Column:
    # a struct of nulls is no null: null hosts meet each other
    return F.struct(F.coalesce(F.concat(F.lit("="), F.col(host)), F.lit("")).alias("host"), F.coalesce(F.concat(F.lit("="), F.col(path)), F.lit("")).alias("path"))


def _placed(scored: DataFrame, sites: DataFrame) -> DataFrame:
    sites = sites.select(_site("host", "path").alias("site"), "good", "n", "h_good", "h_n")
    return scored.withColumn("site", _site("host", "path")).join(sites, "site")


def classify(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT) -> DataFrame:
    """(doc_id, evidence, site_share, posterior, kept) for every row."""
    scored, weights, sites, k_host, k_path, share = judge(docs, labels, max_fit)
    p = posterior(F.col("odds"), _sigmoid(F.col("odds")), k_host, k_path, share)
    site_share = _share(k_host, k_path, share, F.lit(None).cast("double"))
    kept = F.lit(True) if weights is None else F.col("posterior") >= 0.5
    rows = _placed(scored, sites).select("doc_id", F.col("odds").alias("evidence"), site_share.alias("site_share"), p.alias("posterior"))
    return rows.withColumn("kept", kept)


def keep_good(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their columns.

    Features are computed again here: rows kept beside them would lie in the
    shared folder, a copy of all texts, as long as the result is read.
    """
    _, weights, sites, k_host, k_path, share = judge(docs.select("doc_id", "source", "lang", "text"), labels, max_fit)
    if weights is None:
        return docs
    w = weights

    def scored(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        kinds = _classes()
        for texts in batches:
            x = np.array([features(t, kinds) for t in texts]).reshape(-1, FEATURES)
            yield pd.Series(np.clip(x @ np.array(w[:-1]) + w[-1], -MOST_ODDS, MOST_ODDS))

    odds_of = F.pandas_udf(lean(scored), "double", PandasUDFType.SCALAR_ITER)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("source").cast("string").alias("host"), F.col("lang").cast("string").alias("path"), odds_of(F.col("text").cast("string")).alias("odds"))
    good = posterior(F.col("odds"), _sigmoid(F.col("odds")), k_host, k_path, share) >= 0.5
    return _placed(rows, sites).where(good).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


ship(__name__)
