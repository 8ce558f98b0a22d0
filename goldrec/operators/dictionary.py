"""Skills against a dictionary of the user's own.

The dictionary is a table of any size, ``pos`` (its order) and ``name``.  Exact
names are an equi-join.  Spellings that it does not have meet it through an
index: a name's sorted tokens between two marks are cut to pairs of neighbouring
characters, numbered where they repeat.  With L characters in common, strings of
lengths a and b share at least 3L + 1 - a - b of these pairs, as a character left
out of the one breaks two of its pairs and one put in breaks one; a ratio of at
least the cutoff bounds L from below.  So the entries that share enough pairs,
counted over the pairs' lists, are all that can reach the cutoff, and only these
are measured.

Entries are dealt to shards and spellings to blocks.  A task reads the entries of
a shard, indexes them and lets a block's spellings stream past; neither side
reaches the driver or a task whole.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from goldrec.functions.similarity import _lcs_bits
from goldrec.functions.strings import py_strip
from goldrec.sources.dims import FUZZY_CUTOFF

SHARD = 100_000  # entries of a shard
BLOCK = 50_000  # spellings of a block
MARK = "\0"


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(pos, name) of the names in a text file, or in the files of a folder by their paths.

    One name a line, stripped; blank lines and lines that start with # are left
    out.  A file is read as one row.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.split("value", "\r\n|\r|\n").alias("lines"))
    lines = files.select("file", F.posexplode("lines").alias("line", "raw")).withColumn("name", py_strip(F.regexp_replace("raw", "^﻿", "")))
    lines = lines.where((F.col("name") != "") & ~F.col("raw").startswith("#"))
    # one row a file: where its lines start in the whole
    sizes = lines.groupBy("file").agg((F.max("line") + 1).alias("n"))
    sizes = sizes.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("start"))
    return lines.join(sizes, "file").select((F.col("start") + F.col("line")).cast("long").alias("pos"), "name")


def least_common(a: int, b: int, cutoff: float) -> int:
    """Characters that strings of lengths a and b have in common at least, where their ratio reaches ``cutoff``."""
    return math.ceil(cutoff * (a + b) / 200 - 1e-9)


class NameIndex:
    """Entries (pos, name) by the character pairs of their sorted tokens."""

    def __init__(self, entries: list[tuple[int, str]], cutoff: float):
        import numpy as np

        self.np, self.cutoff = np, cutoff
        sorted_names = [(" ".join(sorted(name.split())), pos, name) for pos, name in entries]
        sorted_names.sort(key=lambda e: (len(e[0]), e[1]))
        self.forms = [e[0] for e in sorted_names]
        self.entries = [e[1:] for e in sorted_names]
        self.lengths = np.array([len(f) for f in self.forms])
        lists: dict[tuple[str, int], list[int]] = {}
        for i, form in enumerate(self.forms):
            for pair in self.pairs(form):
                lists.setdefault(pair, []).append(i)
        self.lists = {pair: np.array(ids, np.int32) for pair, ids in lists.items()}
        self.needs: dict[int, tuple] = {}

    @staticmethod
    def pairs(form: str) -> list[tuple[str, int]]:
        """Neighbouring characters of the marked form, with the number of the occurrence."""
        text, seen, out = MARK + form + MARK, {}, []
        for i in range(len(text) - 1):
            pair = text[i : i + 2]
            seen[pair] = n = seen.get(pair, 0) + 1
            out.append((pair, n))
        return out

    def need(self, a: int) -> tuple:
        """(first entry, last, pairs to share) of the entries whose length allows the cutoff."""
        if a not in self.needs:
            np, cutoff = self.np, self.cutoff
            lengths = np.unique(self.lengths)
            fits = [b for b in lengths.tolist() if 200 * min(a, b) >= cutoff * (a + b)]
            lo, hi = (np.searchsorted(self.lengths, fits[0]), np.searchsorted(self.lengths, fits[-1], "right")) if fits else (0, 0)
            shares = {b: 3 * least_common(a, b, cutoff) + 1 - a - b for b in fits}
            self.needs[a] = (int(lo), int(hi), np.array([shares[b] for b in self.lengths[lo:hi].tolist()], np.int32))
        return self.needs[a]

    def best(self, text: str) -> tuple[int | None, str | None, float | None]:
        """(pos, name, ratio) of the entry with the largest token-sort ratio from the cutoff on, the first in order on ties."""
        np = self.np
        form = " ".join(sorted(text.split()))
        lo, hi, share = self.need(len(form))
        if lo == hi:
            return None, None, None
        hits = [ids for ids in (self.lists.get(p) for p in self.pairs(form)) if ids is not None]
        shared = np.bincount(np.concatenate(hits), minlength=len(self.forms))[lo:hi] if hits else np.zeros(hi - lo, np.int64)
        found: tuple = (None, None, None)
        for i in (np.flatnonzero(shared >= share) + lo).tolist():
            total = len(form) + len(self.forms[i])
            ratio = 100.0 * (1.0 - (total - 2 * _lcs_bits(form, self.forms[i])) / total)
            if ratio >= self.cutoff and (found[2] is None or (-ratio, self.entries[i][0]) < (-found[2], found[0])):
                found = (*self.entries[i], ratio)
        return found


def _matched(cutoff: float):
    """Rows (shard, block, pos, text), entries (with a pos) before the spellings of their unit -> (text, pos, name, ratio)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        unit, entries, index = None, [], None
        for b in batches:
            out = []
            for shard, block, pos, text in zip(*(c.to_pylist() for c in b.columns)):
                if (shard, block) != unit:
                    unit, entries, index = (shard, block), [], None
                if pos is not None:
                    entries.append((pos, text))
                    continue
                index = index or NameIndex(entries, cutoff)
                found = index.best(text)
                if found[0] is not None:
                    out.append((text, *found))
            kinds = [pa.string(), pa.int64(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 4, kinds)], names=["text", "pos", "name", "ratio"])

    return run


def similar_names(texts: DataFrame, dictionary: DataFrame, cutoff: float = FUZZY_CUTOFF, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(text, name, ratio) of the distinct ``texts`` (column text) that some entry reaches the cutoff with.

    The largest ratio wins, then the entry that comes first in the dictionary.
    """
    one = F.lit(1).alias("one")
    sizes = texts.agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).select(one, "blocks")
    cuts = dictionary.agg(F.ceil(F.count("*") / shard).cast("int").alias("shards")).select(one, "shards")
    entries = dictionary.select(one, "pos", F.col("name").alias("text")).join(sizes, "one").join(cuts, "one").where("blocks > 0")
    entries = entries.select(
        F.pmod(F.xxhash64("pos"), F.col("shards")).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "pos", "text"
    )
    asked = texts.select(one, "text").join(sizes, "one").join(cuts, "one").where("shards > 0")
    asked = asked.select(
        F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.pmod(F.xxhash64("text"), F.col("blocks")).cast("int").alias("block"),
        F.lit(None).cast("long").alias("pos"), "text",
    )
    units = entries.unionByName(asked).repartition("shard", "block").sortWithinPartitions("shard", "block", F.col("pos").asc_nulls_last())
    found = units.mapInArrow(_matched(cutoff), "text string, pos long, name string, ratio double")
    best = found.groupBy("text").agg(F.min_by(F.struct("name", "ratio"), F.struct(-F.col("ratio"), F.col("pos"))).alias("best"))
    return best.select("text", "best.name", "best.ratio")


def canonical_names(df: DataFrame, dictionary: DataFrame, col: str = "raw", cutoff: float = FUZZY_CUTOFF) -> DataFrame:
    """D7 against ``dictionary``: ``df`` with name, confidence and method of the skill in ``col``.

    Distinct spellings are resolved once and joined back: exact but for case ->
    1.0 (of names alike but for case the first counts); best token-sort ratio
    from the cutoff on -> 0.5 + (s - cutoff) / (100 - cutoff) * 0.49; else the
    stripped value itself at 0.5; blank -> itself at 0.0; null -> nulls.
    """
    from goldrec.operators.skills import fuzzy_confidence

    df = df.withColumn("_s", py_strip(F.col(col)))
    texts = df.select(F.col("_s").alias("text")).where("text <> ''").distinct()
    exact = dictionary.groupBy(F.lower("name").alias("key")).agg(F.min_by("name", "pos").alias("exact"))
    texts = texts.join(exact, F.lower("text") == F.col("key"), "left").select("text", "exact")
    rest = texts.where("exact is null").select("text")
    known = texts.join(similar_names(rest, dictionary, cutoff), "text", "left").select(F.col("text").alias("_t"), F.col("exact").alias("_e"), F.col("name").alias("_n"), F.col("ratio").alias("_r"))
    # rows without a text match nothing; a key of their own keeps them from meeting in one task
    plain = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    df = df.withColumn("_k", F.when(F.coalesce(F.col("_s"), F.lit("")) == "", F.xxhash64(*[F.col(f"`{c}`") for c in plain])))
    df = df.join(known.withColumn("_o", F.lit(None).cast("long")), (F.col("_s") == F.col("_t")) & F.col("_k").eqNullSafe(F.col("_o")), "left")
    blank, hit, fuzzy = F.col("_s") == "", F.col("_e").isNotNull(), F.col("_n").isNotNull()
    return df.withColumns({
        "name": F.when(blank, F.col(col)).otherwise(F.coalesce("_e", "_n", "_s")),
        "confidence": F.when(blank, 0.0).when(hit, 1.0).when(fuzzy, fuzzy_confidence(F.col("_r"), cutoff)).when(F.col("_s").isNotNull(), 0.5),
        "method": F.when(blank, "blank").when(hit, "exact").when(fuzzy, "fuzzy").when(F.col("_s").isNotNull(), "passthrough"),
    }).drop("_s", "_t", "_e", "_n", "_r", "_k", "_o")


# by value: workers need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
