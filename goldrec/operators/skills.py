"""Skill canonicalisation and merge.

Canonicalisation is a projection: a literal map for exact names and, for what
is left, one Arrow-batched function that works out each spelling of a batch
once.  Attribution of sources (E3) compares distinct strings per entity.
"""

from __future__ import annotations

import functools
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.functions.similarity import _lcs_bits
from goldrec.functions.strings import py_strip
from goldrec.operators.dictionary import canonical_names
from goldrec.operators.lists import exploded
from goldrec.operators.simjoin import similar_pairs
from goldrec.sources.dims import FUZZY_CUTOFF, SKILLS, SOURCE_ATTRIBUTION_CUTOFF, literal_map


def fuzzy_confidence(score, cutoff: float = FUZZY_CUTOFF):
    return F.round(F.lit(0.5) + (score - cutoff) / (100 - cutoff) * 0.49, 4)


@functools.lru_cache(maxsize=None)
def _fuzzy_udf(cutoff: int):
    """Best dictionary entry of a skill that is not in the dictionary: its name and ratio, or null."""
    entries = [(name, " ".join(sorted(name.split()))) for name in SKILLS]

    @F.pandas_udf("struct<name:string,ratio:double>")
    def best(texts: pd.Series) -> pd.DataFrame:
        known: dict[str, tuple] = {None: (None, None)}  # a batch repeats spellings
        for text in texts:
            if text in known:
                continue
            mine, found = " ".join(sorted(text.split())), (None, None)
            for name, other in entries:
                total = len(mine) + len(other)
                if 200 * min(len(mine), len(other)) < cutoff * total:
                    continue
                ratio = 100.0 * (1.0 - (total - 2 * _lcs_bits(mine, other)) / total)
                if ratio >= cutoff and (found[1] is None or ratio > found[1]):
                    found = (name, ratio)
            known[text] = found
        return pd.DataFrame([known[t] for t in texts], columns=["name", "ratio"])

    return best


def canonical_skills(df: DataFrame, col: str = "raw", cutoff: int = FUZZY_CUTOFF, dictionary: DataFrame | None = None) -> DataFrame:
    """``df`` with name, confidence and method of the skill in ``col``; no join, no shuffle.

    With ``dictionary`` (pos, name), of any size, the same against that table, by joins (``operators/dictionary.py``).
    exact (case-insensitive, a literal map) -> 1.0; best token-sort ratio >=
    cutoff (first dictionary entry on ties) -> 0.5 + (s - 80) / 20 * 0.49; else
    the stripped value itself at 0.5; blank -> itself at 0.0.
    """
    if dictionary is not None:
        return canonical_names(df, dictionary, col, cutoff)
    exact = literal_map({s.lower(): s for s in reversed(SKILLS)}.items())  # of entries alike but for case the first counts
    df = df.withColumn("_s", py_strip(F.col(col))).withColumn("_e", F.try_element_at(exact, F.lower("_s")))
    df = df.withColumn("_f", _fuzzy_udf(cutoff)(F.when(F.col("_e").isNull() & (F.col("_s") != ""), F.col("_s"))))
    blank, hit, fuzzy = F.col("_s") == "", F.col("_e").isNotNull(), F.col("_f.name").isNotNull()
    return df.withColumns({
        "name": F.when(blank, F.col(col)).otherwise(F.coalesce("_e", "_f.name", "_s")),
        "confidence": F.when(blank, 0.0).when(hit, 1.0).when(fuzzy, fuzzy_confidence(F.col("_f.ratio"))).when(F.col("_s").isNotNull(), 0.5),
        "method": F.when(blank, "blank").when(hit, "exact").when(fuzzy, "fuzzy").when(F.col("_s").isNotNull(), "passthrough"),
    }).drop("_s", "_e", "_f")


def skill_items(spark: SparkSession, keyed: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """entity_key, source, source_rank, record_id, pos, raw, name, confidence (one row per raw skill)."""
    return canonical_skills(exploded(keyed, "skills_raw").where(F.col("raw").isNotNull()), dictionary=dictionary)


def skill_bonus(sources: Column) -> Column:
    """0.05 for every source after the first, 0.1 at most."""
    return F.least(F.lit(0.1), F.lit(0.05) * F.greatest(F.lit(0), F.size(sources) - 1))


def merge_skills(spark: SparkSession, keyed: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """G7 + E3 + G14: entity_key, skills array<struct<name, confidence, sources>> in first-seen order."""
    items = skill_items(spark, keyed, dictionary).withColumn("key", F.lower("name"))
    order = F.struct("source_rank", "record_id", "pos")
    merged = items.groupBy("entity_key", "key").agg(
        F.min_by(F.struct("name", "confidence"), F.struct(-F.col("confidence"), order)).alias("best"),
        F.min(order).alias("first"),
    )
    merged = merged.join(skill_sources(items), ["entity_key", "key"], "left")
    sources = F.coalesce("srcs", F.array(F.lit("merged")))
    confidence = F.round(F.least(F.lit(1.0), F.col("best.confidence") + skill_bonus(sources)), 4)
    skill = F.struct(F.col("best.name").alias("name"), confidence.alias("confidence"), sources.alias("sources"))
    return merged.select("entity_key", F.struct("first", skill.alias("skill")).alias("s")).groupBy("entity_key").agg(
        F.transform(F.array_sort(F.collect_list("s")), lambda x: x["skill"]).alias("skills")
    )


def skill_sources(items: DataFrame, cutoff: int = SOURCE_ATTRIBUTION_CUTOFF) -> DataFrame:
    """entity_key, key, srcs: the sources of the entity's raw skills whose lower-case ratio to the skill is >= cutoff.

    ``items``: entity_key, raw, key (the canonical skill, lower-case), source.
    """
    known = items.groupBy("entity_key", F.lower(py_strip(F.col("raw"))).alias("raw_key"), "key").agg(F.collect_set("source").alias("s"))
    raws = known.groupBy("entity_key", "raw_key").agg(F.flatten(F.collect_list("s")).alias("s"))
    pairs = similar_pairs(raws, known, ["entity_key"], "raw_key", "key", cutoff)
    return pairs.join(raws, ["entity_key", "raw_key"]).groupBy("entity_key", "key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("s")))).alias("srcs")
    )


# by value: workers need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
