"""Ranks within keys of any size.

A window puts all rows of a key into one task.  Here rows are dealt by ranges of
(key, order), so a key with a third of all rows spreads over a third of the tasks;
a rank is the place in the range plus the rows of the key in the ranges before,
of which there is one sum a key and range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldrec.session import ensure_checkpoint_dir


def ranked(df: DataFrame, keys: list[str], order: list[Column | str], name: str = "rank", ranges: int | None = None) -> DataFrame:
    """``df`` with each row's rank, from 1, among the rows of its ``keys`` in ``order``; null keys are keys.

    ``order`` should leave no ties: rows that tie are ranked as they come, and go
    to one task together.  The sorted rows are checkpointed, as places must not change.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [*map(F.col, keys), *order]
    rows = df.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    rows = rows.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at")).checkpoint()
    starts = rows.groupBy(*keys, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    upto = Window.partitionBy(*keys).orderBy("_range")
    starts = starts.withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))
    mine, theirs = rows.alias("r"), starts.alias("s")
    same = F.col("r._range") == F.col("s._range")
    for k in keys:
        same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}"))
    rank = (F.col("s._before") + F.col("r._at") - F.col("s._first") + 1).alias(name)
    return mine.join(theirs, same).select(*[F.col(f"r.`{c}`") for c in df.columns], rank)


def rank_claims(claims: DataFrame, ranges: int | None = None) -> DataFrame:
    """Every claim with its rank for its entity and field: score, then source rank, record and value."""
    order = [F.desc("score"), F.asc("source_rank"), F.asc("record_id"), F.asc("value")]
    return ranked(claims, ["entity_key", "field"], order, ranges=ranges)


def rank_items(items: DataFrame, ranges: int | None = None) -> DataFrame:
    """Every history item (entity_key, k1, k2, o, item) with its rank among those of its key: source, record and place."""
    return ranked(items, ["entity_key", "k1", "k2"], [F.col("o"), F.col("item")], ranges=ranges)
