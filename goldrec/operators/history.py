"""Experience and education union with de-duplication.

Items are exploded with an order key (source rank, record id, position); one
item per de-duplication key survives - the first in that order - via a
partial ``min_by`` aggregation, then the survivors are collected per entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec.functions.dates import normalize_date, normalize_year
from goldrec.functions.strings import py_strip


def _ranked(it: DataFrame) -> DataFrame:
    if "source_rank" in it.columns:
        return it
    from goldrec.sources.dims import source_rank_expr

    return it.withColumn("source_rank", source_rank_expr(F.col("source")))


def _nz(c):
    s = py_strip(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(s != "", s)


def experience_norm(item: Column) -> Column:
    """One raw experience item, normalised."""
    return F.struct(
        _nz(item["company"]).alias("company"),
        _nz(item["title"]).alias("title"),
        normalize_date(item["start"]).alias("start"),
        normalize_date(item["end"]).alias("end"),
        _nz(item["summary"]).alias("summary"),
    )


def education_norm(item: Column) -> Column:
    """One raw education item, normalised."""
    return F.struct(
        _nz(item["institution"]).alias("institution"),
        _nz(item["degree"]).alias("degree"),
        _nz(item["field"]).alias("field"),
        F.coalesce(normalize_year(item["end_year"]), py_strip(item["end_year"]).try_cast("int")).alias("end_year"),
    )


def experience_key(norm: Column) -> tuple[Column, Column]:
    return F.lower(F.coalesce(norm["company"], F.lit(""))), norm["start"]


def education_key(norm: Column) -> tuple[Column, Column]:
    return F.lower(F.coalesce(norm["institution"], F.lit(""))), F.lower(F.coalesce(norm["degree"], F.lit("")))


def _items_from(it: DataFrame, col: str, norm, key) -> DataFrame:
    it = _ranked(it).select("entity_key", F.struct("source_rank", "record_id", "pos").alias("o"), norm(F.col(col)).alias("item"))
    k1, k2 = key(F.col("item"))
    return it.select("entity_key", k1.alias("k1"), k2.alias("k2"), "o", "item")


def experience_items_from(it: DataFrame, col: str = "item") -> DataFrame:
    """Same, from any item table (entity_key, source_rank|source, record_id, pos, <col> struct)."""
    return _items_from(it, col, experience_norm, experience_key)


def education_items_from(it: DataFrame, col: str = "item") -> DataFrame:
    return _items_from(it, col, education_norm, education_key)


def dedup_items(items: DataFrame) -> DataFrame:
    """First item per (entity, k1, k2) in order (partial aggregation, no window).

    The item itself breaks ties of the order key, so the survivor is deterministic.
    """
    return items.groupBy("entity_key", "k1", "k2").agg(
        F.min_by("item", F.struct("o", "item")).alias("item"), F.min("o").alias("o")
    )
