"""Ordered set union of list fields (G4, U2) with D4/D10 normalisation.

Values are exploded with their order key (source rank, record id, position),
reduced to one row per (entity, value) by a partial aggregation, and only the
distinct values are collected per entity, in order.  The collected list is
bounded by the number of *distinct* values of an entity, not by its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec.functions.phones import normalize_phone
from goldrec.functions.strings import py_strip
from goldrec.operators.claims import with_score


def exploded(keyed: DataFrame, field: str) -> DataFrame:
    """entity_key, source, source_rank, record_id, pos, raw (non-empty items of ``fields.<field>``)."""
    return (
        with_score(keyed)
        .select("entity_key", "source", "source_rank", "record_id",
                F.posexplode(F.col(f"fields.{field}")).alias("pos", "raw"))
        .where(F.col("raw").isNotNull() & (F.col("raw") != ""))
    )


def ordered_union(items: DataFrame, value: Column, name: str) -> DataFrame:
    """entity_key, <name> array: distinct non-null ``value`` ordered by first occurrence.

    Occurrence order is source weight (desc), then record id, then position.
    """
    firsts = (
        items.select("entity_key", value.alias("v"), F.struct("source_rank", "record_id", "pos").alias("o"))
        .where(F.col("v").isNotNull() & (F.col("v") != ""))
        .groupBy("entity_key", "v")
        .agg(F.min("o").alias("o"))
    )
    return firsts.groupBy("entity_key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("o", "v"))), lambda x: x["v"]).alias(name)
    )


def union_emails(keyed: DataFrame) -> DataFrame:
    """G4 + D10: entity_key, emails (lower-cased, stripped, distinct, ordered)."""
    items = exploded(keyed, "emails")
    return ordered_union(items, F.lower(py_strip(F.col("raw"))), "emails")


def union_phones(keyed: DataFrame, region: str = "US") -> DataFrame:
    """G4 + D4: entity_key, phones (E.164, invalid dropped, distinct, ordered)."""
    items = exploded(keyed, "phones")
    return ordered_union(items, normalize_phone(F.col("raw"), region), "phones")
