"""Field claims and survivorship of scalar fields.

``field_claims`` is the long form of all scalar values: one row per
(entity, field, record) with the record's score.  Winners are chosen by two
aggregations that both combine map-side (``min_by`` is partial-aggregated), so
an entity holding millions of records never lands in one task as raw rows:

1. per (entity, field, value): how many records agree, and the best claim;
2. per (entity, field): the best value by (score desc, agreement desc,
   source rank, record id).

That ordering is the "stable sort by score" of the single-record version with
a majority tie-break for records of equal score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.sources.dims import (
    DEFAULT_CERTAINTY,
    source_rank_expr,
    source_weight_expr,
)

# Scalar fields decided by pick-winner, in provenance order.
WINNER_FIELDS = [
    "full_name", "headline", "current_company", "years_experience",
    "linkedin", "github", "portfolio", "summary",
]
LOCATION_FIELDS = ["location_raw", "city", "region", "country"]
CLAIM_FIELDS = WINNER_FIELDS + LOCATION_FIELDS

# Order of provenance entries by field.
PROVENANCE_ORDER = WINNER_FIELDS + ["emails", "phones"] + LOCATION_FIELDS + [
    "location", "skills", "experience", "education",
]


def with_score(records: DataFrame) -> DataFrame:
    """score = source weight x extraction certainty; source_rank orders sources by weight."""
    cert = F.coalesce(F.col("extraction_confidence"), F.lit(DEFAULT_CERTAINTY))
    return records.withColumn("score", source_weight_expr(F.col("source")) * cert).withColumn(
        "source_rank", source_rank_expr(F.col("source"))
    )


def field_claims(keyed: DataFrame, fields: list[str] = CLAIM_FIELDS) -> DataFrame:
    """Unpivot scalar fields: entity_key, field, value, source, score, source_rank, record_id.

    Narrow (no shuffle): one ``inline`` per record.  Null values make no claim.
    """
    scored = with_score(keyed)
    arr = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f"fields.{f}").cast("string").alias("value")) for f in fields]
    )
    return (
        scored.select("entity_key", "record_id", "source", "score", "source_rank", F.inline(arr))
        .where(F.col("value").isNotNull())
        .select("entity_key", "field", "value", "source", "score", "source_rank", "record_id")
    )


def pick_winners(claims: DataFrame) -> DataFrame:
    """entity_key, field, value, source, score, agree, record_id (one row per entity and field)."""
    best_claim = F.struct("source", "score", "source_rank", "record_id")
    order = F.struct(-F.col("score"), F.col("source_rank"), F.col("record_id"))
    per_value = claims.groupBy("entity_key", "field", "value").agg(
        F.count(F.lit(1)).alias("agree"), F.min_by(best_claim, order).alias("best")
    )
    order2 = F.struct(-F.col("best.score"), -F.col("agree"), F.col("best.source_rank"), F.col("best.record_id"))
    winners = per_value.groupBy("entity_key", "field").agg(
        F.min_by(F.struct("value", "agree", "best"), order2).alias("w")
    )
    return winners.select(
        "entity_key",
        "field",
        F.col("w.value").alias("value"),
        F.col("w.best.source").alias("source"),
        F.col("w.best.score").alias("score"),
        F.col("w.agree").alias("agree"),
        F.col("w.best.record_id").alias("record_id"),
    )


def alternatives(claims: DataFrame, winners: DataFrame) -> DataFrame:
    """Every (entity, field, source, score) whose value differs from the winner.

    Claims are reduced to distinct (entity, field, value, source, score) before
    the join, so repeated values of a hot entity collapse map-side.
    """
    distinct_claims = claims.select("entity_key", "field", "value", "source", "score", "source_rank").distinct()
    w = winners.select("entity_key", "field", F.col("value").alias("winner_value"))
    return (
        distinct_claims.join(w, ["entity_key", "field"])
        .where(F.col("value") != F.col("winner_value"))
        .select("entity_key", "field", "source", "score", "source_rank")
        .distinct()
    )


def method_text(score_col) -> "F.Column":
    return F.format_string("priority_score=%.3f", score_col)
