"""Field and overall confidence.

Per-record contribution flags are folded into one partial aggregation per
entity (max score and count of contributing records per field), joined to
the golden row by entity key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec.operators.claims import with_score
from goldrec.sources.dims import FIELD_IMPORTANCE

# Raw keys whose truthy value means a record contributed to a golden field.
CONTRIBUTING_KEYS = {
    "full_name": ["full_name"],
    "emails": ["emails"],
    "phones": ["phones"],
    "headline": ["headline"],
    "location": ["location_raw", "city", "country"],
    "years_experience": ["years_experience"],
    "skills": ["skills_raw"],
    "experience": ["experience_raw"],
    "education": ["education_raw", "education_text"],
    "links": ["linkedin", "github", "portfolio"],
}
_ARRAYS = {"emails", "phones", "skills_raw", "experience_raw", "education_raw"}


def _truthy(key: str) -> Column:
    c = F.col(f"fields.{key}")
    if key in _ARRAYS:
        return c.isNotNull() & (F.size(c) > 0)
    if key == "years_experience":
        return c.isNotNull() & (c != 0)
    return c.isNotNull() & (c != "")


def contributed(field: str) -> Column:
    """did the record contribute to ``field``?"""
    flags = [_truthy(k) for k in CONTRIBUTING_KEYS[field]]
    out = flags[0]
    for f in flags[1:]:
        out = out | f
    return out


def stats_state(keyed: DataFrame) -> DataFrame:
    """entity_key, n_records, best_<field>, n_<field>, raw-list flags and the first record with a raw
    location - all in one partial aggregation per entity, and mergeable (``merged_stats``)."""
    scored = with_score(keyed)
    aggs = [F.count(F.lit(1)).alias("n_records")]
    for field, _ in FIELD_IMPORTANCE:
        flag = contributed(field)
        aggs.append(F.max(F.when(flag, F.col("score"))).alias(f"best_{field}"))
        aggs.append(F.count_if(flag).alias(f"n_{field}"))
    for lst in ("emails", "phones"):
        has = F.exists(F.coalesce(F.col(f"fields.{lst}"), F.array()), lambda x: x.isNotNull() & (x != ""))
        aggs.append(F.max(has).alias(f"has_raw_{lst}"))
    loc = F.col("fields.location_raw")
    aggs.append(F.min(F.when(loc.isNotNull() & (loc != ""), F.struct("source_rank", "record_id", "source"))).alias("located"))
    return scored.groupBy("entity_key").agg(*aggs)


def merged_stats(states: DataFrame) -> DataFrame:
    """``stats_state`` of all records from those of parts of them."""
    aggs = [F.sum("n_records").alias("n_records")]
    for field, _ in FIELD_IMPORTANCE:
        aggs += [F.max(f"best_{field}").alias(f"best_{field}"), F.sum(f"n_{field}").alias(f"n_{field}")]
    aggs += [F.max(c).alias(c) for c in ("has_raw_emails", "has_raw_phones")]
    return states.groupBy("entity_key").agg(*aggs, F.min("located").alias("located"))


def stats_of(state: DataFrame) -> DataFrame:
    """The state with the best location source."""
    return state.withColumn("location_raw_best_source", F.col("located.source")).drop("located")


def record_stats(keyed: DataFrame) -> DataFrame:
    """What the golden row takes from its records as a whole, one row an entity."""
    return stats_of(stats_state(keyed))


def populated(field: str) -> Column:
    """F6 on a golden row."""
    c = F.col(field)
    if field in ("emails", "phones", "skills", "experience", "education"):
        return c.isNotNull() & (F.size(c) > 0)
    if field == "location":
        return c.isNotNull() & (c["city"].isNotNull() | c["region"].isNotNull() | c["country"].isNotNull())
    return c.isNotNull()


def _truthy_golden(field: str) -> Column:
    c = F.col(field)
    if field == "years_experience":
        return c.isNotNull() & (c != 0)
    return populated(field)


def field_score(field: str) -> Column:
    """Best contributing score (0.5 if untraceable) + min(.15, .05 (n-1)), capped at 1, 4 digits."""
    best = F.coalesce(F.col(f"best_{field}"), F.lit(0.0))
    best = F.when((best == 0.0) & _truthy_golden(field), F.lit(0.5)).otherwise(best)
    n = F.coalesce(F.col(f"n_{field}"), F.lit(0))
    bonus = F.least(F.lit(0.15), F.lit(0.05) * F.greatest(F.lit(0), n - 1))
    return F.when(~populated(field), F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.round(best + bonus, 4)))


def overall(field_scores: dict[str, Column], n_records: Column) -> Column:
    """Importance-weighted mean over all fields; x0.9 for a single source; 4 digits."""
    total_w = sum(w for _, w in FIELD_IMPORTANCE)
    weighted = None
    for field, w in FIELD_IMPORTANCE:
        term = field_scores[field] * F.lit(w)
        weighted = term if weighted is None else weighted + term
    raw = weighted / F.lit(total_w)
    raw = F.when(n_records == 1, raw * 0.9).when(n_records == 0, F.lit(0.0)).otherwise(raw)
    return F.round(F.least(F.lit(1.0), raw), 4)


def confidence_columns() -> list[Column]:
    """``conf_<field>`` and ``overall_confidence`` over golden columns joined with ``record_stats``."""
    scores = {f: field_score(f) for f, _ in FIELD_IMPORTANCE}
    out = [scores[f].alias(f"conf_{f}") for f, _ in FIELD_IMPORTANCE]
    out.append(overall(scores, F.coalesce(F.col("n_records"), F.lit(0))).alias("overall_confidence"))
    return out
