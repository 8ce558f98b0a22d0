"""Survivorship merge: keyed source records -> one golden row per entity.

One pass over the records lists all their values as rows: scalar claims,
e-mails, phones, skills and history items alike.  The first aggregation makes
one row of each distinct value of an entity (combined before the shuffle, so
an entity with a third of all records sends one row a value and task); the
second gathers an entity's values, from which the golden row is a projection.
Only the record statistics and the skills' sources are aggregated beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.functions.locations import assemble_location
from goldrec.functions.phones import normalize_phone
from goldrec.functions.strings import entity_id, py_strip
from goldrec.operators import claims as C
from goldrec.operators.confidence import confidence_columns, record_stats
from goldrec.operators.history import education_key, education_norm, experience_key, experience_norm
from goldrec.operators.skills import canonical_skills, skill_bonus, skill_items, skill_sources
from goldrec.schemas import EDUCATION_ITEM, EXPERIENCE_ITEM, GOLDEN

SKILLS_METHOD = "skill_normalizer+fuzzy"
_PROV = "array<struct<field:string,source:string,method:string>>"
_EXP, _EDU = EXPERIENCE_ITEM.simpleString(), EDUCATION_ITEM.simpleString()


def _row(part: str, k1: Column, pos: Column | None = None, k2: Column | None = None, raw: Column | None = None, exp: Column | None = None, edu: Column | None = None) -> Column:
    def of(value: Column | None, kind: str) -> Column:
        return (F.lit(None) if value is None else value).cast(kind)

    return F.struct(
        F.lit(part).alias("part"), k1.alias("k1"), of(k2, "string").alias("k2"), (F.lit(0) if pos is None else pos).alias("pos"),
        of(raw, "string").alias("raw"), of(exp, _EXP).alias("exp"), of(edu, _EDU).alias("edu"),
    )


def record_values(keyed: DataFrame, region: str, dictionary: DataFrame | None = None) -> DataFrame:
    """entity_key, record columns, part, k1, k2, pos, raw, name, confidence, exp, edu: every value of every record.

    Narrow, unless skills are looked up in a ``dictionary`` (pos, name).
    """

    def field(name: str) -> Column:
        return F.col(f"fields.{name}")

    def listed(name: str, row) -> Column:
        return F.coalesce(F.transform(field(name), row), F.array())

    scalars = F.array(*[_row(f, field(f).cast("string")) for f in C.CLAIM_FIELDS])
    emails = listed("emails", lambda x, i: _row("emails", F.lower(py_strip(x)), i))
    phones = listed("phones", lambda x, i: _row("phones", normalize_phone(x, region), i))
    skills = listed("skills_raw", lambda x, i: _row("skills", x, i, raw=x))
    jobs = F.transform(F.filter(F.transform(field("experience_raw"), lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda y: y["x"].isNotNull()),
                       lambda y: F.struct(experience_norm(y["x"]).alias("v"), y["i"].alias("i")))
    jobs = F.coalesce(F.transform(jobs, lambda y: _row("experience", experience_key(y["v"])[0], y["i"], experience_key(y["v"])[1], exp=y["v"])), F.array())
    schools = F.transform(F.filter(F.transform(field("education_raw"), lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda y: y["x"].isNotNull()),
                          lambda y: F.struct(education_norm(y["x"]).alias("v"), y["i"].alias("i")))
    schools = F.coalesce(F.transform(schools, lambda y: _row("education", education_key(y["v"])[0], y["i"], education_key(y["v"])[1], edu=y["v"])), F.array())
    rows = C.with_score(keyed).select(
        "entity_key", "record_id", "source", "score", "source_rank", F.inline(F.concat(scalars, emails, phones, skills, jobs, schools))
    )
    listed_parts = F.col("part").isin("emails", "phones", "skills")
    rows = rows.where(F.col("k1").isNotNull() & (~listed_parts | (F.col("k1") != "")))
    if dictionary is None:
        rows = canonical_skills(rows).drop("method")
    else:
        skills = canonical_skills(rows.where("part = 'skills'"), dictionary=dictionary).drop("method")
        others = rows.where("part <> 'skills'").withColumns({"name": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})
        rows = skills.unionByName(others)
    return rows.withColumn("k1", F.when(F.col("part") == "skills", F.lower("name")).otherwise(F.col("k1")))


def distinct_values(rows: DataFrame) -> DataFrame:
    """One row per entity, part and value: how many agree, the best and the first occurrence, the claims on it."""
    rank = F.when(F.col("part") == "skills", -F.col("confidence")).when(F.col("part").isin(C.CLAIM_FIELDS), -F.col("score")).otherwise(F.lit(0.0))
    return rows.groupBy("entity_key", "part", "k1", "k2").agg(
        F.count("*").alias("agree"),
        F.min(F.struct(rank.alias("rank"), "source_rank", "record_id", "pos", "source", "name", "confidence", "exp", "edu")).alias("top"),
        F.min(F.struct("source_rank", "record_id", "pos")).alias("first"),
        F.collect_set(F.when(F.col("part").isin(C.CLAIM_FIELDS), F.struct((-F.col("score")).alias("s"), F.col("source_rank").alias("r"), F.col("source").alias("src")))).alias("claims"),
    )


def _of(part: str) -> Column:
    return F.filter("parts", lambda p: p["part"] == part)


def _winner(part: str) -> Column:
    """The value with the best score, then most agreement, then the first source and record."""
    ranked = F.transform(
        _of(part),
        lambda p: F.struct(
            p["top"]["rank"].alias("rank"), (-p["agree"]).alias("agree"), p["top"]["source_rank"].alias("r"), p["top"]["record_id"].alias("id"),
            p["k1"].alias("value"), p["top"]["source"].alias("source"),
        ),
    )
    return F.array_min(ranked)


def _entry(field: Column, source: Column, method: Column) -> Column:
    return F.struct(field.alias("field"), source.alias("source"), method.alias("method"))


def _scalar_provenance(part: str) -> Column:
    """The winner of ``part`` (column w_<part>), then the claims on other values by score, source rank and source."""
    w = F.col(f"w_{part}")
    won = F.array(_entry(F.lit(part), w["source"], C.method_text(-w["rank"])))
    lost = F.flatten(F.transform(F.filter(_of(part), lambda p: p["k1"] != w["value"]), lambda p: p["claims"]))
    lost = F.transform(F.array_sort(F.array_distinct(lost)), lambda c: _entry(F.lit(f"{part}[alt]"), c["src"], C.method_text(-c["s"])))
    return F.when(w.isNotNull(), F.concat(won, lost)).otherwise(F.array().cast(_PROV))


def _ordered(part: str, item) -> Column:
    """The values of ``part`` in order of first occurrence."""
    placed = F.array_sort(F.transform(_of(part), lambda p: F.struct(p["first"].alias("o"), p["k1"].alias("k1"), p["top"].alias("top"))))
    return F.transform(placed, item)


def _one(cond, field, source, method):
    return F.when(cond, F.array(_entry(F.lit(field), source, F.lit(method)))).otherwise(F.array().cast(_PROV))


def _skill(srcs: Column):
    def item(p: Column) -> Column:
        sources = F.coalesce(F.try_element_at(srcs, p["k1"]), F.array(F.lit("merged")))
        confidence = F.round(F.least(F.lit(1.0), p["top"]["confidence"] + skill_bonus(sources)), 4)
        return F.struct(p["top"]["name"].alias("name"), confidence.alias("confidence"), sources.alias("sources"))

    return item


def merge_records(spark: SparkSession, keyed: DataFrame, region: str = "US", dictionary: DataFrame | None = None) -> DataFrame:
    """G1: entity_key + the golden columns (``schemas.GOLDEN``) + ``conf_<field>`` scores.

    ``dictionary`` (pos, name): the skills dictionary to use in place of the built-in one.
    """
    values = distinct_values(record_values(keyed, region, dictionary))
    return assemble_golden(record_stats(keyed), values, skill_rows(keyed, dictionary))


def skill_rows(keyed: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """entity_key, raw, key (the canonical skill, lower-case), source of every skill of every record; lists no other value."""
    return skill_items(keyed.sparkSession, keyed, dictionary).select("entity_key", "raw", F.lower("name").alias("key"), "source")


def assemble_golden(stats: DataFrame, values: DataFrame, skills: DataFrame) -> DataFrame:
    """Golden rows from ``record_stats``, ``distinct_values`` and ``skill_rows``."""
    parts = values.groupBy("entity_key").agg(F.collect_list(F.struct("part", "k1", "agree", "top", "first", "claims")).alias("parts"))
    srcs = skill_sources(skills)
    srcs = srcs.groupBy("entity_key").agg(F.map_from_entries(F.collect_list(F.struct("key", "srcs"))).alias("srcs"))
    g = stats.join(parts, "entity_key", "left").join(srcs, "entity_key", "left")
    g = g.withColumn("parts", F.coalesce("parts", F.array()))
    g = g.select("*", *[_winner(f).alias(f"w_{f}") for f in C.CLAIM_FIELDS])

    def won(f: str) -> Column:
        return F.col(f"w_{f}.value")

    g = g.select(
        *stats.columns,
        won("full_name").alias("full_name"),
        _ordered("emails", lambda p: p["k1"]).alias("emails"),
        _ordered("phones", lambda p: p["k1"]).alias("phones"),
        assemble_location(won("location_raw"), won("city"), won("region"), won("country")).alias("location"),
        F.struct(*[won(f).alias(f) for f in ("linkedin", "github", "portfolio")], F.array().cast("array<string>").alias("other")).alias("links"),
        won("headline").alias("headline"),
        won("years_experience").try_cast("double").alias("years_experience"),
        _ordered("skills", _skill(F.coalesce("srcs", F.create_map().cast("map<string,array<string>>")))).cast(GOLDEN["skills"].dataType).alias("skills"),
        _ordered("experience", lambda p: p["top"]["exp"]).alias("experience"),
        _ordered("education", lambda p: p["top"]["edu"]).alias("education"),
        F.concat(*[_scalar_provenance(f) for f in C.WINNER_FIELDS]).alias("prov_winners"),
        F.concat(*[_scalar_provenance(f) for f in C.LOCATION_FIELDS]).alias("prov_location"),
    )
    placed = F.col("location.city").isNotNull() | F.col("location.region").isNotNull() | F.col("location.country").isNotNull()
    provenance = F.concat(
        "prov_winners",
        _one(F.coalesce(F.col("has_raw_emails"), F.lit(False)), "emails", F.lit("merged"), "union"),
        _one(F.coalesce(F.col("has_raw_phones"), F.lit(False)), "phones", F.lit("merged"), "union"),
        "prov_location",
        _one(placed, "location", F.coalesce(F.col("location_raw_best_source"), F.lit("merged")), "location_normalizer"),
        _one(F.size("skills") > 0, "skills", F.lit("merged"), SKILLS_METHOD),
        _one(F.size("experience") > 0, "experience", F.lit("merged"), "union+dedup"),
        _one(F.size("education") > 0, "education", F.lit("merged"), "union+dedup"),
    )
    seed = F.coalesce(F.get(F.col("emails"), 0), F.col("full_name"), F.col("entity_key"))
    return g.select(
        "entity_key",
        entity_id(seed).alias("candidate_id"),
        "full_name", "emails", "phones", "location", "links", "headline", "years_experience",
        "skills", "experience", "education",
        provenance.alias("provenance"),
        *confidence_columns(),
    )
