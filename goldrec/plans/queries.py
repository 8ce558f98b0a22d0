"""Registered queries (Spark) and their DuckDB oracles.

Each query takes ``(spark, sf_dir)``, reads the driver's tables, and returns
a DataFrame with flat, explicitly named columns.  Lists are returned joined
by ``|`` so the check can hash them the same way in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.functions import dates as D
from goldrec.functions import text as X
from goldrec.functions.locations import normalize_location
from goldrec.functions.phones import normalize_phones
from goldrec.functions.strings import entity_id
from goldrec.operators import claims as C
from goldrec.operators.history import dedup_items, education_items_from, experience_items_from
from goldrec.operators.lists import union_emails, union_phones
from goldrec.operators.merge import merge_records
from goldrec.operators.resolve import resolve
from goldrec.operators.skills import canonical_skills
from goldrec.plans.derive import customer_records, customer_records_with_orphans
from goldrec.plans.exports import QUERIES as _EXPORTS
from goldrec.plans.jobs import QUERIES as _JOBS
from goldrec.plans.people import QUERIES as _PEOPLE
from goldrec.plans.texts import notes_fields, resume_fields
from goldrec.sources.dims import SKILLS, literal_array

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _keyed(spark, sf_dir, orphans=False, fallback=False, materialize=None):
    """Keyed source records.  After E6 matching the result feeds seven aggregations;
    a reliable checkpoint (shared ``spark.checkpoint.dir``) computes the matching
    once and gives every part a small plan to start from."""
    recs = customer_records_with_orphans(spark, sf_dir) if orphans else customer_records(spark, sf_dir)
    mat = fallback if materialize is None else materialize
    keyed = resolve(recs, fallback=fallback, materialize=mat)
    if mat:
        from goldrec.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(spark)
        keyed = keyed.checkpoint(eager=True)
    return keyed


def _join(c):
    return F.array_join(c, "|")


def _items(column, fields):
    return _join(F.transform(column, lambda x: F.array_join(F.array(*[F.coalesce(x[f].cast("string"), F.lit("")) for f in fields]), ";")))


# --- survivorship ----------------------------------------------------------


def field_winners(spark, sf_dir):
    """One winning value per (entity, scalar field)."""
    w = C.pick_winners(C.field_claims(_keyed(spark, sf_dir)))
    return w.select("entity_key", "field", "value", "source", F.round("score", 6).alias("score"), "agree", "record_id")


def field_alternatives(spark, sf_dir):
    """Losing (field[alt], source, method) entries."""
    cl = C.field_claims(_keyed(spark, sf_dir))
    alts = C.alternatives(cl, C.pick_winners(cl))
    return alts.select(
        "entity_key", F.concat("field", F.lit("[alt]")).alias("field"), "source", C.method_text(F.col("score")).alias("method")
    )


def union_lists(spark, sf_dir):
    """Ordered unions of e-mails and E.164 phones."""
    k = _keyed(spark, sf_dir)
    return union_emails(k).join(union_phones(k), "entity_key", "full").select(
        "entity_key", _join("emails").alias("emails"), _join("phones").alias("phones")
    )


def entity_ids(spark, sf_dir):
    """Candidate id of every entity from its primary e-mail."""
    k = _keyed(spark, sf_dir)
    return union_emails(k).select("entity_key", entity_id(F.get("emails", 0)).alias("candidate_id"))


def golden_confidence(spark, sf_dir):
    """F6/F7/G12/G13 over the merged customers (all golden parts computed)."""
    g = merge_records(spark, _keyed(spark, sf_dir, materialize=True))
    return g.select("entity_key", *[c for c in g.columns if c.startswith("conf_")], "overall_confidence")


def golden_records(spark, sf_dir):
    """G1 flagship: the full golden record per entity, lists flattened."""
    g = merge_records(spark, _keyed(spark, sf_dir, orphans=True, fallback=True))
    skills = F.transform("skills", lambda s: F.concat_ws(":", s["name"], s["confidence"].cast("string"), F.array_join(s["sources"], "+")))
    prov = F.transform("provenance", lambda p: F.concat_ws(":", p["field"], p["source"], p["method"]))
    return g.select(
        "entity_key", "candidate_id", "full_name", _join("emails").alias("emails"), _join("phones").alias("phones"),
        F.col("location.city").alias("city"), F.col("location.region").alias("region"),
        F.col("location.country").alias("country"), F.col("links.linkedin").alias("linkedin"),
        F.col("links.github").alias("github"), F.col("links.portfolio").alias("portfolio"), "headline", "years_experience",
        _join(skills).alias("skills"), _items("experience", ["company", "title", "start", "end"]).alias("experience"),
        _items("education", ["institution", "degree", "field", "end_year"]).alias("education"),
        _join(prov).alias("provenance"), "overall_confidence",
    )


def match_fallback(spark, sf_dir):
    """Entity key of every record, e-mail-less ones matched by phone + name."""
    k = resolve(customer_records_with_orphans(spark, sf_dir), fallback=True, materialize=True)
    return k.select("record_id", "entity_key")


# --- column normalisers ----------------------------------------------------


def _date_raw(o):
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    style = k % 8
    return (
        F.when(style == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(style == 1, F.date_format(d, "MMM yyyy"))
        .when(style == 2, F.date_format(d, "MMMM yyyy"))
        .when(style == 3, F.date_format(d, "MM/yyyy"))
        .when(style == 4, F.date_format(d, "yyyy/MM"))
        .when(style == 5, F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "), F.year(d).cast("string")))
        .when(style == 6, F.date_format(d, "yyyy"))
        .when(k % 16 == 7, F.lit("TBD"))
        .otherwise(F.date_format(d, "yyyy MMM"))
    )


def dates_normalized(spark, sf_dir):
    """Order dates written eight ways, normalised to YYYY-MM and year."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    o = o.select("o_orderkey", _date_raw(o).alias("raw"))
    return o.select("o_orderkey", "raw", D.normalize_date(F.col("raw")).alias("month"), D.normalize_year(F.col("raw")).alias("year"))


LOCATION_EXTRAS = [
    "Austin, TX", "Pune - India", "XYZ123", "", "Bengaluru, Karnataka, India", "GB", "usa",
    "Lyon, Rhone, France", "Springfield, Nowhere", "London", "CA", "Berlin – Germany",
]


def _location_raw():
    k = F.col("c_custkey")
    from goldrec.plans.derive import PLACES

    place = F.element_at(literal_array(PLACES), (F.col("c_nationkey") % len(PLACES)).cast("int") + 1)
    extra = F.element_at(literal_array(LOCATION_EXTRAS), (k % len(LOCATION_EXTRAS)).cast("int") + 1)
    return F.when(k % 4 == 0, place).when(k % 4 == 1, F.upper(place)).when(k % 4 == 2, extra)


def locations(spark, sf_dir):
    """Location strings from customers' nations -> city, region, ISO country."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", _location_raw().alias("raw"))
    loc = normalize_location(F.col("raw"))
    return c.select("c_custkey", "raw", loc["city"].alias("city"), loc["region"].alias("region"), loc["country"].alias("country"))


def _skill_raw():
    k = F.col("p_partkey")
    s = F.element_at(literal_array(SKILLS), (k % len(SKILLS)).cast("int") + 1)
    toks = F.split(s, " ")
    v = k % 7
    return (
        F.when(v == 0, s)
        .when(v == 1, F.lower(s))
        .when(v == 2, F.concat(s, F.lit("s")))
        .when(v == 3, F.substring(s, 2, 1000))
        .when(v == 4, F.concat(F.upper(s), F.lit(" ")))
        .when(v == 5, F.col("p_name"))
        .otherwise(F.array_join(F.reverse(toks), " "))
    )


def skills_normalized(spark, sf_dir):
    """Part-derived raw skills -> canonical name and confidence."""
    p = _t(spark, sf_dir, "part").select("p_partkey", _skill_raw().alias("raw"))
    return canonical_skills(p).select("p_partkey", "raw", "name", "confidence")


def doc_contacts(spark, sf_dir):
    """C1/C2/C3/D3/D4 over ``documents.text``."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "text")
    spans = X.phone_spans(F.col("text"))
    return d.select(
        "doc_id",
        _join(X.emails(F.col("text"))).alias("emails"),
        _join(spans).alias("phone_spans"),
        _join(normalize_phones(spans)).alias("phones"),
        X.linkedin(F.col("text")).alias("linkedin"),
        X.github(F.col("text")).alias("github"),
    )


def page_links(spark, sf_dir):
    """C1/C3 over raw web pages."""
    p = _t(spark, sf_dir, "pages").select("page_id", "html")
    return p.select(
        "page_id",
        _join(X.emails(F.col("html"))).alias("emails"),
        X.linkedin(F.col("html")).alias("linkedin"),
        X.github(F.col("html")).alias("github"),
    )


def notes_extract(spark, sf_dir):
    """C5/C8/C12/C13/C14 (notes extraction) over conversation turns."""
    c = _t(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    t = F.col("text")
    return c.select(
        "conv_id", "turn",
        X.name_from_label(t).alias("full_name"),
        _join(X.skills_labels(t)).alias("skills"),
        X.stated_years(t).alias("years_experience"),
        X.company_mention(t).alias("current_company"),
        F.length(X.snippet(t, 500)).alias("notes_len"),
    )


def resume_extract(spark, sf_dir, as_of_year: int = 2026):
    """C4/C6/C7/C11 (resume extraction) over documents."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "text")
    t = F.col("text")
    name = X.name_from_lines(t)
    return d.select(
        "doc_id",
        name.alias("full_name"),
        X.headline(t, name).alias("headline"),
        _join(X.skills_section(t)).alias("skills"),
        X.sum_year_ranges(t, as_of_year).alias("years_experience"),
    )


#: Lines of orders that a task joins and makes items of.
LINES_A_TASK = 200_000


def _history_items(spark, sf_dir, lines=LINES_A_TASK):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate")
    tasks = -(-li.count() // lines)
    if tasks > spark.sparkContext.defaultParallelism:  # fewer rows are cut finer by Spark itself
        li, o = li.repartition(tasks, "l_orderkey"), o.repartition(tasks, "o_orderkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    src = F.when(F.col("l_linenumber") % 2 == 0, F.lit("ats")).otherwise(F.lit("resume"))
    return j.select(
        F.concat(F.lit("customer"), F.col("o_custkey").cast("string"), F.lit("@example.com")).alias("entity_key"),
        src.alias("source"),
        F.concat(src, F.lit("-"), F.col("o_custkey").cast("string")).alias("record_id"),
        (F.col("o_orderkey") * 100 + F.col("l_linenumber")).alias("pos"),
        F.struct(
            F.concat(F.lit("Supplier "), (F.col("l_suppkey") % 20).cast("string")).alias("company"),
            F.concat(F.lit("Line "), F.col("l_linenumber").cast("string")).alias("title"),
            F.date_format("o_orderdate", "MMM yyyy").alias("start"),
            F.date_format("l_shipdate", "yyyy-MM").alias("end"),
            F.lit(None).cast("string").alias("summary"),
        ).alias("exp"),
        F.struct(
            F.concat(F.lit("University "), (F.col("l_suppkey") % 13).cast("string")).alias("institution"),
            F.col("o_orderpriority").alias("degree"),
            F.col("o_orderstatus").alias("field"),
            F.year("o_orderdate").cast("string").alias("end_year"),
        ).alias("edu"),
    )


def history_dedup(spark, sf_dir):
    """Experience items from orders x lineitem, one per (company, start) and customer."""
    it = experience_items_from(_history_items(spark, sf_dir), "exp")
    d = dedup_items(it)
    return d.select("entity_key", F.col("item.company").alias("company"), F.col("item.title").alias("title"),
                    F.col("item.start").alias("start"), F.col("item.end").alias("end"))


def education_dedup(spark, sf_dir):
    """Education items, one per (institution, degree) and customer."""
    it = education_items_from(_history_items(spark, sf_dir), "edu")
    d = dedup_items(it)
    return d.select("entity_key", F.col("item.institution").alias("institution"), F.col("item.degree").alias("degree"),
                    F.col("item.field").alias("field"), F.col("item.end_year").alias("end_year"))


QUERIES: dict[str, Query] = {
    "golden_records": golden_records,
    "field_winners": field_winners,
    "field_alternatives": field_alternatives,
    "union_lists": union_lists,
    "entity_ids": entity_ids,
    "golden_confidence": golden_confidence,
    "match_fallback": match_fallback,
    "dates_normalized": dates_normalized,
    "locations": locations,
    "skills_normalized": skills_normalized,
    "doc_contacts": doc_contacts,
    "page_links": page_links,
    "notes_extract": notes_extract,
    "resume_extract": resume_extract,
    "history_dedup": history_dedup,
    "education_dedup": education_dedup,
}


# --- projection and validation -----------------------------------------------

CONTACT_CONFIG = {
    "fields": [
        {"path": "person", "from": "full_name", "required": True},
        {"path": "mail", "from": "emails[0]"},
        {"path": "phone.e164", "from": "phones[0]", "normalize": "E164"},
        {"path": "reachable", "from": "phones", "type": "boolean"},
        {"path": "job", "from": "headline"},
        {"path": "years", "from": "years_experience", "type": "number"},
        {"path": "location.country"},
    ],
    "include_confidence": False,
    "on_missing": "null",
}

CUSTOM_CONFIG = {
    "fields": [
        {"path": "person", "from": "full_name"},
        {"path": "mails", "from": "emails", "type": "string[]"},
        {"path": "tools", "from": "skills[].name", "type": "string[]", "normalize": "canonical"},
        {"path": "overall_confidence", "type": "number"},
        {"path": "country", "from": "location.country"},
    ],
    "include_confidence": True,
    "on_missing": "omit",
}


def projected_contact(spark, sf_dir):
    """P1/P2/P3(E164)/P4(null)/P5: contact fields of the golden records, two of them with dots in their names."""
    from goldrec.operators.project import project

    p = project(spark, merge_records(spark, _keyed(spark, sf_dir, materialize=True)), CONTACT_CONFIG)
    return p.toDF(*[c.replace(".", "_") for c in p.columns])


def projected_custom(spark, sf_dir):
    """P1-P6 with skill canonicalisation and confidence columns; null fields left out of the JSON text (P4 omit)."""
    from goldrec.operators.project import project

    p = project(spark, merge_records(spark, _keyed(spark, sf_dir, materialize=True)), CUSTOM_CONFIG)
    omitted = F.to_json(F.struct("person", "country"), {"ignoreNullFields": "true"})
    return p.select(
        "entity_key", "person", _join("mails").alias("mails"), _join("tools").alias("tools"), "overall_confidence", "country",
        F.size("provenance").alias("n_provenance"), (F.size(F.json_object_keys(omitted))).alias("n_fields"),
    )


def violations_report(spark, sf_dir):
    """V1/V3/S3: golden rows with injected faults -> violation rows in report order."""
    from goldrec.operators.quality import sort_violations, validate

    g = merge_records(spark, _keyed(spark, sf_dir, materialize=True))
    k = F.regexp_extract("entity_key", r"^customer([0-9]+)@", 1).try_cast("long")
    bad_prov = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit("x").alias("source"), F.lit("y").alias("method")))
    g = (
        g.withColumn("overall_confidence", F.when(k % 11 == 0, F.lit(1.5)).otherwise(F.col("overall_confidence")))
        .withColumn("candidate_id", F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("candidate_id")))
        .withColumn("emails", F.when(k % 17 == 0, F.concat(F.array(F.lit(None).cast("string")), F.col("emails"))).otherwise(F.col("emails")))
        .withColumn("provenance", F.when(k % 19 == 0, F.concat(bad_prov, F.col("provenance"))).otherwise(F.col("provenance")))
    )
    return sort_violations(validate(g))


QUERIES.update({
    "projected_contact": projected_contact,
    "projected_custom": projected_custom,
    "violations_report": violations_report,
})


def events_winner(spark, sf_dir):
    """G2/W1 on ``events``: per user, the prevailing ``props.k`` across event records.

    Event types act as sources of equal (default) weight, so the majority of
    agreeing records decides, then the smallest record id.
    """
    from goldrec.schemas import fields_struct

    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    keyed = ev.select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("entity_key"),
        F.concat(F.lit("ev-"), F.col("event_id").cast("string")).alias("record_id"),
        F.col("event_type").alias("source"),
        F.lit(None).cast("double").alias("extraction_confidence"),
        fields_struct(headline=F.get_json_object("props", "$.k")).alias("fields"),
    )
    w = C.pick_winners(C.field_claims(keyed, ["headline"]))
    return w.select("entity_key", F.col("value").alias("k"), "source", "agree", "record_id")


QUERIES["events_winner"] = events_winner


# --- ingest mappings -----------------------------------------------------------


def _csv_like(spark, sf_dir):
    """A CSV-shaped table from customer: header spellings, ';'-lists, blanks, bad numbers."""
    from goldrec.plans.derive import PLACES

    k = F.col("c_custkey")
    tail = F.lpad((k % 10000).cast("string"), 4, "0")
    place = F.element_at(literal_array(PLACES), (F.col("c_nationkey") % len(PLACES)).cast("int") + 1)
    c = _t(spark, sf_dir, "customer")
    return c.select(
        k.alias("row_key"),
        F.when(k % 9 == 0, F.lit("")).otherwise(F.col("c_name")).alias(" Name "),
        F.when((k % 9 == 0) & (k % 2 == 0), F.lit(" ")).otherwise(
            F.concat(F.lit("c"), k.cast("string"), F.lit("@x.com; d"), k.cast("string"), F.lit("@y.org ;;"))).alias("EMAIL"),
        F.concat(F.lit("+1 415 555 "), tail, F.lit("; junk ")).alias("Phone"),
        F.col("c_mktsegment").alias("Job Title"),
        F.lit("Python, SQL;Go ,,").alias("Skills"),
        F.when(k % 4 == 0, F.lit("n/a")).otherwise((k % 30).cast("string")).alias("Years Exp"),
        place.alias("Location"),
        F.when(k % 5 == 0, F.concat(F.lit("Alt "), F.col("c_name"))).otherwise(F.lit("")).alias("Full Name"),
    )


def csv_mapping(spark, sf_dir):
    """Header aliases (last non-blank wins), list cells, tolerant numbers, identity gate."""
    from goldrec.sources.files import identity_gate, map_csv_fields

    raw = _csv_like(spark, sf_dir)
    rec = raw.select("row_key", map_csv_fields(raw.drop("row_key")).alias("fields"))
    rec = identity_gate(rec)
    f = F.col("fields")
    return rec.select(
        "row_key", f["full_name"].alias("full_name"), _join(f["emails"]).alias("emails"),
        _join(f["phones"]).alias("phones"), f["headline"].alias("headline"), _join(f["skills_raw"]).alias("skills"),
        f["years_experience"].alias("years_experience"), f["location_raw"].alias("location_raw"),
    )


def _ats_json(spark, sf_dir):
    """JSON documents from customer in four shapes (enveloped, split name, top-level array, invalid)."""
    k = F.col("c_custkey")
    ks = k.cast("string")
    email = F.concat(F.lit("customer"), ks, F.lit("@example.com"))
    phone = F.concat(F.lit("+1 415 555 "), F.lpad((k % 10000).cast("string"), 4, "0"))
    parts = F.split(F.col("c_name"), "#")
    shape0 = F.to_json(F.struct(F.struct(
        F.col("c_name").alias("applicant_name"), email.alias("email_address"), phone.alias("mobile"),
        F.array(F.lit("Python"), F.lit("SQL")).alias("skill_set"), (k % 30).alias("years_of_experience"),
        F.array(F.struct(F.concat(F.lit("Company "), (k % 97).cast("string")).alias("company"),
                         F.col("c_mktsegment").alias("title"), F.lit("2020-01").alias("start"))).alias("work_history"),
    ).alias("candidate")))
    shape1 = F.to_json(F.struct(
        F.get(parts, 0).alias("firstName"), F.get(parts, 1).alias("lastName"),
        F.array(email, F.upper(email), F.lit(" ")).alias("contact_email"), F.array(phone).alias("phone_number"),
        F.lit("Python; SQL, Go").alias("skills"), (k % 30).cast("string").alias("experience_years"),
        F.lit("  ").alias("current_title"),
    ))
    shape2 = F.to_json(F.array(
        F.struct(F.col("c_name").alias("name"), email.alias("email"), F.lit(None).cast("string").alias("job_title")),
        F.struct(F.concat(F.lit("Second "), ks).alias("name"), F.lit(None).cast("string").alias("email"),
                 F.col("c_mktsegment").alias("job_title")),
    ))
    text = F.when(k % 4 == 0, shape0).when(k % 4 == 1, shape1).when(k % 4 == 2, shape2).otherwise(
        F.when(k % 8 == 3, F.lit("{bad json")).otherwise(F.lit("42")))
    return _t(spark, sf_dir, "customer").select(ks.alias("doc_id"), text.alias("text"))


def json_mapping(spark, sf_dir):
    """ATS-style JSON -> mapped fields (envelopes, aliases, scalar-or-list, names, arrays)."""
    from goldrec.sources.files import ats_records_from_text

    rec = ats_records_from_text(_ats_json(spark, sf_dir), "doc_id", "text")
    f = F.col("fields")
    return rec.select(
        "record_id", f["full_name"].alias("full_name"), _join(f["emails"]).alias("emails"),
        _join(f["phones"]).alias("phones"), _join(f["skills_raw"]).alias("skills"),
        f["years_experience"].alias("years_experience"), f["headline"].alias("headline"),
        F.size(f["experience_raw"]).alias("n_experience"),
    )


QUERIES.update({"csv_mapping": csv_mapping, "json_mapping": json_mapping})


def skills_merged(spark, sf_dir):
    """Merged skills per entity - order, canonical name, confidence with bonus, sources."""
    from goldrec.operators.skills import merge_skills

    sk = merge_skills(spark, _keyed(spark, sf_dir))
    return sk.select("entity_key", F.posexplode("skills").alias("pos", "s")).select(
        "entity_key", (F.col("pos") + 1).alias("ord"), F.col("s.name").alias("name"),
        F.col("s.confidence").alias("confidence"), F.array_join("s.sources", "+").alias("sources"),
    )


QUERIES["skills_merged"] = skills_merged


def golden_provenance(spark, sf_dir):
    """The ordered provenance list of every golden record, flattened."""
    g = merge_records(spark, _keyed(spark, sf_dir, materialize=True))
    prov = F.transform("provenance", lambda p: F.concat_ws(":", p["field"], p["source"], p["method"]))
    return g.select("entity_key", F.size("provenance").alias("n"), _join(prov).alias("provenance"))


QUERIES["golden_provenance"] = golden_provenance


QUERIES.update({"resume_fields": resume_fields, "notes_fields": notes_fields, **_EXPORTS, **_PEOPLE, **_JOBS})
