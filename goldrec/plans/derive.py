"""Multi-source records derived from the driver's tables.

The driver's data holds no candidate files, so the registered queries derive
four overlapping "sources" per customer by fixed rules that grow with the
``customer`` table (every row is used; the key only selects which sources
describe a customer and which spelling they use):

* csv    - every customer
* ats    - customers with an even key (upper-cased e-mail, name variant, history)
* resume - keys divisible by 3 (second e-mail, different headline, history
  that repeats the ats one in another spelling)
* notes  - keys divisible by 5 (padded mixed-case e-mail, lower-case name, a region)
* notes without e-mail - keys divisible by 7 (phone + name only, for E6)

The same rules are written as SQL in :mod:`goldrec.plans.oracles`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.schemas import fields_struct
from goldrec.session import spread
from goldrec.sources.dims import SKILLS, literal_array

# Invented place strings, picked by nation key (25 nations).
PLACES = [
    "Bengaluru, India", "San Francisco, CA, USA", "London, UK", "Berlin, Germany",
    "Paris, France", "Austin, TX", "Toronto, Canada", "Sydney, Australia",
    "Tokyo, Japan", "Singapore", "United States", "Mumbai, Maharashtra, India",
    "Madrid - Spain", "Dubai, UAE", "Seoul, South Korea", "Amsterdam, Netherlands",
    "Sao Paulo, Brazil", "Mexico City, Mexico", "Nairobi, Kenya", "Cairo, Egypt",
    "Zurich, Switzerland", "Stockholm, Sweden", "Dublin, Ireland", "Oslo, Norway",
    "Atlantis, Nowhere Land",
]

def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lit_array(values):
    return literal_array(values)


def _skill(idx):
    return F.element_at(_lit_array(SKILLS), (idx % len(SKILLS)).cast("int") + 1)


def _item(**values):
    """A history item: names and Columns or strings, plus the fields it does not name."""
    names = list(values) + (["summary"] if "company" in values else [])
    return F.struct(*[(v if isinstance(v := values.get(n), Column) else F.lit(v)).cast("string").alias(n) for n in names])


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source_records (record_id, source, extraction_confidence, fields) from ``customer``."""
    from goldrec.sources.dims import SOURCE_CONSTANTS

    cert = {s: c for s, _, c in SOURCE_CONSTANTS}
    c = spread(_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))
    k = F.col("c_custkey")
    ks = k.cast("string")
    email = F.concat(F.lit("customer"), ks, F.lit("@example.com"))
    phone_tail = F.lpad((k % 10000).cast("string"), 4, "0")
    place = F.element_at(_lit_array(PLACES), (F.col("c_nationkey") % len(PLACES)).cast("int") + 1)

    def rec(source, where, **fields):
        return c.where(where).select(
            F.concat(F.lit(f"{source}-"), ks).alias("record_id"),
            F.lit(source).alias("source"),
            F.lit(cert.get(source, 0.5)).alias("extraction_confidence"),
            fields_struct(**fields).alias("fields"),
        )

    csv = rec(
        "csv", F.lit(True),
        full_name=F.col("c_name"),
        emails=F.array(email),
        phones=F.array(F.concat(F.lit("+1 415 555 "), phone_tail)),
        headline=F.col("c_mktsegment"),
        current_company=F.concat(F.lit("Company "), (k % 97).cast("string")),
        location_raw=place,
        years_experience=(k % 25).cast("double"),
        linkedin=F.concat(F.lit("https://linkedin.com/in/customer-"), ks),
        skills_raw=F.array(_skill(k), _skill(k * 7)),
        education_text=F.concat(F.lit("B.Tech "), (2000 + k % 20).cast("string")),
        portfolio=F.when(k % 10 == 0, F.concat(F.lit("https://p"), ks, F.lit(".example.org"))),
    )
    firm = F.concat(F.lit("Company "), (k % 97).cast("string"))
    school = F.concat(F.lit("Univ "), (k % 13).cast("string"))
    ats = rec(
        "ats", k % 2 == 0,
        full_name=F.when(k % 4 == 0, F.col("c_name")).otherwise(F.upper(F.col("c_name"))),
        emails=F.array(F.upper(email)),
        phones=F.array(F.concat(F.lit("+1-415-555-"), phone_tail)),
        headline=F.concat(F.col("c_mktsegment"), F.lit(" Lead")),
        years_experience=(k % 25 + 1).cast("double"),
        city=F.concat(F.lit("City"), F.col("c_nationkey").cast("string")),
        github=F.concat(F.lit("https://github.com/cust"), ks),
        skills_raw=F.array(F.lower(_skill(k)), _skill(k + 3)),
        country=F.when(k % 8 == 0, F.lit("usa")),
        experience_raw=F.array(
            _item(company=firm, title=F.col("c_mktsegment"), start="Jan 2015", end="06/2018"),
            _item(company=F.concat(F.lit(" "), F.upper(firm)), title="again", start="2015-01", end=None),
        ),
        education_raw=F.when(k % 4 == 0, F.array(_item(institution=school, degree="B.Tech", field="Physics", end_year="2010"))),
    )
    resume = rec(
        "resume", k % 3 == 0,
        full_name=F.col("c_name"),
        emails=F.array(email, F.concat(F.lit("c"), ks, F.lit("@mail.example.org"))),
        headline=F.concat(F.lit("Engineer at Company "), (k % 97).cast("string")),
        years_experience=F.when(k % 6 == 0, (k % 25 + 2).cast("double")),
        summary=F.concat(F.lit("Account balance "), F.col("c_acctbal").cast("string")),
        skills_raw=F.array(F.upper(_skill(k * 7)), F.concat(_skill(k + 5), F.lit("s"))),
        experience_raw=F.array(
            _item(company=F.lower(firm), title="Copy", start="2015-01-09", end="2018"),
            _item(company="Startup", title="CTO", start="2019", end="present"),
        ),
        education_raw=F.array(
            _item(institution=F.concat(F.upper(school), F.lit(" ")), degree="b.tech", field=None, end_year="June 2011"),
            _item(institution="Open School", degree=None, field="Law", end_year="unknown"),
        ),
    )
    notes = rec(
        "notes", k % 5 == 0,
        full_name=F.lower(F.col("c_name")),
        emails=F.array(F.concat(F.lit("  Customer"), ks, F.lit("@Example.com "))),
        current_company=F.concat(F.lit("Company "), ((k + 1) % 97).cast("string")),
        skills_raw=F.array(_skill(k + 11)),
        region=F.concat(F.lit("Region "), F.col("c_nationkey").cast("string")),
    )
    return csv.unionByName(ats).unionByName(resume).unionByName(notes)


def customer_records_with_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer_records`` plus e-mail-less notes records (keys divisible by 7) for E6."""
    from goldrec.sources.dims import SOURCE_CONSTANTS

    cert = {s: c for s, _, c in SOURCE_CONSTANTS}
    c = spread(_table(spark, sf_dir, "customer").select("c_custkey", "c_name"))
    k = F.col("c_custkey")
    phone_tail = F.lpad((k % 10000).cast("string"), 4, "0")
    # odd keys get a phone nobody else has, so they stay apart
    phone = F.when(k % 2 == 0, F.concat(F.lit("(415) 555-"), phone_tail)).otherwise(
        F.concat(F.lit("(212) 555-"), phone_tail)
    )
    orphans = c.where(k % 7 == 0).select(
        F.concat(F.lit("notes2-"), k.cast("string")).alias("record_id"),
        F.lit("notes").alias("source"),
        F.lit(cert["notes"]).alias("extraction_confidence"),
        fields_struct(full_name=F.regexp_replace(F.col("c_name"), "^Customer", "Custmer"), phones=F.array(phone)).alias("fields"),
    )
    return customer_records(spark, sf_dir).unionByName(orphans)
