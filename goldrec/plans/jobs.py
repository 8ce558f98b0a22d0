"""The end-to-end job over written sources, and checks of its rows against a config.

Sources are written from ``customer`` by rule: CSV exports (``exports.py``), JSON
Lines for even keys, and a note as a text file for every twentieth key, half of
which are blank.  The expected rows follow from these rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.operators.claims import field_claims
from goldrec.operators.incremental import add_records, golden_of
from goldrec.operators.merge import merge_records
from goldrec.operators.project import project
from goldrec.operators.quality import sort_violations, validate, violation_counts
from goldrec.operators.ranking import rank_claims
from goldrec.operators.resolve import resolve
from goldrec.plans.derive import customer_records
from goldrec.plans.exports import FILES, KNOWN, _folder, write_exports
from goldrec.plans.golden import build_golden
from goldrec.session import spread
from goldrec.sources.files import read_csv_source

TAIL = "lpad(CAST(c_custkey % 10000 AS string), 4, '0')"
DOC = f"""CASE WHEN c_custkey % 2 = 0 THEN concat('{{"candidate": {{"name": "', upper(c_name), '", "email": "C', c_custkey, '@Example.org", "phone": "+1 212 555 ', {TAIL},
  '", "current_title": "Lead", "years_of_experience": ', c_custkey % 30, '}}}}') ELSE concat('{{"note": ', c_custkey, '}}') END"""
NOTE = "CASE WHEN c_custkey % 40 = 0 THEN ' ' ELSE concat('Name: ', c_name, chr(10), 'c', c_custkey, '@example.org', chr(10), 'Skills: Go') END"

#: Files that a task writes.
NOTES_A_TASK = 250


def _written(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    c = spread(spark.read.parquet(f"{sf_dir}/customer.parquet"))
    documents, notes = _folder(spark), _folder(spark)
    c.selectExpr(f"{DOC} AS value").write.text(documents)
    # a file a key, all in one folder: listing a folder a key takes longer than reading its file
    noted = c.where("c_custkey % 20 = 0").selectExpr("c_custkey", f"coalesce({NOTE}, '') AS value").groupBy("c_custkey").agg(F.array_sort(F.collect_list("value")).alias("lines"))
    noted = spread(noted, NOTES_A_TASK).select(F.array_join("lines", "\n").alias("value"))
    noted.write.option("maxRecordsPerFile", 1).text(notes, lineSep="\n")
    return {"csv": write_exports(spark, sf_dir), "ats": f"{documents}/*.txt", "notes": notes}


def golden_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written sources -> golden rows in the default projection without confidence, and their violations.

    The canonical shape requires the two columns that this projection leaves out, which is two violations a row.
    """
    result = build_golden(spark, **_written(spark, sf_dir), config={"include_confidence": False}, ats_lines=True)
    assert not {"overall_confidence", "provenance"} & set(result.golden.columns)
    found = result.violations.groupBy("entity_key").agg(F.count("*").alias("n"))
    g = result.golden.join(found, "entity_key", "left")
    return g.select(
        "entity_key", "candidate_id", "full_name", F.array_join("emails", "|").alias("emails"), F.array_join("phones", "|").alias("phones"), "headline",
        "years_experience", F.array_join(F.transform("skills", lambda s: F.concat_ws(":", s["name"], s["confidence"].cast("string"))), "|").alias("skills"),
        F.size("experience").alias("n_experience"), F.coalesce("n", F.lit(0)).cast("long").alias("n_violations"),
    )


def _oracle_golden_job() -> str:
    layout = f"c_custkey % {FILES} % 3"
    return f"""WITH c AS (SELECT *, {KNOWN} AS known, c_custkey % 2 = 0 AS doc FROM customer)
SELECT concat('c', c_custkey, '@example.org') AS entity_key, concat('cand_', substr(sha256(concat('c', c_custkey, '@example.org')), 1, 12)) AS candidate_id,
  CASE WHEN known THEN c_name ELSE upper(c_name) END AS full_name,
  concat('c', c_custkey, '@example.org', CASE WHEN known THEN concat('|d', c_custkey, '@example.org') ELSE '' END) AS emails,
  concat_ws('|', CASE WHEN known AND {layout} < 2 THEN concat('+1415555', {TAIL}) END, CASE WHEN doc THEN concat('+1212555', {TAIL}) END) AS phones,
  CASE WHEN known AND {layout} > 0 THEN concat(c_mktsegment, ', the ', c_nationkey, '"th"') WHEN doc THEN 'Lead' END AS headline,
  CASE WHEN doc THEN c_custkey % 30 END::DOUBLE AS years_experience, CASE WHEN c_custkey % 40 = 20 THEN 'Go:1.0' ELSE '' END AS skills,
  0 AS n_experience, 2::BIGINT AS n_violations
FROM c WHERE known OR doc"""


STRICT = {
    "fields": [
        {"path": "name", "from": "full_name", "required": True},
        {"path": "phones", "type": "string[]", "required": True},
        {"path": "job", "from": "headline", "required": True},
        {"path": "years", "from": "years_experience", "type": "number"},
        {"path": "named", "from": "full_name", "type": "boolean", "required": True},
    ],
    "on_missing": "error",
    "include_confidence": True,
}


def config_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of CSV exports projected with nulls kept, against a config that requires fields."""
    keyed = resolve(read_csv_source(spark, write_exports(spark, sf_dir)), fallback=False)
    golden = merge_records(spark, keyed)
    rows = project(spark, golden.withColumn("phones", F.when(F.size("phones") > 0, F.col("phones"))), {**STRICT, "on_missing": "null"})
    return sort_violations(validate(rows, STRICT))


def _oracle_config_violations() -> str:
    layout = f"c_custkey % {FILES} % 3"

    def missing(path: str, kind: str, where: str) -> str:
        message = f"None is not of type ''{kind}''"
        return f"SELECT concat('c', c_custkey, '@example.org') AS entity_key, '{path}' AS path, '{message}' AS message FROM customer WHERE {KNOWN} AND {layout} {where}"

    return missing("phones", "array", "= 2") + " UNION ALL " + missing("job", "string", "= 0")


def violation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: how often each rule is broken in the violations of ``config_violations``."""
    return violation_counts(config_violations(spark, sf_dir))


def _oracle_violation_totals() -> str:
    return f"SELECT path, message, count(*) AS n, count(DISTINCT entity_key) AS n_entities FROM ({_oracle_config_violations()}) GROUP BY path, message"


# --- ranks and increments -------------------------------------------------------


def claims_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scalar claim on the entities of customer-derived records, with its rank."""
    claims = field_claims(resolve(customer_records(spark, sf_dir), fallback=False))
    out = rank_claims(claims)
    return out.select("entity_key", "field", "value", "source", F.round("score", 6).alias("score"), "record_id", "rank")


def _oracle_claims_ranked() -> str:
    from goldrec.plans.oracles import claims_sql, customer_records_sql, scored_sql

    return f"""WITH keyed AS ({scored_sql(customer_records_sql())}), claims AS ({claims_sql()})
SELECT entity_key, field, value, source, round(score, 6) AS score, record_id,
  row_number() OVER (PARTITION BY entity_key, field ORDER BY score DESC, source_rank, record_id, value) AS rank FROM claims"""


def golden_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records added in two batches, one of them twice; the golden rows' scores are those of one run over all."""
    records, store = customer_records(spark, sf_dir), _folder(spark)
    first = records.where("source in ('ats', 'notes')")
    add_records(spark, store, first, 0)
    add_records(spark, store, first, 0)
    add_records(spark, store, records.where("source not in ('ats', 'notes')"), 1)
    g = golden_of(spark, store)
    return g.select("entity_key", *[c for c in g.columns if c.startswith("conf_")], "overall_confidence")


def _oracle_golden_increments() -> str:
    from goldrec.plans.oracles import oracle_golden_confidence

    return oracle_golden_confidence()


QUERIES = {f.__name__: f for f in (golden_job, config_violations, violation_totals, claims_ranked, golden_increments)}
ORACLES = {
    "golden_job": _oracle_golden_job,
    "config_violations": _oracle_config_violations,
    "violation_totals": _oracle_violation_totals,
    "claims_ranked": _oracle_claims_ranked,
    "golden_increments": _oracle_golden_increments,
}
