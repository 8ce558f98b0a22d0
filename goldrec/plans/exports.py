"""Folders of CSV exports and JSON output written from ``customer`` and read back.

Seven export files in three layouts: other column order, other header names,
the same header twice.  Every ninth customer has neither name nor e-mail.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.operators.project import write_json
from goldrec.session import scratch_folder
from goldrec.sources.files import load_sources, read_csv_source, write_sources

FILES = 7
KNOWN = "c_custkey % 9 <> 0"
NAME = f"CASE WHEN {KNOWN} THEN concat('\"', c_name, '\"') ELSE '' END"
MAIL = f"CASE WHEN {KNOWN} THEN concat('c', c_custkey, '@example.org;d', c_custkey, '@example.org') ELSE ' ' END"
TITLE = "concat('\"', c_mktsegment, ', the ', c_nationkey, chr(34), chr(34), 'th', chr(34), chr(34), '\"')"
LAYOUTS = [
    ("name,email,phone", ["n", "m", "p"]),
    ("phone,EMAIL,title,email,name", ["p", "m", "t", "' '", "n"]),
    ("Job Title,emails,Full Name", ["t", "m", "n"]),
]


def _folder(spark: SparkSession) -> str:
    return scratch_folder(spark, "exports")


def write_exports(spark: SparkSession, sf_dir: str) -> str:
    """FILES CSV files, each with its header; rows by key."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    cells = c.selectExpr(
        f"c_custkey % {FILES} AS f", "c_custkey AS pos", f"{NAME} AS n", f"{MAIL} AS m", "concat('+1 415 555 ', lpad(c_custkey % 10000, 4, '0')) AS p", f"{TITLE} AS t"
    )
    line = "CASE f % 3 " + " ".join(f"WHEN {i} THEN concat_ws(',', {', '.join(cols)})" for i, (_, cols) in enumerate(LAYOUTS)) + " END"
    header = "CASE f % 3 " + " ".join(f"WHEN {i} THEN '{h}'" for i, (h, _) in enumerate(LAYOUTS)) + " END"
    rows = cells.selectExpr("f", "pos", f"{line} AS value")
    heads = rows.select("f").distinct().selectExpr("f", "-1L AS pos", f"{header} AS value")
    path = _folder(spark)
    rows.union(heads).repartition("f").sortWithinPartitions("f", "pos").select("value", "f").write.partitionBy("f").text(path)
    return f"{path}/*/*.txt"


def _flat(records: DataFrame) -> DataFrame:
    f = F.col("fields")
    return records.select(
        f["full_name"].alias("full_name"), F.array_join(f["emails"], "|").alias("emails"), F.array_join(f["phones"], "|").alias("phones"), f["headline"].alias("headline")
    )


def csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1/B1/B2/F1: a folder of exports, each file by its own header."""
    return _flat(read_csv_source(spark, write_exports(spark, sf_dir)))


def first_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first valid row of every export."""
    return _flat(read_csv_source(spark, write_exports(spark, sf_dir), first_per_file=True))


def source_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load found, read, kept and dropped."""
    _, status = load_sources(spark, csv=write_exports(spark, sf_dir), notes=f"{_folder(spark)}/none")
    return status.drop("path")


def json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as JSON lines under both policies for nulls, read back as text fields."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr("c_custkey", f"CASE WHEN {KNOWN} THEN c_name END AS c_name")
    parts = []
    for policy in ("null", "omit"):
        path = _folder(spark)
        write_json(c, path, {"on_missing": policy})
        keys = F.array_join(F.array_sort(F.json_object_keys("value")), ",")
        parts.append(spark.read.text(path).select(F.lit(policy).alias("policy"), F.get_json_object("value", "$.c_custkey").cast("long").alias("c_custkey"), keys.alias("keys")))
    return parts[0].union(parts[1])


DOCS = 3  # files of JSON documents, one a line
DOC = """CASE c_custkey % 5 WHEN 0 THEN concat('{"name": "', c_name) WHEN 1 THEN concat('[7, {"email": "a', c_custkey, '@example.org"}]')
  WHEN 2 THEN concat('{"data": {"note": "n', c_custkey, '"}}') ELSE concat('{"candidate": {"name": "', c_name, '"}}') END"""


def write_documents(spark: SparkSession, sf_dir: str) -> str:
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(f"c_custkey % {DOCS} AS f", "c_custkey", f"{DOC} AS value")
    path = _folder(spark)
    rows.repartition("f").sortWithinPartitions("f", "c_custkey").select("value", "f").write.partitionBy("f").text(path)
    return f"{path}/*/*.txt"


def source_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of CSV exports and JSON Lines that are left out: where they stand, why, and their text."""
    _, rejects = write_sources(spark, _folder(spark), csv=write_exports(spark, sf_dir), ats=write_documents(spark, sf_dir), ats_lines=True)
    return rejects.select("source", F.regexp_extract("file", "/f=([0-9]+)/", 1).cast("int").alias("file"), "place", "reason", "raw")


QUERIES = {f.__name__: f for f in (csv_files, first_per_file, source_status, source_rejects, json_sink)}

_FIELDS = f"""c_custkey % {FILES} AS f, CASE WHEN {KNOWN} THEN c_name END AS full_name,
  CASE WHEN {KNOWN} THEN concat('c', c_custkey, '@example.org|d', c_custkey, '@example.org') END AS emails,
  CASE WHEN c_custkey % {FILES} % 3 < 2 THEN concat('+1 415 555 ', lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')) END AS phones,
  CASE WHEN c_custkey % {FILES} % 3 > 0 THEN concat(c_mktsegment, ', the ', c_nationkey, '"th"') END AS headline"""
_ROWS = f"SELECT c_custkey, {_FIELDS} FROM customer WHERE {KNOWN}"
ORACLES = {
    "csv_files": lambda: f"SELECT full_name, emails, phones, headline FROM ({_ROWS})",
    "first_per_file": lambda: f"SELECT full_name, emails, phones, headline FROM ({_ROWS}) QUALIFY row_number() OVER (PARTITION BY f ORDER BY c_custkey) = 1",
    "source_status": lambda: f"""SELECT 'csv' AS source, true AS found, count(DISTINCT c_custkey % {FILES}) AS files, 0::BIGINT AS files_bad,
  count(*) AS rows_in, count(*) FILTER ({KNOWN}) AS rows_kept, count(*) FILTER (NOT ({KNOWN})) AS rows_bad FROM customer
UNION ALL SELECT 'notes', false, 0, 0, 0, 0, 0""",
    "source_rejects": lambda: f"""WITH c AS (SELECT c_custkey, c_custkey % {FILES} AS f, {KNOWN} AS known, row_number() OVER (PARTITION BY c_custkey % {FILES} ORDER BY c_custkey) - 1 AS place,
  concat('+1 415 555 ', lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')) AS p, {TITLE} AS t FROM customer),
d AS (SELECT c_custkey, c_custkey % {DOCS} AS f, row_number() OVER (PARTITION BY c_custkey % {DOCS} ORDER BY c_custkey) - 1 AS place, {DOC} AS value FROM customer)
SELECT 'csv' AS source, f::INTEGER AS file, place, 'neither name nor e-mail' AS reason,
  CASE f % 3 WHEN 0 THEN concat(', ,', p) WHEN 1 THEN concat(p, ', ,', t, ', ,') ELSE concat(t, ', ,') END AS raw FROM c WHERE NOT known
UNION ALL SELECT 'ats', f::INTEGER, place, CASE c_custkey % 5 WHEN 0 THEN 'not valid JSON' WHEN 1 THEN 'not a JSON object' ELSE 'neither name nor e-mail' END,
  CASE c_custkey % 5 WHEN 0 THEN value WHEN 1 THEN '7' ELSE replace(value, ': ', ':') END FROM d WHERE c_custkey % 5 < 3""",
    "json_sink": lambda: f"""SELECT p AS policy, c_custkey, CASE WHEN p = 'null' OR {KNOWN} THEN 'c_custkey,c_name' ELSE 'c_custkey' END AS keys
FROM customer, (VALUES ('null'), ('omit')) t(p)""",
}
