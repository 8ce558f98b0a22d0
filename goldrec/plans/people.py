"""Spellings against a dictionary file, records without e-mail that share phones, and places, written from the tables by rule.

The rules are SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.functions.similarity import token_sort_ratio_sql, token_sort_sql
from goldrec.operators.countries import search_countries
from goldrec.operators.dictionary import canonical_names, read_dictionary
from goldrec.operators.resolve import resolve
from goldrec.plans.texts import FIRST, LAST, _pick
from goldrec.schemas import fields_struct
from goldrec.session import scratch_folder

#: Syllables of a coined name and its fields, by letters each.
SYLLABLES = [("KaLoMiRuTeVoXeBrSnQu", 2), ("bander" "folgim" "hesjur" "latmon" "pilrok", 3), ("noxelldufagyhistzopi", 2)]
FIELDS = ("LabsFlowTextMathNodeViewOpsy", 4)


def _cut(letters: tuple[str, int], index: str) -> str:
    """The piece number ``index``, around the end, of equal pieces."""
    text, size = letters
    return f"substr('{text}', cast(1 + {size} * (({index}) % {len(text) // size}) AS int), {size})"


def _coined(key: str) -> str:
    """A coined name of two words for every key."""
    digits = [f"cast(floor({key} / {10**i}) AS bigint)" for i in range(len(SYLLABLES))]
    return "concat(" + ", ".join(_cut(s, d) for s, d in zip(SYLLABLES, digits)) + f", ' ', {_cut(FIELDS, key)})"


NAME = _coined("s_suppkey")
MEANT = _coined("p_partkey % 1000")
#: How a part's key writes the name of the skill that is ``meant``.
SPELT = """CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE CASE p_partkey % 11 WHEN 0 THEN meant WHEN 1 THEN lower(meant) WHEN 2 THEN concat('  ', meant, ' ')
  WHEN 3 THEN concat(substr(meant, 1, 1), substr(meant, 3)) WHEN 4 THEN concat(meant, 's') WHEN 5 THEN replace(meant, 'o', 'oo')
  WHEN 6 THEN concat(split_part(meant, ' ', 2), ' ', split_part(meant, ' ', 1)) WHEN 7 THEN upper(meant) WHEN 8 THEN p_name WHEN 9 THEN ' '
  ELSE substr(meant, 1, 4) END END"""


def skills_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings by ``part`` against a dictionary file with a name a ``supplier``, comments and blank lines."""
    path = scratch_folder(spark, "dictionary")
    lines = f"concat({NAME}, CASE WHEN s_suppkey % 5 = 0 THEN concat(chr(10), chr(10), '#', {NAME}) ELSE '' END) AS value"
    names = spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr("s_suppkey", lines)
    names.repartitionByRange(3, "s_suppkey").sortWithinPartitions("s_suppkey").select("value").write.text(path)
    meant = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("p_partkey", "p_name", f"{MEANT} AS meant")
    spelt = meant.selectExpr("p_partkey", f"{SPELT} AS raw")
    return canonical_names(spelt, read_dictionary(spark, path)).select("p_partkey", "raw", "name", "confidence", "method")


def oracle_skills_dictionary() -> str:
    ratio, ta, tb = token_sort_ratio_sql("s", "n"), token_sort_sql("s"), token_sort_sql("n")
    return f"""WITH d AS MATERIALIZED (SELECT s_suppkey AS pos, {NAME} AS n FROM supplier),
p AS MATERIALIZED (SELECT p_partkey, {SPELT} AS raw FROM (SELECT p_partkey, p_name, {MEANT} AS meant FROM part)),
t AS (SELECT DISTINCT trim(raw) AS s FROM p WHERE trim(raw) <> ''),
e AS MATERIALIZED (SELECT s, arg_min(n, pos) AS exact FROM t JOIN d ON lower(s) = lower(n) GROUP BY s),
r AS (SELECT s, n, pos, {ratio} AS ratio FROM (SELECT s FROM t ANTI JOIN e USING (s)), d
      WHERE 200 * least(length({ta}), length({tb})) >= 80 * (length({ta}) + length({tb}))),
b AS (SELECT s, arg_min(n, (-ratio, pos)) AS best, max(ratio) AS ratio FROM r WHERE ratio >= 80 GROUP BY s)
SELECT p_partkey, raw, CASE WHEN trim(raw) = '' THEN raw ELSE coalesce(exact, best, trim(raw)) END AS name,
  CASE WHEN raw IS NULL THEN NULL WHEN trim(raw) = '' THEN 0.0 WHEN exact IS NOT NULL THEN 1.0
       WHEN best IS NOT NULL THEN round(0.5 + (ratio - 80) / 20 * 0.49, 4) ELSE 0.5 END::DOUBLE AS confidence,
  CASE WHEN raw IS NULL THEN NULL WHEN trim(raw) = '' THEN 'blank' WHEN exact IS NOT NULL THEN 'exact' WHEN best IS NOT NULL THEN 'fuzzy' ELSE 'passthrough' END AS method
FROM p LEFT JOIN e ON trim(raw) = e.s LEFT JOIN b ON trim(raw) = b.s"""


# --- records without e-mail ----------------------------------------------------

GROUP = "cast(floor(c_custkey / 4) AS bigint)"
BASE = f"concat({_pick(FIRST, GROUP)}, ' ', {_pick(LAST, GROUP)})"
OTHER = f"concat({_pick(FIRST, GROUP + ' + 5')}, ' ', {_pick(LAST, GROUP + ' + 3')})"
PERSON = f"""CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN {BASE} WHEN c_custkey % 4 = 1 THEN concat({BASE}, 'e')
  WHEN c_custkey % 4 = 2 THEN concat(substr({BASE}, 1, 1), substr({BASE}, 3)) ELSE {OTHER} END"""
TAIL = f"lpad(cast({GROUP} % 10000 AS string), 4, '0')"
#: Member 1 of a group of four has both of its phones and so joins members 0 and 2.
FIRST_PHONE = f"CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 4 = 2 THEN concat('+1 212 555 ', {TAIL}) ELSE concat('(415) 555-', {TAIL}) END"
SECOND_PHONE = f"CASE WHEN c_custkey % 4 = 1 THEN concat('+1 (212) 555-', {TAIL}) END"
MAIL = f"CASE WHEN c_custkey % 4 = 0 AND {GROUP} % 6 = 0 THEN concat('p', c_custkey, '@example.org') END"


def match_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of groups of four, most without e-mail, linked by phones in common and similar names, over several records too."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    c = c.select(F.concat(F.lit("p-"), F.col("c_custkey").cast("string")).alias("record_id"), *[F.expr(e).alias(n) for n, e in (("n", PERSON), ("a", FIRST_PHONE), ("b", SECOND_PHONE), ("m", MAIL))])
    fields = fields_struct(full_name=F.col("n"), emails=F.array_compact(F.array("m")), phones=F.array_compact(F.array("a", "b")))
    records = c.select("record_id", F.lit("notes").alias("source"), F.lit(0.55).alias("extraction_confidence"), fields.alias("fields"))
    return resolve(records, materialize=True).select("record_id", "entity_key")


def oracle_match_components() -> str:
    from goldrec.plans.oracles import fallback_sql

    return fallback_sql(
        f"SELECT 'p-' || c_custkey AS record_id, {PERSON} AS full_name, list_filter([{MAIL}], lambda x: x IS NOT NULL) AS emails, "
        f"list_filter([{FIRST_PHONE}, {SECOND_PHONE}], lambda x: x IS NOT NULL) AS phones FROM customer"
    )


# --- countries ------------------------------------------------------------------

#: Texts and the countries that are meant.
PLACES = [
    ("Karnataka", "IN"), ("bavaria", "DE"), ("XYZ123", None), ("Emirates", "AE"), (" usa ", "US"), ("Nova Scotia", "CA"), ("Republic", None), ("Herzegovina", "BA"),
    ("Leichtenstein", "LI"), ("Tobago", "TT"), ("Californa", "US"), ("of the", None), ("Islands Marshall", "MH"), ("", None), ("Queensland", "AU"),
]
#: Countries whose names are written with a letter left out.
NAMES = [
    ("Argentina", "AR"), ("Bangladesh", "BD"), ("Cambodia", "KH"), ("Denmark", "DK"), ("Ethiopia", "ET"), ("Finland", "FI"), ("Germany", "DE"), ("Honduras", "HN"),
    ("Indonesia", "ID"), ("Kazakhstan", "KZ"), ("Luxembourg", "LU"), ("Mozambique", "MZ"), ("Nicaragua", "NI"), ("Portugal", "PT"), ("Singapore", "SG"),
]


def _literal(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


def _case(index: str, values: list[str | None]) -> str:
    return f"CASE ({index}) % {len(values)} " + " ".join(f"WHEN {i} THEN {_literal(v)}" for i, v in enumerate(values)) + " END"


WHICH = "cast(floor(c_custkey / 3) AS bigint)"
WRITTEN = _case(WHICH, [n for n, _ in NAMES])
LEFT_OUT = f"cast(2 + c_custkey % (length({WRITTEN}) - 1) AS int)"
PLACE = f"CASE WHEN c_custkey % 3 = 0 THEN {_case(WHICH, [p for p, _ in PLACES])} ELSE concat(substr({WRITTEN}, 1, {LEFT_OUT} - 1), substr({WRITTEN}, {LEFT_OUT} + 1)) END"


def country_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in part, misspelt names and subdivisions, by ``customer``."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr("c_custkey", f"{PLACE} AS raw")
    return search_countries(c).select("c_custkey", "raw", "country")


def oracle_country_search() -> str:
    """What the rule means, not what the search does."""
    return f"SELECT c_custkey, {PLACE} AS raw, CASE WHEN c_custkey % 3 = 0 THEN {_case(WHICH, [c for _, c in PLACES])} ELSE {_case(WHICH, [c for _, c in NAMES])} END AS country FROM customer"


QUERIES = {f.__name__: f for f in (skills_dictionary, match_components, country_search)}
ORACLES = {"skills_dictionary": oracle_skills_dictionary, "match_components": oracle_match_components, "country_search": oracle_country_search}
