"""Resume and notes texts written from ``customer`` by rule, with what extraction must find in them.

The texts and the expected values are SQL expressions that Spark and DuckDB
read alike; the expected values follow from the rule, not from the extraction
patterns, so the check sees faults in the patterns too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.functions.phones import normalize_phones
from goldrec.session import spread
from goldrec.sources.files import extract_notes, extract_resume

AS_OF_YEAR = 2026
FIRST = ["Ana", "Bela", "Caio", "Dora", "Enzo", "Fay", "Gil", "Hana", "Ivo", "Jun", "Kaya"]
LAST = ["Lopes", "Marsh", "Novak", "Ortiz", "Pratt", "Quist", "Rossi"]


def _pick(values: list[str], index: str) -> str:
    return f"CASE ({index}) % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def _text(*parts: str) -> str:
    """concat() of SQL expressions and of 'literal' lines, in which \\n is a line break."""
    return "concat(" + ", ".join(p.replace("\\n", "', chr(10), '") for p in parts) + ")"


N = "cast(c_custkey % 99991 AS string)"  # few digits, else ids would look like phones
NAME = f"concat({_pick(FIRST, 'c_custkey')}, ' ', {_pick(LAST, 'c_custkey')})"
TAIL = "lpad(cast(c_custkey % 10000 AS string), 4, '0')"
START = "cast(2000 + c_custkey % 9 AS string)"
STOP = "cast(2010 + c_custkey % 9 AS string)"
FIRM = "concat('Acme ', cast(c_custkey % 7 AS string), ' Ltd')"
SHOP = "concat('(small works ', cast(c_custkey % 5 AS string), ')')"  # a letter after a blank line would end the section
SCHOOL = "concat('College ', cast(c_custkey % 13 AS string), ', B.Tech in Physics 2004')"
OPEN = "c_custkey % 3 = 0"  # has a second, still open job
PLAIN = "c_custkey % 11 = 0"  # a text with none of the sections

RESUME = (
    f"CASE WHEN {PLAIN} THEN " + _text(NAME, "'\\nnothing else is known of this person'") + " ELSE "
    + _text(
        NAME, "'\\nPlans and builds '", "lower(c_mktsegment)", "'\\nmail'", N, "'@example.org, MAIL'", N, "'@example.net\\n+1 415 555 '", TAIL,
        "'\\nhttps://www.linkedin.com/in/person-'", N, "'/\\nGitHub.com/p'", N,
        "'\\n\\nTechnical Skills:\\nPython, SQL (advanced) | C\\tGo\\n\\nWork Experience:\\n'".replace("\\t", "•"),
        FIRM, "'\\nField Lead\\n'", START, "' - '", STOP, "'\\n- ran pumps\\n• fixed valves\\n'",
        f"CASE WHEN {OPEN} THEN " + _text("'\\n'", SHOP, "'\\nhelper\\n2020 to present\\n'") + " ELSE '' END",
        "'\\nEducation\\n'", SCHOOL, "'\\nPorto Academy\\n  MBA in Trade and Law 2009\\n'",
    )
    + " END"
)
RESUME_FINDS = {
    "full_name": NAME,
    "headline": f"CASE WHEN {PLAIN} THEN 'nothing else is known of this person' ELSE concat('Plans and builds ', lower(c_mktsegment)) END",
    "emails": f"concat('mail', {N}, '@example.org|MAIL', {N}, '@example.net')",
    "phones": f"concat('+1415555', {TAIL})",
    "linkedin": f"concat('https://www.linkedin.com/in/person-', {N})",
    "github": f"concat('GitHub.com/p', {N})",
    "skills": "'Python|SQL|Go'",
    "years_experience": f"CASE WHEN {OPEN} THEN 16.0 ELSE 10.0 END",
    "experience": f"concat({FIRM}, ';Field Lead;', {START}, '-01;', {STOP}, '-01;- ran pumps • fixed valves', "
    f"CASE WHEN {OPEN} THEN concat('|', {SHOP}, ';helper;2020-01;;') ELSE '' END)",
    "education": f"concat({SCHOOL}, ';B.Tech;Physics 2004;2004|Porto Academy;MBA;Trade and Law 2009;2009')",
}
KNOWN_WHEN_PLAIN = ("full_name", "headline")

NOTES = (
    f"CASE WHEN {PLAIN} THEN " + _text("'met at a fair, likes tea\\n'", N) + " ELSE "
    + _text(
        "'Candidate - '", NAME, "'\\nreach: notes'", N, "'@example.org or +1 (415) 555-'", TAIL, "'\\nSkills: Go, Rust | Kafka\\nknows: dbt\\nhas '",
        "cast(1 + c_custkey % 30 AS string)", "'.5+ years of experience\\ncurrently at '", FIRM, "', on the coast\\nwww.github.com/n'", N, "'/\\n'",
        "repeat(concat('more about ', c_name, '; '), 30)",
    )
    + " END"
)
NOTES_FINDS = {
    "full_name": NAME,
    "emails": f"concat('notes', {N}, '@example.org')",
    "phones": f"concat('+1415555', {TAIL})",
    "github": f"concat('www.github.com/n', {N})",
    "skills": "'Go|Rust|Kafka|dbt'",
    "years_experience": "1 + c_custkey % 30 + 0.5",
    "current_company": FIRM,
}


def _list(c):
    return F.when(F.size(c) > 0, F.array_join(c, "|"))


def _blocks(column: str, fields: list[str]):
    items = F.transform(column, lambda x: F.array_join(F.array(*[F.coalesce(x[f], F.lit("")) for f in fields]), ";"))
    return _list(items)


def _texts(spark: SparkSession, sf_dir: str, expression: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/customer.parquet")).select("c_custkey", F.expr(expression).alias("text"))


def resume_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resume extractor over texts written from ``customer``."""
    f = extract_resume(_texts(spark, sf_dir, RESUME), "c_custkey", "text", AS_OF_YEAR).select("record_id", "fields.*")
    return f.select(
        "record_id", "full_name", "headline", _list(F.col("emails")).alias("emails"), _list(normalize_phones(F.col("phones"))).alias("phones"),
        "linkedin", "github", _list(F.col("skills_raw")).alias("skills"), "years_experience",
        _blocks("experience_raw", ["company", "title", "start", "end", "summary"]).alias("experience"),
        _blocks("education_raw", ["institution", "degree", "field", "end_year"]).alias("education"),
    )


def notes_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notes extractor over texts written from ``customer``."""
    f = extract_notes(_texts(spark, sf_dir, NOTES), "c_custkey", "text").select("record_id", "fields.*")
    return f.select(
        "record_id", "full_name", _list(F.col("emails")).alias("emails"), _list(normalize_phones(F.col("phones"))).alias("phones"),
        "github", _list(F.col("skills_raw")).alias("skills"), "years_experience", "current_company", "notes_raw",
    )


def _expected(finds: dict[str, str], plain: tuple[str, ...], more: str = "") -> str:
    columns = [f"{v} AS {k}" if k in plain else f"CASE WHEN NOT ({PLAIN}) THEN {v} END AS {k}" for k, v in finds.items()]
    return f"SELECT cast(c_custkey AS string) AS record_id, {', '.join(columns)}{more} FROM customer"


def oracle_resume_fields() -> str:
    return _expected(RESUME_FINDS, KNOWN_WHEN_PLAIN)


def oracle_notes_fields() -> str:
    return _expected(NOTES_FINDS, (), f", substr({NOTES}, 1, 500) AS notes_raw")
