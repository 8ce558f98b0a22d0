"""Token-sort ratio and skill canonicalisation."""

import pytest
from pyspark.sql import functions as F

from goldrec.functions.similarity import token_sort_ratio
from goldrec.operators.skills import canonical_skills


def _ratio(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    return df.select(token_sort_ratio(F.col("a"), F.col("b")).alias("r")).first()["r"]


@pytest.mark.parametrize("a,b,expected", [
    ("sql", "mysql", 75.0), ("ReactJS", "React", 83.3333), ("Postgres", "PostgreSQL", 77.7778),
    ("learning machine", "machine learning", 100.0), ("abc", "abc", 100.0), ("abc", "xyz", 0.0),
])
def test_ratio(spark, a, b, expected):
    assert _ratio(spark, a, b) == pytest.approx(expected, abs=1e-3)


def test_normalize(spark):
    raws = ["Python", "python", "machine learning", "Pythn", "Quantum Basketweaving", "  Docker ", ""]
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = {r["raw"]: (r["name"], r["confidence"]) for r in canonical_skills(df).collect()}
    assert got["Python"] == ("Python", 1.0)
    assert got["python"] == ("Python", 1.0)
    assert got["machine learning"] == ("Machine Learning", 1.0)
    assert got["Pythn"][0] == "Python" and 0.5 <= got["Pythn"][1] < 1.0
    assert got["Quantum Basketweaving"] == ("Quantum Basketweaving", 0.5)
    assert got["  Docker "] == ("Docker", 1.0)
    assert got[""] == ("", 0.0)
