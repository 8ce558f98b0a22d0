"""Country search: names in part, misspelt names and subdivisions.

``normalize_country`` knows aliases, codes and whole names.  What it leaves is
looked up by steps, and the first that finds something decides:

1. the whole name of a subdivision (ISO 3166-2) gives its country;
2. the words of the text, in an index of the words of countries' names: all must
   stand in one name, and one of them, of ``TELLING`` letters or more, in no more
   than ``COMMON`` names; of several names the one with the fewest other words wins,
   then the first in the list;
3. the token-sort ratio with whole names and subdivisions, from ``CUTOFF`` on and
   for texts of ``LEAST`` letters or more; the best wins, then the first in the list.

Distinct texts are looked up once and joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from goldrec.functions.locations import normalize_country
from goldrec.functions.strings import py_strip
from goldrec.operators.dictionary import similar_names
from goldrec.sources.dims import country_rows, subdivision_rows

COMMON = 3  # names that may share a word which still tells them
TELLING = 4
CUTOFF = 88
LEAST = 5
WORD_GAP = r"[^\p{L}\p{N}]+"


def country_names(spark: SparkSession) -> DataFrame:
    """(pos, name, country): countries, then subdivisions; lower-case."""
    rows = [(name.lower(), code) for code, name in [*country_rows(), *subdivision_rows()]]
    known: dict[str, str] = {}
    for name, code in rows:
        known.setdefault(name, code)
    return spark.createDataFrame([(i, n, c) for i, (n, c) in enumerate(known.items())], "pos long, name string, country string")


def _words(c):
    return F.array_remove(F.array_distinct(F.split(c, WORD_GAP)), "")


def search_countries(df: DataFrame, col: str = "raw") -> DataFrame:
    """``df`` with country (ISO alpha-2 or null) and method (exact, subdivision, words, fuzzy or null) of the text in ``col``."""
    spark = df.sparkSession
    names = country_names(spark)
    n_countries = len({name.lower() for _, name in country_rows()})
    texts = df.select(py_strip(F.col(col)).alias("text")).where("text <> ''").distinct()
    texts = texts.withColumns({"exact": normalize_country(F.col("text")), "low": F.lower("text")})
    rest = texts.where("exact is null").select("text", "low")

    parts = names.where(F.col("pos") >= n_countries).select(F.col("name").alias("low"), F.col("country").alias("part"))
    rest = rest.join(parts, "low", "left")
    open_ = rest.where("part is null").select("text", "low")

    index = names.where(F.col("pos") < n_countries).select("pos", "country", F.size(_words(F.col("name"))).alias("size"), F.explode(_words(F.col("name"))).alias("word"))
    held = index.groupBy("word").agg(F.count("*").alias("names"))
    asked = open_.select("text", _words(F.col("low")).alias("words")).select("text", F.size("words").alias("n"), F.explode("words").alias("word"))
    met = asked.join(index.join(held, "word"), "word").groupBy("text", "n", "pos", "country", "size").agg(F.count("*").alias("hits"), F.min(F.when(F.length("word") >= TELLING, F.col("names"))).alias("rarest"))
    first = F.row_number().over(Window.partitionBy("text").orderBy("size", "pos"))
    by_words = met.where((F.col("hits") == F.col("n")) & (F.col("rarest") <= COMMON)).withColumn("r", first).where("r = 1").select("text", F.col("country").alias("worded"))

    spelt = open_.join(by_words, "text", "left_anti").where(F.length("low") >= LEAST).select(F.col("low").alias("text")).distinct()
    close = similar_names(spelt, names, CUTOFF).join(names.select("name", "country"), "name").select(F.col("text").alias("low"), F.col("country").alias("close"))

    found = texts.join(rest.select("text", "part"), "text", "left").join(by_words, "text", "left").join(close, "low", "left")
    known = F.coalesce("exact", "part", "worded", "close")
    method = F.when(F.col("exact").isNotNull(), "exact").when(F.col("part").isNotNull(), "subdivision").when(F.col("worded").isNotNull(), "words").when(F.col("close").isNotNull(), "fuzzy")
    found = found.select(F.col("text").alias("_t"), known.alias("country"), method.alias("method"))
    return df.join(found, py_strip(F.col(col)) == F.col("_t"), "left").drop("_t")
