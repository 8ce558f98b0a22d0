"""The elements of large JSON arrays, read by many tasks.

A file that holds one array is read as pieces that end at a closing brace, which
Spark splits into blocks.  Whether a piece begins inside a string follows from the
quotes before it, how deep it stands from the brackets outside strings; both are
running sums, taken inside every block and over one row a block.  A piece whose
brace closes back to the array ends an element, and the pieces of an element are
joined.  So no array has to fit a row or a task, and a broken element with as many
closing as opening brackets leaves the others whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from goldrec.session import broadcast_if_few, ensure_checkpoint_dir

END = "}"


def _count(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def _pieces(spark: SparkSession, path: str, names: str) -> DataFrame:
    """(file, block, pos, value, quotes, out, inside): brackets opened less those closed, outside strings, if the piece begins outside or inside one."""
    rows = spark.read.option("lineSep", END).option("ignoreCorruptFiles", "true").option("pathGlobFilter", names).text(path)
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), "value")
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"', -1)
    rows = rows.withColumn("parts", parts)

    def depth(odd: int) -> Column:
        text = F.array_join(F.filter("parts", lambda _, i: i % 2 == odd), "")
        return _count(text, "[{") - _count(text, "]")

    return rows.select("file", "block", "pos", "value", (F.size("parts") - 1).alias("quotes"), depth(0).alias("out"), depth(1).alias("inside"))


def array_elements(spark: SparkSession, path: str, names: str = "*") -> DataFrame:
    """(file, line, value): the elements of each file's array by number; what stands between objects goes with the object behind it.

    ``value`` is the text of a JSON array: of one element, or of several if some of them are no objects.
    """
    ensure_checkpoint_dir(spark)
    rows = _pieces(spark, path, names)
    inside, over = Window.partitionBy("file", "block").orderBy("pos"), Window.partitionBy("file").orderBy("block")
    # the last piece of a file is not ended by a brace
    rows = rows.withColumn("last", F.lead("pos").over(inside).isNull())
    rows = rows.withColumn("quoted", F.sum("quotes").over(inside) - F.col("quotes"))

    def change(begins: int) -> Column:
        starts, ends = F.pmod(F.col("quoted") + begins, F.lit(2)), F.pmod(F.col("quoted") + F.col("quotes") + begins, F.lit(2))
        return F.when(starts == 0, F.col("out")).otherwise(F.col("inside")) - F.when(ends == 0, 1).otherwise(0)

    rows = rows.withColumns({"change0": change(0), "change1": change(1)}).checkpoint()
    blocks = rows.groupBy("file", "block").agg(*[F.sum(c).alias(f"b_{c}") for c in ("quotes", "change0", "change1")])
    blocks = blocks.withColumn("odd", F.pmod(F.sum("b_quotes").over(over) - F.col("b_quotes"), F.lit(2)))
    blocks = blocks.withColumn("b_change", F.when(F.col("odd") == 0, F.col("b_change0")).otherwise(F.col("b_change1")))
    blocks = blocks.withColumn("depth", F.sum("b_change").over(over) - F.col("b_change")).withColumn("final", F.lead("block").over(over).isNull())

    rows = rows.join(broadcast_if_few(blocks.select("file", "block", "odd", "depth", "final").checkpoint()), ["file", "block"])
    mine = F.when(F.col("odd") == 0, F.col("change0")).otherwise(F.col("change1"))
    rows = rows.withColumn("after", F.col("depth") + F.sum(mine).over(inside))
    closed = F.pmod(F.col("quoted") + F.col("quotes") + F.col("odd"), F.lit(2)) == 0
    rows = rows.withColumn("end", F.when(closed & (F.col("after") == 1) & ~(F.col("last") & F.col("final")), 1).otherwise(0))
    rows = rows.withColumn("ends", F.sum("end").over(inside) - F.col("end"))
    counts = rows.groupBy("file", "block").agg(F.sum("end").alias("n"))
    counts = counts.select("file", "block", (F.sum("n").over(over) - F.col("n")).alias("earlier"))
    rows = rows.join(counts, ["file", "block"]).withColumn("line", F.col("earlier") + F.col("ends"))

    piece = F.struct("block", "pos", F.concat("value", F.when(F.col("last") & F.col("final"), "").otherwise(END)).alias("value"))
    elements = rows.groupBy("file", "line").agg(F.array_sort(F.collect_list(piece)).alias("p"), F.max(F.col("last") & F.col("final")).alias("tail"))
    text = F.array_join(F.transform("p", lambda p: p["value"]), "")
    text = F.when(F.col("line") == 0, F.regexp_replace(text, r"^﻿?\s*\[", "")).otherwise(F.regexp_replace(text, r"^\s*,", ""))
    text = F.when(F.col("tail"), F.regexp_replace(text, r"\]\s*$", "")).otherwise(text)
    elements = elements.select("file", "line", text.alias("text")).where(F.col("text").rlike(r"[^\s,]"))
    return elements.select("file", "line", F.concat(F.lit("["), "text", F.lit("]")).alias("value"))
