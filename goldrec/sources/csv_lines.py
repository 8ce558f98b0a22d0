"""CSV files as records, read by many tasks also where quoted cells hold line breaks.

A file is read as lines, which Spark splits into blocks.  Whether a line begins
inside a quoted cell depends on all lines before it, but what a line does to that
state does not: it keeps it, turns it round or sets it.  So

1. one pass sums up every block - number of lines, first line, and what the block
   as a whole does to the state; one row a block;
2. running over the blocks of a file, these sums give each block's first line
   number and the state it begins in;
3. lines of blocks that begin outside quotes and leave no cell open are records
   as they stand; in the other blocks the same running over the lines shows where
   records start, and the lines of a record are joined.

A record's place is its first line's number in the file, whatever the blocks are.
A quote opens a cell only at its start; a doubled quote inside is a quote.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from goldrec.session import broadcast_if_few, ensure_checkpoint_dir

BOM = "﻿"
KEEPS, TURNS, CLOSES, OPENS = 0, 1, 2, 3  # what a line does to "inside a quoted cell"
BLOCKS = "file string, block long, first long, n long, head string, effect int, quiet boolean"


def _close(line: str, at: int) -> int:
    """The quote that ends a quoted cell, or -1."""
    while (q := line.find('"', at)) >= 0:
        if line[q + 1 : q + 2] != '"':
            return q
        at = q + 2
    return -1


def _open_after(line: str, at: int) -> bool:
    """Whether ``line``, read from the start of a cell on, ends inside a quoted cell."""
    while True:
        if line[at : at + 1] == '"':
            q = _close(line, at + 1)
            if q < 0:
                return True
            at = q + 1
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1


def line_effect(line: str) -> int:
    outside = _open_after(line.lstrip(BOM), 0)
    q = _close(line, 0)
    comma = line.find(",", q + 1) if q >= 0 else -1
    inside = q < 0 or (comma >= 0 and _open_after(line, comma + 1))
    return {(False, True): KEEPS, (True, False): TURNS, (False, False): CLOSES, (True, True): OPENS}[outside, inside]


def combined(first: int, then: int) -> int:
    """The effect of one after the other."""
    if then != TURNS:
        return first if then == KEEPS else then
    return {KEEPS: TURNS, TURNS: KEEPS, CLOSES: OPENS, OPENS: CLOSES}[first]


class _Block:
    """What is known of a block while its lines stream past."""

    def __init__(self, first: int) -> None:
        self.first, self.n, self.effect, self.quiet = first, 0, KEEPS, True
        self.head: list[str] = []  # the lines of its first record, if it begins outside quotes
        self.head_ends = False

    def take(self, effect: int) -> None:
        self.effect = combined(self.effect, effect)
        self.quiet = self.quiet and effect in (KEEPS, CLOSES)

    def add(self, values, a: int, z: int, quoted: list[int]) -> None:
        """Lines a to z of ``values``, of which ``quoted`` hold a quote."""
        self.n += z - a
        effects = {i: line_effect(values[i].as_py()) for i in quoted if a <= i < z}
        for effect in effects.values():
            self.take(effect)
        while not self.head_ends and a < z:
            effect = effects.get(a, KEEPS)
            self.head_ends = effect in (CLOSES, TURNS if self.head else KEEPS)
            self.head.append(values[a].as_py())
            a += 1


def _sum_up(batches: Iterator) -> Iterator:
    """Lines (file, block, pos, value) in their order -> BLOCKS."""
    import pyarrow as pa
    import pyarrow.compute as pc

    blocks: dict[tuple, _Block] = {}
    for b in batches:
        files, starts, places, values = (b.column(i) for i in range(4))
        quoted = pc.indices_nonzero(pc.match_substring(values, '"')).to_pylist()
        keys = list(zip(files.to_pylist(), starts.to_pylist()))
        cuts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
        for a, z in zip(cuts, [*cuts[1:], len(keys)]):
            if keys[a] not in blocks:
                blocks[keys[a]] = _Block(places[a].as_py())
            blocks[keys[a]].add(values, a, z, quoted if len(cuts) == 1 else [q for q in quoted if a <= q < z])
    rows = [(*key, x.first, x.n, "\n".join(x.head), x.effect, x.quiet) for key, x in blocks.items()]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_()]
    columns = list(zip(*rows)) or [[]] * len(kinds)
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "block", "first", "n", "head", "effect", "quiet"])


def _inside_before(effect: Column, window) -> tuple[Column, Column]:
    """(whether all before sets the state, to what; whether it turns it an odd number of times since)."""
    sets = F.when(effect.isin(CLOSES, OPENS), effect == OPENS)
    turned = F.sum(F.when(effect == TURNS, 1).otherwise(0)).over(window)
    return sets, turned


def _state(df: DataFrame, by: list[str], order: str, begins: Column) -> DataFrame:
    """``df`` with ``inside``: the state before each row; ``begins`` is the state before the first of its group."""
    upto = Window.partitionBy(*by).orderBy(order)
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    sets, turned = _inside_before(F.col("effect"), upto)
    df = df.withColumn("_turned", turned)
    df = df.withColumn("_set", F.when(sets.isNotNull(), F.struct(sets.alias("to"), F.col("_turned").alias("at"))))
    last, turns = F.last("_set", ignorenulls=True).over(before), F.coalesce(F.max("_turned").over(before), F.lit(0))
    df = df.withColumns({"_last": last, "_turns": turns})
    odd = F.pmod(F.col("_turns") - F.coalesce("_last.at", F.lit(0)), F.lit(2)) == 1
    return df.withColumn("inside", F.coalesce("_last.to", begins) != odd).drop("_turned", "_set", "_last", "_turns")


def read_lines(spark: SparkSession, path: str, names: str = "*") -> DataFrame:
    """(file, block, pos, value) of the files named like ``names``; pos rises with the lines of a block."""
    lines = spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", "true").option("pathGlobFilter", names).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), "value"
    )


def blocks_of(lines: DataFrame) -> DataFrame:
    """(file, block, first, n, head, line, inside, plain) of every block: one row a block, checkpointed.

    ``line`` is the number of the block's first line in its file; lines of a
    ``plain`` block are records as they stand.
    """
    ensure_checkpoint_dir(lines.sparkSession)
    blocks = lines.mapInArrow(_sum_up, BLOCKS)
    blocks = _state(blocks, ["file"], "block", F.lit(False))
    upto = Window.partitionBy("file").orderBy("block")
    blocks = blocks.withColumn("line", F.sum("n").over(upto) - F.col("n"))
    return blocks.withColumn("plain", F.col("quiet") & ~F.col("inside")).drop("effect", "quiet").checkpoint()


def numbered_lines(spark: SparkSession, path: str, names: str = "*") -> DataFrame:
    """(file, line, value) of every line of the files, numbered from 0 in each."""
    lines = read_lines(spark, path, names)
    blocks = lines.groupBy("file", "block").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
    ensure_checkpoint_dir(spark)
    blocks = blocks.withColumn("line", F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")).checkpoint()
    placed = lines.join(broadcast_if_few(blocks), ["file", "block"])
    return placed.select("file", (F.col("line") + F.col("pos") - F.col("first")).alias("line"), "value")


def _joined(lines: DataFrame) -> DataFrame:
    """Records of blocks with cells that hold line breaks; lines: file, block, line, value, begins."""

    @F.pandas_udf("int")
    def effects(values):
        return values.map(line_effect)

    effect = F.when(F.contains("value", F.lit('"')), effects("value")).otherwise(KEEPS)
    lines = _state(lines.withColumn("effect", effect), ["file", "block"], "line", F.col("begins"))
    start = F.last(F.when(~F.col("inside"), F.col("line")), ignorenulls=True).over(Window.partitionBy("file", "block").orderBy("line"))
    lines = lines.withColumn("start", start)
    # what goes on from a block before: one row a block shows where it began
    starts = lines.groupBy("file", "block").agg(F.max("start").alias("last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("file", "block", F.last("last", ignorenulls=True).over(before).alias("earlier"))
    lines = lines.join(starts, ["file", "block"]).withColumn("start", F.coalesce("start", "earlier"))
    parts = lines.groupBy("file", F.col("start").alias("line")).agg(F.array_sort(F.collect_list(F.struct("line", "value"))).alias("parts"))
    return parts.select("file", "line", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"))


def _clean(value: Column) -> Column:
    return F.regexp_replace(value, "\r$", "")


def csv_records(spark: SparkSession, path: str, multiline: bool = True) -> tuple[DataFrame, DataFrame]:
    """((file, line, value) of the records after the header, (file, header)).

    ``line`` is the number of a record's first line, from 0 after the header's
    first line.  Without ``multiline`` every line is a record.
    """
    lines = read_lines(spark, path)
    blocks = blocks_of(lines)
    head = F.col("head") if multiline else F.split("head", "\n", 2)[0]
    heads = blocks.where("block = 0").select("file", F.ltrim(_clean(head), F.lit(BOM)).alias("header"))
    placed = lines.join(broadcast_if_few(blocks.drop("head")), ["file", "block"]).withColumn("line", F.col("line") + F.col("pos") - F.col("first"))
    records = placed.where("plain") if multiline else placed
    records = records.select("file", "line", "value")
    if multiline and not blocks.where("not plain").isEmpty():
        broken = placed.where("not plain").select("file", "block", "line", "value", F.col("inside").alias("begins"))
        records = records.unionByName(_joined(broken))
    records = records.where("line > 0").select("file", (F.col("line") - 1).alias("line"), _clean(F.col("value")).alias("value"))
    return records.where("value <> ''"), heads


# by value: workers need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
