"""Mix sources to target weights by hash-threshold histograms.

Every document has a fixed 60-bit hash.  A source whose target is q times its
size takes all documents floor(q) times and, once more, those whose hash lies
below a threshold.  Thresholds come from histograms, never from a sort: words
are summed by source and bucket of the hash's leading bits, the bucket in which
the budget ends is found, and only its rows are summed again by the next bits.
Budgets are nested: a larger one takes all that a smaller one takes.

Defined results: a null text has size 0; a null source is a source of its own,
ordered last; rows alike in doc_id, source and text are taken or left together;
an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldrec.llm.common import Scratch

WEIGHTS = (5, 2, 1)
MOST = 3  # passes over a source, at most
HASH_BITS = 60
LEVEL_BITS = 12
SPACE = " \t\n\u000b\f\r"


def word_count(text: Column) -> Column:
    """Number of runs of other than ASCII white space; null counts 0."""
    inner = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(inner) > 0, F.size(F.split(inner, r"[\x20\x09-\x0D]+"))).otherwise(0).cast("long")


def document_hash() -> Column:
    text = F.coalesce(F.md5("text"), F.lit("-"))
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("source", F.lit("-")), text)
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(
        "mix",
        F.struct(
            F.col("source").isNull().alias("none"),
            F.coalesce("source", F.lit("")).alias("name"),
            word_count(F.col("text")).alias("size"),
            document_hash().alias("hash"),
        ),
    )


def _sources(sized: DataFrame, weights: tuple[int, ...], scratch: Scratch) -> DataFrame:
    """(none, name, source_size, weight): weights dealt along the sources' order, by ranges of sources in parallel."""
    parts = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    sources = scratch.save(sized.groupBy("none", "name").agg(F.sum("size").alias("source_size")), "sources")
    ranges = sources.repartitionByRange(parts, "none", "name").sortWithinPartitions("none", "name")
    ranges = scratch.save(
        ranges.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "ranges"
    )
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")  # one row a partition
    starts = ranges.groupBy("part").agg(F.count("*").alias("n")).select("part", before.alias("start"))
    rank = (F.col("start") + F.col("place")) % len(weights)
    dealt = ranges.join(F.broadcast(starts), "part").withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank + 1).cast("int")))
    return scratch.save(dealt.select("none", "name", "source_size", "weight"), "weights")


def _level(sources: DataFrame, most: int) -> float:
    """The words per weight at which the targets, stopped at ``most`` times their sources, share all words."""
    total, level, capped = sources.agg(F.sum("source_size")).first()[0] or 0, 0.0, -1
    cap = F.lit(most) * F.col("source_size")
    while True:
        over = cap < F.lit(level) * F.col("weight")
        n, held, free = sources.agg(F.count(F.when(over, 1)), F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight")))).first()
        if n == capped or not free:
            return level
        capped, level = n, (total - (held or 0)) / free


def _thresholds(sized: DataFrame, plan: DataFrame, scratch: Scratch) -> DataFrame:
    """(none, name, cut): hashes below ``cut`` are taken once more; sources without a rest are left out."""
    keys = ["none", "name"]
    open_ = plan.where("rest > 0").select(*keys, "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"))
    rows = sized
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        inside = F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix")
        rows = rows.join(open_.select(*keys, "prefix"), keys).where(inside).drop("prefix")
        rows = scratch.save(rows, "boundary") if shift < HASH_BITS - LEVEL_BITS else rows
        buckets = rows.groupBy(*keys, F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("mass"), F.count(F.when(F.col("size") > 0, 1)).alias("n"))
        so_far = F.sum("mass").over(Window.partitionBy(*keys).orderBy("bucket"))
        ends = buckets.join(open_.drop("prefix"), keys).withColumn("until", F.col("before") + so_far).withColumn("start", F.col("until") - F.col("mass"))
        ends = ends.where("start <= rest and rest < until")
        open_ = scratch.save(ends.select(*keys, "rest", F.col("bucket").alias("prefix"), F.col("start").alias("before"), "mass", "n"), "ends")
        if shift == 0 or not open_.where("n > 1").limit(1).count():
            nearer = (F.col("before") + F.col("mass") - F.col("rest")) < (F.col("rest") - F.col("before"))
            return open_.select(*keys, (F.col("prefix") + nearer.cast("long")).alias("top")).select(*keys, F.shiftleft("top", shift).alias("cut"))
        open_ = open_.select(*keys, "rest", "prefix", "before")
    raise AssertionError("the last level returns")


def _plan(docs: DataFrame, weights: tuple[int, ...], most: int) -> tuple[DataFrame, DataFrame]:
    scratch = Scratch(docs.sparkSession)
    sized = scratch.save(_keyed(docs).select("doc_id", "mix.*"), "sized")
    sources = _sources(sized, weights, scratch)
    target = F.least(F.lit(most) * F.col("source_size"), F.lit(_level(sources, most)) * F.col("weight")).cast("double")
    plan = sources.withColumn("target", target)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("times", times).withColumn("rest", F.col("target") - F.col("times") * F.col("source_size"))
    plan = scratch.save(plan, "plan")
    cuts = _thresholds(sized.select("none", "name", "size", "hash"), plan, scratch)
    plan = plan.join(cuts, ["none", "name"], "left").withColumn("cut", F.coalesce("cut", F.lit(0).cast("long")))
    return sized, scratch.save(plan.select("none", "name", "source_size", "target", "times", "cut"), "cuts")


def _passes(h: str) -> Column:
    return F.col("times") + (F.col(h) < F.col("cut")).cast("long")


def mix_sizes(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row; ``taken`` counts words, repeats included."""
    sized, plan = _plan(docs, weights, most)
    out = sized.join(plan, ["none", "name"])
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * _passes("hash")).alias("taken"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mixed corpus: each row as many times as the mix takes it, with the columns of ``docs``."""
    _, plan = _plan(docs.select("doc_id", "source", "text"), weights, most)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source", "text")
    keyed = _keyed(rows).select("row", "mix.none", "mix.name", "mix.hash")
    out = keyed.join(plan.select("none", "name", "times", "cut"), ["none", "name"]).withColumn("n", _passes("hash")).where("n > 0")
    return out.withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select("row.*")
