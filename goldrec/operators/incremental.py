"""Golden rows kept up to date by increments.

What the merge needs of the records of an entity are states that can be merged
again: its distinct values with how many agree, the best and the first occurrence
and the claims; the sources of its raw skills; the sums of its records.  A store
holds these states as tables, one part a batch:

    <path>/values, <path>/skills, <path>/stats / batch=<id> / bucket=<hash of the entity>

``add_records`` writes a batch's own states, from its records alone; writing a
batch again replaces it, so a batch that is repeated counts once.  ``golden_of``
merges the states of all batches for the entities that a batch has touched, or
for all, and reads only the buckets that hold them.

Entities are those of E5 (the first e-mail; a record without one stands alone):
E6 compares records with each other and needs them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrec.operators.confidence import merged_stats, stats_of, stats_state
from goldrec.operators.merge import assemble_golden, distinct_values, record_values, skill_rows
from goldrec.operators.resolve import resolve
from goldrec.schemas import SOURCE_RECORDS

BUCKETS = 64  # of a store: all its batches take the same number
TABLES = ("values", "skills", "stats")


def _own_states(records: DataFrame, region: str, dictionary: DataFrame | None) -> dict[str, DataFrame]:
    keyed = resolve(records, fallback=False)
    values = distinct_values(record_values(keyed, region, dictionary))
    return {"values": values, "skills": skill_rows(keyed, dictionary).distinct(), "stats": stats_state(keyed)}


def add_records(spark: SparkSession, path: str, records: DataFrame, batch: int, region: str = "US", dictionary: DataFrame | None = None) -> None:
    """Add the source_records of one batch to the store; a batch that is there is replaced."""
    for name, state in _own_states(records, region, dictionary).items():
        _write(state, f"{path}/{name}/batch={batch}")


def _write(state: DataFrame, path: str) -> None:
    """By buckets, each in a few files.  Buckets are met by a hash, cut where they are large: ranges would be
    sampled first, which works out the whole state twice."""
    state = state.withColumn("bucket", F.pmod(F.xxhash64("entity_key"), F.lit(BUCKETS)).cast("int"))
    state.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def _states(spark: SparkSession, path: str, batch: int | None) -> dict[str, DataFrame]:
    # a table may hold no file, so its columns are stated
    kinds = {name: state.schema for name, state in _own_states(spark.createDataFrame([], SOURCE_RECORDS), "US", None).items()}
    parts = [T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())]
    tables = {name: spark.read.schema(T.StructType([*kinds[name].fields, *parts])).parquet(f"{path}/{name}") for name in TABLES}
    if batch is None:
        return tables
    touched = tables["stats"].where(F.col("batch") == batch).select("entity_key", "bucket").distinct()
    buckets = [r["bucket"] for r in touched.select("bucket").distinct().collect()]  # BUCKETS at most
    return {name: t.where(F.col("bucket").isin(buckets)).join(touched.select("entity_key"), "entity_key", "left_semi") for name, t in tables.items()}


def _merged_values(values: DataFrame) -> DataFrame:
    return values.groupBy("entity_key", "part", "k1", "k2").agg(
        F.sum("agree").alias("agree"), F.min("top").alias("top"), F.min("first").alias("first"),
        F.array_distinct(F.flatten(F.collect_list("claims"))).alias("claims"),
    )


def golden_of(spark: SparkSession, path: str, batch: int | None = None) -> DataFrame:
    """Golden rows, as ``merge_records`` gives them, of the entities that ``batch`` touched, over all batches; None: of all entities."""
    states = _states(spark, path, batch)
    return assemble_golden(stats_of(merged_stats(states["stats"])), _merged_values(states["values"]), states["skills"].select("entity_key", "raw", "key", "source").distinct())


def compact(spark: SparkSession, path: str, out: str) -> None:
    """The store with all batches merged to batch 0, written to ``out``."""
    states = _states(spark, path, None)
    merged = {"values": _merged_values(states["values"]), "skills": states["skills"].select("entity_key", "raw", "key", "source").distinct(), "stats": merged_stats(states["stats"])}
    for name, state in merged.items():
        _write(state, f"{out}/{name}/batch=0")
