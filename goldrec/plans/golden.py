"""The end-to-end golden-record job.

sources -> resolve (E5/E6) -> merge (G1-G15) -> project (P) -> validate (V)

``keyed`` records feed seven aggregations.  By default they are checkpointed
into the shared checkpoint folder (``spark.checkpoint.dir``): extraction and
matching run once, every aggregation starts from a small plan, and a lost
executor costs a re-read of that folder, not a re-run of extraction and
matching.  ``checkpoint=False`` persists in memory/disk instead.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from goldrec.operators import claims as C
from goldrec.operators.dictionary import read_dictionary
from goldrec.operators.merge import merge_records
from goldrec.operators.project import project
from goldrec.operators.quality import validate
from goldrec.operators.resolve import resolve
from goldrec.session import ensure_checkpoint_dir
from goldrec.sources.files import load_sources


@dataclass
class GoldenResult:
    golden: DataFrame          # projected golden rows (entity_key kept)
    field_claims: DataFrame    # long form of every scalar value
    violations: DataFrame      # entity_key, path, message
    source_status: DataFrame   # a row a source: files and rows found, kept, bad


@contextmanager
def _without_constraints(spark: SparkSession):
    """Constraint propagation over the large extraction expressions fills the heap before any
    task runs; it is off while they are planned, and the session's setting comes back after."""
    key = "spark.sql.constraintPropagation.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def build_golden_from_records(spark: SparkSession, records: DataFrame, config: dict | None = None,
                              region: str = "US", checkpoint: bool = True, dictionary: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    with _without_constraints(spark):
        keyed = resolve(records, materialize=checkpoint)
        if checkpoint:
            ensure_checkpoint_dir(spark)
            keyed = keyed.checkpoint(eager=True)
        else:
            keyed = keyed.persist(StorageLevel.MEMORY_AND_DISK)
            keyed.count()
    golden = merge_records(spark, keyed, region, dictionary)
    projected = project(spark, golden, config)
    return projected, C.field_claims(keyed), validate(projected, config)


def build_golden(spark: SparkSession, csv: str | None = None, ats: str | None = None, resume: str | None = None,
                 notes: str | None = None, config: dict | None = None, as_of_year: int = 2026,
                 region: str = "US", checkpoint: bool = True, skills: str | None = None,
                 ats_lines: bool | str | None = None) -> GoldenResult:
    """``skills``: a text file with the skills dictionary, one name a line; else the built-in one.

    ``ats_lines``: whether the JSON files hold a document a line (None: by their names), or "arrays" that are split.
    """
    dictionary = read_dictionary(spark, skills) if skills else None
    records, status = load_sources(spark, csv=csv, ats=ats, resume=resume, notes=notes, as_of_year=as_of_year, ats_lines=ats_lines)
    golden, claims, viol = build_golden_from_records(spark, records, config, region, checkpoint, dictionary)
    return GoldenResult(golden, claims, viol, status)
