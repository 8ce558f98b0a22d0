"""The corpus pipeline: documents in; good, distinct, secret-free, mixed and tokenised documents out.

Every stage takes (spark, docs, sf_dir) and calls one operator over all rows
that the stage before it kept; all but the last return the columns of
``documents``.

Defined results: null texts pass as empty ones and stay null; of rows that
repeat, whatever their doc_id, near-dedup keeps one; the mix repeats a row as
often as it takes it; an empty table gives an empty result; columns beside those
of ``documents`` are carried along up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from goldrec.llm.common import Scratch, table
from goldrec.llm.mixing import mix_documents
from goldrec.llm.quality import keep_good
from goldrec.llm.secret_scan import redact_documents
from goldrec.llm.sentencepiece_codec import encode_documents
from goldrec.llm.simhash import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every SimHash component: the smallest doc_id's, by a total order of its rows."""
    return keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return redact_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token ids, with parity and round trip checked for every row."""
    return encode_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("mixing to target weights", mixing),
    ("SentencePiece encoding", tokens),
]

#: The classifier's fit, XXH64 and the tokeniser have no DuckDB counterpart; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a table in the shared folder."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
