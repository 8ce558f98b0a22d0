"""Incremental ingestion of source files with Structured Streaming.

The reference processes a fixed set of files per run; at scale new source
files keep arriving.  This job runs the *same* extraction operators (A3, A5,
A6) on a file stream: each new file becomes ``source_records`` rows appended
to a parquet table.  Extraction is per document, so the stream holds no state;
the checkpoint (beside the table, the same at every start) gives exactly-once
output across restarts and lost executors.  The batch job (J1) then reads the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from goldrec.operators.incremental import add_records, golden_of
from goldrec.sources.files import ats_records_from_text, extract_notes, extract_resume


def _stream(spark: SparkSession, landing: str, max_files: int) -> DataFrame:
    return (
        spark.readStream.format("text").option("wholetext", "true").option("maxFilesPerTrigger", max_files)
        .load(landing)
        .select(F.col("_metadata.file_path").alias("file"), "value")
    )


def source_record_stream(spark: SparkSession, landing: str, kind: str, as_of_year: int = 2026,
                         max_files: int = 1000) -> DataFrame:
    """Streaming ``source_records`` for files of one kind: 'ats', 'resume' or 'notes'."""
    docs = _stream(spark, landing, max_files)
    if kind == "ats":
        return ats_records_from_text(docs, "file", "value")
    if kind == "resume":
        return extract_resume(docs, "file", "value", as_of_year)
    if kind == "notes":
        return extract_notes(docs, "file", "value")
    raise ValueError(f"unknown source kind {kind!r}")


def start_ingest(spark: SparkSession, landing: str, kind: str, table_path: str, checkpoint: str | None = None,
                 available_now: bool = False, as_of_year: int = 2026) -> StreamingQuery:
    """Append extracted records of new files under ``landing`` to parquet at ``table_path``.

    ``checkpoint`` defaults to a folder beside the table.  It must be the same
    at every start: a new one would begin again at batch 0, which the table's
    log already holds, and files would be lost.
    """
    checkpoint = checkpoint or f"{table_path.rstrip('/')}-checkpoint-{kind}"
    w = (
        source_record_stream(spark, landing, kind, as_of_year).writeStream.format("parquet")
        .option("path", table_path).option("checkpointLocation", checkpoint).outputMode("append")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_golden(spark: SparkSession, landing: str, kind: str, store: str, golden: str, checkpoint: str | None = None,
                 available_now: bool = False, as_of_year: int = 2026) -> StreamingQuery:
    """Keep golden rows up to date: every trigger adds the new files' records to the store (``operators/incremental.py``)
    and writes the golden rows of the entities they touch to ``golden``/batch=<id>.

    A trigger that is repeated after a failure replaces its own batch.  An entity's
    current row is the one of its largest batch.  One store takes one stream.
    """

    def add(records: DataFrame, batch: int) -> None:
        add_records(spark, store, records, batch)
        golden_of(spark, store, batch).write.mode("overwrite").parquet(f"{golden}/batch={batch}")

    checkpoint = checkpoint or f"{store.rstrip('/')}-checkpoint-{kind}"
    w = source_record_stream(spark, landing, kind, as_of_year).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
