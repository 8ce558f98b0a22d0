"""File-stream ingestion runs the batch extractors incrementally."""

import os
import shutil

from conftest import FIXTURES

from goldrec.streaming.ingest import start_ingest


def test_notes_stream(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    shutil.copy(os.path.join(FIXTURES, "notes.txt"), landing / "a.txt")
    q = start_ingest(spark, str(landing), "notes", str(tmp_path / "out"), str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(300)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == 1 and rows[0]["fields"]["full_name"] == "Maya Rodriguez"


def test_restart_takes_new_files_only(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()
    for i, name in enumerate(["a.txt", "b.txt", "c.txt"], 1):
        (landing / name).write_text(f"Name: Person {name[0].upper()}\nEmail: {name[0]}@example.org\n")
        start_ingest(spark, str(landing), "notes", out, available_now=True).awaitTermination(300)
        emails = sorted(r["fields"]["emails"][0] for r in spark.read.parquet(out).collect())
        assert emails == [f"{c}@example.org" for c in "abc"[:i]]
