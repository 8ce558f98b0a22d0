"""JSON documents by file and by line, and what the readers leave out."""

import json

import pytest

from goldrec.sources.files import read_ats_source, write_sources


def names(df):
    return sorted((r["record_id"].rsplit("/", 1)[1], r["fields"]["full_name"] or r["fields"]["emails"][0]) for r in df.collect())


def test_lines_and_whole_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"name": "A1"}, {"candidate": {"name": "A2"}}], indent=1))
    (tmp_path / "b.jsonl").write_text('{"name": "B1"}\n\nbroken\n[{"name": "B2"}, {"email": "b3@x.org"}]\n{"name": "B4"}')
    (tmp_path / "c.ndjson").write_text('{"name": "C1"}\r\n{"name": "C2"}\r\n')
    got = names(read_ats_source(spark, str(tmp_path)))
    assert got == [("a.json#0", "A1"), ("a.json#1", "A2"), ("b.jsonl#0#0", "B1"), ("b.jsonl#3#0", "B2"), ("b.jsonl#3#1", "b3@x.org"), ("b.jsonl#4#0", "B4"), ("c.ndjson#0#0", "C1"), ("c.ndjson#1#0", "C2")]
    assert [n for n, _ in names(read_ats_source(spark, str(tmp_path / "c.ndjson")))] == ["c.ndjson#0#0", "c.ndjson#1#0"]


@pytest.mark.parametrize("size", ["128m", "700b"])
def test_a_large_file_of_lines_is_split(spark, tmp_path, size):
    (tmp_path / "all.json").write_text("\n".join(json.dumps({"name": f"N{i}", "notes": "x" * (i % 50)}) for i in range(500)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = names(read_ats_source(spark, str(tmp_path), lines=True))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted((f"all.json#{i}#0", f"N{i}") for i in range(500))


def test_rejects_say_where_and_why(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "x.csv").write_text("name,email,city\nAnn,,Ulm\n,,Bonn\n\n, ,\"two\nlines\"\nBo,b@x.org,\n")
    (folder / "none.csv.gz").write_bytes(b"not gzip")
    (tmp_path / "d.jsonl").write_text('{"name": "D1"}\n{oops\n"text"\n{"applicant": {"city": "Rom"}}\n[4, {"name": "D2"}]\n')
    (tmp_path / "notes").mkdir()
    (tmp_path / "notes" / "n1.txt").write_text("Name: Eve\n")
    (tmp_path / "notes" / "n2.txt").write_text(" \n\t")
    records, rejects = write_sources(spark, str(tmp_path / "out"), csv=str(folder), ats=str(tmp_path / "d.jsonl"), notes=str(tmp_path / "notes"), resume=str(tmp_path / "missing"))
    assert sorted((r["source"], r["fields"]["full_name"]) for r in records.collect()) == [("ats", "D1"), ("ats", "D2"), ("csv", "Ann"), ("csv", "Bo"), ("notes", "Eve")]
    got = {(r["source"], r["file"].rsplit("/", 1)[1], r["place"]): (r["reason"], r["raw"]) for r in rejects.collect()}
    assert got == {
        ("csv", "x.csv", 1): ("neither name nor e-mail", ",,Bonn"), ("csv", "x.csv", 3): ("neither name nor e-mail", ', ,"two\nlines"'),
        ("csv", "none.csv.gz", None): ("unreadable or empty file", None), ("notes", "n2.txt", 0): ("no text", " \n\t"),
        ("ats", "d.jsonl", 1): ("not valid JSON", "{oops"), ("ats", "d.jsonl", 2): ("not a JSON object", '"text"'),
        ("ats", "d.jsonl", 3): ("neither name nor e-mail", '{"applicant":{"city":"Rom"}}'), ("ats", "d.jsonl", 4): ("not a JSON object", "4"),
    }
