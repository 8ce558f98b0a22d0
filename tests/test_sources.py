"""Folders of exports: headers of their own, repeated headers, broken files, stable ids."""

import gzip


from goldrec.functions.phones import normalize_phone
from goldrec.sources.files import load_sources, read_csv_source

from conftest import one_col


def write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def by_name(df):
    return {r["fields"]["full_name"]: r for r in df.collect()}


def test_each_file_has_its_own_header(spark, tmp_path):
    path = write(
        tmp_path / "in",
        a="name,email,phone\nAda Nowak,ada@example.org,+1 415 555 2671\n",
        b="email,phone,name\nbo@example.org,+1 415 555 2672,Bo Ray\n",
        c='﻿Name , E-mail,email\n"Cy\nLong",x,cy@example.org\n',
    )
    got = by_name(read_csv_source(spark, path))
    assert got["Bo Ray"]["fields"]["emails"] == ["bo@example.org"]
    assert got["Bo Ray"]["fields"]["phones"] == ["+1 415 555 2672"]
    assert got["Ada Nowak"]["fields"]["phones"] == ["+1 415 555 2671"]
    assert got["Cy\nLong"]["fields"]["emails"] == ["cy@example.org"]


def test_repeated_headers(spark, tmp_path):
    path = write(tmp_path / "in", a="Email,email,name\nx@example.org,,Di Vale\n,y@example.org,Ed Moor\n")
    got = by_name(read_csv_source(spark, path))
    assert got["Di Vale"]["fields"]["emails"] == ["x@example.org"]
    assert got["Ed Moor"]["fields"]["emails"] == ["y@example.org"]


def test_ids_stay_when_files_arrive(spark, tmp_path):
    text = "name,email\nA,a@example.org\n,\nB,b@example.org\n"
    path = write(tmp_path / "in", m=text)
    before = {k: r["record_id"] for k, r in by_name(read_csv_source(spark, path)).items()}
    write(tmp_path / "in", a=text.replace("A,", "C,").replace("B,", "D,"), z="name\nE\n")
    after = {k: r["record_id"] for k, r in by_name(read_csv_source(spark, path)).items()}
    assert before.items() <= after.items() and len(after) == 5 == len(set(after.values()))
    assert before["B"].endswith("m.csv#2")
    first = by_name(read_csv_source(spark, path, first_per_file=True))
    assert set(first) == {"A", "C", "E"}


def test_broken_file_is_skipped_and_counted(spark, tmp_path):
    path = write(tmp_path / "in", good="name,email\nA,a@example.org\n,,\n")
    (tmp_path / "in" / "bad.csv.gz").write_bytes(b"no gzip at all")
    (tmp_path / "in" / "fine.csv.gz").write_bytes(gzip.compress(b"name\nB\n"))
    records, status = load_sources(spark, csv=path, ats=str(tmp_path / "none"))
    assert {r["fields"]["full_name"] for r in records.collect()} == {"A", "B"}
    rows = {r["source"]: r.asDict() for r in status.collect()}
    assert rows["csv"] == {"source": "csv", "path": path, "found": True, "files": 3, "files_bad": 1, "rows_in": 3, "rows_kept": 2, "rows_bad": 1}
    assert rows["ats"]["found"] is False and rows["ats"]["files"] == rows["ats"]["rows_kept"] == 0
    records, status = load_sources(spark)
    assert records.count() == status.count() == 0


def test_phones_of_all_countries(spark):
    raw = {
        "+998 90 123 45 67": "+998901234567",
        "+370 612 34567": "+37061234567",
        "+385 91 234 5678": "+385912345678",
        "+421 903 123 456": "+421903123456",
        "+260 97 1234567": "+260971234567",
        "+593 99 123 4567": "+593991234567",
        "+974 3312 3456": "+97433123456",
        "(+91) 98765 43210": "+919876543210",
        "+1 415 555 2671 ext 5": "+14155552671",
        "+1 415 555 2671 x12": "+14155552671",
        "415-555-2671;ext=9": "+14155552671",
        "+44 (0)20 7946 0958": "+442079460958",
        "+999 12345678": None,
        "+210 1234567": None,
        "+998 1": None,
        "+3706123456789012": None,
    }
    assert dict(zip(raw, one_col(spark, list(raw), normalize_phone))) == raw
