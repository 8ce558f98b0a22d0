"""Splitting CSV files whose quoted cells hold line breaks."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from goldrec.sources.csv_lines import combined, line_effect, read_lines
from goldrec.sources.files import read_csv_source


def plain_state(text: str) -> bool:
    """Whether ``text`` ends inside a quoted cell, character by character."""
    start, inside, i = True, False, 0
    while i < len(text):
        c = text[i]
        if inside:
            if c == '"':
                if text[i + 1 : i + 2] == '"':
                    i += 1
                else:
                    inside = False
            start = False
        elif start and c == '"':
            inside = True
        else:
            start = c in ",\n"
        i += 1
    return inside


@given(st.lists(st.text('ab",', max_size=8), min_size=1, max_size=8))
@settings(max_examples=500, deadline=None)
def test_effects_add_up(lines):
    whole, inside = 0, False
    for n, line in enumerate(lines):
        effect = line_effect(line)
        whole = combined(whole, effect)
        inside = effect in ((0, 3) if inside else (1, 3))
        assert inside == plain_state("\n".join(lines[: n + 1]))
    assert (whole in (1, 3)) == inside


def cell(rng: random.Random) -> str:
    kind = rng.random()
    if kind < 0.25:
        return "".join(rng.choice('xy",\n é') for _ in range(rng.randint(1, 12)))
    return rng.choice(["plain", "two words", 'with "quotes"', "a,b", "", "over\nlines", "stray\" mark"])


def export(rng: random.Random, rows: int) -> tuple[str, list[tuple]]:
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
    writer.writerow(["name", "e-mail", "title", "summary", "email"])
    kept = []
    for i in range(rows):
        row = [f"N{i}", "x", cell(rng), cell(rng), f"n{i}@x.org"]
        kept.append((f"N{i}", row[2].strip() or None, row[3].strip() or None))
        writer.writerow(row)
        if rng.random() < 0.02:
            out.write("\n")
    return out.getvalue(), kept


def found(spark, path, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        blocks = read_lines(spark, path).select("file", "block").distinct().count()
        rows = read_csv_source(spark, path).collect()
        first = read_csv_source(spark, path, first_per_file=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return blocks, {r["record_id"]: (r["fields"]["full_name"], r["fields"]["headline"], r["fields"]["summary"]) for r in rows}, {r["fields"]["full_name"] for r in first}


@pytest.mark.parametrize("seed", range(3))
def test_one_file_over_many_tasks(spark, tmp_path, seed):
    rng = random.Random(seed)
    wanted = []
    for n in range(2):
        text, kept = export(rng, 400)
        (tmp_path / f"f{n}.csv").write_bytes((["", "﻿"][n] + text).encode())
        wanted += kept
    one, whole, first = found(spark, str(tmp_path), "128m")
    many, cut, again = found(spark, str(tmp_path), "1500b")
    assert one == 2 and many > 10
    assert cut == whole and first == again == {"N0"}
    assert sorted(whole.values(), key=str) == sorted(wanted, key=str)
    assert len(whole) == 800


def test_a_header_and_a_cell_over_several_blocks(spark, tmp_path):
    long = "\n".join(f"line {i} of a long, quoted cell" for i in range(400))
    (tmp_path / "a.csv").write_text(f'"Full\nName",name,"email"\nx,Ann,"ann@x.org"\n,Bea,"{long}"\n,Cy,cy@x.org\n')
    for size in ("128m", "1k"):
        rows = read_csv_source_at(spark, str(tmp_path), size)
        assert rows == {1: ("Ann", ["ann@x.org"]), 2: ("Bea", [long]), 402: ("Cy", ["cy@x.org"])}


def read_csv_source_at(spark, path, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        rows = read_csv_source(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return {int(r["record_id"].rsplit("#", 1)[1]): (r["fields"]["full_name"], r["fields"]["emails"]) for r in rows}


def test_files_without_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,email\n")
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text("name,email\r\nDee,\r\n\r\n")
    rows = read_csv_source(spark, str(tmp_path)).collect()
    assert [r["fields"]["full_name"] for r in rows] == ["Dee"]
