"""Large JSON arrays over many tasks."""

import json
import random

import pytest

from goldrec.sources.files import read_ats_source, write_sources
from goldrec.sources.json_arrays import array_elements


def sized(spark, size, run):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        return run()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def value(rng, deep=0):
    kind = rng.random()
    if deep < 3 and kind < 0.25:
        return {rng.choice(["a", "b}", 'c"', "d\\"]): value(rng, deep + 1) for _ in range(rng.randint(0, 3))}
    if deep < 3 and kind < 0.4:
        return [value(rng, deep + 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([1, None, True, "", "plain", "}", "]}", '"', '\\"}', "{[", "é\n}", "back\\", ","])


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("size", ["128m", "150b"])
def test_elements_are_those_of_the_array(spark, tmp_path, size, indent):
    rng = random.Random(3)
    wanted = {}
    for n in range(3):
        items = [{"n": i, "v": value(rng)} for i in range(120 if n else 0)]
        wanted[f"f{n}.json"] = items
        (tmp_path / f"f{n}.json").write_text(json.dumps(items, indent=indent, ensure_ascii=n == 1))
    rows = sized(spark, size, lambda: array_elements(spark, str(tmp_path)).collect())
    got = {name: [] for name in wanted}
    for r in sorted(rows, key=lambda r: (r["file"], r["line"])):
        got[r["file"].rsplit("/", 1)[1]] += json.loads(r["value"])
    assert got == wanted


def test_a_broken_element_leaves_the_others(spark, tmp_path):
    good = [json.dumps({"name": f"N{i}", "notes": "x}" * (i % 3)}) for i in range(200)]
    good[50] = '{"name": oops, "x": {"y": }}'
    good[70] = '7, {"name": "N70"}, "text"'
    (tmp_path / "a.json").write_text("﻿[" + ",\n".join(good) + ", 8]\n")
    records, rejects = sized(spark, "300b", lambda: write_sources(spark, str(tmp_path / "out"), ats=str(tmp_path / "a.json"), ats_lines="arrays"))
    assert sorted(r["fields"]["full_name"] for r in records.collect()) == sorted(f"N{i}" for i in range(200) if i != 50)
    got = sorted((r["place"], r["reason"], r["raw"]) for r in rejects.collect())
    assert [g[1] for g in got] == ["not valid JSON", "not a JSON object", "not a JSON object", "not a JSON object"]
    assert got[0][0] == 50 and {g[2] for g in got[1:]} == {"7", '"text"', "8"}


def test_ids_do_not_depend_on_blocks(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"name": f"N{i}"} for i in range(300)]))
    runs = [sized(spark, s, lambda: {r["record_id"]: r["fields"]["full_name"] for r in read_ats_source(spark, str(tmp_path), "arrays").collect()}) for s in ("128m", "97b")]
    assert runs[0] == runs[1] and len(runs[0]) == 300 and all(i.split("#")[1] == n[1:] for i, n in runs[0].items())
