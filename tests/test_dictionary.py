"""A user's own skills dictionary: reading, the index and canonical names."""

import random

import pytest
from pyspark.sql import functions as F

from goldrec.functions.similarity import _ratio_py
from goldrec.operators.dictionary import NameIndex, canonical_names, least_common, read_dictionary, similar_names
from goldrec.operators.skills import canonical_skills


def table(spark, names):
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "pos long, name string")


def best_of(names, text, cutoff):
    scored = [(-_ratio_py(text, n), i, n) for i, n in enumerate(names)]
    ratio, i, name = min(scored) if scored else (0, None, None)
    return (name, -ratio) if -ratio >= cutoff else None


def coined(rng, letters, most):
    return "".join(rng.choice(letters) for _ in range(rng.randint(1, most)))


@pytest.mark.parametrize("cutoff", [50, 66, 75, 80, 95, 100])
def test_index_finds_what_all_pairs_find(cutoff):
    rng = random.Random(cutoff)
    for letters, most in (("ab", 6), ("abc d", 12), ("abcdefghij ", 16)):
        names = [n for n in (coined(rng, letters, most) for _ in range(120)) if n.strip()]
        index = NameIndex(list(enumerate(names)), cutoff)
        for text in [t for t in (coined(rng, letters, most) for _ in range(150)) if t.strip()] + names[:20]:
            pos, name, ratio = index.best(text)
            want = best_of(names, text, cutoff)
            assert ((name, ratio) if name else None) == want, text
            if want:
                assert pos == min(i for i, n in enumerate(names) if _ratio_py(text, n) == ratio)


def test_few_entries_are_measured():
    rng = random.Random(3)
    names = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)) for _ in range(5000)]
    index = NameIndex(list(enumerate(names)), 80)
    lo, hi, share = index.need(12)
    assert (lo, hi) == (0, 5000) and set(share.tolist()) == {3 * least_common(12, 12, 80) + 1 - 24}
    assert index.best(names[77][:5] + names[77][6:])[:2] == (77, names[77])


@pytest.mark.parametrize(("shard", "block"), [(100_000, 50_000), (13, 7)])
def test_shards_and_blocks_agree(spark, shard, block):
    rng = random.Random(9)
    names = [coined(rng, "abcde ", 9).strip() or "x" for _ in range(90)]
    texts = sorted({t for t in (coined(rng, "abcde ", 9).strip() for _ in range(120)) if t})
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["text"]: (r["name"], r["ratio"]) for r in similar_names(df, table(spark, names), 75, shard, block).collect()}
    assert got == {t: best_of(names, t, 75) for t in texts if best_of(names, t, 75)}


def test_empty_sides(spark):
    none = spark.createDataFrame([], "text string")
    one = spark.createDataFrame([("abc",)], "text string")
    assert similar_names(none, table(spark, ["abc"])).count() == 0
    assert similar_names(one, table(spark, [])).count() == 0


def test_read_dictionary(spark, tmp_path):
    (tmp_path / "b.txt").write_text("# head\nNode.js\n\n  Go  \r\n#x\nC#\n", encoding="utf-8")
    (tmp_path / "a.txt").write_bytes("﻿Rust\n # kept\nÉlan".encode())
    rows = read_dictionary(spark, str(tmp_path)).orderBy("pos").collect()
    assert [r["name"] for r in rows] == ["Rust", "# kept", "Élan", "Node.js", "Go", "C#"]
    assert len({r["pos"] for r in rows}) == 6


def test_canonical_names(spark):
    names = ["Quantum Looms", "quantum looms", "Weaving", "Dye Work", "Work Dye", "Go"]
    raws = ["QUANTUM LOOMS", "Quantm Looms", "Wevaing", "Dye Wrk", "GO", " go ", "basket", "  ", "", None, None, "Weavin", "Weavin"]
    df = spark.createDataFrame([(i, r, "a", 1) for i, r in enumerate(raws)], "i int, raw string, text string, pos int").withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    out = canonical_names(df, table(spark, names))
    got = {r["i"]: (r["name"], r["confidence"], r["method"]) for r in out.collect()}
    assert out.columns == ["i", "raw", "text", "pos", "m", "name", "confidence", "method"] and len(got) == len(raws)
    assert got[0] == ("Quantum Looms", 1.0, "exact") and got[4] == got[5] == ("Go", 1.0, "exact")
    assert got[1][0] == "Quantum Looms" and got[1][2] == "fuzzy"
    assert got[3][0] == "Dye Work"  # both orders have one ratio; the first entry counts
    assert got[6] == ("basket", 0.5, "passthrough") and got[7] == ("  ", 0.0, "blank") and got[8] == ("", 0.0, "blank")
    assert got[9] == got[10] == (None, None, None)
    assert got[11] == got[12] and got[11][0] == "Weaving" and got[11][1] == round(0.5 + (_ratio_py("Weavin", "Weaving") - 80) / 20 * 0.49, 4)


def test_same_as_the_built_in_path(spark):
    from goldrec.sources.dims import SKILLS

    raws = ["python", "Pythn", "machne learning", "Learning Machine", "Kuberntes", "", "zzz", "Postgre SQL"]
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    mine = {r["raw"]: tuple(r) for r in canonical_skills(df, dictionary=table(spark, SKILLS)).collect()}
    assert mine == {r["raw"]: tuple(r) for r in canonical_skills(df).collect()}
