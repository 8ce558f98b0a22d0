"""Secret scans of very long texts, of doubled ledger rows and of awkward places."""

from __future__ import annotations

import time

import pytest

from goldrec.llm.secret_scan import RULES, redact_documents, scan_documents

SCHEMA = "doc_id long, text string"
RUN = "0123456789abcdef"


def hexes(n: int) -> str:
    return " ".join(f"{RUN}{i:08x}" for i in range(n))


def scan_seconds(spark, text: str) -> float:
    df = spark.createDataFrame([(1, text)], SCHEMA)
    began = time.perf_counter()
    (row,) = scan_documents(df).select("spans").collect()
    assert len(row.spans) == text.count(RUN)
    assert all(text[s.start : s.end].startswith(RUN) for s in row.spans[:50] + row.spans[-50:])
    return time.perf_counter() - began


def test_time_grows_with_the_text(spark):
    scan_seconds(spark, hexes(1000))
    small, large = scan_seconds(spark, hexes(30_000)), scan_seconds(spark, hexes(120_000))
    assert large < 6 * max(small, 1.0)


def test_ten_megabytes(spark):
    text = ("plain words of a dump " * 20 + RUN + "00 token = 'abcdefghijklmnopqrst' ") * 20_000
    assert len(text) > 9_000_000
    df = spark.createDataFrame([(1, text)], SCHEMA)
    began = time.perf_counter()
    (clean,) = redact_documents(df).collect()
    assert time.perf_counter() - began < 60
    assert clean.text == ("plain words of a dump " * 20 + "[SECRET] [SECRET]' ") * 20_000


def test_a_blob_twice_in_the_ledger(spark, tmp_path):
    ledger = f"file://{tmp_path}/ledger"
    df = spark.createDataFrame([(1, f"x {RUN}"), (2, "token: abcdefghijklmnop")], SCHEMA)
    once = sorted(scan_documents(df, ledger).select("row.doc_id", "spans").collect())
    rows = spark.read.parquet(ledger).collect()
    spark.createDataFrame(rows, spark.read.parquet(ledger).schema).write.mode("append").parquet(ledger)  # two scans at once
    assert spark.read.parquet(ledger).count() == 4
    assert sorted(scan_documents(df, ledger).select("row.doc_id", "spans").collect()) == once
    assert spark.read.parquet(ledger).count() == 4  # nothing was scanned again


@pytest.mark.parametrize(
    ("text", "clean"),
    [
        (f"﻿{RUN}﻿{RUN}﻿", "﻿[SECRET]﻿[SECRET]﻿"),
        (f"😀é{RUN}😀é", "😀é[SECRET]😀é"),
        (f"token={RUN}-x y{RUN}", "[SECRET] y[SECRET]"),
        (f"{RUN}", "[SECRET]"),
        (f"secret: eyJabcdefgh.abcdefgh.{RUN} end", "[SECRET] end"),
        ("\0" + RUN + "\0", "\0[SECRET]\0"),
    ],
)
def test_masks(spark, text, clean):
    df = spark.createDataFrame([(1, text), (1, text), (2, None)], SCHEMA)
    assert [r.text for r in redact_documents(df).orderBy("doc_id").collect()] == [clean, clean, None]


def test_rule_names_are_kept():
    assert [r.name for r in RULES][:3] == ["assign@1", "access@1", "hex@1"]
