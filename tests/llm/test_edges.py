"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns: one table for all operators."""

import hashlib

import pytest
from pyspark.sql import functions as F

from goldrec.llm.licenses import scan_licenses
from goldrec.llm.mixing import mix_documents, mix_sizes
from goldrec.llm.quality import classify, keep_good
from goldrec.llm.secret_scan import redact_documents, scan_documents
from goldrec.llm.sentencepiece_codec import decode_documents, encode_documents
from goldrec.llm.simhash import keep_one, simhash_components
from goldrec.llm.substring import dedup_substrings, strip_reference
from goldrec.llm.topk import scaled, top_k
from goldrec.llm.urls import filter_urls
from goldrec.llm.vectors import near_vectors

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ["size", "hash", "row", "mix", "spans", "h", "n", "fp", "ids", "site", "odds", "words", "key", "target", "piece"]
PASSAGE = " ".join(f"w{i}" for i in range(30))
LONG = " ".join(f"x{i}" for i in range(40_000))


def documents(spark, rows):
    """Rows (doc_id, text, source), with columns whose names the operators use inside."""
    df = spark.createDataFrame([(i, t, "en" if i else None, s, len(t or "")) for i, t, s in rows], DOCS)
    return df.withColumns({c: F.lit("extra") for c in EXTRA})


@pytest.fixture(scope="module")
def odd(spark):
    return documents(
        spark,
        [
            (1, PASSAGE, "a"),
            (2, f"before {PASSAGE} after", "a"),
            (2, f"before {PASSAGE} after", "a"),
            (3, None, None),
            (4, "", "b"),
            (5, " \t\n ", None),
            (6, LONG, "c"),
            (None, PASSAGE, "a"),
            (7, 'token = "abcdefghij0123456789" all rights reserved', "b"),
        ],
    ).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


def test_substrings(odd, empty):
    got = {(r.doc_id, r.n_words, r.n_removed) for r in dedup_substrings(odd).collect()}
    assert got == {(1, 30, 0), (2, 32, 30), (3, 0, 0), (4, 0, 0), (5, 0, 0), (6, 40_000, 0), (None, 30, 0), (7, 6, 0)}
    rows = dedup_substrings(odd).where("doc_id = 2").collect()
    assert len(rows) == 2 and {r.kept_sha256 for r in rows} == {hashlib.sha256(b"before after").hexdigest()}
    assert [tuple(s) for s in rows[0].removed_spans] == [(1, 31)]
    assert dedup_substrings(empty).count() == 0


def test_reference(spark, odd, empty):
    ref = spark.createDataFrame([(PASSAGE,), (None,), ("",)], "text string")
    got = {r.doc_id: (r.n_removed, r.kept_text) for r in strip_reference(odd, ref).collect()}
    assert got[1] == (30, "") and got[2] == (30, "before after") and got[3] == (0, "") and got[6][0] == 0
    assert strip_reference(empty, ref).count() == 0
    with pytest.raises(ValueError):
        strip_reference(odd, ref, max_reference_bytes=10)


def test_mixing(odd, empty):
    rows = mix_sizes(odd).collect()
    assert len(rows) == 9 and all(0 <= r.taken <= 3 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r.doc_id in (3, 4, 5)} == {0}
    assert abs(sum({(r.source_size, r.target) for r in rows} and [t for _, t in {(r.source_size, r.target) for r in rows}]) - sum(r["size"] for r in rows)) < 1e-6
    mixed = mix_documents(odd)
    assert mixed.columns == odd.columns
    assert {r.n for r in mixed.select("n").distinct().collect()} <= {"extra"}
    assert mix_sizes(empty).count() == 0 and mix_documents(empty).count() == 0


def test_simhash(odd, empty):
    rows = simhash_components(odd).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.fp == 0, r.component_id))
    assert len(rows) == 9
    assert by[3] == by[4] == by[5] == {(True, 3)}
    assert by[None] == by[1] == {(False, 1)}
    kept = keep_one(odd)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert kept.columns == odd.columns and len(ids) == len(set(ids)) and {1, 3, 6, 7} <= set(ids) and None not in ids
    assert simhash_components(empty).count() == 0 and keep_one(empty).count() == 0


def test_licenses(odd, empty):
    rows = {r.doc_id: r for r in scan_licenses(odd).collect()}
    assert rows[3].n_words == rows[4].n_words == 0 and rows[3].labels == [] and rows[3].score == 0
    assert rows[7].base_labels == ["reserved"] and [p.start for p in rows[7].places] == [2] and rows[7].score == 1
    assert rows[6].n_words == 40_000
    assert scan_licenses(empty).count() == 0


def test_secrets(odd, empty):
    rows = scan_documents(odd).select("row.doc_id", "spans").collect()
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in rows}
    assert len(rows) == 9 and found[7] == [("assign", 0, 29)] and found[3] == []
    clean = redact_documents(odd)
    assert clean.columns == odd.columns and clean.count() == 9
    r = clean.where("doc_id = 7").first()
    assert r.text == '[SECRET]" all rights reserved' and r.n_chars == len(r.text)
    assert clean.where("doc_id = 3").first().text is None
    assert scan_documents(empty).count() == 0 and redact_documents(empty).count() == 0


def test_tokens(odd, empty):
    rows = encode_documents(odd)
    assert rows.where("not parity or not roundtrip").count() == 0 and rows.count() == 9
    null = rows.where("doc_id = 3").first()
    assert null.ids is None and null.n_tokens == 0
    back = {r.doc_id: r.text for r in decode_documents(rows).collect()}
    assert back[6] == LONG and back[3] is None and back[4] == "" and back[5] == " \t\n "
    assert encode_documents(empty).count() == 0


def test_quality(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (7, None, 0), (None, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.kept for r in classify(odd, none).collect()} == {True}
    assert classify(odd, some).count() == 9
    kept = keep_good(odd, some)
    assert kept.columns == odd.columns and kept.count() <= 9
    assert classify(empty, some).count() == 0 and keep_good(empty, some).count() == 0


def test_urls(spark):
    kind = "page_id long, url string, host string, segs string, template string, n string"
    urls = [None, "", "no scheme", "http://", "http://A.NET", "https://x.example.net/en/1?q#f", "ftp://example.org/fr/" + "9" * 5000, "http://example.com/de/a/b/c/d/e/f", "http://example.com/de/a/b/c/d/e/f"]
    df = spark.createDataFrame([(i, u, "e", "e", "e", "e") for i, u in enumerate(urls)], kind)
    rows = {r.page_id: r for r in filter_urls(df).collect()}
    assert len(rows) == 9
    assert [(rows[i].host, rows[i].path, rows[i].rule) for i in range(4)] == [("", "", None)] * 4
    assert (rows[4].host, rows[4].path, rows[4].rule) == ("a.net", "", None)
    assert (rows[5].host, rows[5].path, rows[5].rule, rows[5].verdict) == ("x.example.net", "/en/1", "example.net/en/", "allow")
    assert (rows[6].rule, rows[6].verdict) == ("org/fr/", "allow")
    assert rows[7].rule == rows[8].rule == "example.com/de/" and rows[7].verdict == "block"
    assert filter_urls(df.limit(0)).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, cid string, v string, links string, id string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, x, "e", "e", "e", "e") for i, v, x in rows], VECTORS)


ODD_VECTORS = [
    (0, [1.0, 0.0], 1),
    (1, [1.0, 0.1], 1),
    (2, [1.0, 0.1], 1),
    (3, [1.0, 0.0], 2),
    (4, [1.0, 0.0], None),
    (5, None, 1),
    (6, [0.0, 0.0], 1),
    (7, [float("nan"), 1.0], 1),
    (8, [1.0, None], 1),
    (9, [float("inf"), 1.0], 1),
    (10, [1.0, 0.0, 0.0], 1),
    (None, [1.0, 0.0], 1),
    (11, [], 1),
    (20, [-0.0, 2.0], 1),
    (21, [0.0, 2.0], 1),
    (21, [0.0, 2.0], 1),
]


def test_vectors(spark):
    rows = near_vectors(vectors(spark, ODD_VECTORS)).collect()
    assert len(rows) == len(ODD_VECTORS)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows}
    assert got[0] == (3, 0, True) and got[1] == got[2] == (3, 0, False) and got[None] == (3, 0, False)
    for i in (3, 4, 5, 6, 7, 8, 9, 10, 11):
        assert got[i] == (0, i, True)
    assert got[20] == (2, 20, True) and got[21] == (2, 20, False)
    assert near_vectors(vectors(spark, [])).count() == 0


def test_top_k(spark):
    v = scaled(vectors(spark, ODD_VECTORS))
    rows = [tuple(r) for r in top_k(v.where("id % 20 = 0"), v, k=2).orderBy("query_id", "rank").collect()]
    assert rows == [(0, 1, 1, 4096), (0, 2, 2, 4096), (20, 1, 21, 16384), (20, 2, 21, 16384)]
    few = top_k(v.where("id = 0"), v, k=50)
    assert few.count() == 8 and few.agg(F.max("rank")).first()[0] == 8
    none = scaled(vectors(spark, []))
    assert top_k(none, none).count() == 0
    huge = scaled(vectors(spark, [(0, [1e30, 1.0], 1), (1, [1e30, 2.0], 1), (2, [-1e30, 3.0], 1)]))
    assert [r.vec_id for r in top_k(huge.where("id = 0"), huge, k=5).orderBy("rank").collect()] == [1, 2]
