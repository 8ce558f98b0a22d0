"""Components, and records without e-mail that phones and similar names link."""

import random

import pytest

from goldrec.operators.components import components
from goldrec.operators.resolve import resolve
from goldrec.operators.simjoin import similar_links
from goldrec.schemas import fields_struct


def roots(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    rng = random.Random(seed)
    nodes = [f"n{i:03d}" for i in range(80)]
    pairs = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(45 + 15 * seed)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    linked = roots([p for p in pairs if p[0] != p[1]])
    assert got == linked


def test_components_of_a_long_chain_and_of_nothing(spark):
    chain = [(f"{i:04d}", f"{i + 1:04d}") for i in range(300)]
    got = components(spark.createDataFrame(chain, "a string, b string")).collect()
    assert len(got) == 301 and {r["root"] for r in got} == {"0000"}
    assert components(spark.createDataFrame([("x", "x")], "a string, b string")).count() == 0


@pytest.mark.parametrize("chunk", [1024, 5])
def test_links_connect_like_all_pairs(spark, chunk):
    from goldrec.functions.similarity import _ratio_py

    rng = random.Random(7)
    names = sorted({"".join(rng.choice("abcd ") for _ in range(rng.randint(3, 8))).strip() for _ in range(60)} - {""})
    rows = [(b, n) for b in ("p", "q") for n in names[: 60 if b == "p" else 20]]
    got = similar_links(spark.createDataFrame(rows, "phone string, name string"), ["phone"], "name", 70, chunk).collect()
    for block, mine in (("p", names), ("q", names[:20])):
        want = roots([(a, b) for a in mine for b in mine if a < b and _ratio_py(a, b) >= 70])
        assert roots([(r["l"], r["r"]) for r in got if r["phone"] == block]) == want


def keys(spark, people):
    """people: record id -> (name, phones, e-mails)."""
    df = spark.createDataFrame([(i, *p) for i, p in people.items()], "record_id string, n string, p array<string>, e array<string>")
    from pyspark.sql import functions as F

    fields = fields_struct(full_name=F.col("n"), emails=F.col("e"), phones=F.col("p"))
    records = df.select("record_id", F.lit("notes").alias("source"), F.lit(0.5).alias("extraction_confidence"), fields.alias("fields"))
    return {r["record_id"]: r["entity_key"] for r in resolve(records).collect()}


A, B, C = "+1 415 555 0101", "+1 212 555 0102", "+1 312 555 0103"


def test_similar_names_at_one_phone_are_one_entity(spark):
    got = keys(spark, {
        "1": ("Jon Smith", [A], None), "2": ("John Smith", [A], None), "3": ("Smith John", [A], None),
        "4": ("Petra Zwick", [A], None), "5": ("John Smith", [B], None), "6": (None, [A], None), "7": ("Jon Smith", None, None),
    })
    assert got["1"] == got["2"] == got["3"] == "phone:+14155550101|john smith"
    assert got["4"] == "phone:+14155550101|petra zwick" and got["5"] == "phone:+12125550102|john smith"
    assert got["6"] == "record:6" and got["7"] == "record:7"


def test_links_lead_over_a_third_record(spark):
    got = keys(spark, {
        "1": ("Jon Smith", [A], None), "2": ("John Smith", [A, B], None), "3": ("Johnn Smith", [B, C], None), "4": ("Johnny Smith", [C], None),
        "5": ("Maria Lund", [C], None),
    })
    assert len({got[i] for i in "1234"}) == 1 and got["5"] != got["1"]


def test_equal_names_with_other_first_phones_meet_at_the_second(spark):
    got = keys(spark, {"1": ("Ada Byron", [A, B], None), "2": ("Ada Byron", [B], None), "3": ("Ada Byron", [C], None)})
    assert got["1"] == got["2"] != got["3"]


def test_an_entity_with_an_e_mail_comes_first(spark):
    got = keys(spark, {"1": ("Jon Smith", [A], ["jon@x.org"]), "2": ("John Smith", [A, B], None), "3": ("Jon Smyth", [B], None)})
    assert got["1"] == got["2"] == "jon@x.org" and got["3"] == "phone:+12125550102|jon smyth"
