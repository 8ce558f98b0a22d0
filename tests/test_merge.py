"""Survivorship against a plain restatement of its rules, over random claims, ties, unknown sources and a hot entity."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrec.operators.claims import alternatives, field_claims, pick_winners
from goldrec.operators.lists import union_emails
from goldrec.schemas import SOURCE_RECORDS

#: weight, certainty and rank by source; "crm" is no source of the dimension.
SOURCES = {"csv": (0.9, 0.95, 1), "ats": (0.85, 0.9, 2), "resume": (0.75, 0.7, 3), "notes": (0.6, 0.55, 4), "crm": (0.5, None, 5)}
FIELDS = ("headline", "city", "portfolio", "years_experience")


def keyed(spark, rows):
    """rows: (entity, record id, source, fields)."""
    names = [f.name for f in SOURCE_RECORDS["fields"].dataType.fields]
    data = [(i, s, SOURCES[s][1], {n: f.get(n) for n in names}, e) for e, i, s, f in rows]
    return spark.createDataFrame(data, T.StructType([*SOURCE_RECORDS.fields, T.StructField("entity_key", T.StringType())]))


def plain_winners(rows):
    claims = defaultdict(list)
    for e, i, s, f in rows:
        weight, certainty, rank = SOURCES[s]
        for name in FIELDS:
            if f.get(name) is not None:
                claims[e, name].append((weight * (0.5 if certainty is None else certainty), rank, i, str(f[name]), s))
    won, lost = {}, set()
    for key, mine in claims.items():
        agree = defaultdict(int)
        for c in mine:
            agree[c[3]] += 1
        best = min(mine, key=lambda c: (-round(c[0], 9), -agree[c[3]], c[1], c[2]))
        won[key] = (best[3], best[4], agree[best[3]])
        lost |= {(*key, c[4]) for c in mine if c[3] != best[3]}
    return won, lost


@pytest.mark.parametrize("seed", range(4))
def test_random_claims(spark, seed):
    rng = random.Random(seed)
    rows = []
    for n in range(160):
        fields = {"headline": rng.choice([None, "tanner", "smith", "cook"]), "city": rng.choice([None, None, "Ulm", "Bern"]),
                  "portfolio": rng.choice([None, "p1", "p2"]), "years_experience": rng.choice([None, 1.0, 2.5])}
        rows.append((f"e{rng.randint(0, 11)}", f"id{n:03d}", rng.choice(list(SOURCES)), fields))
    claims = field_claims(keyed(spark, rows))
    won, lost = plain_winners(rows)
    got = pick_winners(claims)
    assert {(r["entity_key"], r["field"]): (r["value"], r["source"], r["agree"]) for r in got.collect()} == won
    assert {(r["entity_key"], r["field"], r["source"]) for r in alternatives(claims, got).collect()} == lost


def test_records_that_say_nothing_claim_nothing(spark):
    rows = [("e", "1", "csv", {}), ("e", "2", "notes", {"emails": ["a@b.org"]})]
    assert field_claims(keyed(spark, rows)).count() == 0


def test_one_entity_with_nearly_all_records(spark):
    rows = [("hot", f"{n:06d}", "notes", {"headline": f"h{n % 50}"}) for n in range(20_000)]
    rows += [("hot", "x", "ats", {"headline": "h7"}), ("cold", "y", "crm", {"headline": "h7"})]
    got = {r["entity_key"]: (r["value"], r["source"], r["agree"]) for r in pick_winners(field_claims(keyed(spark, rows))).collect()}
    assert got == {"hot": ("h7", "ats", 401), "cold": ("h7", "crm", 1)}


def test_lists_keep_the_place_of_the_first_occurrence(spark):
    rng = random.Random(2)
    pool = [f"{c}@mail.example" for c in "abcdefgh"]
    rows = []
    for n in range(60):
        mails = [m.upper() if rng.random() < 0.3 else f" {m}" for m in rng.sample(pool, rng.randint(0, 4))]
        rows.append((f"e{n % 5}", f"{n:02d}", rng.choice(list(SOURCES)), {"emails": mails or None}))
    want = defaultdict(list)
    for e, i, s, f in sorted(rows, key=lambda r: (SOURCES[r[2]][2], r[1])):
        want[e] += [m.strip().lower() for m in f["emails"] or [] if m.strip().lower() not in want[e]]
    got = {r["entity_key"]: r["emails"] for r in union_emails(keyed(spark, rows).withColumn("x", F.lit(1))).collect()}
    assert got == dict(want)
