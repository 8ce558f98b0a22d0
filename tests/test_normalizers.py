"""Normalisers by properties: every style of a known value gives that value, what comes out stays, noise gives null."""

import calendar
import random
import re

import pytest
from conftest import one_col
from pyspark.sql import functions as F

from goldrec.functions.dates import normalize_date, normalize_year
from goldrec.functions.locations import normalize_country, normalize_location
from goldrec.functions.phones import assigned_codes, normalize_phone, normalize_phones
from goldrec.sources.dims import US_STATES, country_rows

MONTHS = [(y, m) for y in (1900, 1969, 2000, 2024, 2099) for m in range(1, 13)]
STYLES = [
    lambda y, m: f"{y}-{m:02d}", lambda y, m: f"{y}-{m:02d}-{calendar.monthrange(y, m)[1]}", lambda y, m: f"  {m}/{y} ", lambda y, m: f"{m:02d}-{y}",
    lambda y, m: f"{y}/{m}", lambda y, m: f"{calendar.month_name[m]} {y}", lambda y, m: f"{calendar.month_abbr[m].upper()}. {y}",
    lambda y, m: f"{y}, {calendar.month_abbr[m].lower()}", lambda y, m: f"since {calendar.month_name[m]}, {y}",
]


def test_every_style_of_every_month(spark):
    cases = [(style(y, m), f"{y}-{m:02d}") for style in STYLES for y, m in MONTHS]
    assert one_col(spark, [c[0] for c in cases], normalize_date) == [c[1] for c in cases]
    quarters = [(f"{q}{n} {y}", f"{y}-{3 * n:02d}") for q in "qQ" for n in range(1, 5) for y in (1950, 2031)]
    assert one_col(spark, [c[0] for c in quarters], normalize_date) == [c[1] for c in quarters]


def test_dates_that_come_out_stay(spark):
    rng = random.Random(1)
    noise = ["".join(rng.choice("0123456789-/ JanuryQ.'") for _ in range(rng.randint(0, 14))) for _ in range(600)]
    once = one_col(spark, noise, normalize_date)
    assert all(x is None or re.fullmatch(r"(19|20)\d\d-(0[1-9]|1[0-2])", x) for x in once)
    assert one_col(spark, once, normalize_date) == once


@pytest.mark.parametrize(("text", "month"), [("2020-00", "2020-01"), ("2020-2031", "2020-01"), ("13/2020", "2020-01"), ("1899", None), ("2100-05", None), ("Smarch 2011", "2011-01"), ("May", None)])
def test_what_is_no_month(spark, text, month):
    assert one_col(spark, [text], normalize_date) == [month]


def test_years_stand_alone(spark):
    years = [1900, 1987, 2099]
    texts = [f"{a}{y}{b}" for y in years for a, b in (("", ""), ("(", ")"), ("from ", "/2050"), ("ünd-", "."))]
    assert one_col(spark, texts, normalize_year) == [y for y in years for _ in range(4)]
    assert one_col(spark, ["1899", "21999", "a2001", "2001b", "20 01", "", None], normalize_year) == [None] * 7


def test_punctuation_of_a_phone_does_not_matter(spark):
    rng = random.Random(4)
    national = [f"{rng.randint(2, 9)}{rng.randint(10, 99)}{rng.randint(2, 9)}{rng.randint(0, 999999):06d}" for _ in range(60)]
    cases = []
    for n in national:
        a, b, c = n[:3], n[3:6], n[6:]
        cases += [(t, f"+1{n}") for t in (n, f"({a}) {b}-{c}", f"1.{a}.{b}.{c}", f"+1 {a} {b} {c}", f" 011 1 {n}", f"{a}-{b}-{c} ext. 12", f"tel +1{n}x7")]
    got = one_col(spark, [c[0] for c in cases], normalize_phone)
    assert got == [c[1] for c in cases]
    assert one_col(spark, got, normalize_phone) == got


def test_every_number_has_an_assigned_code(spark):
    rng = random.Random(6)
    noise = ["+" + "".join(rng.choice("0123456789") for _ in range(rng.randint(1, 17))) for _ in range(2000)]
    codes = tuple(f"+{c}" for c in [*assigned_codes(), "1", "7"])
    for raw, out in zip(noise, one_col(spark, noise, normalize_phone)):
        assert out is None or (out == raw and out.startswith(codes) and 7 <= len(out) <= 16)
    assert one_col(spark, ["+999 1234567", "+210 123456", "0", "+", "", "ring me", None], normalize_phone) == [None] * 7


def test_phone_lists_keep_first_places(spark):
    raw = ["+44 20 7946 0018", "none", "(617) 555-0123", "+442079460018", "617 555 0123", "+49 30 901820"]
    df = spark.createDataFrame([(raw,), ([],), (None,)], "p array<string>")
    assert [r["o"] for r in df.select(normalize_phones(F.col("p")).alias("o")).collect()] == [["+442079460018", "+16175550123", "+4930901820"], [], None]


def test_every_country_by_code_and_name(spark):
    rows = country_rows()
    by_name = {}
    for code, name in rows:
        by_name.setdefault(name, code)
    assert one_col(spark, [c for c, _ in rows], normalize_country) == [c for c, _ in rows]
    assert one_col(spark, [f" {n.upper()} " for n in by_name], normalize_country) == list(by_name.values())
    plain = [(n, c) for n, c in by_name.items() if "," not in n and " - " not in n]
    got = one_col(spark, [f"Somewhere, {n}" for n, _ in plain], normalize_location)
    assert [tuple(r) for r in got] == [("Somewhere", None, c) for _, c in plain]


def test_states_that_are_no_country_codes(spark):
    codes = {c for c, _ in country_rows()}
    states = [s for s in US_STATES if s not in codes]
    got = one_col(spark, [f"Old Town, {s.lower()}" for s in states], normalize_location)
    assert [tuple(r) for r in got] == [("Old Town", s, "US") for s in states] and len(states) > 20


def test_parts_of_a_place(spark):
    cases = {
        "Graz – Styria – Austria": ("Graz", "Styria", "AT"), "Graz, Styria, Atlantis": ("Graz", "Styria", None), "Graz, Styria": ("Graz", "Styria", None),
        " , Graz , ": ("Graz", None, None), "Saint-Denis, France": ("Saint-Denis", None, "FR"), "a, b, c, d, Peru": ("a", "b", "PE"), "\t": (None, None, None),
    }
    assert [tuple(r) for r in one_col(spark, list(cases), normalize_location)] == list(cases.values())
