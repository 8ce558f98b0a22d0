"""Country search by parts of names, subdivisions and misspelt names."""

import pytest

from goldrec.operators.countries import search_countries
from goldrec.sources.dims import country_rows, subdivision_rows

CASES = {
    "usa": ("US", "exact"), "Portugal": ("PT", "exact"), "Bavaria": ("DE", "subdivision"), "tamil nadu": ("IN", "subdivision"), "Emirates": ("AE", "exact"), "arab": ("AE", "words"),
    "Grenadines": ("VC", "words"), "Caledonia": ("NC", "words"), "Herzegovina and Bosnia": ("BA", "exact"), "Germny": ("DE", "fuzzy"), "Afganistan": ("AF", "fuzzy"),
    "Massachusets": ("US", "fuzzy"), "XYZ123": (None, None), "Republic": (None, None), "the": (None, None), "Prt": (None, None), "  ": (None, None),
}


def test_steps(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate([*CASES, None, "usa"])]
    df = spark.createDataFrame(rows, "i int, raw string, text string, name string")
    out = search_countries(df)
    got = {r["i"]: (r["country"], r["method"]) for r in out.collect()}
    assert out.columns == ["i", "raw", "text", "name", "country", "method"]
    want = list(CASES.values())
    want[list(CASES).index("Herzegovina and Bosnia")] = ("BA", "words")
    assert [got[i] for i in range(len(want))] == want and got[len(want)] == (None, None) and got[len(want) + 1] == ("US", "exact")


def test_every_subdivision_is_found(spark):
    codes = {n.lower() for _, n in country_rows()}
    mine = [(c, n) for c, n in subdivision_rows() if n.lower() not in codes]
    df = spark.createDataFrame([(i, n.upper()) for i, (_, n) in enumerate(mine)], "i int, raw string")
    assert {r["i"]: r["country"] for r in search_countries(df).collect()} == {i: c for i, (c, _) in enumerate(mine)}


@pytest.mark.parametrize("rows", [[], [(None,)], [("",)]])
def test_nothing_to_search(spark, rows):
    out = search_countries(spark.createDataFrame(rows, "raw string")).collect()
    assert len(out) == len(rows) and all(r["country"] is None for r in out)
