"""Location and country Column builders.

The country dimension (ISO 3166 names and codes plus the alias list) is a
fixed-size literal map, so lookups stay inside codegen and need no join.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldrec.functions import patterns as P
from goldrec.functions.strings import py_strip
from goldrec.sources.dims import COUNTRY_ALIASES, US_STATES, country_rows, literal_array, literal_map

PART_SPLIT = P.portable(r",\s*|\s+[-–]\s+")


@functools.lru_cache(maxsize=None)
def country_keys() -> tuple[tuple[str, str], ...]:
    """lower-case key -> alpha-2; aliases first, then codes, then names."""
    seen: dict[str, str] = {}
    for alias, code in COUNTRY_ALIASES:
        seen.setdefault(alias, code)
    for code, _ in country_rows():
        seen.setdefault(code.lower(), code)
    for code, name in country_rows():
        seen.setdefault(name.lower(), code)
    assert len(seen) < 1000
    return tuple(seen.items())


def _map(pairs) -> Column:
    return literal_map(pairs)


def normalize_country(c: Column) -> Column:
    """Country text -> ISO alpha-2 (alias, code, or exact name), else null."""
    return F.try_element_at(_map(country_keys()), F.lower(py_strip(c)))


def location_parts(c: Column) -> Column:
    parts = F.transform(F.split(py_strip(c), PART_SPLIT), py_strip)
    return F.filter(parts, lambda p: p != "")


def normalize_location(c: Column) -> Column:
    """Raw location -> struct(city, region, country).

    1 part: a country, else a city.  2 parts: city + (country, else US state
    -> region and US, else region).  3+ parts: city, region, last = country.
    """
    parts = location_parts(c)
    n = F.when(c.isNull(), F.lit(0)).otherwise(F.size(parts))
    p0 = F.get(parts, 0)
    p1 = F.get(parts, 1)
    last = F.element_at(F.when(n > 0, parts), -1)
    c0 = normalize_country(p0)
    c1 = normalize_country(p1)
    state = F.array_contains(literal_array(US_STATES), F.upper(p1))
    city = F.when(n == 1, F.when(c0.isNull(), p0)).when(n >= 2, p0)
    region = (
        F.when((n == 2) & c1.isNull(), F.when(state, F.upper(p1)).otherwise(p1))
        .when(n >= 3, p1)
    )
    country = (
        F.when(n == 1, c0)
        .when(n == 2, F.coalesce(c1, F.when(state, F.lit("US"))))
        .when(n >= 3, normalize_country(last))
    )
    return F.struct(city.alias("city"), region.alias("region"), country.alias("country"))


def assemble_location(location_raw: Column, city: Column, region: Column, country: Column) -> Column:
    """Parsed raw location overridden by explicit parts; or explicit parts alone."""
    parsed = normalize_location(location_raw)
    has_raw = location_raw.isNotNull() & (location_raw != "")
    explicit = (city.isNotNull() & (city != "")) | (country.isNotNull() & (country != ""))
    ctry = F.when(country.isNotNull() & (country != ""), normalize_country(country))
    nz = lambda x: F.when(x.isNotNull() & (x != ""), x)
    return (
        F.when(
            has_raw,
            F.struct(
                F.coalesce(nz(city), parsed["city"]).alias("city"),
                F.coalesce(nz(region), parsed["region"]).alias("region"),
                F.when(nz(country).isNotNull(), ctry).otherwise(parsed["country"]).alias("country"),
            ),
        )
        .when(explicit, F.struct(nz(city).alias("city"), nz(region).alias("region"), ctry.alias("country")))
        .otherwise(
            F.struct(
                F.lit(None).cast("string").alias("city"),
                F.lit(None).cast("string").alias("region"),
                F.lit(None).cast("string").alias("country"),
            )
        )
    )


def country_sql(x: str) -> str:
    """D6 in DuckDB SQL (a CASE over the same key list)."""
    whens = " ".join(f"WHEN '{k.replace(chr(39), chr(39) * 2)}' THEN '{v}'" for k, v in country_keys())
    key = f"lower(regexp_replace(regexp_replace({x}, '^{P.WS_CLASS}+', ''), '{P.WS_CLASS}+$', ''))"
    return f"(CASE {key} {whens} END)"
