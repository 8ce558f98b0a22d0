"""Phone Column builders.

E.164 country calling codes are prefix-free, so a number's country is decided
by one anchored alternation over the numbering-plan dimension.  The whole
check is therefore a single foldable regex: no per-row lookup, no join, and it
stays inside whole-stage codegen.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldrec.functions.strings import let, py_strip
from goldrec.sources.dims import numbering_plan_rows

DEFAULT_REGION = "US"

# Assigned E.164 country codes (ITU), as ranges; +1 and +7 have plans of their own.
ASSIGNED_CODES = (
    "20 27 211-213 216 218 220-258 260-269 290 291 297-299 "
    "30-34 36 39 350-359 370-383 385-387 389 40 41 43-49 420 421 423 "
    "51-58 500-509 590-599 60-66 670 672-683 685-692 "
    "800 808 81 82 84 86 850 852 853 855 856 870 878 880-883 886 888 "
    "90-95 98 960-968 970-977 979 992-996 998"
)
#: Where no national plan is known: 5 digits at least, 15 with the country code at most, none a trunk zero.
LEAST_NATIONAL, MOST_DIGITS = 5, 15
EXTENSION = r"(?i)(?:;ext=|[ ,;]*(?:ext(?:ension|n)?\.?|x|#))[ :.]*[0-9]{1,7}$"


def assigned_codes() -> list[str]:
    out = []
    for part in ASSIGNED_CODES.split():
        lo, _, hi = part.partition("-")
        out += [str(c) for c in range(int(lo), int(hi or lo) + 1)]
    return out


@functools.lru_cache(maxsize=None)
def plan_regex() -> str:
    """``^(?:cc(national)|...)$`` over the national plans, then the other assigned codes by length."""
    plans = {r[0]: r[4] for r in numbering_plan_rows()}
    for cc in assigned_codes():
        plans.setdefault(cc, f"[1-9][0-9]{{{LEAST_NATIONAL - 1},{MOST_DIGITS - len(cc) - 1}}}")
    for a in plans:
        for b in plans:
            assert a == b or not b.startswith(a), f"calling codes not prefix-free: {a} {b}"
    return "^(?:" + "|".join(f"{cc}(?:{pat})" for cc, pat in plans.items()) + ")$"


@functools.lru_cache(maxsize=None)
def region_code(region: str) -> str:
    for cc, reg, *_ in numbering_plan_rows():
        if reg == region:
            return cc
    raise ValueError(f"region {region!r} not in the numbering plan")


def normalize_phone(c: Column, region: str = DEFAULT_REGION) -> Column:
    """D3: raw phone text -> E.164 (``+<digits>``) or null when invalid.

    An extension at the end is dropped.  A ``+`` before the first digit (or ``011`` for the NANP) makes the number international;
    otherwise it is read as a national number of ``region`` (trunk prefix
    ``1`` for the NANP, ``0`` elsewhere).
    """
    cc = region_code(region)
    plan = plan_regex()

    def national(digits: Column) -> Column:
        if cc != "1":
            return F.concat(F.lit(cc), F.regexp_replace(digits, "^0", ""))
        return (
            F.when((F.length(digits) == 11) & digits.startswith("1"), digits)
            .when(digits.startswith("011"), F.substring(digits, 4, 64))
            .otherwise(F.concat(F.lit("1"), digits))
        )

    def full(s: Column) -> Column:
        digits = F.regexp_replace(s, "[^0-9]", "")
        return F.when(s.rlike(r"^[^0-9+]*\+"), digits).otherwise(let(digits, national))

    s = F.replace(F.regexp_replace(py_strip(c.cast("string")), EXTENSION, ""), F.lit("(0)"), F.lit(""))
    return let(let(s, full), lambda n: F.when(n.rlike(plan), F.concat(F.lit("+"), n)))


def normalize_phones(arr: Column, region: str = DEFAULT_REGION) -> Column:
    """Normalise each phone, drop invalid ones, keep first occurrence order."""
    out = F.transform(arr, lambda p: normalize_phone(p, region))
    return F.array_distinct(F.filter(out, lambda p: p.isNotNull()))


def phone_sql(x: str, region: str = DEFAULT_REGION) -> str:
    """The same normalisation as DuckDB SQL over expression ``x``."""
    from goldrec.functions.patterns import WS_CLASS

    s = f"regexp_replace(regexp_replace(regexp_replace(CAST({x} AS VARCHAR), '^{WS_CLASS}+', ''), '{WS_CLASS}+$', ''), '{EXTENSION}', '')"
    s = f"replace({s}, '(0)', '')"
    plus = f"regexp_matches({s}, '^[^0-9+]*\\+')"
    d = f"regexp_replace({s}, '[^0-9]', '', 'g')"
    cc = region_code(region)
    if cc == "1":
        nat = (
            f"CASE WHEN length({d}) = 11 AND starts_with({d}, '1') THEN {d} "
            f"WHEN starts_with({d}, '011') THEN substr({d}, 4) ELSE '1' || {d} END"
        )
    else:
        nat = f"'{cc}' || regexp_replace({d}, '^0', '')"
    full = f"(CASE WHEN {plus} THEN {d} ELSE {nat} END)"
    return f"(CASE WHEN {d} <> '' AND regexp_full_match({full}, '{plan_regex()}') THEN '+' || {full} END)"
