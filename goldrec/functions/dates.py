"""Date Column builders.

Dates are ``YYYY-MM`` strings.  The cascade is one ``coalesce``: a pattern is tried
only where those before it gave nothing, it meets the text once, and its parts
are cut from the match by their places.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldrec.functions import patterns as P
from goldrec.functions.strings import let, py_strip
from goldrec.sources.dims import MONTHS, QUARTERS, literal_map

# Java \b differs from Python's; a non-word character (or an end) on both
# sides gives the same first match.
_NW = r"[^\p{L}\p{N}_]"
ISO_RX = P.portable(P.ISO_DATE) + r"(?:[^\p{Nd}]|$)"
QUARTER_RX = "(?i)" + P.portable(P.QUARTER_DATE)
MONTH_YEAR_RX = P.portable(P.MONTH_YEAR)
NUMERIC_RX = P.portable(P.NUMERIC_MONTH_YEAR)
YEAR_RX = rf"(?:^|{_NW})((?:19|20)\p{{Nd}}{{2}})(?:{_NW}|$)"


def _nz(c: Column) -> Column:
    return F.when(c != "", c)


def normalize_date(c: Column) -> Column:
    """Raw date text -> ``YYYY-MM`` or null.

    ISO prefix (month 01-12, no digit after it) -> quarter -> month name and
    year in either order -> ``M/YYYY`` / ``YYYY/M`` -> bare year (``-01``).
    """
    return let(py_strip(c.cast("string")), _month)


def _found(s: Column, rx: str, body) -> Column:
    """``body`` of the first match; an empty match gives null."""
    return let(F.regexp_extract(s, rx, 0), lambda m: F.when(m != "", body(m)))


def _month(s: Column) -> Column:
    def dashed(year: Column, month: Column) -> Column:
        return F.concat(year, F.lit("-"), month)

    def iso(m: Column) -> Column:
        return F.when(F.substring(m, 6, 2).try_cast("int").between(1, 12), F.substring(m, 1, 7))

    def quarter(m: Column) -> Column:
        return dashed(F.right(m, F.lit(4)), F.try_element_at(literal_map(QUARTERS), F.lower(F.left(m, F.lit(2)))))

    def named(m: Column) -> Column:
        year = F.when(m.rlike("^[A-Za-z]"), F.right(m, F.lit(4))).otherwise(F.left(m, F.lit(4)))
        return dashed(year, F.try_element_at(literal_map(MONTHS), F.lower(F.regexp_extract(m, "[A-Za-z]+", 0))))

    def numeric(m: Column) -> Column:
        first = F.substring(m, 5, 1).isin("/", "-")  # the year stands first
        month = F.when(first, F.substring(m, 6, 2)).otherwise(F.left(m, F.length(m) - 5))
        year = F.when(first, F.left(m, F.lit(4))).otherwise(F.right(m, F.lit(4)))
        return F.when(month.try_cast("int").between(1, 12), dashed(year, F.lpad(month, 2, "0")))

    year = let(F.regexp_extract(s, YEAR_RX, 1), lambda y: F.when(y != "", dashed(y, F.lit("01"))))
    return F.coalesce(_found(s, ISO_RX, iso), _found(s, QUARTER_RX, quarter), _found(s, MONTH_YEAR_RX, named), _found(s, NUMERIC_RX, numeric), year)


def normalize_year(c: Column) -> Column:
    """First 19xx/20xx year standing alone as a word, as int."""
    return _nz(F.regexp_extract(c.cast("string"), YEAR_RX, 1)).try_cast("int")
