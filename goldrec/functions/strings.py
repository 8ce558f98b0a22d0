"""String, id and numeric Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldrec.functions.patterns import WS_CHARS


def let(value: Column, body) -> Column:
    """``body`` of ``value`` with ``value`` worked out once, however often the body names it.

    A ``transform`` of a one-item array: its body is interpreted, not compiled, so
    this is for bodies whose own work (regular expressions) outweighs that.
    """
    return F.get(F.transform(F.array(value), body), 0)


def py_strip(c: Column) -> Column:
    """Trim every Unicode whitespace character (``trim`` alone only removes spaces)."""
    return F.trim(c, F.lit(WS_CHARS))


def blank_to_null(c: Column) -> Column:
    """Stripped text, or null when nothing is left."""
    s = py_strip(c.cast("string"))
    return F.when(s != "", s)


def split_cell(c: Column, seps: str = ";") -> Column:
    """B2: split a delimited cell, strip the items, drop blanks (null -> null)."""
    parts = F.split(c, f"[{seps}]")
    return F.filter(F.transform(parts, py_strip), lambda x: x != "")


def to_double(c: Column) -> Column:
    """Tolerant float parse; anything unparsable becomes null (Java's ``5d`` and ``5f`` too)."""
    s = py_strip(c.cast("string"))
    return F.when(~s.rlike("[0-9.][dDfF]$"), s.try_cast("double"))


def compose_name(full: Column, first: Column, last: Column) -> Column:
    """Full name, else 'first last' from whichever parts are present."""
    joined = F.concat_ws(" ", blank_to_null(first), blank_to_null(last))
    return F.coalesce(blank_to_null(full), F.when(joined != "", joined))


def canonical_emails(arr: Column) -> Column:
    """Lower-case, strip, drop blanks, keep first occurrence order."""
    return F.array_distinct(F.filter(F.transform(arr, lambda e: F.lower(py_strip(e))), lambda e: e != ""))


def entity_id(seed: Column) -> Column:
    """D9: 'cand_' + first 12 hex digits of SHA-256 of the lower-cased seed."""
    return F.concat(F.lit("cand_"), F.substring(F.sha2(F.lower(py_strip(seed)), 256), 1, 12))
