"""Token-sort Indel similarity (D8) with built-in higher-order functions.

ratio(a, b) = 100 * (1 - indel_distance / (len a + len b)) on the strings with
their whitespace-separated tokens sorted and re-joined by one space; the
indel distance is ``len a + len b - 2 * LCS``.  LCS is a dynamic programme
folded with ``aggregate``; cost is len(a) * len(b)^2, so callers run it on
distinct short values only (skill names, person names) and prune first with
the length bound ``2 * min(la, lb) / (la + lb) >= cutoff / 100``.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from goldrec.functions.patterns import WS_CLASS


def token_sort(c: Column) -> Column:
    toks = F.filter(F.split(c, WS_CLASS + "+"), lambda x: x != "")
    return F.array_join(F.array_sort(toks), " ")


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two strings.

    The fold's accumulator carries b's characters, so they are split once per
    pair, not once per cell of the table.
    """
    init = F.struct(F.split(b, "").alias("b"), F.array_repeat(F.lit(0), F.length(b) + 1).alias("row"))

    def row(acc, ca):
        bc, prev = acc["b"], acc["row"]

        def cell(cur, j):
            hit = F.element_at(prev, j) + 1
            miss = F.greatest(F.element_at(prev, j + 1), F.element_at(cur, j))
            return F.concat(cur, F.array(F.when(ca == F.element_at(bc, j), hit).otherwise(miss)))

        new_row = F.aggregate(F.sequence(F.lit(1), F.size(prev) - 1), F.array(F.lit(0)), cell)
        return F.struct(bc.alias("b"), new_row.alias("row"))

    table = F.aggregate(F.split(a, ""), init, row)
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)).otherwise(F.element_at(table["row"], -1))


def indel_ratio(a: Column, b: Column) -> Column:
    total = F.length(a) + F.length(b)
    dist = total - 2 * lcs_length(a, b)
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(100.0) * (F.lit(1.0) - dist / total))


def token_sort_ratio(a: Column, b: Column) -> Column:
    """0-100, case-sensitive.  Pass column references: the sorted forms are used several times."""
    return indel_ratio(token_sort(a), token_sort(b))


def token_sort_sql(x: str) -> str:
    return f"array_to_string(list_sort(list_filter(regexp_split_to_array({x}, '{WS_CLASS}+'), lambda t: t <> '')), ' ')"


def lcs_sql(a: str, b: str) -> str:
    return (
        f"(CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE list_reduce(string_split({a}, ''), "
        f"lambda prev, ca: list_reduce(range(1, length({b}) + 1), "
        f"lambda cur, j: list_append(cur, CASE WHEN ca = substr({b}, j, 1) THEN prev[j] + 1 "
        f"ELSE greatest(prev[j + 1], cur[j]) END), [0]), "
        f"list_transform(range(0, length({b}) + 1), lambda z: 0))[-1] END)"
    )


def token_sort_ratio_sql(a: str, b: str) -> str:
    ta, tb = token_sort_sql(a), token_sort_sql(b)
    total = f"(length({ta}) + length({tb}))"
    return (
        f"(CASE WHEN {total} = 0 THEN 100.0 ELSE 100.0 * (1.0 - "
        f"({total} - 2 * {lcs_sql(ta, tb)}) / CAST({total} AS DOUBLE)) END)"
    )


# --- in tasks ------------------------------------------------------------------
#
# The fold above is exact but interpreted and copies the DP row per cell.  Inside
# Arrow-batched functions the bit-parallel LCS recurrence (one big-integer step
# per character) gives the same ratio far cheaper.


def _lcs_bits(a: str, b: str) -> int:
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def _ratio_py(a: str | None, b: str | None) -> float | None:
    if a is None or b is None:
        return None
    ta, tb = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    total = len(ta) + len(tb)
    if total == 0:
        return 100.0
    return 100.0 * (1.0 - (total - 2 * _lcs_bits(ta, tb)) / total)


# by value: workers need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
