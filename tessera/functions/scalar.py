"""Scalar feature expressions (section B of the operator list)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.nulls import ColumnOrName, _c, flag, strip_ws

# Fixed values that must equal the reference's rules.
# Month spellings -> month number; anything else -> 0.
MONTH_SPELLINGS = {
    "jan": 1, "january": 1,
    "feb": 2, "february": 2,
    "mar": 3, "march": 3,
    "apr": 4, "april": 4,
    "may": 5,
    "jun": 6, "june": 6,
    "jul": 7, "july": 7,
    "aug": 8, "august": 8,
    "sep": 9, "sept": 9, "september": 9,
    "oct": 10, "october": 10,
    "nov": 11, "november": 11,
    "dec": 12, "december": 12,
}
# Visitor type codes; unknown or missing -> 2.
VISITOR_CODES = {"Returning_Visitor": 0, "New_Visitor": 1, "Other": 2}
# Right-closed page-value bins (-0.001, 0], (0, 5], (5, 25], (25, inf) -> 0..3.
PAGE_VALUE_EDGES = (-0.001, 0.0, 5.0, 25.0, math.inf)


def lookup(x: ColumnOrName, mapping: dict, default=None) -> Column:
    """Dictionary lookup with a default for missing keys (``map[...]`` -> NULL -> default)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    found = F.create_map(*pairs)[_c(x)]
    return found if default is None else F.coalesce(found, F.lit(default))


def month_number(x: ColumnOrName) -> Column:
    """Month text -> 1..12 (24 spellings, case and whitespace insensitive), else 0.
    NULL becomes the text 'nan' in the reference and so maps to 0 as well."""
    key = F.lower(strip_ws(_c(x).cast("string")))
    return F.coalesce(lookup(key, MONTH_SPELLINGS), F.lit(0)).cast("int")


def cyclic(x: ColumnOrName, period: float = 12.0) -> tuple[Column, Column]:
    """``(sin(2*pi*x/period), cos(2*pi*x/period))``."""
    angle = F.lit(2.0 * math.pi) * _c(x).cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def right_closed_bucket(x: ColumnOrName, edges: Sequence[float] = PAGE_VALUE_EDGES) -> Column:
    """Index of the right-closed bin ``(edges[i], edges[i+1]]`` holding ``x``;
    NULL when missing or outside every bin. (``ml.feature.Bucketizer`` is
    left-closed, so it is not used.)"""
    c = _c(x)
    expr = F.lit(None).cast("int")
    for i in reversed(range(len(edges) - 1)):
        lo, hi = edges[i], edges[i + 1]
        cond = c > F.lit(lo)
        if not math.isinf(hi):
            cond = cond & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(i)).otherwise(expr)
    return expr


def in_set(x: ColumnOrName, values: Sequence) -> Column:
    """Membership flag as 0/1 (missing -> 0)."""
    return flag(_c(x).isin(list(values)))


def above(x: ColumnOrName, threshold: float, inclusive: bool = False) -> Column:
    """Threshold flag ``x > k`` (or ``>=``) as 0/1, missing -> 0."""
    c = _c(x)
    return flag(c >= F.lit(threshold) if inclusive else c > F.lit(threshold))


def any_flag(*xs: ColumnOrName) -> Column:
    """OR of 0/1 (or boolean) flags as int; a missing flag counts as 0."""
    return F.greatest(*[F.coalesce(_c(x).cast("int"), F.lit(0)) for x in xs])


def powers(x: ColumnOrName, upto: int = 3) -> list[Column]:
    """``[x^2, ..., x^upto]`` as repeated products (exact, no ``pow``)."""
    c = _c(x).cast("double")
    out, term = [], c
    for _ in range(2, upto + 1):
        term = term * c
        out.append(term)
    return out
