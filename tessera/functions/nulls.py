"""One place for the missing-value and arithmetic rules that differ between a
pandas/NumPy program and Spark SQL (NaN vs NULL, ANSI division, clip, strip,
rounding). Every operator builds on these expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(x: ColumnOrName) -> Column:
    """NaN -> NULL (pandas treats both as missing; Spark orders NaN above every
    number and ``max``/``avg`` return NaN)."""
    c = _c(x)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def normalize_missing(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Apply :func:`nan_to_null` to every float/double column (or ``cols``)."""
    fractional = (T.DoubleType, T.FloatType)
    targets = set(cols) if cols is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, fractional)
    }
    return df.select([nan_to_null(c).alias(c) if c in targets else F.col(c) for c in df.columns])


def safe_div(a: ColumnOrName, b: ColumnOrName, fill: float = 0.0) -> Column:
    """``a / b`` with zero denominator, missing input or missing result -> ``fill``."""
    return F.coalesce(F.try_divide(_c(a).cast("double"), _c(b).cast("double")), F.lit(float(fill)))


def clip_lower(x: ColumnOrName, lower: float) -> Column:
    """``clip(lower=...)`` that keeps missing values missing (``greatest`` would not)."""
    c = _c(x)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(c, F.lit(lower)))


def clip(x: ColumnOrName, lower: float, upper: float) -> Column:
    """Two-sided clip; missing stays missing."""
    c = _c(x)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.least(F.greatest(c, F.lit(lower)), F.lit(upper)))


def strip_ws(x: ColumnOrName) -> Column:
    """Remove leading/trailing whitespace of every kind (``trim`` removes spaces only)."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


def flag(pred: Column) -> Column:
    """Boolean predicate -> 0/1 int, a missing comparison counts as false."""
    return F.coalesce(pred, F.lit(False)).cast("int")


def fill_text(x: ColumnOrName) -> Column:
    """Missing text -> empty string (B1)."""
    return F.coalesce(_c(x), F.lit(""))


def round_half_even(x: ColumnOrName, digits: int = 2) -> Column:
    """Report rounding: half-to-even on the scaled binary value
    (``rint(x * 10^d) / 10^d``); equals DuckDB ``round_even``."""
    scale = float(10 ** digits)
    return F.rint(_c(x) * F.lit(scale)) / F.lit(scale)
