"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_us(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock (NTZ) timestamp."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts.cast("timestamp_ntz"))


def shift(ts: Column, seconds: int) -> Column:
    """``ts + seconds`` (negative to go back), keeping the timestamp type."""
    return F.timestamp_add("SECOND", F.lit(seconds), ts)
