"""Filters and predicates."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import with_scalars
from tessera.plans import ordered as O

_OPS = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
        "==": operator.eq, "!=": operator.ne}


def all_of(conditions: Mapping[str, tuple[str, object]]) -> Column:
    """AND of ``column op constant`` tests; a missing value makes the test
    false (never NULL, so it can be cast to 0/1 safely)."""
    pred = F.lit(True)
    for col, (op, k) in conditions.items():
        pred = pred & F.coalesce(_OPS[op](F.col(col), F.lit(k)), F.lit(False))
    return pred


def running_failure(comp: str = "COMP", current: str = "Motor_current", current_min: float = 1.0) -> Column:
    """C1 on the compressor schema: compressor valve off but motor drawing current."""
    return all_of({comp: ("<", 0.05), current: (">", current_min)})


def frozen(current: str = "Motor_current") -> Column:
    return all_of({current: ("<", 0.05)})


def normal(current: str = "Motor_current") -> Column:
    return all_of({current: (">", 0.5)})


def in_time_range(ts: str, start, end) -> Column:
    """Closed range; text bounds like ``'2020-04-17'`` are read as midnight."""
    lo = F.lit(start).cast("timestamp_ntz") if isinstance(start, str) else F.lit(start)
    hi = F.lit(end).cast("timestamp_ntz") if isinstance(end, str) else F.lit(end)
    return F.coalesce(F.col(ts).between(lo, hi), F.lit(False))


def above_reference_max(df: DataFrame, reference: DataFrame, value: str) -> DataFrame:
    """Rows whose ``value`` is above the maximum of a reference population
    (one-row aggregate broadcast to the rows)."""
    ref = reference.agg(F.max(value).alias("_ref_max"))
    return with_scalars(df, ref).filter(F.col(value) > F.col("_ref_max")).drop("_ref_max")


def period_split(df: DataFrame, period: str, valid_from: int, pool_from: int) -> DataFrame:
    """C4: ``is_train`` (< valid_from), ``is_valid`` (>= valid_from) and
    ``in_pool`` (>= pool_from; the pool contains the validation periods)."""
    p = F.col(period)
    return (df.withColumn("is_train", F.coalesce(p < valid_from, F.lit(False)))
            .withColumn("is_valid", F.coalesce(p >= valid_from, F.lit(False)))
            .withColumn("in_pool", F.coalesce(p >= pool_from, F.lit(False))))


def label_windows(df: DataFrame, ts: str, windows: Sequence[tuple], out: str = "label") -> DataFrame:
    """1 for rows inside any of the closed ``(start, end)`` windows, else 0, for
    all rows (a literal window list, expanded into one expression)."""
    pred = F.lit(False)
    for start, end in windows:
        pred = pred | in_time_range(ts, start, end)
    return df.withColumn(out, pred.cast("int"))


def label_by_windows(df: DataFrame, ts: str, windows: DataFrame, start: str, end: str,
                     keys: Sequence[str] = (), out: str = "label",
                     chunk_rows: int = O.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """C5 for a table of windows: 1 for rows inside any closed window of equal ``keys``,
    else 0, for all rows and with their columns. A sweep line: each window adds one before
    the rows of its start and takes it away after those of its end (added up where
    many share a time), and a row is inside where the running sum of its series is over
    zero. The cost is one sort of rows and window ends, however the windows overlap; no
    (row, window) pair is made and a hot key is split. A missing time is outside, and
    windows with a missing end, or that end before they start, hold nothing."""
    bounds = windows.filter(F.col(start) <= F.col(end))

    def step(at: str, order: int, delta: int) -> DataFrame:
        d = bounds.groupBy(*keys, F.col(at).cast("timestamp_ntz").alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
        return d.select(*keys, "_at", F.lit(order).alias("_kind"), (F.col("_n") * F.lit(delta)).alias("_step"))

    rows = df.select(F.struct(*df.columns).alias("_row"), *keys, F.col(ts).cast("timestamp_ntz").alias("_at"),
                     F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_step"))
    line = rows.unionByName(step(start, 0, 1), allowMissingColumns=True).unionByName(step(end, 2, -1), allowMissingColumns=True)
    swept = O.running_sum(O.with_position(line, keys, ["_at", "_kind"], from_zero=False), F.col("_step"), "_open", chunk_rows)
    return swept.filter(F.col("_kind") == 1).select("_row.*", (F.col("_open") > 0).cast("int").alias(out))


def all_rows(df: DataFrame, pred: Column, out: str = "all_true") -> DataFrame:
    """Does the predicate hold on every row (``bool_and``; empty -> NULL)."""
    return df.agg(F.every(F.coalesce(pred, F.lit(False))).alias(out))
