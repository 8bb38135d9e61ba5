"""Joins (D1-D4): lookup with default, interval containment (range join),
broadcast of a one-row aggregate, id-set overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.time import epoch_us
from tessera.session import broadcast_if_small, staged


def lookup_join(df: DataFrame, dim: DataFrame, key: str, value: str, out: str,
                default, dim_key: str | None = None) -> DataFrame:
    """Left equi-join to a dimension, missing or NULL key -> ``default``. A
    dimension of at most ``BROADCAST_ROWS`` rows (counted here) is broadcast, so the
    facts are not shuffled by its few keys; a larger one is joined by shuffle."""
    dk = dim_key or key
    right = dim.select(F.col(dk).alias("_dk"), F.col(value).alias("_dv"))
    right = broadcast_if_small(right)
    joined = df.join(right, F.col(key) == F.col("_dk"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_dv"), F.lit(default))).drop("_dk", "_dv")


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """D3: attach the columns of a one-row aggregate to every row (broadcast
    cross join of a single row; no ``collect`` to the driver)."""
    return df.crossJoin(F.broadcast(one_row))


#: Ratio of the bucket lengths of neighbouring levels, and levels (8^10 hours are
#: longer than any timestamp's range).
FAN, LEVELS = 8, 10


def _window_buckets(first, last) -> Column:
    """The fewest aligned buckets that tile the cells ``first .. last`` without overlap, as
    ``(level, bucket)``: on each level the cells before the first and after the last
    bucket of the next one, at most ``2 * (FAN - 1)`` each side taken together."""
    from_ = lambda k: F.ceil(first / F.lit(FAN ** k)).cast("long")
    to = lambda k: F.floor((last + 1) / F.lit(FAN ** k)).cast("long")

    def run(k, a, b):
        return F.when(a < b, F.transform(F.sequence(a, b - 1), lambda x: F.struct(F.lit(k).alias("level"), x.alias("bucket"))))

    none = F.array().cast("array<struct<level:int,bucket:bigint>>")
    parts = []
    for k in range(LEVELS + 1):
        a, b, a_up, b_up = from_(k), to(k), from_(k + 1), to(k + 1)
        inner = (a_up < b_up) if k < LEVELS else F.lit(False)
        parts += [F.coalesce(F.when(inner, run(k, a, a_up * FAN)).otherwise(run(k, a, b)), none),
                  F.coalesce(F.when(inner, run(k, b_up * FAN, b)), none)]
    return F.concat(*parts)


def range_join(rows: DataFrame, windows: DataFrame, ts: str, start: str, end: str,
               keys: Sequence[str] = (), how: str = "inner", bucket_seconds: int = 3600,
               windows_are_small: bool = False) -> DataFrame:
    """Rows x closed windows with ``start <= ts <= end`` (and equal ``keys``).

    ``how`` is ``inner`` or ``window_left`` (every window kept once more where no row
    falls inside, with NULL row columns). With ``windows_are_small`` (a literal window
    list) an inner join broadcasts the windows (the preserved side of an outer join
    cannot be). Otherwise time is cut into cells of ``bucket_seconds`` and buckets of 8,
    64, ... cells: a window becomes the few aligned buckets that tile it (a year of
    hours: some dozens), a row one bucket on each level that any window uses (counted
    first: at most eleven). The join is an equi-join on ``(keys, level, bucket)`` with
    the exact interval test as a residual; the buckets of a window do not overlap, so
    no pair is produced twice and nothing is broadcast blindly. Window columns must not
    clash with row columns.
    """
    cond_range = (F.col(ts) >= F.col(start)) & (F.col(ts) <= F.col(end))
    if windows_are_small and how == "inner":
        cond = cond_range
        for k in keys:
            cond = cond & F.col(f"_r_{k}").eqNullSafe(F.col(k))
        left = rows.select("*", *[F.col(k).alias(f"_r_{k}") for k in keys]).drop(*keys)
        return left.join(F.broadcast(windows), cond, "inner").drop(*[f"_r_{k}" for k in keys])
    cell = lambda c: F.floor(epoch_us(F.col(c)) / F.lit(bucket_seconds * 1_000_000)).cast("long")
    w = windows
    if how == "window_left":
        w = staged(windows.withColumn("_wid", F.monotonically_increasing_id()), "range-windows")
    tiled = (w.filter(F.col(start) <= F.col(end)).withColumn("_a", cell(start)).withColumn("_z", cell(end))
             .withColumn("_b", F.explode(_window_buckets(F.col("_a"), F.col("_z")))).drop("_a", "_z"))
    levels = sorted(r["level"] for r in tiled.select("_b.level").distinct().collect())  # LEVELS + 1 at most
    own = [F.struct(F.lit(k).alias("level"), F.floor(cell(ts) / F.lit(FAN ** k)).cast("long").alias("bucket")) for k in levels]
    own = F.array(*own) if own else F.array().cast("array<struct<level:int,bucket:bigint>>")
    # rows without a time fall into no window
    r = rows.filter(F.col(ts).isNotNull()).withColumn("_rb", F.explode(own))
    r = r.select("*", *[F.col(k).alias(f"_r_{k}") for k in keys]).drop(*keys)
    cond = (F.col("_b.level") == F.col("_rb.level")) & (F.col("_b.bucket") == F.col("_rb.bucket")) & cond_range
    for k in keys:
        cond = cond & F.col(f"_r_{k}").eqNullSafe(F.col(k))
    found = r.join(tiled, cond, "inner").drop("_b", "_rb", *[f"_r_{k}" for k in keys])
    if how != "window_left":
        return found
    found = staged(found, "range-pairs")
    empty = w.join(found.select("_wid").distinct(), "_wid", "left_anti")
    return found.unionByName(empty, allowMissingColumns=True).drop("_wid")


def id_overlap(a: DataFrame, b: DataFrame, id_col: str) -> DataFrame:
    """Size, min and max of the intersection of two id sets."""
    both = a.select(id_col).intersect(b.select(id_col))
    return both.agg(F.count(F.lit(1)).alias("n_overlap"), F.min(id_col).alias("id_min"),
                    F.max(id_col).alias("id_max"))
