"""Aggregations and profiles (A5, E1-E5, E13). Each profile is one pass with
conditional aggregates, reshaped to long form with ``stack``; partial
aggregation combines map-side, so a hot cohort costs no more than a cold one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count per value, most frequent first (missing values excluded)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(col)))


def column_stats(df: DataFrame, col: str) -> DataFrame:
    """Mean, sample std, max, min, sum of one column."""
    return df.agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"), F.max(col).alias("max"),
                  F.min(col).alias("min"), F.sum(col).alias("sum"))


def mean_std(df: DataFrame, col: str, group: Sequence[str] = ()) -> DataFrame:
    """Mean and population std (NumPy ``std``) per group."""
    return df.groupBy(*group).agg(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std"))


def _stack(names: Sequence[str], value_cols: Sequence[Sequence[str]], label: str, out: Sequence[str]) -> Column:
    parts = []
    for n, vals in zip(names, value_cols):
        parts.append(f"'{n}'")
        parts += [f"`{v}`" for v in vals]
    return F.expr(f"stack({len(names)}, {', '.join(parts)}) as ({label}, {', '.join(out)})")


def cohort_profile(df: DataFrame, sensors: Sequence[str], cohorts: Mapping[str, Column],
                   compare: tuple[str, str], threshold: float = 0.1) -> DataFrame:
    """Mean of each sensor in each (possibly empty) cohort, long form, one row
    per sensor; ``marked`` when ``|mean[a] - mean[b]| > threshold`` for the pair
    ``compare``; an empty cohort gives NULL means and is never marked."""
    aggs, cols = [], []
    for s in sensors:
        row = []
        for name, pred in cohorts.items():
            alias = f"_{name}__{s}"
            aggs.append(F.avg(F.when(F.coalesce(pred, F.lit(False)), F.col(s))).alias(alias))
            row.append(alias)
        cols.append(row)
    wide = df.agg(*aggs)
    long = wide.select(_stack(sensors, cols, "sensor", list(cohorts)))
    a, b = compare
    return long.withColumn("marked", F.coalesce(F.abs(F.col(a) - F.col(b)) > F.lit(threshold), F.lit(False)))


def drift_profile(train: DataFrame, test: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Per sensor the train mean/max and test mean/max, ``exceeds`` when the
    test max is above the train max. One scan of the tagged union."""
    tagged = train.select(*sensors, F.lit(True).alias("_tr")).unionByName(
        test.select(*sensors, F.lit(False).alias("_tr")))
    aggs, cols = [], []
    for s in sensors:
        names = [f"_tm_{s}", f"_tx_{s}", f"_em_{s}", f"_ex_{s}"]
        aggs += [F.avg(F.when(F.col("_tr"), F.col(s))).alias(names[0]),
                 F.max(F.when(F.col("_tr"), F.col(s))).alias(names[1]),
                 F.avg(F.when(~F.col("_tr"), F.col(s))).alias(names[2]),
                 F.max(F.when(~F.col("_tr"), F.col(s))).alias(names[3])]
        cols.append(names)
    long = tagged.agg(*aggs).select(_stack(sensors, cols, "sensor",
                                           ["train_mean", "train_max", "test_mean", "test_max"]))
    return long.withColumn("exceeds", F.coalesce(F.col("test_max") > F.col("train_max"), F.lit(False)))


def cohort_compare(df: DataFrame, cohorts: Sequence[tuple[str, Column]], sensors: Sequence[str]) -> DataFrame:
    """E5: mean of ``sensors`` per named cohort; cohorts may overlap (a row is
    counted in each cohort it belongs to). One scan: each row explodes into the
    labels of its cohorts; empty cohorts produce no row."""
    labels = F.filter(F.array(*[F.when(F.coalesce(p, F.lit(False)), F.lit(n)) for n, p in cohorts]),
                      lambda x: x.isNotNull())
    exploded = df.select(F.explode(labels).alias("cohort"), *sensors)
    return exploded.groupBy("cohort").agg(F.count(F.lit(1)).alias("n_rows"),
                                          *[F.avg(s).alias(f"{s}_mean") for s in sensors])
