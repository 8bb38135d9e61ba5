"""Metamorphic and plan-shape tests of the skew-safe ordered plans."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import timeseries as T
from tessera.plans import ordered as O


def _frame(spark, n=400, keys=3, seed=1):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        k = 0 if rnd.random() < 0.6 else rnd.randint(1, keys)   # key 0 is hot
        rows.append((k, t0 + dt.timedelta(minutes=rnd.randint(0, 5000)), i, rnd.random() * 100, rnd.random() < 0.3))
    return spark.createDataFrame(rows, "k long, ts timestamp_ntz, id long, v double, flag boolean")


def test_position_equals_row_number(spark):
    df = _frame(spark)
    pos = O.with_position(df, ["k"], ["ts", "id"])
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")) - 1)
    got = {r.id: r[O.POS] for r in pos.collect()}
    assert got == {r.id: r.rn for r in ref.collect()}


def test_keyless_position(spark):
    df = _frame(spark)
    pos = O.with_position(df, [], ["ts", "id"])
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("ts", "id")) - 1)
    assert {r.id: r[O.POS] for r in pos.collect()} == {r.id: r.rn for r in ref.collect()}


def test_chunked_rolling_equals_window(spark):
    df = _frame(spark)
    pos = T.order_series(df, ["k"], ["ts", "id"])
    got = T.rolling_stats(pos, {"mx": ("max", "v"), "s": ("sum", F.col("flag").cast("int"))}, width=7, chunk_rows=5)
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(-6, 0)
    ref = df.select("id", F.max("v").over(w).alias("mx"), F.sum(F.col("flag").cast("int")).over(w).alias("s"))
    assert {r.id: (r.mx, r.s) for r in got.collect()} == {r.id: (r.mx, r.s) for r in ref.collect()}


def test_running_sum_equals_window(spark):
    df = _frame(spark)
    pos = T.order_series(df, ["k"], ["ts", "id"])
    got = O.running_sum(pos, F.col("flag").cast("long"), "rs", chunk_rows=4)
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("id", F.sum(F.col("flag").cast("long")).over(w).alias("rs"))
    assert {r.id: r.rs for r in got.collect()} == {r.id: r.rs for r in ref.collect()}


def test_bucketed_range_join_equals_nested_loop(spark):
    df = _frame(spark)
    wins = df.filter("flag").select(F.col("k"), F.col("ts").alias("e"),
                                    F.timestamp_add("MINUTE", F.lit(-90), "ts").alias("s"))
    from tessera.operators.joins import range_join
    a = range_join(df.select("k", "ts", "id"), wins, "ts", "s", "e", keys=["k"], bucket_seconds=1800)
    b = range_join(df.select("k", "ts", "id"), wins, "ts", "s", "e", keys=["k"], windows_are_small=True)
    key = lambda r: (r.k, r.e, r.id)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_partition_only_moves_aggregates(spark):
    """A keyless series may pass its per-bucket / per-chunk count tables through
    one task, never the rows themselves."""
    df = _frame(spark)
    pos = T.order_series(df, [], ["ts", "id"])
    lines = _plan(T.island_ids(pos, "flag")).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate" in lines[i + 1], lines[i:i + 3]
    keyed = _plan(T.island_ids(T.order_series(df, ["k"], ["ts", "id"]), "flag"))
    assert "SinglePartition" not in keyed


def test_no_python_udf_in_event_rollup(spark):
    import __spark_entry__ as E
    plan = _plan(E.entry(spark))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
