"""Plans that must hold at scale: long windows, sweep lines, frames by time, vocabularies
cut without a full sort, buckets by document, fingerprints, rejected lines."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import dedup, filters, joins, textfeatures, timeseries
from tessera.plans import ordered as O
from tessera.sources import tables

T0 = dt.datetime(2024, 1, 1)


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _points(spark, n=300, seed=2):
    rnd = random.Random(seed)
    rows = [(rnd.choice([0, 0, 0, 1, None]), T0 + dt.timedelta(minutes=rnd.choice([0, 1, 7]) * rnd.randint(0, 900)), i, rnd.random()) for i in range(n)]
    rows += [(0, None, n, 1.0), (None, None, n + 1, 2.0)]
    return spark.createDataFrame(rows, "k long, ts timestamp_ntz, id long, v double")


def _windows(spark, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(60):
        s = T0 + dt.timedelta(minutes=rnd.randint(-3000, 6500))
        out.append((rnd.choice([0, 1, None]), s, s + dt.timedelta(minutes=rnd.choice([-5, 0, 30, 700, 100_000])), i))
    out += [(0, None, T0, 90), (0, T0, None, 91), (5, T0, T0 + dt.timedelta(days=400), 92)]
    return spark.createDataFrame(out, "k long, s timestamp_ntz, e timestamp_ntz, w long")


def test_a_long_window_makes_few_buckets(spark):
    hour = lambda c: F.floor(F.col(c) / 3600).cast("long")
    spans = [(a, a + n) for a in (0, 5, 3600 * 777, -3600 * 1000 - 1) for n in (0, 3599, 3600 * 9, 3600 * 24 * 366)]
    df = spark.createDataFrame(spans, "a long, b long").withColumn("t", joins._window_buckets(hour("a"), hour("b")))
    for r in df.collect():
        cells = sorted(c for t in r.t for c in range(t.bucket * 8 ** t.level, (t.bucket + 1) * 8 ** t.level))
        assert cells == list(range(r.a // 3600, r.b // 3600 + 1)) and len(r.t) < 100


@pytest.mark.parametrize("bucket_seconds", [60, 3600])
def test_range_join_equals_nested_loop(spark, bucket_seconds):
    rows, wins = _points(spark), _windows(spark)
    got = joins.range_join(rows, wins, "ts", "s", "e", keys=["k"], bucket_seconds=bucket_seconds)
    want = joins.range_join(rows, wins, "ts", "s", "e", keys=["k"], windows_are_small=True)
    pairs = lambda d: sorted((r.id, r.w) for r in d.collect())
    assert pairs(got) == pairs(want) and got.count() > 500
    kept = joins.range_join(rows, wins, "ts", "s", "e", keys=["k"], how="window_left", bucket_seconds=bucket_seconds)
    inside = {w for _, w in pairs(want)}
    lone = [(None, w) for w in range(60) if w not in inside] + [(None, w) for w in (90, 91, 92)]
    assert sorted(((r.id, r.w) for r in kept.collect()), key=str) == sorted(pairs(want) + lone, key=str)
    assert set(kept.columns) == {"ts", "id", "v", "k", "s", "e", "w"}


@pytest.mark.parametrize("keys", [["k"], []])
def test_sweep_line_labels(spark, keys):
    rows, wins = _points(spark), _windows(spark)
    got = filters.label_by_windows(rows, "ts", wins.filter("w < 60 OR w > 89"), "s", "e", keys, "inside", chunk_rows=7)
    assert got.columns == [*rows.columns, "inside"]
    ws = [r for r in wins.collect() if r.s and r.e]
    want = {r.id: int(any((not keys or w.k == r.k) and r.ts is not None and w.s <= r.ts <= w.e for w in ws)) for r in rows.collect()}
    assert {r.id: r.inside for r in got.collect()} == want and 0 < sum(want.values()) < len(want)
    assert {r.inside for r in filters.label_by_windows(rows, "ts", wins.limit(0), "s", "e", keys, "inside").collect()} == {0}
    assert filters.label_by_windows(rows.limit(0), "ts", wins, "s", "e", keys, "inside").count() == 0


@pytest.mark.parametrize("chunk_rows", [3, 50, 100_000])
def test_frames_by_time_equal_a_plain_window(spark, chunk_rows):
    rows = _points(spark)
    pos = timeseries.order_series(rows, ["k"], ["ts", "id"])
    got = timeseries.rolling_stats_over_time(pos, "ts", {"hi": ("max", "v"), "n": ("sum", F.lit(1))}, 1.5, chunk_rows)
    us = F.timestamp_diff("SECOND", F.lit(T0), "ts")
    w = Window.partitionBy("k").orderBy(us).rangeBetween(-5400, 0)
    want = rows.filter("ts IS NOT NULL").select("id", F.max("v").over(w).alias("hi"), F.count("id").over(w).alias("n"))
    expected = {r.id: (r.hi, r.n) for r in want.collect()} | {300: (None, None), 301: (None, None)}
    assert {r.id: (r.hi, r.n) for r in got.collect()} == expected


@pytest.mark.parametrize("most", [0, 1, 3, 4, 5, 6, 50])
def test_vocabulary_is_cut_at_a_level_of_counts(spark, most):
    counts = {"a": 9, "b": 4, "c": 4, "d": 4, "e": 1, "f": 1}
    tf = spark.createDataFrame([(i, t, n) for i, (t, n) in enumerate(counts.items())], "doc_id long, term string, tf long")
    got = {r.term for r in textfeatures.vocabulary(tf, 1, most).collect()}
    assert got == set(sorted(counts, key=lambda t: (-counts[t], t))[:most])
    assert textfeatures.vocabulary(tf.limit(0), 1, most).count() == 0


def test_tfidf_norm_needs_no_exchange(spark):
    docs = spark.createDataFrame([(i, f"alpha beta w{i % 7} w{i % 3}", i % 2 == 0) for i in range(40)], "doc_id long, text string, fit boolean")
    weights, _ = textfeatures.fit_transform_tfidf(docs, "doc_id", "text", "fit", "word", (1, 2), 1, 100)
    plan = _plan(weights)
    assert "Window" in plan and "Exchange hashpartitioning(doc_id" not in plan
    norms = weights.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert len(norms) == 40 and all(abs(r.n - 1) < 1e-9 for r in norms)


def test_keyword_tests_are_compiled(spark):
    docs = spark.createDataFrame([(1, "A Price War and a LAWSUIT"), (2, None)], "id long, text string")
    scored = textfeatures.keyword_scores(docs, "text")
    plan = _plan(scored)
    assert plan.count("lower(") == 1 and "lambda" not in plan
    got = {r.id: r for r in scored.collect()}
    assert got[1].competitive_risk_kw == 1 and got[1].litigation_risk_kw == 1 and got[2].market_risk_kw == 0


@pytest.mark.parametrize("fingerprint", [None, "1", "length(coalesce(t, ''))"])
def test_dedup_whatever_the_fingerprint(spark, fingerprint):
    rows = [(3, "x", 1, 0), (1, "x", 1, 5), (2, None, 1, 6), (5, None, 1, 7), (4, "y", 1, 8), (None, "y", 1, 9), (None, "z", 1, 2),
            (7, "x", 2, 1), (1, "x", 1, 4)]
    df = spark.createDataFrame(rows, "id long, t string, n int, y int").repartition(3)
    got = dedup.drop_exact_duplicates(df, "id", exclude=["y"], fingerprint=fingerprint and F.expr(fingerprint))
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "x", 1, 4), (2, None, 1, 6), (4, "y", 1, 8), (None, "z", 1, 2), (7, "x", 2, 1)], key=str)


def test_dedup_exchanges_no_text(spark):
    df = spark.createDataFrame([(i, f"text {i % 20}") for i in range(60)], "id long, t string")
    plan = _plan(dedup.drop_exact_duplicates(df, "id"))
    keys = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert keys and not any(re.search(r"\bt#", k.split("),")[0]) for k in keys)
    assert "SortAggregate" not in plan


def test_rejected_csv_lines(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,v,t\n1,2.5,2024-01-01 00:00:00\nx,1.0,2024-01-01 00:00:00\n2,NaN,2024-01-02 00:00:00\n"
                                     "3,4.0\n4,1.0,2024-01-01 00:00:00,9\n5,,\n6,1.0,nope\n")
    rows, rejects = tables.read_csv_checked(spark, str(tmp_path / "in.csv"), "id long, v double, t timestamp_ntz")
    assert sorted((r.id, r.v) for r in rows.select("id", "v").collect()) == [(1, 2.5), (2, None), (5, None)]
    assert sorted(r.id for r in rows.select("id").collect()) == [1, 2, 5] and rows.count() == 3
    assert sorted(r.line.split(",")[0] for r in rejects.collect()) == ["3", "4", "6", "x"]
    assert all(r.file.endswith("in.csv") for r in rejects.collect())
    assert O.POS not in rows.columns
