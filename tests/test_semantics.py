"""Missing-value, edge and tie semantics on tiny inline frames."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.functions.nulls import clip_lower, nan_to_null, safe_div, strip_ws
from tessera.functions.replies import extract_json_array, normalize_labels
from tessera.operators import dedup, encoding, evaluation, timeseries as T


def test_safe_div_and_clip(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (4.0, 2.0), (float("nan"), 1.0)], "a double, b double")
    out = df.select(safe_div(nan_to_null("a"), "b", -1.0).alias("r"), clip_lower(F.col("a") - 3, 0.0).alias("c")).collect()
    assert [r.r for r in out] == [-1.0, -1.0, 2.0, -1.0]
    assert out[1].c is None and out[0].c == 0.0 and out[2].c == 1.0


def test_month_and_strip(spark):
    df = spark.createDataFrame([(" Sept ",), ("xyz",), (None,), ("\tDecember\n",), ("may",)], "m string")
    got = [r[0] for r in df.select(S.month_number("m")).collect()]
    assert got == [9, 0, 0, 12, 5]
    assert spark.createDataFrame([("\t a \n",)], "s string").select(strip_ws("s")).first()[0] == "a"


def test_right_closed_bucket_edges(spark):
    vals = [0.0, 5.0, 25.0, 25.0001, -0.001, -0.0005, 1e9, None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(S.right_closed_bucket("v")).collect()]
    assert got == [0, 1, 2, 3, None, 0, 3, None]


def _series(spark, rows):
    return spark.createDataFrame(rows, "k long, ts timestamp_ntz, id long, v double, flag boolean")


def test_first_row_is_change_and_islands(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0 + dt.timedelta(minutes=10 * i), i, float(i), f) for i, f in
            enumerate([True, True, False, True, False, False, True])]
    pos = T.order_series(_series(spark, rows), ["k"], ["ts", "id"])
    ch = T.change_points(pos, "flag", chunk_rows=3).orderBy("id").collect()
    assert [r.change for r in ch] == [True, False, True, True, True, False, True]
    bl = T.island_ids(pos, "flag", chunk_rows=2).orderBy("id").collect()
    assert [r.block for r in bl] == [1, 1, 2, 3, 4, 4, 5]


def test_gap_exactly_30_minutes_stays_in_session(spark):
    t0 = dt.datetime(2024, 1, 1)
    offs = [0, 30 * 60, 60 * 60 + 1, 90 * 60 + 1]   # 30 min gap, then 30 min 1 s, then 30 min
    rows = [(1, t0 + dt.timedelta(seconds=s), i, 1.0, True) for i, s in enumerate(offs)]
    out = T.gap_sessions(_series(spark, rows), ["k"], "flag", "ts", "id", 1800, "v", "id", min_rows=1)
    assert sorted(r.n_rows for r in out.collect()) == [2, 2]


def test_peak_row_first_on_ties(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0 + dt.timedelta(minutes=i), i, v, False) for i, v in enumerate([1.0, 9.0, 3.0, 9.0, None])]
    r = T.peak_row(_series(spark, rows), ["k"], "v", "ts", "id").first()
    assert r.peak_id == 1 and r.peak_value == 9.0


def test_best_window_earliest_on_ties(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0 + dt.timedelta(minutes=i), i, 1.0, False) for i in range(10)]
    pos = T.order_series(_series(spark, rows).withColumn("score", F.lit(1.0)), ["k"], ["ts", "id"])
    b = T.best_window(pos, ["k"], "score", "ts", "id", "v", width=4, chunk_rows=3).first()
    assert b.id_min == 0 and b.id_max == 3 and b.window_score == 4.0


def test_fold_maps_unseen_and_self(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 0, 1), ("b", 1, 1), (None, 1, 0)], "c string, y int, fold int")
    maps = {(r.fold, r.c): r for r in encoding.fold_target_maps(df, "c", "y", "fold", 2).collect()}
    # fold 0 map is built from fold 1 rows only: a -> (1 row, mean 0), b -> (1 row, mean 1)
    assert maps[(0, "a")].n == 1 and abs(maps[(0, "a")].te - (5 * 0.155) / 6) < 1e-12
    assert (1, "b") not in maps  # b only occurs in fold 1
    te = encoding.apply_encoding(spark.createDataFrame([("z",), (None,)], "c string"),
                                 encoding.target_encoding_map(df, "c", "y"), "c", "te")
    assert [r.te for r in te.collect()] == [0.155, 0.155]


def test_dedup_keeps_smallest_id(spark):
    df = spark.createDataFrame([(3, "x", 1), (1, "x", 0), (2, None, 1), (5, None, 0), (4, "y", 1)], "id long, t string, y int")
    out = sorted((r.id, r.y) for r in dedup.drop_exact_duplicates(df, "id", exclude=["y"]).collect())
    assert out == [(1, 0), (2, 1), (4, 1)]


def test_reply_parsing(spark):
    df = spark.createDataFrame([
        ('Sure: ["Market Risk", " tax "] ok', 2), ('no array', 2), ('["a", "b"', 3), ('["market_risk"]', 3)],
        "reply string, n int")
    got = [r[0] for r in df.select(normalize_labels(extract_json_array(F.col("reply")), F.col("n"))).collect()]
    assert got[0] == ["market_risk", "other_risk"]
    assert got[1] == ["other_risk"] * 2
    assert got[2] == ["other_risk"] * 3
    assert got[3] == ["market_risk", "other_risk", "other_risk"]


def test_macro_f1_and_auc(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    r = evaluation.macro_f1(df, "y", "p").first()
    assert math.isclose(r.macro_f1, (2 / 3 + 2 / 4 + 0) / 3)
    s = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1), (0, 0.5)], "y int, s double")
    auc = evaluation.roc_auc(s, "y", "s").first().auc
    # pairs: (0.9 vs 0.9 tie .5, 0.9>0.5, 0.9>0.1) + (0.5 vs 0.9 lose, 0.5>0.1, 0.5 tie .5) = 2.5 + 1.5 = 4 / 6
    assert math.isclose(auc, 4 / 6)


def test_empty_inputs(spark):
    e = _series(spark, [])
    pos = T.order_series(e, ["k"], ["ts", "id"])
    assert T.island_ids(pos, "flag").count() == 0
    assert T.gap_sessions(e, ["k"], "flag", "ts", "id", 1800, "v", "id").count() == 0
    assert T.peak_row(e, ["k"], "v", "ts", "id").count() == 0
