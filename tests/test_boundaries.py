"""Rules at the edges: missing order values, NaN, zones, crowded scores, CSV, scripts."""

import datetime as dt
import json
import unicodedata

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import strip_accents
from tessera.operators import batching as H
from tessera.operators import encoding as E
from tessera.operators import evaluation as J
from tessera.operators import joins as D
from tessera.operators import timeseries as T
from tessera.plans import ordered as O
from tessera.sources import tables as S


def test_rows_without_an_order_value_come_last(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t, 1), ("a", None, 2), ("a", t, 3), (None, t, 4), ("a", None, 5), (None, None, 6)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long")
    got = {r.id: r[O.POS] for r in O.with_position(df, ["k"], ["ts", "id"]).collect() if r.k}
    assert got == {1: 0, 3: 1, 2: 2, 5: 3}
    assert sorted(r[O.POS] for r in O.with_position(df, [], ["ts", "id"]).collect()) == list(range(6))
    assert O.with_position(df.limit(0), ["k"], ["ts", "id"]).count() == 0


def test_a_hot_key_in_one_hour_is_split(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(O, "staged", lambda df, name, real=O.staged: kept.append(real(df, name)) or kept[-1])
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are put together
    try:
        pos = O.with_position(df, ["k"], ["ts", "id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert pos.filter(F.col(O.POS) == F.col("id")).count() == 20_000
    ranges = kept[0].groupBy(F.shiftright(O.POS, 33).alias("p")).count().collect()
    assert len(ranges) > 2 and max(r["count"] for r in ranges) < 10_000


def test_auc_of_crowded_scores_and_missing_ones(spark):
    n = 2_000
    rows = [(i % 2, 0.5 + (i // 2) * 1e-9 + (1e-10 if i % 2 else 0.0)) for i in range(n)] + [(0, 1e9), (1, float("nan")), (0, None)]
    got = J.roc_auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()
    valid = [(y, s) for y, s in rows if s is not None and s == s]
    pos, neg = [s for y, s in valid if y], [s for y, s in valid if not y]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(got.auc - want) < 1e-12 and (got.n_pos, got.n_neg) == (len(pos), len(neg))


def test_scorer_hook_with_line_breaks(spark):
    df = spark.createDataFrame([(i, f"line\n{i % 3 + 7}. [x] more", "t") for i in range(70)], "id int, text string, tag string")
    before = H.make_batches(df, ["id"], "text", "tag", 30)
    scored = H.score_batches(before, lambda p: json.dumps(["market_risk"] * 30))
    assert "reply" not in before.columns and scored.count() == 3
    out = H.labels_from_replies(H.score_batches(before, H.echo_scorer()), ["id"])
    assert out.count() == 70 and out.filter("n_mismatch").count() == 0


def test_csv_round_trip_and_nan(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5), (2, None), (3, float("nan"))], "id long, p double")
    S.write_predictions(df, str(tmp_path / "out"))
    back = S.read_table(spark, str(tmp_path / "out"), "id long, p double", "csv")
    assert {r.id: r.p for r in back.collect()} == {1: 0.5, 2: None, 3: None}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_have_no_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00",), ("bad",), (None,)], "t string")
        want = [dt.datetime(2024, 3, 10, 2, 30), None, None]
        assert [r.t for r in S.parse_ts(df, "t").collect()] == want
        assert [r.t for r in S.parse_ts(df, "t", "yyyy-MM-dd HH:mm:ss").collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_accents_of_every_script(spark):
    texts = ["ﬁx й ά Ａ", "éà ñ Ǆ", "한글 カ゛ が", "𝔸 é", "plain", "", None]
    fold = lambda t: t and "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(strip_accents(F.col("t"))).collect()] == [fold(t) for t in texts]


def test_lookup_of_a_small_dimension_does_not_shuffle_the_facts(spark):
    facts = spark.range(1000).select("id", (F.col("id") % 5).cast("string").alias("k"))
    dim = facts.groupBy("k").agg(F.avg("id").alias("v")).filter("k != '4'")
    out = D.lookup_join(facts, dim, "k", "v", "got", -1.0)
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.filter("got = -1.0").count() == 200


def test_window_summary_takes_whole_buckets(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t + dt.timedelta(minutes=7 * i), i, float(i)) for i in range(300)], "k int, ts timestamp_ntz, id long, v double")
    spans = [(0, 600), (13, 14), (60, 120), (59, 61), (5000, 6000), (100, 90), (0, 60)]
    w = spark.createDataFrame([(1, n, t + dt.timedelta(minutes=a), t + dt.timedelta(minutes=b)) for n, (a, b) in enumerate(spans)],
                              "k int, n int, win_start timestamp_ntz, win_end timestamp_ntz")
    got = {r.n: r for r in T.window_summary(df, w, "ts", "id", "v", ["n"], keys=["k"]).collect()}
    for n, (a, b) in enumerate(spans):
        inside = [i for i in range(300) if a <= 7 * i <= b]
        assert got[n].n_rows == len(inside)
        if inside:
            assert (got[n].id_min, got[n].id_max, got[n].value_mean) == (inside[0], inside[-1], sum(inside) / len(inside))


def test_rows_without_a_label_are_no_class(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, y string")
    got = {r.id: r.weight for r in E.class_weights(df, "y").collect()}
    assert got == {1: 0.75, 2: 0.75, 3: 1.5, 4: None}
