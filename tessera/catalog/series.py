"""Registered queries for ordered sensor series (events stand-in) and their
DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog import standins as S
from tessera.catalog.standins import KEYS, ORDER, SQL_REF, SQL_TEST, SQL_TRAIN
from tessera.functions.nulls import round_half_even
from tessera.functions.time import shift


def r9(c):
    """Computed doubles are reported half-even at 9 decimals (DuckDB ``round_even``)."""
    return round_half_even(F.col(c) if isinstance(c, str) else c, 9)
from tessera.operators import filters as C
from tessera.operators import joins as D
from tessera.operators import timeseries as T
from tessera.sources.tables import parse_ts, prediction_frame

QUERIES: dict = {}
ORACLE: dict = {}

W_SQL = "PARTITION BY user_id ORDER BY ts, event_id"
FRAME37 = f"({W_SQL} ROWS BETWEEN 36 PRECEDING AND CURRENT ROW)"


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _blocks(spark, sf):
    pos = T.order_series(S.test_rows(spark, sf), KEYS, ORDER, from_zero=False)
    return T.island_ids(pos, "flag")


def _events(spark, sf):
    return T.event_rollup(_blocks(spark, sf), KEYS, "flag", "ts", "event_id", "value",
                          reference=S.train_reference(spark, sf))


SQL_BLOCKS = f"""
  SELECT *, sum(chg) OVER ({W_SQL} ROWS UNBOUNDED PRECEDING) AS block FROM (
    SELECT *, CASE WHEN lag(flag) OVER ({W_SQL}) IS NULL OR lag(flag) OVER ({W_SQL}) <> flag
                   THEN 1 ELSE 0 END AS chg
    FROM ({SQL_TEST}))"""

SQL_EVENTS = f"""
SELECT user_id, CAST(block AS BIGINT) AS block, min(ts) AS ts_start, max(ts) AS ts_end,
       count(*) AS n_rows, round_even(count(*) * 10 / 60, 2) AS dur_h,
       round_even(max(value), 2) AS value_max, round_even(avg(value), 2) AS value_mean,
       min(event_id) AS id_min, max(event_id) AS id_max,
       coalesce(max(value) > (SELECT ref_max FROM ({SQL_REF})), false) AS exceeds
FROM ({SQL_BLOCKS}) WHERE flag GROUP BY user_id, block"""


@register("e6_event_rollup", SQL_EVENTS)
def e6_event_rollup(spark, sf):
    """E6 (+F4, F5, D3): runs of flagged rows per machine in the test half,
    rolled up with duration, peak, mean, id range and 'above training max'."""
    return _events(spark, sf)


@register("g2_rank_events", SQL_EVENTS + " ORDER BY value_max DESC, ts_start")
def g2_rank_events(spark, sf):
    return T.rank_events(_events(spark, sf))


@register("a2_parse_ts", """
SELECT event_id, CAST(ts_text AS TIMESTAMP) AS ts
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts_text
      FROM events) WHERE ts_text <> 'n/a'
UNION ALL SELECT event_id, NULL FROM events WHERE event_type = 'error'""")
def a2_parse_ts(spark, sf):
    """A2: timestamp text (with unparsable entries) -> timestamp, bad text -> NULL."""
    ev = S.events(spark, sf)
    text = ev.select("event_id", F.when(F.col("event_type") == "error", F.lit("n/a"))
                     .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("ts"))
    return parse_ts(text, "ts")


WINDOW_A = ("2024-01-20 00:00:00", "2024-01-20 06:00:00")


@register("c5_label_windows", f"""
SELECT event_id, CAST(coalesce(ts BETWEEN TIMESTAMP '{WINDOW_A[0]}' AND TIMESTAMP '{WINDOW_A[1]}', false)
                   OR coalesce(ts BETWEEN TIMESTAMP '2024-01-25 12:00:00' AND TIMESTAMP '2024-01-25 18:00:00', false)
                   AS INTEGER) AS label
FROM ({SQL_TEST})""")
def c5_label_windows(spark, sf):
    """Label 1 inside either closed window, else 0, for every test row."""
    t = S.test_rows(spark, sf)
    return C.label_windows(t, "ts", [WINDOW_A, ("2024-01-25 12:00:00", "2024-01-25 18:00:00")]).select("event_id", "label")


@register("c5_window_table", f"""
WITH w AS (SELECT user_id, ts AS s, ts + INTERVAL 6 HOURS AS e FROM events WHERE event_type IN ('error', 'purchase')),
k AS (SELECT DISTINCT t.event_id FROM ({SQL_TEST}) t JOIN w ON w.user_id = t.user_id AND t.ts BETWEEN w.s AND w.e),
a AS (SELECT DISTINCT t.event_id FROM ({SQL_TEST}) t JOIN (SELECT DISTINCT s, e FROM w WHERE user_id % 7 = 0) w ON t.ts BETWEEN w.s AND w.e)
SELECT t.event_id, CAST(k.event_id IS NOT NULL AS INTEGER) AS own_machine, CAST(a.event_id IS NOT NULL AS INTEGER) AS any_machine
FROM ({SQL_TEST}) t LEFT JOIN k USING (event_id) LEFT JOIN a USING (event_id)""")
def c5_window_table(spark, sf):
    """C5 with a table of windows: the six hours after each error or purchase (thousands
    of overlapping windows). A row is labelled by the windows of its own machine, and by
    those of any machine whose number divides by seven."""
    ev = S.events(spark, sf).filter(F.col("event_type").isin("error", "purchase"))
    w = ev.select("user_id", F.col("ts").alias("s"), shift(F.col("ts"), 6 * 3600).alias("e"))
    rows = C.label_by_windows(S.test_rows(spark, sf).select("user_id", "event_id", "ts"), "ts", w, "s", "e", KEYS, "own_machine")
    rows = C.label_by_windows(rows, "ts", w.filter(F.col("user_id") % 7 == 0), "s", "e", (), "any_machine")
    return rows.select("event_id", "own_machine", "any_machine")


@register("a4_prediction_frame", f"""
SELECT CAST(event_id AS BIGINT) AS event_id,
       CAST(coalesce(ts BETWEEN TIMESTAMP '{WINDOW_A[0]}' AND TIMESTAMP '{WINDOW_A[1]}', false) AS INTEGER) AS will_fail
FROM ({SQL_TEST}) ORDER BY event_id""")
def a4_prediction_frame(spark, sf):
    """A4: (id, 0/1 prediction) for every test row, sorted by id."""
    t = C.label_windows(S.test_rows(spark, sf), "ts", [WINDOW_A], out="will_fail")
    return prediction_frame(t, "event_id", "will_fail", "will_fail")


@register("c1_threshold_flag", """
SELECT event_id, CAST(coalesce(value > 40.0, false) AND coalesce(event_type = 'error', false) AS INTEGER) AS running_fail,
       CAST(coalesce(value < 1.0, false) AS INTEGER) AS frozen
FROM events""")
def c1_threshold_flag(spark, sf):
    """Multi-column threshold predicates as 0/1 flags (missing -> 0)."""
    ev = S.events(spark, sf)
    running = C.all_of({"value": (">", 40.0), "event_type": ("==", "error")})
    return ev.select("event_id", running.cast("int").alias("running_fail"),
                     C.all_of({"value": ("<", 1.0)}).cast("int").alias("frozen"))


@register("c2_time_range", """
SELECT count(*) AS n_rows, min(event_id) AS id_min, max(event_id) AS id_max
FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'""")
def c2_time_range(spark, sf):
    """Closed time range with date-only text bounds (midnight)."""
    ev = S.events(spark, sf).filter(C.in_time_range("ts", "2024-01-10", "2024-01-12"))
    return ev.agg(F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("id_min"),
                  F.max("event_id").alias("id_max"))


@register("c3_above_reference_max", f"""
SELECT event_id, user_id, ts, value FROM ({SQL_TEST})
WHERE value > (SELECT ref_max FROM ({SQL_REF}))""")
def c3_above_reference_max(spark, sf):
    """Test rows above the training population's maximum."""
    return C.above_reference_max(S.test_rows(spark, sf), S.train_rows(spark, sf), "value") \
        .select("event_id", "user_id", "ts", "value")


@register("c6_all_rows", f"""
SELECT user_id, bool_and(coalesce(value > 0.5, false)) AS all_true FROM ({SQL_TEST}) WHERE flag GROUP BY user_id""")
def c6_all_rows(spark, sf):
    """Per machine, does every flagged test row have value > 0.5."""
    t = S.test_rows(spark, sf).filter("flag")
    return t.groupBy("user_id").agg(F.every(F.coalesce(F.col("value") > 0.5, F.lit(False))).alias("all_true"))


@register("d3_broadcast_scalar", f"""
SELECT event_id, round_even(value - tr.mu, 9) AS centered, round_even((value - tr.mu) / tr.sd, 9) AS z,
       value > tr.mx AS above_train_max
FROM ({SQL_TEST}) t, (SELECT avg(value) AS mu, stddev_samp(value) AS sd, max(value) AS mx FROM ({SQL_TRAIN})) tr""")
def d3_broadcast_scalar(spark, sf):
    """D3: training mean/std/max broadcast to every test row."""
    stats = S.train_rows(spark, sf).agg(F.avg("value").alias("mu"), F.stddev_samp("value").alias("sd"),
                                        F.max("value").alias("mx"))
    j = D.with_scalars(S.test_rows(spark, sf), stats)
    return j.select("event_id", r9(F.col("value") - F.col("mu")).alias("centered"),
                    r9((F.col("value") - F.col("mu")) / F.col("sd")).alias("z"),
                    (F.col("value") > F.col("mx")).alias("above_train_max"))


@register("d4_id_overlap", f"""
SELECT count(*) AS n_overlap, min(event_id) AS id_min, max(event_id) AS id_max FROM (
  SELECT event_id FROM ({SQL_TEST}) WHERE flag
  INTERSECT SELECT event_id FROM events WHERE value > 40.0)""")
def d4_id_overlap(spark, sf):
    """Overlap of two id sets (flagged test rows vs. rows above 40)."""
    a = S.test_rows(spark, sf).filter("flag")
    b = S.events(spark, sf).filter(F.col("value") > 40.0)
    return D.id_overlap(a, b, "event_id")


@register("e2_column_stats", f"""
SELECT round_even(avg(value), 9) AS mean, round_even(stddev_samp(value), 9) AS std, max(value) AS max,
       min(value) AS min, round_even(sum(value), 9) AS sum FROM ({SQL_TRAIN})""")
def e2_column_stats(spark, sf):
    """Global mean / sample std / max / min / sum of the training column."""
    t = S.train_rows(spark, sf)
    return t.agg(r9(F.avg("value")).alias("mean"), r9(F.stddev_samp("value")).alias("std"),
                 F.max("value").alias("max"), F.min("value").alias("min"),
                 r9(F.sum("value")).alias("sum"))


@register("f1_rolling_max", f"SELECT event_id, max(value) OVER {FRAME37} AS roll_max FROM ({SQL_TEST})")
def f1_rolling_max(spark, sf):
    """trailing 37-row max per machine."""
    pos = T.order_series(S.test_rows(spark, sf), KEYS, ORDER, from_zero=False)
    return T.rolling_stats(pos, {"roll_max": ("max", "value")}).select("event_id", "roll_max")


@register("f2_rolling_mean", f"SELECT event_id, round_even(avg(value) OVER {FRAME37}, 9) AS roll_mean FROM ({SQL_TEST})")
def f2_rolling_mean(spark, sf):
    """trailing 37-row mean per machine."""
    pos = T.order_series(S.test_rows(spark, sf), KEYS, ORDER, from_zero=False)
    r = T.rolling_stats(pos, {"roll_mean": ("mean", "value")})
    return r.select("event_id", r9("roll_mean").alias("roll_mean"))


@register("f3_rolling_flag_sum",
          f"SELECT event_id, CAST(sum(CAST(flag AS INTEGER)) OVER {FRAME37} AS BIGINT) AS roll_flag FROM ({SQL_TEST})")
def f3_rolling_flag_sum(spark, sf):
    """trailing 37-row count of flagged rows per machine."""
    pos = T.order_series(S.test_rows(spark, sf), KEYS, ORDER, from_zero=False)
    r = T.rolling_stats(pos, {"roll_flag": ("sum", F.col("flag").cast("long"))})
    return r.select("event_id", "roll_flag")


FRAME6H = "(PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW)"


@register("f1_f3_time_frames", f"""
SELECT event_id, max(value) OVER {FRAME37} AS max_rows, max(value) OVER {FRAME6H} AS max_6h,
       round_even(avg(value) OVER {FRAME37}, 9) AS mean_rows, round_even(avg(value) OVER {FRAME6H}, 9) AS mean_6h,
       CAST(sum(CAST(flag AS INTEGER)) OVER {FRAME37} AS BIGINT) AS flags_rows,
       CAST(sum(CAST(flag AS INTEGER)) OVER {FRAME6H} AS BIGINT) AS flags_6h FROM ({SQL_TEST})""")
def f1_f3_time_frames(spark, sf):
    """F1-F3 by both kinds of frame: the last 37 rows and the last 6 hours of a machine
    (they differ where the cadence has gaps)."""
    pos = T.order_series(S.test_rows(spark, sf), KEYS, ORDER, from_zero=False)
    by = lambda tail: {f"max_{tail}": ("max", "value"), f"mean_{tail}": ("mean", "value"),
                       f"flags_{tail}": ("sum", F.col("flag").cast("long"))}
    both = T.rolling_stats(T.rolling_stats_over_time(pos, "ts", by("6h"), hours=6.0), by("rows"))
    return both.select("event_id", "max_rows", "max_6h", r9("mean_rows").alias("mean_rows"), r9("mean_6h").alias("mean_6h"),
                       "flags_rows", "flags_6h")


@register("f4_change_points", f"""
SELECT event_id, coalesce(flag <> lag(flag) OVER ({W_SQL}), true) AS change FROM ({SQL_TEST})""")
def f4_change_points(spark, sf):
    """flag differs from the previous row (first row is a change)."""
    pos = T.order_series(S.test_rows(spark, sf), KEYS, ORDER, from_zero=False)
    return T.change_points(pos, "flag").select("event_id", "change")


@register("f5_island_ids", f"SELECT event_id, CAST(block AS BIGINT) AS block FROM ({SQL_BLOCKS}) WHERE flag")
def f5_island_ids(spark, sf):
    """island id (running count of change points) of each flagged row."""
    return _blocks(spark, sf).filter("flag").select("event_id", "block")


def _sessions_sql():
    rows = S.SQL_ROWS
    return f"""
WITH f AS (SELECT user_id, ts, event_id FROM ({rows}) WHERE flag),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > 86400000000 THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session
      FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM f)),
b AS (SELECT user_id, session, min(ts) AS start, max(ts) AS "end" FROM s GROUP BY user_id, session)
SELECT b.user_id, CAST(b.session AS BIGINT) AS session, b.start, b."end", count(*) AS n_rows,
       max(r.value) AS value_max, round_even(avg(r.value), 9) AS value_mean,
       min(r.event_id) AS id_min, max(r.event_id) AS id_max
FROM b JOIN ({rows}) r ON r.user_id = b.user_id AND r.ts BETWEEN b.start AND b."end"
GROUP BY b.user_id, b.session, b.start, b."end" HAVING count(*) >= 6
ORDER BY value_max DESC, b.start"""


@register("f6_gap_sessions", _sessions_sql())
def f6_gap_sessions(spark, sf):
    """F6 (+D2): sessions of flagged rows split on gaps over 24 h, then every row
    of the machine inside each session span, kept when >= 6 rows."""
    rows = S.sensor_rows(spark, sf)
    out = T.gap_sessions(rows, KEYS, "flag", "ts", "event_id", gap_seconds=86400,
                         value="value", id_col="event_id", min_rows=6)
    return out.withColumn("value_mean", r9("value_mean"))


def _scored(spark, sf):
    pos = T.order_series(S.test_rows(spark, sf), KEYS, ORDER)
    return T.anomaly_score(pos, "value", "flag", S.train_reference(spark, sf))


SQL_SCORED = f"""
SELECT *, greatest(roll_max - (SELECT ref_max FROM ({SQL_REF})), 0) AS anomaly,
       greatest(roll_max - (SELECT ref_max FROM ({SQL_REF})), 0) * (roll_flag / 37.0::DOUBLE + 0.01::DOUBLE) AS score
FROM (SELECT *, max(value) OVER {FRAME37} AS roll_max,
             sum(CAST(flag AS INTEGER)) OVER {FRAME37} AS roll_flag FROM ({SQL_TEST}))"""


@register("f7_anomaly_score", f"SELECT event_id, round_even(anomaly, 9) AS anomaly, round_even(score, 9) AS score FROM ({SQL_SCORED})")
def f7_anomaly_score(spark, sf):
    """anomaly = clip(rolling max - training max, 0); score weights it by the
    rolling share of flagged rows (+0.01)."""
    s = _scored(spark, sf)
    return s.select("event_id", r9("anomaly").alias("anomaly"), r9("score").alias("score"))


@register("f8_best_window", f"""
WITH r AS (SELECT user_id, ts, event_id, value,
                  row_number() OVER ({W_SQL}) - 1 AS pos,
                  round_even(sum(score) OVER {FRAME37}, 9) AS window_score,
                  min(ts) OVER {FRAME37} AS win_start, min(event_id) OVER {FRAME37} AS id_min,
                  max(event_id) OVER {FRAME37} AS id_max, min(value) OVER {FRAME37} AS value_min,
                  avg(value) OVER {FRAME37} AS value_mean, max(value) OVER {FRAME37} AS value_max
           FROM ({SQL_SCORED})),
k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY window_score DESC, pos) AS rk FROM r WHERE pos >= 36)
SELECT user_id, win_start, ts AS win_end, window_score, id_min, id_max, value_min,
       round_even(value_mean, 9) AS value_mean, value_max FROM k WHERE rk = 1""")
def f8_best_window(spark, sf):
    """F8: per machine the full 37-row window with the highest summed score
    (sums compared at 9 decimals), earliest on ties."""
    s = _scored(spark, sf).withColumn("score", F.col("score"))
    b = T.best_window(s, KEYS, "score", "ts", "event_id", "value", width=37, digits=9)
    return b.withColumn("value_mean", r9("value_mean"))


@register("g3_top_k", f"""
SELECT event_id, ts, round_even(score, 9) AS score FROM ({SQL_SCORED}) WHERE score IS NOT NULL
ORDER BY score DESC, ts, event_id LIMIT 37""")
def g3_top_k(spark, sf):
    """The 37 test rows with the highest anomaly score, earliest on ties."""
    top = T.top_k_rows(_scored(spark, sf), 37, "score", ["ts", "event_id"])
    return top.select("event_id", "ts", r9("score").alias("score"))


@register("e11_peak_row", f"""
SELECT user_id, ts AS peak_ts, value AS peak_value, event_id AS peak_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, ts, event_id) AS rk
  FROM ({SQL_TEST})) WHERE rk = 1""")
def e11_peak_row(spark, sf):
    """Per machine the row with the peak value, first on ties."""
    return T.peak_row(S.test_rows(spark, sf), KEYS, "value", "ts", "event_id")


def _sql_windows():
    return f"""
SELECT user_id, ts_end AS event_end, 'A' AS label, ts_end - INTERVAL 350 MINUTE AS win_start, ts_end AS win_end FROM ({SQL_EVENTS})
UNION ALL
SELECT user_id, ts_end, 'B', ts_end - INTERVAL 360 MINUTE, ts_end - INTERVAL 10 MINUTE FROM ({SQL_EVENTS})"""


@register("f9_trailing_windows", f"""
SELECT w.user_id, w.event_end, w.label, w.win_start, w.win_end, count(t.event_id) AS n_rows,
       min(t.event_id) AS id_min, max(t.event_id) AS id_max
FROM ({_sql_windows()}) w LEFT JOIN ({SQL_TEST}) t
  ON t.user_id = w.user_id AND t.ts BETWEEN w.win_start AND w.win_end
GROUP BY w.user_id, w.event_end, w.label, w.win_start, w.win_end""")
def f9_trailing_windows(spark, sf):
    """F9 (+D2, E7): the 6-hour windows ending at (A) and 10 minutes before (B)
    each event end, with the count and id range of test rows inside."""
    wins = T.trailing_windows(_events(spark, sf), "ts_end", keys=KEYS)
    cols = ["user_id", "event_end", "label", "win_start", "win_end"]
    s = T.window_summary(S.test_rows(spark, sf), wins, "ts", "event_id", "value", cols, keys=KEYS)
    return s.select(*cols, "n_rows", "id_min", "id_max")


@register("e7_window_summary", f"""
SELECT w.user_id, w.event_end, w.label, count(t.event_id) AS n_rows, min(t.value) AS value_min,
       round_even(avg(t.value), 9) AS value_mean, max(t.value) AS value_max,
       min(t.event_id) AS id_min, max(t.event_id) AS id_max
FROM ({_sql_windows()}) w LEFT JOIN ({SQL_TEST}) t
  ON t.user_id = w.user_id AND t.ts BETWEEN w.win_start AND w.win_end
GROUP BY w.user_id, w.event_end, w.label""")
def e7_window_summary(spark, sf):
    """Per window n, min/mean/max and id range; empty windows give n = 0."""
    wins = T.trailing_windows(_events(spark, sf), "ts_end", keys=KEYS)
    cols = ["user_id", "event_end", "label"]
    s = T.window_summary(S.test_rows(spark, sf), wins, "ts", "event_id", "value", cols, keys=KEYS)
    return s.select(*cols, "n_rows", "value_min", r9("value_mean").alias("value_mean"),
                    "value_max", "id_min", "id_max")


@register("d2_range_join", f"""
SELECT w.user_id, w.event_end, w.label, t.event_id
FROM ({_sql_windows()}) w JOIN ({SQL_TEST}) t
  ON t.user_id = w.user_id AND t.ts BETWEEN w.win_start AND w.win_end""")
def d2_range_join(spark, sf):
    """(window, row) pairs for rows inside each trailing window, via the
    bucketed equi-join plan."""
    wins = T.trailing_windows(_events(spark, sf), "ts_end", keys=KEYS)
    rows = S.test_rows(spark, sf).select("user_id", "ts", "event_id")
    j = D.range_join(rows, wins, "ts", "win_start", "win_end", keys=KEYS)
    return j.select("user_id", "event_end", "label", "event_id")


@register("g4_top_event_detail", f"""
WITH top AS (SELECT user_id, ts_start, ts_end FROM ({SQL_EVENTS}) ORDER BY value_max DESC, ts_start, user_id LIMIT 1)
SELECT t.event_id, t.ts, t.value, t.flag FROM ({SQL_TEST}) t, top
WHERE t.user_id = top.user_id AND t.ts BETWEEN top.ts_start AND top.ts_end""")
def g4_top_event_detail(spark, sf):
    """The rows of the top-ranked event."""
    ranked = _events(spark, sf).orderBy(F.col("value_max").desc_nulls_last(), "ts_start", "user_id")
    d = T.top_event_detail(ranked, S.test_rows(spark, sf), "ts", keys=KEYS)
    return d.select("event_id", "ts", "value", "flag")


@register("g1_sort_by_time", f"SELECT event_id, user_id, ts FROM ({SQL_TEST}) ORDER BY ts, event_id")
def g1_sort_by_time(spark, sf):
    """G1: rows sorted by timestamp (range-partitioned global sort)."""
    return S.test_rows(spark, sf).select("event_id", "user_id", "ts").orderBy("ts", "event_id")
