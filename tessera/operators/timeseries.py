"""Ordered-series operators (F1-F9, E6, E7, E11, G2-G4) on the skew-safe plan
of :mod:`tessera.plans.ordered`. A series is the rows of one key (one machine);
``keys=()`` is a single keyless series. ``order`` columns must make the row order
unique inside a key (timestamp, then id)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.nulls import clip_lower, round_half_even
from tessera.functions.time import epoch_us, shift
from tessera.operators.joins import range_join, with_scalars
from tessera.plans import ordered as O

_AGG = {"max": F.max, "min": F.min, "mean": F.avg, "sum": F.sum}


def order_series(df: DataFrame, keys: Sequence[str], order: Sequence[str], from_zero: bool = True) -> DataFrame:
    """Attach the series key and exact row position (``_sk``, ``_pos``); without ``from_zero``
    the positions of one series do not start at 0, which all but F8 can do with."""
    return O.with_position(df, keys, order, from_zero)


def rolling_stats(positioned: DataFrame, specs: Mapping[str, tuple[str, str | Column]],
                  width: int = 37, chunk_rows: int = O.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Trailing ``width``-row max / mean / sum (partial frames allowed).
    ``specs`` maps output name -> (``max``|``min``|``mean``|``sum``, column)."""
    aggs = {name: _AGG[fn](F.col(c) if isinstance(c, str) else c) for name, (fn, c) in specs.items()}
    return O.rolling(positioned, width, aggs, chunk_rows)


def rolling_stats_over_time(positioned: DataFrame, ts: str, specs: Mapping[str, tuple[str, str | Column]],
                            hours: float = 6.0, chunk_rows: int = O.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """F1-F3 by time: trailing max / mean / sum over the rows of the last ``hours`` (closed
    range), whatever their number. Equals :func:`rolling_stats` only where the cadence
    has no gap."""
    aggs = {name: _AGG[fn](F.col(c) if isinstance(c, str) else c) for name, (fn, c) in specs.items()}
    return O.rolling_time(positioned, ts, int(hours * 3600), aggs, chunk_rows)


def change_points(positioned: DataFrame, flag: str, out: str = "change",
                  chunk_rows: int = O.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """the flag differs from the previous row's; the first row is a change."""
    d = O.lag(positioned, {"_prev_flag": flag}, 1, chunk_rows)
    return d.withColumn(out, F.coalesce(F.col(flag) != F.col("_prev_flag"), F.lit(True))).drop("_prev_flag")


def island_ids(positioned: DataFrame, flag: str, out: str = "block",
               chunk_rows: int = O.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """block id = running count of change points (runs of equal flags)."""
    return O.running_changes(positioned, flag, out, chunk_rows)


def event_rollup(blocks: DataFrame, keys: Sequence[str], flag: str, ts: str, id_col: str,
                 value: str, means: Sequence[str] = (), reference: DataFrame | None = None,
                 cadence_minutes: float = 10.0, digits: int = 2) -> DataFrame:
    """One row per run of flagged rows: start, end, n, duration in hours
    (``n * cadence / 60``), peak and mean of ``value``, means of ``means``, id
    range and ``exceeds`` (peak above ``reference.ref_max``, unrounded)."""
    aggs = [F.min(ts).alias("ts_start"), F.max(ts).alias("ts_end"),
            F.count(F.lit(1)).alias("n_rows"), F.max(value).alias("_peak"),
            F.avg(value).alias("_mean"), F.min(id_col).alias("id_min"), F.max(id_col).alias("id_max")]
    aggs += [F.avg(m).alias(f"_m_{m}") for m in means]
    ev = blocks.filter(F.col(flag)).groupBy(*keys, "block").agg(*aggs)
    if reference is not None:
        ev = with_scalars(ev, reference).withColumn(
            "exceeds", F.coalesce(F.col("_peak") > F.col("ref_max"), F.lit(False))).drop("ref_max")
    cols = [*keys, "block", "ts_start", "ts_end", "n_rows",
            round_half_even(F.col("n_rows") * F.lit(cadence_minutes) / F.lit(60.0), digits).alias("dur_h"),
            round_half_even(F.col("_peak"), digits).alias("value_max"),
            round_half_even(F.col("_mean"), digits).alias("value_mean"),
            *[round_half_even(F.col(f"_m_{m}"), digits).alias(f"{m}_mean") for m in means],
            "id_min", "id_max"]
    if reference is not None:
        cols.append("exceeds")
    return ev.select(*cols)


def rank_events(events: DataFrame, by: str = "value_max", tiebreak: str = "ts_start") -> DataFrame:
    """Events by severity, highest first, earlier start first on ties."""
    return events.orderBy(F.col(by).desc_nulls_last(), F.col(tiebreak).asc())


def gap_sessions(df: DataFrame, keys: Sequence[str], flag: str, ts: str, tiebreak: str,
                 gap_seconds: int, value: str, id_col: str, min_rows: int = 6,
                 means: Sequence[str] = (), reference: DataFrame | None = None,
                 bucket_seconds: int = 86400, chunk_rows: int = O.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """sessions of flagged rows (a new one starts when the gap to the previous
    flagged row is strictly more than ``gap_seconds``); then every row of the key
    inside ``[start, end]`` (flagged or not) is summarised and sessions with at
    least ``min_rows`` rows are kept, highest peak first."""
    flagged = df.filter(F.coalesce(F.col(flag), F.lit(False))).select(*keys, ts, tiebreak)
    pos = O.with_position(flagged, keys, [ts, tiebreak], from_zero=False)
    lagged = O.lag(pos, {"_prev_ts": ts}, 1, chunk_rows)
    new = F.col("_prev_ts").isNull() | (
        (epoch_us(F.col(ts)) - epoch_us(F.col("_prev_ts"))) > F.lit(gap_seconds * 1_000_000))
    sess = O.running_sum(lagged, new.cast("long"), "session", chunk_rows)
    bounds = sess.groupBy(*keys, "session").agg(F.min(ts).alias("start"), F.max(ts).alias("end"))
    rows = df.select(*keys, ts, id_col, value, *means)
    inside = range_join(rows, bounds, ts, "start", "end", keys=keys, bucket_seconds=bucket_seconds)
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.max(value).alias("_peak"), F.avg(value).alias("_mean"),
            F.min(id_col).alias("id_min"), F.max(id_col).alias("id_max")]
    aggs += [F.avg(m).alias(f"{m}_mean") for m in means]
    out = inside.groupBy(*keys, "session", "start", "end").agg(*aggs).filter(F.col("n_rows") >= min_rows)
    if reference is not None:
        out = with_scalars(out, reference).withColumn(
            "exceeds", F.coalesce(F.col("_peak") > F.col("ref_max"), F.lit(False))).drop("ref_max")
    return (out.withColumnRenamed("_peak", "value_max").withColumnRenamed("_mean", "value_mean")
            .orderBy(F.col("value_max").desc_nulls_last(), F.col("start")))


def anomaly_score(positioned: DataFrame, value: str, flag: str, reference: DataFrame,
                  width: int = 37, floor: float = 0.01,
                  chunk_rows: int = O.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``clip(rolling_max - ref_max, 0) * (rolling_flag_sum / width + floor)``;
    divides by ``width`` even in the partial frames at a series start."""
    rolled = rolling_stats(positioned, {"roll_max": ("max", value), "roll_mean": ("mean", value),
                                        "roll_flag": ("sum", F.col(flag).cast("int"))}, width, chunk_rows)
    scored = with_scalars(rolled, reference)
    anomaly = clip_lower(F.col("roll_max") - F.col("ref_max"), 0.0)
    return (scored.withColumn("anomaly", anomaly)
            .withColumn("score", F.col("anomaly") * (F.col("roll_flag") / F.lit(float(width)) + F.lit(floor)))
            .drop("ref_max"))


def best_window(positioned: DataFrame, keys: Sequence[str], score: str, ts: str, id_col: str,
                value: str, width: int = 37, digits: int | None = 9,
                chunk_rows: int = O.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """F8: the full ``width``-row window with the highest score sum per series,
    the earliest on ties; with its time span, id range and value stats. Sums are
    compared at ``digits`` decimals so float summation order cannot break ties."""
    rolled = O.rolling(positioned, width, {
        "_wsum": F.sum(score), "win_start": F.min(ts), "id_min": F.min(id_col),
        "id_max": F.max(id_col), "value_min": F.min(value), "value_mean": F.avg(value),
        "value_max": F.max(value)}, chunk_rows)
    wscore = round_half_even(F.col("_wsum"), digits) if digits is not None else F.col("_wsum")
    full = rolled.filter(F.col(O.POS) >= F.lit(width - 1)).withColumn("window_score", wscore)
    best = F.min(F.struct(F.col("window_score").isNull().alias("_null"),
                          (-F.col("window_score")).alias("_neg"), F.col(O.POS).alias("_p"),
                          F.col("win_start"), F.col(ts).alias("win_end"), "window_score", "id_min",
                          "id_max", "value_min", "value_mean", "value_max")).alias("_b")
    g = full.groupBy(*keys).agg(best)
    return g.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in (
        "win_start", "win_end", "window_score", "id_min", "id_max", "value_min", "value_mean", "value_max")])


def peak_row(df: DataFrame, keys: Sequence[str], value: str, ts: str, id_col: str) -> DataFrame:
    """Per key the row with the largest ``value``; earliest (ts, id) on ties.
    A partial aggregate (min of a struct), so a hot key is combined map-side."""
    best = F.min(F.struct(F.col(value).isNull().alias("_null"), (-F.col(value)).alias("_neg"),
                          F.col(ts).alias("peak_ts"), F.col(id_col).alias("peak_id"),
                          F.col(value).alias("peak_value"))).alias("_b")
    g = df.groupBy(*keys).agg(best)
    return g.select(*keys, "_b.peak_ts", "_b.peak_value", "_b.peak_id")


def top_k_rows(df: DataFrame, k: int, score: str, order: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest score, earliest first on ties; missing
    scores are never picked. Plans as a distributed ``TakeOrderedAndProject``."""
    return (df.filter(F.col(score).isNotNull())
            .orderBy(F.col(score).desc(), *[F.col(c).asc() for c in order]).limit(k))


def trailing_windows(events: DataFrame, end: str, hours: float = 6.0, step_minutes: int = 10,
                     keys: Sequence[str] = ()) -> DataFrame:
    """two windows ending at each event end: ``A = [end-6h+10min, end]`` and
    ``B = [end-6h, end-10min]`` (long form: ``label, win_start, win_end``)."""
    span, step = int(hours * 3600), step_minutes * 60
    a = events.select(*keys, F.col(end).alias("event_end"), F.lit("A").alias("label"),
                      shift(F.col(end), -span + step).alias("win_start"), F.col(end).alias("win_end"))
    b = events.select(*keys, F.col(end).alias("event_end"), F.lit("B").alias("label"),
                      shift(F.col(end), -span).alias("win_start"), shift(F.col(end), -step).alias("win_end"))
    return a.unionByName(b)


def window_summary(rows: DataFrame, windows: DataFrame, ts: str, id_col: str, value: str,
                   window_cols: Sequence[str], keys: Sequence[str] = (), start: str = "win_start",
                   end: str = "win_end", bucket_seconds: int = 3600) -> DataFrame:
    """E7 (with D2): per window the row count, min/mean/max of ``value`` and the id
    range of the rows inside; an empty window gives ``n_rows = 0`` and NULLs. Equal
    windows are one. Rows are summarised by (keys, time bucket) first; a window takes
    the summaries of the buckets wholly inside it, and only the rows of its two edge
    buckets one by one, so overlapping windows do not multiply the rows."""
    wc = [*keys, *[c for c in (*window_cols, start, end) if c not in keys]]
    windows = windows.select(*dict.fromkeys(wc)).distinct()
    width = F.lit(bucket_seconds * 1_000_000)
    bucket = lambda c: F.floor(epoch_us(F.col(c)) / width).cast("long")
    r = rows.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(ts).alias("_ts"), F.col(id_col).alias("_id"),
                    F.col(value).alias("_v")).filter(F.col("_ts").isNotNull()).withColumn("_rb", bucket("_ts"))
    per = {"_n": F.count("_id"), "_lo": F.min("_v"), "_sum": F.sum("_v"), "_c": F.count("_v"), "_hi": F.max("_v"),
           "_i0": F.min("_id"), "_i1": F.max("_id")}
    whole = r.groupBy(*[f"_k_{k}" for k in keys], "_rb").agg(*[e.alias(n) for n, e in per.items()])
    w = windows.withColumn("_first", bucket(start)).withColumn("_last", bucket(end)).filter(F.col(start) <= F.col(end))
    inner = w.filter(F.col("_last") - F.col("_first") > 1).withColumn(
        "_b", F.explode(F.sequence(F.col("_first") + 1, F.col("_last") - 1)))
    edges = w.withColumn("_b", F.explode(F.array_distinct(F.array("_first", "_last"))))

    def same(extra=F.lit(True)):
        cond = (F.col("_b") == F.col("_rb")) & extra
        for k in keys:
            cond = cond & F.col(f"_k_{k}").eqNullSafe(F.col(k))
        return cond

    names = list(dict.fromkeys(wc))
    from_whole = whole.join(inner, same()).select(*names, *per)
    exact = (F.col("_ts") >= F.col(start)) & (F.col("_ts") <= F.col(end))
    from_edges = r.join(edges, same(exact)).groupBy(*names).agg(*[e.alias(n) for n, e in per.items()])
    found = from_whole.unionByName(from_edges).groupBy(*window_cols).agg(
        F.sum("_n").alias("n_rows"), F.min("_lo").alias("value_min"),
        F.try_divide(F.sum("_sum"), F.sum("_c")).alias("value_mean"), F.max("_hi").alias("value_max"),
        F.min("_i0").alias("id_min"), F.max("_i1").alias("id_max"))
    keep = windows.select(*window_cols).distinct()
    out = keep.join(found.select(*[F.col(c).alias(f"_w_{c}") for c in window_cols], "n_rows", "value_min", "value_mean",
                                 "value_max", "id_min", "id_max"),
                    reduce(and_, [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in window_cols]), "left")
    return out.select(*window_cols, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "value_min", "value_mean", "value_max",
                      "id_min", "id_max")


def top_event_detail(ranked_events: DataFrame, rows: DataFrame, ts: str,
                     keys: Sequence[str] = (), start: str = "ts_start", end: str = "ts_end") -> DataFrame:
    """The rows inside the top-ranked event (the event list is cut to one row
    first, so broadcasting it is bounded)."""
    top = ranked_events.limit(1).select(*keys, F.col(start).alias("_ev_start"), F.col(end).alias("_ev_end"))
    return range_join(rows, top, ts, "_ev_start", "_ev_end", keys=keys, windows_are_small=True)
