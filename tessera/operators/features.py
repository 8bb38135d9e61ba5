"""Feature programs (B1-B19, D1 lookups) applied the same way to every frame
(``df.transform(fn)``). All columns are built-in expressions inside one
projection, so each program is a single whole-stage-codegen step."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.functions.nulls import clip, clip_lower, fill_text, flag, safe_div

# Fixed names of the margin-regression inputs: (output, home column, away column).
MARGIN_DIFFS = [
    ("margin_roll5_diff", "home_margin_roll5", "away_margin_roll5"),
    ("margin_roll20_diff", "home_margin_roll20", "away_margin_roll20"),
    ("home_net_roll5", "home_pts_roll5", "home_opp_pts_roll5"),
    ("away_net_roll5", "away_pts_roll5", "away_opp_pts_roll5"),
    ("net_roll5_diff", "home_net_roll5", "away_net_roll5"),
    ("home_net_roll10", "home_pts_roll10", "home_opp_pts_roll10"),
    ("away_net_roll10", "away_pts_roll10", "away_opp_pts_roll10"),
    ("net_roll10_diff", "home_net_roll10", "away_net_roll10"),
    ("home_net_roll20", "home_pts_roll20", "home_opp_pts_roll20"),
    ("away_net_roll20", "away_pts_roll20", "away_opp_pts_roll20"),
    ("net_roll20_diff", "home_net_roll20", "away_net_roll20"),
    ("win_roll5_diff", "home_win_roll5", "away_win_roll5"),
    ("win_roll10_diff", "home_win_roll10", "away_win_roll10"),
    ("elo_delta_diff", "home_elo_delta_prev1", "away_elo_delta_prev1"),
    ("elo_delta_roll5_diff", "home_elo_delta_roll5", "away_elo_delta_roll5"),
]
MISSING_FLAGS = ["home_roll_missing_10", "away_roll_missing_10", "home_roll_missing_20", "away_roll_missing_20"]


def fill_missing_text(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """B1: missing text -> ''."""
    cols = set(cols)
    return df.select([fill_text(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def difference_features(df: DataFrame, diffs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``out = a - b`` in order, so later differences may use earlier outputs
    (difference of differences); all in one projection."""
    exprs: dict[str, Column] = {}
    for out, a, b in diffs:
        ca = exprs.get(a, F.col(a))
        cb = exprs.get(b, F.col(b))
        exprs[out] = ca - cb
    return df.select("*", *[e.alias(n) for n, e in exprs.items()])


def margin_features(df: DataFrame, modern_from: int = 1980) -> DataFrame:
    """B2-B5 for the margin model: polynomial Elo terms, the 15 paired
    differences, OR of the missing-window flags, modern-era flag."""
    sq, cb = S.powers("elo_diff", 3)
    out = df.select("*", sq.alias("elo_diff_sq"), cb.alias("elo_diff_cb"))
    out = difference_features(out, MARGIN_DIFFS)
    return out.select("*", S.any_flag(*MISSING_FLAGS).alias("any_roll_missing"),
                      S.above("season", modern_from, inclusive=True).alias("is_modern"))


def session_features(df: DataFrame) -> DataFrame:
    """The browsing-session feature program (month, page value regime,
    duration ratios, zero-duration anomalies, totals, interactions, visitor code).
    NaN inputs should be normalised to NULL first (:func:`normalize_missing`)."""
    month = S.month_number("month")
    m_sin, m_cos = S.cyclic(month)
    pv = F.col("page_values")
    pv_log = F.log1p(pv)
    holiday = S.in_set(month, [11, 12])
    visitor = S.lookup(F.col("visitor_type"), S.VISITOR_CODES, 2).cast("int")
    total_pages = F.col("administrative") + F.col("informational") + F.col("product_related")
    total_dur = (F.col("administrative_duration") + F.col("informational_duration")
                 + F.col("product_related_duration"))

    def zero_dur(count: str, dur: str) -> Column:
        return flag((F.col(count) > 0) & (F.col(dur) == 0))

    cols = {
        "month_num": month,
        "is_holiday_season": holiday,
        "is_data_scarce_month": S.in_set(month, [0, 1, 4]),
        "month_sin": m_sin,
        "month_cos": m_cos,
        "pv_nonzero": S.above(pv, 0.0),
        "pv_log1p": pv_log,
        "pv_sqrt": F.sqrt(pv),
        "pv_bucket": S.right_closed_bucket(pv),
        "admin_dur_per_page": safe_div("administrative_duration", "administrative"),
        "info_dur_per_page": safe_div("informational_duration", "informational"),
        "product_dur_per_page": safe_div("product_related_duration", "product_related"),
        "admin_zero_dur": zero_dur("administrative", "administrative_duration"),
        "info_zero_dur": zero_dur("informational", "informational_duration"),
        "product_zero_dur": zero_dur("product_related", "product_related_duration"),
        "total_pages": total_pages,
        "total_duration": total_dur,
        "avg_page_dur": safe_div(total_dur, total_pages),
        "bounce_x_exit": F.col("bounce_rates") * F.col("exit_rates"),
        "exit_minus_bounce": F.col("exit_rates") - F.col("bounce_rates"),
        "pv_x_products": pv_log * F.log1p(F.col("product_related")),
        "pv_x_stay": pv_log * (F.lit(1.0) - F.col("exit_rates")),
        "visitor_enc": visitor,
        "is_returning": flag(visitor == 0),
        "is_new": flag(visitor == 1),
        "weekend_holiday": F.col("weekend").cast("int") * holiday,
        "is_special_day": S.above("special_day", 0.0),
        "product_pg_ratio": safe_div("product_related", total_pages),
        "admin_pg_ratio": safe_div("administrative", total_pages),
        "administrative_duration_log": F.log1p("administrative_duration"),
        "informational_duration_log": F.log1p("informational_duration"),
        "product_related_duration_log": F.log1p("product_related_duration"),
    }
    out = df.select("*", *[c.alias(n) for n, c in cols.items()])
    return out.withColumn("any_zero_dur", S.any_flag("admin_zero_dur", "info_zero_dur", "product_zero_dur"))


def select_features(df: DataFrame, exclude: Iterable[str] = (), include: Sequence[str] | None = None) -> DataFrame:
    """Keep a named list, or every column except ``exclude``."""
    if include is not None:
        return df.select(*include)
    ex = set(exclude)
    return df.select([c for c in df.columns if c not in ex])


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features",
             weights: Mapping[str, float] | None = None, handle_invalid: str = "keep") -> DataFrame:
    """B18 (+H9): one vector column from numeric columns; ``weights`` scales a
    block before stacking. Missing values are kept as NaN (``handleInvalid='keep'``).
    The vector carries no names of its slots: for wide blocks these are megabytes that
    would travel with every task."""
    w = weights or {}
    scaled = [f"_w_{c}" if c in w else c for c in cols]
    d = df.select("*", *[(F.col(c) * F.lit(float(k))).alias(f"_w_{c}") for c, k in w.items()])
    va = VectorAssembler(inputCols=scaled, outputCol=out, handleInvalid=handle_invalid)
    return va.transform(d).withColumn(out, F.col(out).alias(out, metadata={})).drop(*[f"_w_{c}" for c in w])


def clip_probability(x: str | Column, eps: float = 1e-6) -> Column:
    """Clip to ``[eps, 1-eps]`` (missing stays missing)."""
    return clip(F.col(x) if isinstance(x, str) else x, eps, 1.0 - eps)


__all__ = ["fill_missing_text", "difference_features", "margin_features", "session_features",
           "select_features", "assemble", "clip_probability", "clip_lower"]
