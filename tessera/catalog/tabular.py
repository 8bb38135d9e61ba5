"""Registered queries for tabular features, aggregations and encodings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.catalog.tabular_standins import SQL_GAMES, SQL_SESSIONS, games, sessions
from tessera.functions import scalar as S
from tessera.functions.nulls import clip_lower, fill_text, round_half_even
from tessera.operators import aggregates as A
from tessera.operators import encoding as E
from tessera.operators import features as B
from tessera.operators import filters as C
from tessera.operators.dedup import drop_exact_duplicates
from tessera.sources.tables import preview, profile_shape, table

QUERIES: dict = {}
ORACLE: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r9_all(df: DataFrame) -> DataFrame:
    """Report every double column half-even at 9 decimals."""
    return df.select([round_half_even(F.col(f.name), 9).alias(f.name)
                      if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema.fields])


def sql_r9(inner: str, cols: list[tuple[str, bool]]) -> str:
    sel = ", ".join(f"round_even({c}, 9) AS {c}" if dbl else c for c, dbl in cols)
    return f"SELECT {sel} FROM ({inner})"


MONTH_CASE = "CASE lower(regexp_replace(CAST({x} AS VARCHAR), '^\\s+|\\s+$', '', 'g')) " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in S.MONTH_SPELLINGS.items()) + " END"


def month_sql(x: str) -> str:
    return f"CAST(coalesce({MONTH_CASE.format(x=x)}, 0) AS INTEGER)"


def safe_div_sql(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 OR ({b}) IS NULL OR ({a}) IS NULL THEN 0.0::DOUBLE ELSE ({a}) / ({b}) END)"


def flag_sql(pred: str) -> str:
    return f"CAST(coalesce({pred}, false) AS INTEGER)"


# ---------------------------------------------------------------- sessions
SESSION_OUT = [
    ("session_id", False), ("month_num", False), ("is_holiday_season", False), ("is_data_scarce_month", False),
    ("month_sin", True), ("month_cos", True), ("pv_nonzero", False), ("pv_log1p", True), ("pv_sqrt", True),
    ("pv_bucket", False), ("admin_dur_per_page", True), ("info_dur_per_page", True),
    ("product_dur_per_page", True), ("admin_zero_dur", False), ("info_zero_dur", False),
    ("product_zero_dur", False), ("any_zero_dur", False), ("total_pages", False), ("total_duration", True),
    ("avg_page_dur", True), ("bounce_x_exit", True), ("exit_minus_bounce", True), ("pv_x_products", True),
    ("pv_x_stay", True), ("visitor_enc", False), ("is_returning", False), ("is_new", False),
    ("weekend_holiday", False), ("is_special_day", False), ("product_pg_ratio", True), ("admin_pg_ratio", True),
    ("administrative_duration_log", True), ("informational_duration_log", True),
    ("product_related_duration_log", True),
]


def _session_sql() -> str:
    pv = "page_values"
    tp = "(administrative + informational + product_related)"
    td = "(administrative_duration + informational_duration + product_related_duration)"
    visitor = ("coalesce(CASE visitor_type WHEN 'Returning_Visitor' THEN 0 WHEN 'New_Visitor' THEN 1 "
               "WHEN 'Other' THEN 2 END, 2)")
    inner = f"""
SELECT session_id, month_num, CAST(month_num IN (11, 12) AS INTEGER) AS is_holiday_season,
  CAST(month_num IN (0, 1, 4) AS INTEGER) AS is_data_scarce_month,
  sin(2 * pi() * month_num / 12) AS month_sin, cos(2 * pi() * month_num / 12) AS month_cos,
  {flag_sql(f'{pv} > 0')} AS pv_nonzero, ln(1 + {pv}) AS pv_log1p, sqrt({pv}) AS pv_sqrt,
  CASE WHEN {pv} > -0.001 AND {pv} <= 0 THEN 0 WHEN {pv} > 0 AND {pv} <= 5 THEN 1
       WHEN {pv} > 5 AND {pv} <= 25 THEN 2 WHEN {pv} > 25 THEN 3 END AS pv_bucket,
  {safe_div_sql('administrative_duration', 'administrative')} AS admin_dur_per_page,
  {safe_div_sql('informational_duration', 'informational')} AS info_dur_per_page,
  {safe_div_sql('product_related_duration', 'product_related')} AS product_dur_per_page,
  {flag_sql('administrative > 0 AND administrative_duration = 0')} AS admin_zero_dur,
  {flag_sql('informational > 0 AND informational_duration = 0')} AS info_zero_dur,
  {flag_sql('product_related > 0 AND product_related_duration = 0')} AS product_zero_dur,
  {tp} AS total_pages, {td} AS total_duration, {safe_div_sql(td, tp)} AS avg_page_dur,
  bounce_rates * exit_rates AS bounce_x_exit, exit_rates - bounce_rates AS exit_minus_bounce,
  ln(1 + {pv}) * ln(1 + product_related) AS pv_x_products, ln(1 + {pv}) * (1.0::DOUBLE - exit_rates) AS pv_x_stay,
  {visitor} AS visitor_enc, CAST({visitor} = 0 AS INTEGER) AS is_returning, CAST({visitor} = 1 AS INTEGER) AS is_new,
  CAST(weekend AS INTEGER) * CAST(month_num IN (11, 12) AS INTEGER) AS weekend_holiday,
  {flag_sql('special_day > 0')} AS is_special_day,
  {safe_div_sql('product_related', tp)} AS product_pg_ratio, {safe_div_sql('administrative', tp)} AS admin_pg_ratio,
  ln(1 + administrative_duration) AS administrative_duration_log,
  ln(1 + informational_duration) AS informational_duration_log,
  ln(1 + product_related_duration) AS product_related_duration_log
FROM (SELECT *, {month_sql('month')} AS month_num FROM ({SQL_SESSIONS}))"""
    inner = f"SELECT *, greatest(admin_zero_dur, info_zero_dur, product_zero_dur) AS any_zero_dur FROM ({inner})"
    return sql_r9(inner, SESSION_OUT)


def _session_features(spark, sf):
    return B.session_features(sessions(spark, sf))


@register("b_session_features", _session_sql())
def b_session_features(spark, sf):
    """The whole session feature program on (user, day) sessions."""
    return r9_all(_session_features(spark, sf).select(*[c for c, _ in SESSION_OUT]))


def _session_subset(cols):
    out = [(c, d) for c, d in SESSION_OUT if c in cols or c == "session_id"]
    return f"SELECT {', '.join(c for c, _ in out)} FROM ({_session_sql()})", [c for c, _ in out]


for _name, _cols, _doc in [
    ("b6_safe_div", ["admin_dur_per_page", "info_dur_per_page", "product_dur_per_page", "avg_page_dur",
                     "product_pg_ratio", "admin_pg_ratio"], "B6: ratios with a zero/missing denominator -> 0"),
    ("b13_zero_duration_flags", ["admin_zero_dur", "info_zero_dur", "product_zero_dur", "any_zero_dur"],
     "B13: visited but zero duration flags and their OR"),
    ("b14_row_totals", ["total_pages", "total_duration"], "B14: row totals over columns"),
    ("b11_category_codes", ["visitor_enc", "is_returning", "is_new"], "B11: category code map with default"),
]:
    _sql, _keep = _session_subset(_cols)

    def _make(keep, doc):
        def q(spark, sf):
            return r9_all(_session_features(spark, sf).select(*keep))
        q.__doc__ = doc
        return q
    register(_name, _sql)(_make(_keep, _doc))


# ---------------------------------------------------------------- games
DIFF_NAMES = [d[0] for d in B.MARGIN_DIFFS]


def _sql_margin() -> str:
    exprs = {}
    for out, a, b in B.MARGIN_DIFFS:
        exprs[out] = f"(({exprs.get(a, a)}) - ({exprs.get(b, b)}))"
    cols = ", ".join(f"{e} AS {n}" for n, e in exprs.items())
    anyf = "greatest(" + ", ".join(f"coalesce(CAST({c} AS INTEGER), 0)" for c in B.MISSING_FLAGS) + ")"
    return (f"SELECT *, elo_diff * elo_diff AS elo_diff_sq, elo_diff * elo_diff * elo_diff AS elo_diff_cb, {cols}, "
            f"{anyf} AS any_roll_missing, CAST(coalesce(season >= 1995, false) AS INTEGER) AS is_modern "
            f"FROM ({SQL_GAMES})")


def _margin(spark, sf):
    return B.margin_features(games(spark, sf), modern_from=1995)


@register("b3_difference_features", sql_r9(_sql_margin(), [("id", False)] + [(n, True) for n in DIFF_NAMES]))
def b3_difference_features(spark, sf):
    """15 paired differences incl. differences of differences."""
    return r9_all(_margin(spark, sf).select("id", *DIFF_NAMES))


@register("b2_powers", sql_r9(_sql_margin(), [("id", False), ("elo_diff_sq", True), ("elo_diff_cb", True)]))
def b2_powers(spark, sf):
    """B2: polynomial terms x^2, x^3."""
    return r9_all(_margin(spark, sf).select("id", "elo_diff_sq", "elo_diff_cb"))


@register("b4_any_flag", f"SELECT id, any_roll_missing FROM ({_sql_margin()})")
def b4_any_flag(spark, sf):
    """OR of 0/1 flags cast to int (missing flag counts 0)."""
    return _margin(spark, sf).select("id", "any_roll_missing")


@register("b5_threshold_flags", f"SELECT id, is_modern FROM ({_sql_margin()})")
def b5_threshold_flags(spark, sf):
    """Threshold flag (season >= k) as int."""
    return _margin(spark, sf).select("id", "is_modern")


@register("b17_select_features", f"SELECT * EXCLUDE (id, home_margin, season) FROM ({_sql_margin()})")
def b17_select_features(spark, sf):
    """Every column except id, target and season."""
    return B.select_features(_margin(spark, sf), exclude=["id", "home_margin", "season"])


@register("c4_period_split", f"""
SELECT id, coalesce(season < 1997, false) AS is_train, coalesce(season >= 1997, false) AS is_valid,
       coalesce(season >= 1995, false) AS in_pool FROM ({SQL_GAMES})""")
def c4_period_split(spark, sf):
    """C4: train / validation / pool split by season (pool holds validation years)."""
    return C.period_split(games(spark, sf), "season", 1997, 1995).select("id", "is_train", "is_valid", "in_pool")


# ---------------------------------------------------------------- orders
ORDERS_MONTH_TEXT = """CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%b')
  WHEN o_orderkey % 3 = 1 THEN '  ' || upper(strftime(o_orderdate, '%B')) || chr(9)
  ELSE lower(strftime(o_orderdate, '%B')) END"""


def _orders_month(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    text = (F.when(k % 3 == 0, F.date_format("o_orderdate", "MMM"))
            .when(k % 3 == 1, F.concat(F.lit("  "), F.upper(F.date_format("o_orderdate", "MMMM")), F.lit("\t")))
            .otherwise(F.lower(F.date_format("o_orderdate", "MMMM"))))
    return o.select("o_orderkey", "o_totalprice", text.alias("month"))


@register("b10_month_normalize", f"SELECT o_orderkey, {month_sql(ORDERS_MONTH_TEXT)} AS month_num FROM orders")
def b10_month_normalize(spark, sf):
    """Month text (mixed case, padding, full/short names) -> 1..12, else 0."""
    return _orders_month(spark, sf).select("o_orderkey", S.month_number("month").alias("month_num"))


@register("b8_cyclic_month", f"""
SELECT o_orderkey, round_even(sin(2 * pi() * m / 12), 9) AS month_sin, round_even(cos(2 * pi() * m / 12), 9) AS month_cos
FROM (SELECT o_orderkey, {month_sql(ORDERS_MONTH_TEXT)} AS m FROM orders)""")
def b8_cyclic_month(spark, sf):
    """Cyclic month encoding."""
    m = S.month_number("month")
    s, c = S.cyclic(m)
    return r9_all(_orders_month(spark, sf).select("o_orderkey", s.alias("month_sin"), c.alias("month_cos")))


@register("b12_membership_flags", f"""
SELECT o_orderkey, CAST(m IN (11, 12) AS INTEGER) AS is_holiday_season, CAST(m IN (0, 1, 4) AS INTEGER) AS is_data_scarce_month
FROM (SELECT o_orderkey, {month_sql(ORDERS_MONTH_TEXT)} AS m FROM orders)""")
def b12_membership_flags(spark, sf):
    """Membership flags."""
    m = S.month_number("month")
    return _orders_month(spark, sf).select("o_orderkey", S.in_set(m, [11, 12]).alias("is_holiday_season"),
                                           S.in_set(m, [0, 1, 4]).alias("is_data_scarce_month"))


@register("b7_log_sqrt", """
SELECT o_orderkey, round_even(ln(1 + o_totalprice), 9) AS price_log1p, round_even(sqrt(o_totalprice), 9) AS price_sqrt FROM orders""")
def b7_log_sqrt(spark, sf):
    """log1p and sqrt of a skewed column."""
    o = table(spark, sf, "orders")
    return r9_all(o.select("o_orderkey", F.log1p("o_totalprice").alias("price_log1p"),
                           F.sqrt("o_totalprice").alias("price_sqrt")))


@register("e13_mean_std", """
SELECT o_orderstatus, round_even(avg(o_totalprice), 9) AS mean, round_even(stddev_pop(o_totalprice), 9) AS std
FROM orders GROUP BY o_orderstatus""")
def e13_mean_std(spark, sf):
    """Mean and population std per group."""
    return r9_all(A.mean_std(table(spark, sf, "orders"), "o_totalprice", ["o_orderstatus"]))


@register("a5_profile_shape", "SELECT count(*) AS n_rows, 6 AS n_cols FROM orders")
def a5_profile_shape(spark, sf):
    """A5: row and column count."""
    return profile_shape(table(spark, sf, "orders")).select("n_rows", F.col("n_cols").cast("int"))


@register("a5_preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def a5_preview(spark, sf):
    """A5: first rows by key (the limit is the feature)."""
    return preview(table(spark, sf, "orders"), 5, ["o_orderkey"])


# ---------------------------------------------------------------- events
@register("b9_right_closed_bucket", """
SELECT event_id, CASE WHEN v > -0.001 AND v <= 0 THEN 0 WHEN v > 0 AND v <= 5 THEN 1 WHEN v > 5 AND v <= 25 THEN 2
                      WHEN v > 25 THEN 3 END AS bucket
FROM (SELECT event_id, value - 1.0::DOUBLE AS v FROM events)""")
def b9_right_closed_bucket(spark, sf):
    """Right-closed bins (-0.001,0] (0,5] (5,25] (25,inf) -> 0..3, else NULL."""
    ev = table(spark, sf, "events").select("event_id", (F.col("value") - 1.0).alias("v"))
    return ev.select("event_id", S.right_closed_bucket("v").alias("bucket"))


@register("b16_clip", """
SELECT event_id, round_even(least(greatest(value / 600.0::DOUBLE, 1e-6), 1 - 1e-6), 9) AS prob,
       round_even(greatest(value - 100.0::DOUBLE, 0), 9) AS excess FROM events""")
def b16_clip(spark, sf):
    """Clip to [1e-6, 1-1e-6] and to a lower bound."""
    ev = table(spark, sf, "events")
    return r9_all(ev.select("event_id", B.clip_probability(F.col("value") / 600.0).alias("prob"),
                            clip_lower(F.col("value") - 100.0, 0.0).alias("excess")))


@register("b19_round", "SELECT event_id, round_even(value / 7.0::DOUBLE, 2) AS value_2dp FROM events")
def b19_round(spark, sf):
    """Report rounding to 2 decimals (half-even on the binary value)."""
    ev = table(spark, sf, "events")
    return ev.select("event_id", round_half_even(F.col("value") / 7.0, 2).alias("value_2dp"))


@register("e5_cohort_compare", """
SELECT cohort, count(*) AS n_rows, round_even(avg(value), 9) AS value_mean FROM (
  SELECT 'first_week' AS cohort, value FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-08'
  UNION ALL SELECT 'errors', value FROM events WHERE event_type = 'error'
  UNION ALL SELECT 'mid_low', value FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' AND value < 10
  UNION ALL SELECT 'never', value FROM events WHERE value < -1)
GROUP BY cohort""")
def e5_cohort_compare(spark, sf):
    """E5: sensor means of named, overlapping cohorts in one scan."""
    ev = table(spark, sf, "events")
    cohorts = [("first_week", C.in_time_range("ts", "2024-01-01", "2024-01-08")),
               ("errors", F.col("event_type") == "error"),
               ("mid_low", C.in_time_range("ts", "2024-01-05", "2024-01-20") & (F.col("value") < 10)),
               ("never", F.col("value") < -1)]
    return r9_all(A.cohort_compare(ev, cohorts, ["value"]))


# ---------------------------------------------------------------- lineitem
SENSORS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("e3_cohort_profile", "SELECT sensor, round_even(pos, 9) AS pos, round_even(frozen, 9) AS frozen, "
          "round_even(normal, 9) AS normal, marked FROM (SELECT *, coalesce(abs(pos - frozen) > 0.1, false) AS marked FROM ("
          + " UNION ALL ".join(
              f"SELECT '{s}' AS sensor, avg({s}) FILTER (WHERE l_returnflag = 'R') AS pos, "
              f"avg({s}) FILTER (WHERE l_returnflag = 'A' AND l_shipdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1995-06-30') AS frozen, "
              f"avg({s}) FILTER (WHERE l_linestatus = 'O') AS normal FROM lineitem" for s in SENSORS) + "))")
def e3_cohort_profile(spark, sf):
    """Per-sensor means of three cohorts, long form, marked when the first
    two differ by more than 0.1."""
    li = table(spark, sf, "lineitem")
    cohorts = {"pos": F.col("l_returnflag") == "R",
               "frozen": (F.col("l_returnflag") == "A") & C.in_time_range("l_shipdate", "1995-01-01", "1995-06-30"),
               "normal": F.col("l_linestatus") == "O"}
    return r9_all(A.cohort_profile(li, SENSORS, cohorts, ("pos", "frozen")))


@register("e4_drift_profile", "SELECT sensor, round_even(train_mean, 9) AS train_mean, train_max, "
          "round_even(test_mean, 9) AS test_mean, test_max, coalesce(test_max > train_max, false) AS exceeds FROM ("
          + " UNION ALL ".join(
              f"SELECT '{s}' AS sensor, avg({s}) FILTER (WHERE l_shipdate < TIMESTAMP '1996-01-01') AS train_mean, "
              f"max({s}) FILTER (WHERE l_shipdate < TIMESTAMP '1996-01-01') AS train_max, "
              f"avg({s}) FILTER (WHERE l_shipdate >= TIMESTAMP '1996-01-01') AS test_mean, "
              f"max({s}) FILTER (WHERE l_shipdate >= TIMESTAMP '1996-01-01') AS test_max FROM lineitem" for s in SENSORS) + ")")
def e4_drift_profile(spark, sf):
    """Train vs test mean/max per sensor with an 'exceeds' flag."""
    li = table(spark, sf, "lineitem")
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    return r9_all(A.drift_profile(li.filter(F.col("l_shipdate") < cut), li.filter(F.col("l_shipdate") >= cut), SENSORS))


def _li_part(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_shipdate")
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    return li.join(p, li.l_partkey == p.p_partkey, "left").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "p_brand", "p_type",
        (F.col("l_returnflag") == "R").cast("int").alias("target"))


SQL_LI_PART = ("SELECT l_orderkey, l_linenumber, l_shipdate, p_brand, p_type, CAST(l_returnflag = 'R' AS INTEGER) AS target "
               "FROM lineitem LEFT JOIN part ON l_partkey = p_partkey")


@register("e8_target_encoding", f"""
SELECT p_brand, n, round_even(mu, 9) AS mu, round_even((n * mu + 5 * 0.155::DOUBLE) / (n + 5), 9) AS te
FROM (SELECT p_brand, count(*) AS n, avg(target) AS mu FROM ({SQL_LI_PART}) WHERE p_brand IS NOT NULL GROUP BY p_brand)""")
def e8_target_encoding(spark, sf):
    """Smoothed target mean per category (prior 0.155, smoothing 5)."""
    return r9_all(E.target_encoding_map(_li_part(spark, sf), "p_brand", "target"))


@register("d1_lookup_join", f"""
WITH m AS (SELECT p_brand, (count(*) * avg(target) + 5 * 0.155::DOUBLE) / (count(*) + 5) AS te
           FROM ({SQL_LI_PART}) WHERE p_brand IS NOT NULL AND l_shipdate < TIMESTAMP '1994-01-01' GROUP BY p_brand)
SELECT l.l_orderkey, l.l_linenumber, round_even(coalesce(m.te, 0.155::DOUBLE), 9) AS brand_te
FROM ({SQL_LI_PART}) l LEFT JOIN m ON l.p_brand = m.p_brand""")
def d1_lookup_join(spark, sf):
    """Encoding map fitted on the rows shipped before 1994, applied to every
    row by a left join; unseen or missing category -> prior."""
    rows = _li_part(spark, sf)
    fit = rows.filter(F.col("l_shipdate") < F.lit("1994-01-01").cast("timestamp_ntz"))
    out = E.apply_encoding(rows, E.target_encoding_map(fit, "p_brand", "target"), "p_brand", "brand_te")
    return r9_all(out.select("l_orderkey", "l_linenumber", "brand_te"))


@register("e9_fold_target_encoding", f"""
WITH r AS (SELECT *, CAST(l_orderkey % 5 AS INTEGER) AS fold FROM ({SQL_LI_PART}) WHERE p_type IS NOT NULL),
f AS (SELECT * FROM (VALUES (0), (1), (2), (3), (4)) t(fold)),
m AS (SELECT f.fold, r.p_type, count(*) AS n, sum(r.target) AS s FROM f JOIN r ON r.fold <> f.fold GROUP BY f.fold, r.p_type)
SELECT fold, p_type, n, round_even((n * (s / n) + 5 * 0.155::DOUBLE) / (n + 5), 9) AS te FROM m""")
def e9_fold_target_encoding(spark, sf):
    """Out-of-fold encoding maps for every fold from one aggregate."""
    rows = _li_part(spark, sf).withColumn("fold", (F.col("l_orderkey") % 5).cast("int"))
    return r9_all(E.fold_target_maps(rows, "p_type", "target", "fold", 5))


# ---------------------------------------------------------------- documents / labels
@register("b1_fill_text", "SELECT doc_id, md5(coalesce(CASE WHEN doc_id % 10 = 0 THEN NULL ELSE text END, '')) AS text_md5 FROM documents")
def b1_fill_text(spark, sf):
    """B1: missing text -> '' (every tenth text blanked to NULL as input)."""
    d = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 10 == 0, F.lit(None)).otherwise(F.col("text")).alias("text"))
    return d.select("doc_id", F.md5(fill_text("text")).alias("text_md5"))


@register("e1_value_counts", "SELECT lang, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang ORDER BY count DESC, lang")
def e1_value_counts(spark, sf):
    """Value counts, descending."""
    return A.value_counts(table(spark, sf, "documents"), "lang")


@register("e10_dedup", """
SELECT min(doc_id) AS doc_id, md5(text) AS text_md5 FROM documents GROUP BY text""")
def e10_dedup(spark, sf):
    """Exact duplicates on every column but the id removed, first id kept."""
    d = drop_exact_duplicates(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return d.select("doc_id", F.md5("text").alias("text_md5"))


@register("e12_class_weights", """
SELECT doc_id, quality, round_even(n / (k * nc), 9) AS weight FROM labels
JOIN (SELECT quality AS q, count(*) AS nc FROM labels GROUP BY quality) c ON c.q IS NOT DISTINCT FROM labels.quality
CROSS JOIN (SELECT count(*) AS n, count(DISTINCT coalesce(quality, -999)) AS k FROM labels)""")
def e12_class_weights(spark, sf):
    """Balanced class weight n / (k * n_class) per row."""
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return r9_all(E.class_weights(lab, "quality"))


@register("i3_stratified_folds", """
SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY md5(concat('42', doc_id)), doc_id) - 1) % 5 AS INTEGER) AS fold
FROM labels""")
def i3_stratified_folds(spark, sf):
    """Deterministic shuffled stratified 5-fold assignment."""
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return E.stratified_folds(lab, "quality", "doc_id", 5, 42)
