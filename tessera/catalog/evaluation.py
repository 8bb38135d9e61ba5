"""Registered queries for evaluation metrics and prediction blends."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.standins import SQL_TEST, test_rows
from tessera.catalog.tabular import r9_all
from tessera.catalog.tabular_standins import SQL_GAMES, games
from tessera.operators import ensemble as I
from tessera.operators import evaluation as J
from tessera.operators.features import clip_probability
from tessera.operators.filters import in_time_range
from tessera.sources.tables import table

QUERIES: dict = {}
ORACLE: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Rule-based language guess used as the "prediction" column for J1.
def _lang_guess(text):
    low = F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))
    return (F.when(F.contains(low, F.lit(" the ")), "en")
            .when(F.contains(low, F.lit(" und ")) | F.contains(low, F.lit(" der ")), "de")
            .when(F.contains(low, F.lit(" les ")) | F.contains(low, F.lit(" le ")), "fr").otherwise("es"))


LANG_SQL = """CASE WHEN contains(' ' || lower(coalesce(text, '')) || ' ', ' the ') THEN 'en'
  WHEN contains(' ' || lower(coalesce(text, '')) || ' ', ' und ') OR contains(' ' || lower(coalesce(text, '')) || ' ', ' der ') THEN 'de'
  WHEN contains(' ' || lower(coalesce(text, '')) || ' ', ' les ') OR contains(' ' || lower(coalesce(text, '')) || ' ', ' le ') THEN 'fr'
  ELSE 'es' END"""


@register("j1_macro_f1", f"""
WITH d AS (SELECT lang AS y, {LANG_SQL} AS p FROM documents),
l AS (SELECT y AS label FROM d UNION SELECT p FROM d),
s AS (SELECT label, (SELECT count(*) FROM d WHERE y = label AND p = label) AS tp,
             (SELECT count(*) FROM d WHERE y = label) AS nt, (SELECT count(*) FROM d WHERE p = label) AS np FROM l)
SELECT round_even(avg(CASE WHEN nt + np = 0 THEN 0.0 ELSE 2.0 * tp / (nt + np) END), 9) AS macro_f1, count(*) AS n_labels FROM s""")
def j1_macro_f1(spark, sf):
    """Macro F1 of a rule-based language guess against documents.lang."""
    d = table(spark, sf, "documents").select(F.col("lang").alias("y"), _lang_guess(F.col("text")).alias("p"))
    return r9_all(J.macro_f1(d, "y", "p"))


def _model_preds(spark, sf):
    g = games(spark, sf)
    preds = {
        "a": F.col("elo_diff") / 10.0,
        "b": F.col("home_margin_roll5") * 5.0 - 150.0 + ((F.col("id") % 7) - 3),
        "c": F.col("home_margin_roll20") * 20.0 * 0.9 - 135.0,
    }
    parts = [g.select("id", "season", "home_margin", F.lit(m).alias("model"), e.alias("pred")) for m, e in preds.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


PREDS_SQL = f"""
SELECT id, season, home_margin, 'a' AS model, elo_diff / 10.0::DOUBLE AS pred FROM ({SQL_GAMES})
UNION ALL SELECT id, season, home_margin, 'b', home_margin_roll5 * 5.0::DOUBLE - 150.0::DOUBLE + ((id % 7) - 3) FROM ({SQL_GAMES})
UNION ALL SELECT id, season, home_margin, 'c', home_margin_roll20 * 20.0::DOUBLE * 0.9::DOUBLE - 135.0::DOUBLE FROM ({SQL_GAMES})"""


@register("j2_rmse", f"""
SELECT model, season, round_even(sqrt(avg((home_margin - pred) * (home_margin - pred))), 9) AS rmse, count(*) AS n
FROM ({PREDS_SQL}) GROUP BY model, season""")
def j2_rmse(spark, sf):
    """RMSE per model and season."""
    return r9_all(J.rmse(_model_preds(spark, sf), "home_margin", "pred", ["model", "season"]))


@register("j4_fold_report", f"""
SELECT model, round_even(avg(rmse), 9) AS mean, round_even(stddev_pop(rmse), 9) AS std FROM (
  SELECT model, id % 5 AS fold, sqrt(avg((home_margin - pred) * (home_margin - pred))) AS rmse
  FROM ({PREDS_SQL}) GROUP BY model, id % 5) GROUP BY model""")
def j4_fold_report(spark, sf):
    """Per model the mean and population std of the per-fold RMSE."""
    p = _model_preds(spark, sf).withColumn("fold", F.col("id") % 5)
    per_fold = J.rmse(p, "home_margin", "pred", ["model", "fold"])
    return r9_all(per_fold.groupBy("model").agg(F.avg("rmse").alias("mean"), F.stddev_pop("rmse").alias("std")))


AUC_SQL = """
WITH g AS (SELECT {keys}score, sum(y) AS pos, sum(1 - y) AS neg FROM ({src}) WHERE score IS NOT NULL AND y IS NOT NULL GROUP BY {keys}score),
r AS (SELECT *, sum(neg) OVER (PARTITION BY {part} ORDER BY score ROWS UNBOUNDED PRECEDING) - neg AS below FROM g)
SELECT {keys}sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc, CAST(sum(pos) AS BIGINT) AS n_pos,
       CAST(sum(neg) AS BIGINT) AS n_neg FROM r {group}"""


@register("j3_roc_auc", "SELECT round_even(auc, 9) AS auc, n_pos, n_neg FROM (" + AUC_SQL.format(
    keys="", part="1", group="",
    src="SELECT d.n_chars AS score, l.quality AS y FROM labels l JOIN documents d USING (doc_id)") + ")")
def j3_roc_auc(spark, sf):
    """ROC AUC of document length as a quality score, ties counted half."""
    d = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    return r9_all(J.roc_auc(d, "quality", "n_chars"))


WIN_P = ("2024-01-20 00:00:00", "2024-01-20 06:00:00")
WIN_T = ("2024-01-20 03:00:00", "2024-01-20 09:00:00")


@register("j5_overlap_f1", f"""
SELECT CAST(sum(p * t) AS BIGINT) AS tp, CAST(sum(p) AS BIGINT) AS n_pred, CAST(sum(t) AS BIGINT) AS n_true,
       coalesce(2.0 * sum(p * t) / nullif(sum(p) + sum(t), 0), 0.0) AS f1
FROM (SELECT CAST(coalesce(ts BETWEEN TIMESTAMP '{WIN_P[0]}' AND TIMESTAMP '{WIN_P[1]}', false) AS BIGINT) AS p,
             CAST(coalesce(ts BETWEEN TIMESTAMP '{WIN_T[0]}' AND TIMESTAMP '{WIN_T[1]}', false) AS BIGINT) AS t FROM ({SQL_TEST}))""")
def j5_overlap_f1(spark, sf):
    """Overlap F1 of a predicted and a true failure window over the test rows."""
    t = test_rows(spark, sf).select(in_time_range("ts", *WIN_P).alias("p"), in_time_range("ts", *WIN_T).alias("t"))
    return J.overlap_f1(t, "p", "t")


@register("j6_output_checks", """
SELECT count(*) FILTER (WHERE prob IS NULL OR isnan(prob)) AS n_missing, count(*) AS n_out,
       count(*) FILTER (WHERE NOT (prob BETWEEN 0.0 AND 1.0)) AS n_out_of_range, (SELECT count(*) FROM orders) AS n_in,
       (count(*) FILTER (WHERE prob IS NULL OR isnan(prob)) = 0 AND count(*) = (SELECT count(*) FROM orders)
        AND count(*) FILTER (WHERE NOT (prob BETWEEN 0.0 AND 1.0)) = 0) AS ok
FROM (SELECT o_totalprice / 400000.0::DOUBLE AS prob FROM orders)""")
def j6_output_checks(spark, sf):
    """Missing / row count / [0,1] range checks of a prediction column."""
    o = table(spark, sf, "orders")
    out = o.select((F.col("o_totalprice") / 400000.0).alias("prob"))
    return J.output_checks(out, o, "prob")


@register("i6_equal_blend", f"SELECT id, round_even(avg(pred), 9) AS blend, count(model) AS n_models FROM ({PREDS_SQL}) GROUP BY id")
def i6_equal_blend(spark, sf):
    """Equal-weight blend of three models per id."""
    return r9_all(I.equal_blend(_model_preds(spark, sf), "id"))


@register("i7_inverse_mse_blend", f"""
WITH m AS (SELECT model, sqrt(avg((home_margin - pred) * (home_margin - pred))) AS rmse FROM ({PREDS_SQL}) WHERE season >= 1997 GROUP BY model),
w AS (SELECT model, (1.0 / (rmse * rmse)) / sum(1.0 / (rmse * rmse)) OVER () AS weight FROM m)
SELECT id, round_even(sum(weight * pred), 9) AS blend FROM ({PREDS_SQL}) JOIN w USING (model) GROUP BY id""")
def i7_inverse_mse_blend(spark, sf):
    """Blend weighted by inverse validation MSE (validation = seasons >= 1997)."""
    p = _model_preds(spark, sf)
    metrics = J.rmse(p.filter(F.col("season") >= 1997), "home_margin", "pred", ["model"])
    return r9_all(I.weighted_blend(p, I.inverse_mse_weights(metrics), "id"))


SCORES_SQL = f"SELECT id, model, CAST(home_margin > 0 AS INTEGER) AS y, 1.0 / (1.0 + exp(-pred / 50.0)) AS score FROM ({PREDS_SQL})"


@register("i10_softmax_blend", f"""
WITH a AS ({AUC_SQL.format(keys="model, ", part="model", group="GROUP BY model", src=SCORES_SQL)}),
w AS (SELECT model, exp(25 * auc) / sum(exp(25 * auc)) OVER () AS weight FROM a)
SELECT id, round_even(least(greatest(sum(weight * score), 1e-6), 1 - 1e-6), 9) AS prob
FROM ({SCORES_SQL}) JOIN w USING (model) GROUP BY id""")
def i10_softmax_blend(spark, sf):
    """I10 (+J3, B16): AUC per model, softmax-sharpened weights exp(25*auc),
    weighted probability per id clipped to [1e-6, 1-1e-6]."""
    p = _model_preds(spark, sf)
    s = p.select("id", "model", (F.col("home_margin") > 0).cast("int").alias("y"),
                 (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("pred") / 50.0))).alias("score"))
    aucs = J.roc_auc(s, "y", "score", ["model"])
    blend = I.weighted_blend(s.withColumnRenamed("score", "pred"), I.softmax_weights(aucs), "id")
    return r9_all(blend.select("id", clip_probability("blend").alias("prob")))
