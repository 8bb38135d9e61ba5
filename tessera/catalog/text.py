"""Registered queries for text features and batched labelling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.catalog.tabular import r9_all
from tessera.functions.replies import RISK_LABELS
from tessera.functions.text import strip_accents
from tessera.operators import batching as H10
from tessera.operators import textfeatures as H
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


NORM_SQL = "strip_accents(lower(coalesce(text, '')))"
TOK_SQL = f"list_filter(regexp_extract_all({NORM_SQL}, '[\\p{{L}}\\p{{N}}_]+'), lambda x: length(x) >= 2)"


def _word_grams_sql(src: str = "documents") -> str:
    parts = [f"[array_to_string(tok[i:i+{n - 1}], ' ') FOR i IN range(1, len(tok) - {n - 2})]" for n in (1, 2, 3)]
    return (f"SELECT doc_id, list_concat({', '.join(parts)}) AS grams "
            f"FROM (SELECT doc_id, {TOK_SQL} AS tok FROM {src})")


def _char_grams_sql(src: str = "documents") -> str:
    words = f"list_filter(string_split_regex({NORM_SQL}, '\\s+'), lambda w: w <> '')"
    per_n = []
    for n in (3, 4, 5):
        reached = "true" if n == 3 else f"length(w) > {n - 1}"
        per_n.append(f"CASE WHEN NOT ({reached}) THEN []::VARCHAR[] WHEN length(w) <= {n} THEN [w] "
                     f"ELSE [substring(w, i, {n}) FOR i IN range(1, length(w) - {n - 2})] END")
    grams = f"flatten([list_concat({', '.join(per_n)}) FOR w IN [' ' || x || ' ' FOR x IN {words}]])"
    return f"SELECT doc_id, {grams} AS grams FROM {src}"


def _summary_sql(grams_sql: str) -> str:
    return (f"SELECT doc_id, len(grams) AS n_grams, len(list_distinct(grams)) AS n_distinct, "
            f"md5(array_to_string(list_sort(list_distinct(grams)), '|')) AS grams_md5 FROM ({grams_sql})")


DIGEST = ("n_grams", "n_distinct", "grams_md5")


def _summary(terms: DataFrame) -> DataFrame:
    """Count, distinct count and digest of each row's n-grams, which are not written out."""
    distinct = F.sort_array(F.array_distinct("terms"))
    return terms.select("doc_id", F.size("terms").alias("n_grams"), F.size(distinct).alias("n_distinct"),
                        F.md5(F.array_join(distinct, "|")).alias("grams_md5"))


@register("h1_word_ngrams", _summary_sql(_word_grams_sql()))
def h1_word_ngrams(spark, sf):
    """H1: word 1-3-grams of every document (count, distinct count, digest)."""
    docs = table(spark, sf, "documents")
    return H.with_terms(docs.select("doc_id", "text"), "doc_id", "text", "word", (1, 3), digest=DIGEST)


@register("h2_char_ngrams", _summary_sql(_char_grams_sql()))
def h2_char_ngrams(spark, sf):
    """H2: character 3-5-grams within padded words of every document."""
    docs = table(spark, sf, "documents")
    return H.with_terms(docs.select("doc_id", "text"), "doc_id", "text", "char_wb", (3, 5), digest=DIGEST)


@register("h3_strip_accents", "SELECT doc_id, md5(strip_accents(text)) AS text_md5, "
          "length(strip_accents(text)) AS n_chars FROM documents")
def h3_strip_accents(spark, sf):
    """H3: accents removed from every document."""
    d = table(spark, sf, "documents").select("doc_id", strip_accents(F.col("text")).alias("t"))
    return d.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").alias("n_chars"))


FIT_SQL = "(SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))"


def _fit_docs(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")


def _vocab_sql(grams_sql: str, min_df: int, limit: int) -> str:
    return f"""
SELECT term, CAST(sum(tf) AS BIGINT) AS tf_total, count(*) AS df FROM (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(grams) AS term FROM ({grams_sql})) GROUP BY doc_id, term)
GROUP BY term HAVING count(*) >= {min_df} ORDER BY tf_total DESC, term LIMIT {limit}"""


@register("h4_word_vocabulary", _vocab_sql(_word_grams_sql(FIT_SQL), 1, 100000))
def h4_word_vocabulary(spark, sf):
    """H4: word vocabulary fitted on the labelled documents (min_df 1, top 100000)."""
    return H.fit_vocabulary(_fit_docs(spark, sf), "doc_id", "text", "word", (1, 3), 1, 100000)


@register("h4_char_vocabulary", _vocab_sql(_char_grams_sql(FIT_SQL), 2, 50000))
def h4_char_vocabulary(spark, sf):
    """H4: char_wb vocabulary fitted on the labelled documents (min_df 2, top 50000)."""
    return H.fit_vocabulary(_fit_docs(spark, sf), "doc_id", "text", "char_wb", (3, 5), 2, 50000)


def _idf_sql(grams_sql_fit: str, min_df: int, limit: int) -> str:
    return (f"SELECT term, ln((1 + n) / (1 + df)) + 1 AS idf FROM ({_vocab_sql(grams_sql_fit, min_df, limit)}), "
            f"(SELECT count(*)::DOUBLE AS n FROM {FIT_SQL})")


@register("h6_idf", f"SELECT term, round_even(idf, 9) AS idf FROM ({_idf_sql(_word_grams_sql(FIT_SQL), 1, 100000)})")
def h6_idf(spark, sf):
    """H6: smoothed idf of the fitted word vocabulary."""
    fit = _fit_docs(spark, sf)
    vocab = H.fit_vocabulary(fit, "doc_id", "text", "word", (1, 3), 1, 100000)
    return r9_all(H.idf_table(vocab, fit))


def _tfidf_sql(grams_all: str, grams_fit: str, min_df: int, limit: int) -> str:
    return f"""
WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(grams) AS term FROM ({grams_all})) GROUP BY doc_id, term),
w AS (SELECT doc_id, tf.term, (1 + ln(tf)) * idf AS weight FROM tf JOIN ({_idf_sql(grams_fit, min_df, limit)}) i ON tf.term = i.term),
nw AS (SELECT doc_id, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS weight FROM w)
SELECT doc_id, count(weight) AS n_terms, round_even(coalesce(sum(weight), 0), 9) AS weight_sum,
       round_even(coalesce(max(weight), 0), 9) AS weight_max, round_even(coalesce(sum(weight * weight), 0), 9) AS sq_sum
FROM documents LEFT JOIN nw USING (doc_id) GROUP BY doc_id"""


def _flagged(spark, sf):
    """Every document, with whether it is one of the labelled (fitted) ones."""
    fit = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("fit")).distinct()
    return table(spark, sf, "documents").join(fit, "doc_id", "left").withColumn("fit", F.coalesce("fit", F.lit(False)))


def _tfidf_summary(w: DataFrame, docs: DataFrame) -> DataFrame:
    """One row for each document; one without a known term is a zero row."""
    s = w.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("weight").alias("weight_sum"),
                                F.max("weight").alias("weight_max"),
                                F.sum(F.col("weight") * F.col("weight")).alias("sq_sum"))
    return r9_all(docs.select("doc_id").join(s, "doc_id", "left").na.fill(0))


@register("h7_word_tfidf", _tfidf_sql(_word_grams_sql(), _word_grams_sql(FIT_SQL), 1, 100000))
def h7_word_tfidf(spark, sf):
    """H5-H7: sublinear tf x idf, L2-normalised word weights of every document
    (fit on the labelled ones); per-document summary of the sparse vector."""
    w, _ = H.fit_transform_tfidf(_flagged(spark, sf), "doc_id", "text", "fit", "word", (1, 3), 1, 100000)
    return _tfidf_summary(w, table(spark, sf, "documents"))


@register("h7_char_tfidf", _tfidf_sql(_char_grams_sql(), _char_grams_sql(FIT_SQL), 2, 50000))
def h7_char_tfidf(spark, sf):
    """H2+H5-H7: char_wb 3-5 TF-IDF block (min_df 2, 50000 terms)."""
    w, _ = H.fit_transform_tfidf(_flagged(spark, sf), "doc_id", "text", "fit", "char_wb", (3, 5), 2, 50000)
    return _tfidf_summary(w, table(spark, sf, "documents"))


def _kw_sql(weight: float) -> str:
    cols = []
    for cat, kws in H.CATEGORY_KEYWORDS.items():
        s = " + ".join(f"CAST(contains(lower(coalesce(text, '')), '{k.lower()}') AS INTEGER)" for k in kws)
        cols.append(f"({s}){'' if weight == 1.0 else f' * {weight}::DOUBLE'} AS {cat}_kw")
    return f"SELECT doc_id, {', '.join(cols)} FROM documents"


@register("h8_keyword_scores", _kw_sql(1.0))
def h8_keyword_scores(spark, sf):
    """H8: per risk category, listed keywords found as substrings of each document."""
    d = H.keyword_scores(table(spark, sf, "documents").select("doc_id", "text"), "text")
    return d.drop("text")


@register("h9_weighted_keywords", _kw_sql(5.0))
def h9_weighted_keywords(spark, sf):
    """H9: the keyword block weighted x5 before stacking."""
    d = H.keyword_scores(table(spark, sf, "documents").select("doc_id", "text"), "text", weight=5.0)
    return d.drop("text")


# ---------------------------------------------------------------- batches
BATCH_SQL = """
WITH p AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos FROM conversations),
b AS (SELECT *, pos // 30 AS batch_id, pos % 30 + 1 AS i FROM p),
f AS (SELECT batch_id, arg_min(role, pos) AS tag FROM b GROUP BY batch_id)
SELECT b.batch_id, count(*) AS n, f.tag,
       string_agg(CAST(i AS VARCHAR) || '. [' || coalesce(f.tag, '') || '] ' || coalesce(text, ''), chr(10) ORDER BY i) AS prompt
FROM b JOIN f USING (batch_id) GROUP BY b.batch_id, f.tag"""


def _batches(spark, sf):
    conv = table(spark, sf, "conversations")
    return H10.make_batches(conv, ["conv_id", "turn"], "text", "role", 30)


@register("h10_batches", f"SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(n AS INTEGER) AS n, tag, md5(prompt) AS prompt_md5, "
          f"length(prompt) AS prompt_len FROM ({BATCH_SQL})")
def h10_batches(spark, sf):
    """Conversation turns dealt into batches of 30 in (conv_id, turn) order,
    numbered prompt lines tagged with the batch's first role."""
    b = _batches(spark, sf)
    return b.select("batch_id", "n", "tag", F.md5("prompt").alias("prompt_md5"),
                    F.length("prompt").alias("prompt_len"))


# Replies are made in the query from each batch's roles, with every fifth batch
# wrapped in prose, one in five short by a label, one in five with no array and
# one in five cut off mid-array (stand-in for a remote labeller's text).
def _synthetic_replies(b: DataFrame) -> DataFrame:
    roles = F.transform("keys", lambda k: k["role"])
    labels = F.transform(roles, lambda r: F.when(r == "user", F.lit(" Market Risk"))
                         .when(r == "assistant", F.lit("LITIGATION_RISK ")).otherwise(F.lit("made up")))
    js = F.to_json(labels)
    kind = F.pmod(F.col("batch_id"), F.lit(5))
    reply = (F.when(kind == 0, js)
             .when(kind == 1, F.concat(F.lit("Here are the labels:\n"), js, F.lit("\nDone.")))
             .when(kind == 2, F.to_json(F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(0)))))
             .when(kind == 3, F.lit("I cannot classify these."))
             .otherwise(F.concat(F.lit("["), F.lit('"market_risk", "oper'))))
    return b.withColumn("reply", reply)


REPLY_SQL = f"""
WITH p AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos FROM conversations),
b AS (SELECT batch_id, count(*) AS n,
             list(CASE WHEN role = 'user' THEN ' Market Risk' WHEN role = 'assistant' THEN 'LITIGATION_RISK ' ELSE 'made up' END ORDER BY pos) AS labels,
             list(conv_id ORDER BY pos) AS conv_ids, list(turn ORDER BY pos) AS turns
      FROM (SELECT *, pos // 30 AS batch_id FROM p) GROUP BY batch_id),
r AS (SELECT *, CASE batch_id % 5 WHEN 0 THEN to_json(labels)::VARCHAR
                  WHEN 1 THEN 'Here are the labels:' || chr(10) || to_json(labels)::VARCHAR || chr(10) || 'Done.'
                  WHEN 2 THEN to_json(labels[1:greatest(len(labels) - 1, 0)])::VARCHAR
                  WHEN 3 THEN 'I cannot classify these.' ELSE '["market_risk", "oper' END AS reply FROM b),
x AS (SELECT *, regexp_extract(regexp_replace(reply, '^\\s+|\\s+$', '', 'g'), '\\[.*\\]', 0, 's') AS body FROM r),
j AS (SELECT *, CASE WHEN body <> '' AND json_valid(body) THEN from_json(body, '["VARCHAR"]') END AS parsed FROM x),
l AS (SELECT *, coalesce(len(parsed) <> n, true) AS n_mismatch,
             list_resize(coalesce([CASE WHEN list_contains({RISK_LABELS!r}, replace(lower(regexp_replace(v, '^\\s+|\\s+$', '', 'g')), ' ', '_'))
                                  THEN replace(lower(regexp_replace(v, '^\\s+|\\s+$', '', 'g')), ' ', '_') ELSE 'other_risk' END FOR v IN parsed],
                                  []::VARCHAR[]), n, 'other_risk') AS labels_out FROM j)
SELECT unnest(conv_ids) AS conv_id, unnest(turns) AS turn, CAST(batch_id AS BIGINT) AS batch_id,
       unnest(labels_out) AS label, n_mismatch FROM l"""


@register("h10_scored_batches", """
WITH p AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn, role) - 1 AS pos FROM conversations)
SELECT conv_id, turn, CAST(pos // 30 AS BIGINT) AS batch_id, false AS n_mismatch,
       (['credit_risk', 'market_risk', 'operational_risk'])[CAST((pos % 30) % 3 + 1 AS INTEGER)] AS label FROM p""")
def h10_scored_batches(spark, sf):
    """H10 + B20 + B21: batches go through the scorer hook (a deterministic one that
    labels the numbered items in turn) and every row gets its label back."""
    conv = table(spark, sf, "conversations")
    b = H10.make_batches(conv, ["conv_id", "turn", "role"], "text", "role", 30)
    names = ["credit_risk", "market_risk", "operational_risk"]
    return H10.labels_from_replies(H10.score_batches(b, H10.echo_scorer(names)), ["conv_id", "turn"], names)


@register("b20_b21_reply_labels", REPLY_SQL)
def b20_b21_reply_labels(spark, sf):
    """B20 + B21: per-row risk labels parsed from each batch's reply (array
    extracted from surrounding text, labels normalised, failures -> other_risk,
    padded to the batch size)."""
    conv = table(spark, sf, "conversations")
    b = H10.make_batches(conv.withColumn("_role", F.col("role")), ["conv_id", "turn", "role"], "text", "_role", 30)
    replies = _synthetic_replies(b)
    out = H10.labels_from_replies(replies, ["conv_id", "turn"])
    return out
