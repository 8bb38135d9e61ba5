"""Registered queries opN_<name> and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tessera.llm import (
    alignment, ann, bpe, chat, decontam, langid, license, neardup, ngram_join, pii, resampling, tokencount, toxicity)
from tessera.llm.common import held_out
from tessera.sources.tables import table

#: Key of the pseudonyms that the registered queries use; a deployment has its own.
PII_KEY = "tessera-demonstration-key"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op4_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs.filter(~held_out("doc_id")), labels.filter(~held_out("doc_id")))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op5_token_counts(spark, sf_dir):
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)


def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit_backoff(docs.filter(~held_out("doc_id")))
    pred = langid.predict_language(docs, model)
    return pred.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op1_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    encoded = bpe.encode(docs, BYTE_BPE).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "ids")
    decoded = bpe.decode(encoded, BYTE_BPE)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


def op2_ann(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


def op3_decontamination(spark, sf_dir):
    found = decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op7_license_scan(spark, sf_dir):
    return license.scan_licenses(table(spark, sf_dir, "documents"), license.default_templates(spark))


def op8_chat_format(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], talk.schema)
    formatted = chat.format_turns(talk.unionByName(control), chat.text_part(F.col("text")))
    return chat.read_back(formatted)


def op9_pii(spark, sf_dir):
    found = pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)
    return found.select("doc_id", F.size("pii").cast("long").alias("n_pii"),
                        F.array_join(F.col("pii.kind"), ",").alias("kinds"), "text")


def op10_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op11_resampling(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, min_words=20,
                               seed=2024, buckets=10_000)


def op12_alignment(spark, sf_dir):
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


def op13_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_ann, op3_decontamination, op4_toxicity, op5_token_counts, op6_language_id, op7_license_scan,
    op8_chat_format, op9_pii, op10_ngram_join, op11_resampling,
    op12_alignment, op13_near_duplicates)}

ORACLE: dict[str, str] = {}

ORACLE["op3_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, s, occ.n, item_id FROM occ JOIN win ON occ.n = win.n AND occ.win = win.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""

ORACLE["op10_ngram_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + least(len(w), 4) - 1], ' ') AS g
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
link AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM sh x JOIN sh y ON x.g = y.g AND x.doc_id <> y.doc_id
                    GROUP BY 1, 2) p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * i >= 85 * (na.n + nb.n - i)),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, link.b AS r FROM reach JOIN link ON link.a = reach.r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id, n.n
"""

ORACLE["op8_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
c(s) AS (VALUES ('<s>'), ('</s>'), ('[INST]'), ('[/INST]'), ('<|image|>'), ('<|audio|>'), ('<|document|>'), (chr(92))),
e AS (SELECT t.*, length(text) + length(role) + 20
        + list_sum([CAST((length(text) - length(replace(text, s, ''))) / length(s) AS BIGINT) FOR s IN (SELECT list(c.s) FROM c)])
        + list_sum([CAST((length(role) - length(replace(role, s, ''))) / length(s) AS BIGINT) FOR s IN (SELECT list(c.s) FROM c)]) AS f
      FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(f) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

_NOTICES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in license.NOTICES.items())
ORACLE["op7_license_scan"] = rf"""
WITH t AS (
  SELECT license, list_filter(string_split_regex(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM (VALUES {_NOTICES}) AS v(license, text)),
tg AS (SELECT DISTINCT license, array_to_string(w[s:s + 4], ' ') AS g FROM (SELECT license, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM t)),
ts AS (SELECT license, count(*) AS n, greatest(1, count(*) // 4) AS stride,
              CASE WHEN count(*) = 1 THEN 1 ELSE count(*) + greatest(1, count(*) // 4) END AS wide FROM tg GROUP BY license),
d AS (
  SELECT DISTINCT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
dg AS (SELECT doc_id, s - 1 AS pos, greatest(len(w) - 4, 1) AS m, array_to_string(w[s:s + 4], ' ') AS g
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM d WHERE len(w) > 0)),
hit AS (
  SELECT doc_id, license, g, n, m, wide, unnest(range(greatest(0, CAST(ceil((pos - wide + 1) / stride) AS BIGINT)), pos // stride + 1)) * stride AS start
  FROM dg JOIN tg USING (g) JOIN ts USING (license)),
win AS (SELECT doc_id, license, start, count(DISTINCT g) / any_value(n) AS containment, any_value(least(wide, m - start)) AS k
        FROM hit GROUP BY doc_id, license, start)
SELECT doc_id, license, start AS first_word, k + 4 AS n_words, containment FROM win WHERE containment >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY containment DESC, start) = 1
"""

ORACLE["op11_resampling"] = r"""
WITH byte AS (SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)
                          ORDER BY b) AS crc FROM range(256) r(b)),
w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w, src
  FROM (SELECT doc_id, text, 's' AS src FROM documents UNION ALL SELECT NULL, text, 't' FROM benchmark)),
f AS (SELECT doc_id, src, unnest(w) AS f FROM w),
n AS (SELECT f, count_if(src = 's') AS s, count_if(src = 't') AS t FROM f GROUP BY f),
b AS (
  SELECT f, s, t, xor(list_reduce(list_prepend(4294967295,
           list_transform(range(0, strlen(f)), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT))),
           lambda c, x: xor(crc[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket FROM n, byte),
g AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(sum(t) AS DOUBLE) + 1) * ((SELECT sum(s) FROM n) + 10000::DOUBLE)
         / ((CAST(sum(s) AS DOUBLE) + 1) * ((SELECT sum(t) FROM n) + 10000::DOUBLE)))) AS BIGINT) AS gain FROM b GROUP BY bucket),
x AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM f JOIN b USING (f) JOIN g USING (bucket) WHERE src = 's' GROUP BY doc_id),
scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS UBIGINT) + 0.5::DOUBLE)
                                                      / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM w LEFT JOIN x USING (doc_id) WHERE src = 's'),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""

ORACLE["op13_near_duplicates"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
         WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, link.b FROM reach JOIN link ON link.a = reach.r),
n AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(r) AS component_id, min(r) = vec_id AS kept
FROM reach LEFT JOIN n USING (vec_id) GROUP BY vec_id
"""
