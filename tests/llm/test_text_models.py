"""Toxicity (4) and language ID (6): held-out accuracy and defined edge cases."""

import math

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import langid, toxicity
from tessera.llm.common import held_out
from tessera.sources.tables import table

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_rows(spark):
    docs = table(spark, SF, "documents")
    model = langid.fit_backoff(docs.filter(~held_out("doc_id")))
    got = langid.predict_language(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(held_out("doc_id"))
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("lang")).first()
    assert n > 100 and right > 0.98


def test_language_edges(spark):
    learn = spark.createDataFrame([("the cat and the dog", "en"), ("le chat et le chien", "fr"), (None, "en"), ("lost", None)],
                                  "text string, lang string")
    model = langid.fit_backoff(learn)
    assert model.langs == ["en", "fr"]
    data = [(1, "the dog"), (2, "le chien"), (3, None), (4, "123 !?"), (5, ""), (6, "the"), (6, "the"), (None, "chien"),
            (8, "chienne"), (9, "日本")]
    rows = spark.createDataFrame([(i, t, "x") for i, t in data], "doc_id long, text string, lang_pred string")
    got = langid.predict_language(rows, model).collect()
    assert len(got) == len(data) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.lang_pred for r in got}
    assert by[1] == by[6] == "en" and by[2] == by[None] == by[8] == "fr"
    assert by[3] == by[4] == by[5] == "und" and by[9] in model.langs
    none = spark.createDataFrame([], "text string, lang string")
    empty = langid.fit_backoff(none)
    assert {r.lang_pred for r in langid.predict_language(rows, empty).collect()} == {"und"}
    assert langid.predict_language(rows.limit(0), model).count() == 0


def test_language_model_has_no_cap_and_joins_alike(spark, monkeypatch):
    docs = table(spark, SF, "documents").limit(300)
    learn = docs.filter(~held_out("doc_id")).select("text", "lang").unionByName(
        spark.createDataFrame([("zyxabc", f"l{i:04d}") for i in range(1_001)], "text string, lang string"))
    assert len(langid.fit_backoff(learn).langs) > 1_001
    model = langid.fit_backoff(docs.filter(~held_out("doc_id")))
    counted = langid.word_counts(docs.filter(~held_out("doc_id")), "text", "lang")
    assert model.n_words == model.words.count() == counted.select("word").distinct().count()
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(-1, None), (-2, "123 !?"), (-3, "日本 qqqq"), (None, "the dog"), (-4, ""), (-5, "the"), (-5, "the")], "doc_id long, text string"))
    gathered = langid.predict_language(rows, model).collect()
    monkeypatch.setattr(langid, "SMALL_ROWS", 0)
    joined = langid.predict_language(rows, model).collect()
    flat = lambda got: sorted((str(r.doc_id), r.lang_pred, round(r.score, 9)) for r in got)
    assert flat(joined) == flat(gathered) and len(joined) == rows.count()
    assert langid.predict_language(rows.limit(0), model).count() == 0


def test_a_joined_model_asks_in_packed_rows(spark, monkeypatch):
    """A block's words cross the exchange as one row for each bucket, not as one for each
    word, and n-grams that are too many to gather give the same."""
    docs = table(spark, SF, "documents").limit(200).select("doc_id", "text", "lang")
    model = langid.fit_backoff(docs.filter("doc_id % 3 > 0"))
    want = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in langid.predict_language(docs, model).collect()}
    monkeypatch.setattr(langid, "SMALL_ROWS", 0)
    written, staged = {}, langid.staged

    def seen(df, name, *a):
        written[name] = staged(df, name, *a)
        return written[name]

    monkeypatch.setattr(langid, "staged", seen)
    for cells in (16_000_000, 0):
        monkeypatch.setattr(langid, "GRAM_CELLS", cells)
        got = langid.predict_language(docs, model).collect()
        assert {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in got} == want and len(got) == len(want)
    blocks = written["langid-blocks"]
    most = blocks.groupBy("block").count().agg(F.max("count")).first()[0]
    assert most <= langid.WORD_BUCKETS + 1 and "word" not in blocks.columns
    assert "langid-unseen-rows" in written


def test_backoff_takes_the_longest_known_grams():
    one, two = np.array([1.0, 0.0]), np.array([0.0, 1.0])
    m = langid.BackoffModel(["a", "b"], {"known": one}, {"new": two, "n": one, "e": one})
    got = m.scores(["known", "new", "en", "zzz"])
    assert got.tolist() == [[1, 0], [0, 1], [1, 0], [0, 0]]


def test_toxic_held_out_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.fit_toxicity(docs.filter(~held_out("doc_id")), labels.filter(~held_out("doc_id")))
    got = toxicity.score_toxicity(docs, model).join(labels, "doc_id").filter(held_out("doc_id"))
    caught, wrong = got.agg(F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))), F.avg(F.when(F.col("toxic") == 0, F.col("predicted")))).first()
    assert caught > 0.8 and wrong < 0.03


def test_toxicity_sample_bounds_rows_and_keeps_all_telling_features(spark, monkeypatch):
    rows = spark.createDataFrame([(1, list(range(500)))] * 50 + [(0, list(range(1_000, 1_010)))] * 50, "y int, f array<int>")
    assert toxicity.telling_features(rows) == (list(range(500)), 50, 50)
    docs = spark.createDataFrame([(1, f"awful{chr(97 + i % 26)}{chr(97 + i // 26)} thing") for i in range(50)]
                                 + [(2 + i, f"calm words {chr(97 + i)}q") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    sizes, train = [], toxicity.train_pu
    monkeypatch.setattr(toxicity, "train_pu", lambda p, u, *a: sizes.append((len(p), len(u))) or train(p, u, *a))
    toxicity.fit_toxicity(docs, labels, max_positive=10, max_unlabelled=15)
    assert sizes[0] == (10, 15)


def test_nonnegative_risk_matches_a_plain_one():
    """One epoch of one batch against the risk written out with finite differences."""
    rng = np.random.default_rng(1)
    pos = [np.flatnonzero(rng.random(4) < 0.6) for _ in range(30)]
    unl = [np.flatnonzero(rng.random(4) < 0.3) for _ in range(50)]
    prior, decay = 0.2, 2e-3

    def risk(w, b):
        s = [[1 / (1 + math.exp(-(sum(w[k] for k in d) + b))) for d in part] for part in (pos, unl)]
        plus, minus = -sum(map(math.log, s[0])) / len(pos), -sum(math.log(1 - x) for x in s[0]) / len(pos)
        corrected = -sum(math.log(1 - x) for x in s[1]) / len(unl) - prior * minus
        # the corrected part is taken upwards where it would fall below zero
        return (prior * plus + corrected if corrected >= 0 else -corrected) + decay / 20 * sum(x * x for x in w)

    w, b = np.zeros(4), math.log(prior / (1 - prior))
    m, v, rate = np.zeros(5), np.zeros(5), 0.05
    for step in range(1, 41):
        grad = [(risk(w + e[:-1], b + e[-1]) - risk(w - e[:-1], b - e[-1])) / 2e-6 for e in np.eye(5) * 1e-6]
        m, v = 0.9 * m + 0.1 * np.array(grad), 0.999 * v + 0.001 * np.array(grad) ** 2
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    got = toxicity.train_pu(pos, unl, prior, 4, seed=0, epochs=40, batches=1)
    assert np.allclose(got[0], w, atol=2e-3) and abs(got[1] - b) < 2e-3


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(i, f"calm words {chr(97 + i % 26)}{chr(97 + i // 26)}q here", "x") for i in range(60)]
                                 + [(100 + i, f"you awful thing {chr(97 + i)}zz", "x") for i in range(20)]
                                 + [(200, None, "x"), (201, "", "x"), (None, "awful", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(100 + i, 1) for i in range(20)] + [(i, 0) for i in range(60)] + [(7, None), (None, 1)],
                                   "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    got = toxicity.score_toxicity(docs, model).collect()
    assert len(got) == 83 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[101] > 0.3 > by[1] and by[200] == by[201]
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {*range(60), 200, 201}
    assert toxicity.fit_toxicity(docs, labels.filter("toxic = 0")) is None
    assert {r.score for r in toxicity.score_toxicity(docs, None).collect()} == {0.0}
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_non_negative_risk_separates():
    pos = [np.array([0, 1]) for _ in range(40)]
    unl = [np.array([1]) for _ in range(150)] + [np.array([0, 1]) for _ in range(20)]
    w, b = toxicity.train_pu(pos, unl, 0.12, 2, seed=0)
    p = lambda f: 1 / (1 + np.exp(-(w[f].sum() + b)))
    assert p([0, 1]) > 0.3 > 0.2 > p([1])
