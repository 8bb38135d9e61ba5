"""Toxicity (4): non-negative positive-unlabelled learning.

numpy logistic classifiers over hashed word presence are trained from confirmed toxic
examples and unlabelled text. The risk of the unlabelled part is corrected by the class
prior, and its corrected value is kept from falling below zero (the non-negative
estimator): a step that would is taken upwards instead.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import ID, TEXT, id_and_text, letters, row_slices, staged

#: Bounds of the sample of labelled rows that the classifiers are fitted on.
MAX_POSITIVE, MAX_UNLABELLED = 3_000, 9_000
BUCKETS = 1 << 20
MIN_DOCS = 4
PREFIXES = range(3, 9)
CLASSIFIERS = 3
#: Sampled texts that a task cuts.
TEXTS_A_TASK = 500
MEMO_ENTRIES = 150_000


def _hash(text: str) -> int:
    return zlib.crc32(text.encode()) % BUCKETS


def _features_of(token: str) -> tuple[int, ...]:
    """The token's letters as a whole and their beginnings (compounds share these)."""
    word = letters(token)
    if not word:
        return ()
    return (_hash("=" + word), *(_hash(word[:k]) for k in PREFIXES if k <= len(word)))


class _Features(dict):
    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) > MEMO_ENTRIES:
            self.clear()
        self[token] = found = _features_of(token)
        return found


def _present(text: str, memo: _Features) -> set[int]:
    return set(chain.from_iterable(map(memo.__getitem__, set(text.split()))))


class _Weights(dict):
    """The weighted features of a token; most tokens have none."""

    def __init__(self, weights: dict[int, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) > MEMO_ENTRIES:
            self.clear()
        self[token] = found = tuple(f for f in _features_of(token) if f in self.weights)
        return found


class NonNegativePU:
    """Linear classifiers on hashed word presence; ``weights`` holds only words seen
    in at least ``MIN_DOCS`` fitted texts."""

    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias = weights, bias


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _margins(rows: np.ndarray, cols: np.ndarray, n: int, w: np.ndarray, bias: float) -> np.ndarray:
    return np.bincount(rows, weights=w[cols], minlength=n) + bias


def train_pu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, width: int, seed: int,
             epochs: int = 60, rate: float = 0.05, decay: float = 2e-3, beta: float = 0.0, batches: int = 8) -> tuple[np.ndarray, float]:
    """One classifier by Adam on the logistic loss l: risk = prior * E_p l(+) +
    max(-beta, E_u l(-) - prior * E_p l(-))."""
    rng = np.random.default_rng(seed)

    def flat(docs):
        return np.repeat(np.arange(len(docs)), [len(d) for d in docs]), (
            np.concatenate(docs) if len(docs) else np.zeros(0, np.int64))

    w, bias = np.zeros(width), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    step = 0
    for _ in range(epochs):
        p_of = np.array_split(rng.permutation(len(positive)), batches)
        u_of = np.array_split(rng.permutation(len(unlabelled)), batches)
        for pi, ui in zip(p_of, u_of, strict=True):
            if not len(pi) or not len(ui):
                continue
            p, u = [positive[i] for i in pi], [unlabelled[i] for i in ui]
            (pr, pc), (ur, uc) = flat(p), flat(u)
            sp = _sigmoid(_margins(pr, pc, len(p), w, bias))
            su = _sigmoid(_margins(ur, uc, len(u), w, bias))
            # logistic loss: l(+) = -log s, l(-) = -log(1 - s); their slopes are s - 1 and s
            unl = -np.log1p(-np.clip(su, 0, 1 - 1e-12)).mean()
            corrected = unl - prior * -np.log1p(-np.clip(sp, 0, 1 - 1e-12)).mean()
            gp_plus, gp_minus, gu = prior * (sp - 1) / len(p), -prior * sp / len(p), su / len(u)
            if corrected >= -beta:
                gp, gu_used = gp_plus + gp_minus, gu
            else:
                gp, gu_used = -gp_minus, -gu
            grad = np.empty(width + 1)
            grad[:-1] = (np.bincount(pc, weights=gp[pr], minlength=width)
                         + np.bincount(uc, weights=gu_used[ur], minlength=width) + decay / 10 * w)
            grad[-1] = gp.sum() + gu_used.sum()
            step += 1
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad * grad
            move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            w = w - move[:-1]
            bias -= move[-1]
    return w, bias


def telling_features(rows: DataFrame) -> tuple[list[int], int, int]:
    """The features whose share of texts differs by more than three standard errors
    between the positive and the unlabelled texts of ``rows`` (``y`` 1 and 0, features
    ``f``), among those of at least ``MIN_DOCS`` positive texts; and the two parts' sizes.
    Counted where the texts are; only the telling features' numbers are returned."""
    n_p, n_u = rows.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    each = rows.select("y", F.explode("f").alias("f")).groupBy("f").agg(
        F.count_if(F.col("y") == 1).alias("c_p"), F.count_if(F.col("y") == 0).alias("c_u"))
    share = lambda c, n: (F.col(c) + 0.5) / F.lit(n + 1.0)
    each = each.withColumn("p", share("c_p", n_p)).withColumn("u", share("c_u", n_u))
    error = F.sqrt(F.col("p") * (1 - F.col("p")) / max(n_p, 1) + F.col("u") * (1 - F.col("u")) / max(n_u, 1))
    told = each.filter((F.col("c_p") >= MIN_DOCS) & (F.abs(F.col("p") - F.col("u")) > 3.0 * error))
    return sorted(r["f"] for r in told.select("f").collect()), n_p, n_u  # at most BUCKETS numbers


def fit_toxicity(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", max_positive: int = MAX_POSITIVE,
                 max_unlabelled: int = MAX_UNLABELLED) -> NonNegativePU | None:
    """Fit on the rows of ``labels``. Confirmed toxic rows are the positives; the
    unlabelled part are the texts of the rated rows whatever their label, which is not
    looked at: at most ``max_positive`` and ``max_unlabelled`` rows, those of the smallest
    id hash (of rows equal in id and text one; of an id's rows those of the smallest text
    hash; of texts with the same features one). Texts are cut into features in tasks, and
    the driver gets, of each sampled text, the telling features alone.
    The class prior is the toxic share over all labelled rows. None if there is no
    positive or no text to learn from."""
    named = labels.select(F.col(id_col).alias(ID), F.col(label_col).cast("int").alias("y")).filter(
        F.col(ID).isNotNull() & F.col("y").isin(0, 1))
    toxic, rated = named.agg(F.sum("y"), F.count("y")).first()
    if not toxic:
        return None
    prior = min(max(toxic / rated, 0.005), 0.5)
    texts = id_and_text(documents, id_col, text_col)
    order = F.xxhash64(F.col(ID))
    first = lambda df, n: df.select(ID).distinct().orderBy(order, ID).limit(n)
    ids = (first(named.filter("y = 1"), max_positive).withColumn("y", F.lit(1))
           .unionByName(first(named, max_unlabelled).withColumn("y", F.lit(0))))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Features()
        for b in row_slices(batches):
            found = [sorted(_present(t, memo)) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int32()))], names=["y", "o", "f"])

    rows = texts.join(F.broadcast(ids), ID).dropDuplicates([ID, "y", TEXT])  # ids: bounded above
    part = lambda y, n: rows.filter(F.col("y") == y).orderBy(order, ID, F.xxhash64(TEXT), TEXT).limit(n)
    chosen = part(1, max_positive).unionByName(part(0, max_unlabelled)).select("y", order.alias("o"), TEXT)
    chosen = chosen.repartition(max(1, (max_positive + max_unlabelled) // TEXTS_A_TASK)).mapInArrow(features, "y int, o bigint, f array<int>")
    # copies teach nothing new
    chosen = staged(chosen.groupBy("y", "f").agg(F.min("o").alias("o")), "toxicity-sample")
    kept, n_p, n_u = telling_features(chosen)
    if not n_p or not n_u:
        return None

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(BUCKETS, -1, np.int32)
        place[kept] = np.arange(len(kept), dtype=np.int32)
        for b in batches:
            found = [q[q >= 0].tolist() for q in (place[np.asarray(f, np.int64)] for f in b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int32()))], names=["y", "o", "f"])

    small = chosen.select("y", "o", "f").mapInArrow(compact, "y int, o bigint, f array<int>").collect()
    small.sort(key=lambda r: (r["o"], r["f"]))
    positive, unlabelled = ([np.asarray(r["f"], np.int64) for r in small if r["y"] == y] for y in (1, 0))
    fits = [train_pu(positive, unlabelled, prior, len(kept), seed) for seed in range(CLASSIFIERS)]
    w = np.mean([f[0] for f in fits], axis=0)
    return NonNegativePU({int(k): float(x) for k, x in zip(kept, w, strict=True) if abs(x) > 1e-6},
                         float(np.mean([f[1] for f in fits])))


def score_toxicity(df: DataFrame, model: NonNegativePU | None, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = 0.3) -> DataFrame:
    """``(id_col, score, predicted)``, one row for each input row, from the whole text
    alone. A null or empty text gets the score of a text without known words; without a
    model every score is 0. The model is bounded by ``BUCKETS`` weights."""
    source = id_and_text(df, id_col, text_col)
    schema = T.StructType([T.StructField(id_col, source.schema[ID].dataType), T.StructField("score", T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        w = m.weights if m else {}
        memo = _Weights(w)
        for b in row_slices(batches):
            texts = b.column(1).to_pylist()
            sums = [sum(map(w.__getitem__, sorted(set(chain.from_iterable(map(memo.__getitem__, set(t.split())))))))
                    for t in texts] if m else []
            s = _sigmoid(np.array(sums) + m.bias) if m else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=[id_col, "score"])

    scored = source.mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= F.lit(threshold)).cast("int"))


def keep_clean(df: DataFrame, model: NonNegativePU | None, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``df``, with all their columns, whose text scores below
    ``threshold``. The scored column travels with its row, so that no join and no
    unique id is needed."""
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), F.col(text_col).alias(TEXT))
    scored = score_toxicity(whole, model, "__row", TEXT, threshold)
    return scored.filter("predicted = 0").select("__row.*")
