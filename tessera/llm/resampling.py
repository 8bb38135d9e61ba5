"""Target-distribution importance resampling (11): array-scored weights, distributed
quickselect.

Hashed word runs of the corpus and of a target set are counted into one array of
buckets each. The log ratio of a bucket's shares is its gain, and a document's weight is
the sum of its features' gains, looked up in that array. Gumbel noise drawn from the
document's id turns "the highest weights" into a draw without replacement in proportion
to the weights. The draw's last key is found by quickselect: random pivot keys, and
exact counts of the keys before, at and after each, until the k-th key is left. Only
the drawn documents are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ID, TEXT, id_and_text, row_slices, staged
from tessera.plans import ordered

#: Pivot keys of one quickselect round: each round leaves about an eighth of the keys.
PIVOTS = 16
#: Bytes of a text that are words at a time, and words whose buckets a task remembers.
RUN_BYTES, MEMO_ENTRIES = 1 << 20, 500_000

_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else ord(chr(b).lower()) if chr(b).isupper() else 32
                    for b in range(256))


def word_runs(text: str, carry: int = 0) -> Iterator[list[bytes]]:
    """The words of a text as UTF-8 (A-Z lower-cased, all ASCII but letters and digits
    between them), in bounded runs; each run starts with the last ``carry`` words of
    the one before."""
    data = text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES)
    at, last = 0, []
    while at < len(data):
        end = data.find(b" ", at + RUN_BYTES)
        end = len(data) if end < 0 else end
        words = last + data[at:end].split()
        yield words
        last, at = words[len(words) - carry:] if carry else [], end


class _Buckets(dict):
    """Bucket of a feature's bytes."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) > MEMO_ENTRIES:
            self.clear()
        self[feature] = found = zlib.crc32(feature) % self.buckets
        return found


def _features(text: str, memo: _Buckets, lo: int, hi: int) -> Iterator[tuple[np.ndarray, int]]:
    """The buckets of the text's features (runs of ``lo`` to ``hi`` words), in parts,
    each with its number of new words."""
    carried = 0
    for words in word_runs(text, hi - 1):
        parts = []
        for n in range(lo, hi + 1):
            # a run that lies in the carried words alone was counted before
            first = max(0, carried - n + 1)
            runs = words[first:] if n == 1 else [b" ".join(words[i:i + n]) for i in range(first, len(words) - n + 1)]
            parts.append(np.fromiter(map(memo.__getitem__, runs), np.int64, count=len(runs)))
        yield np.concatenate(parts), len(words) - carried
        carried = min(hi - 1, len(words))


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = 10_000, lo: int = 1, hi: int = 1) -> DataFrame:
    """``(bucket, n)``: how many features of all whole texts fall into each bucket that
    holds one. Every task counts into one array and sends at most ``buckets`` rows.
    Null and wordless texts have no features; an empty table gives no rows."""
    source = id_and_text(df, text_col, text_col).select(TEXT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, total = _Buckets(buckets), np.zeros(buckets, np.int64)
        held, size = [], 0
        for b in row_slices(batches):
            for text in b.column(0).to_pylist():
                for found, _ in _features(text, memo, lo, hi):
                    held.append(found)
                    size += len(found)
                    if size > 32 * buckets:
                        total += np.bincount(np.concatenate(held), minlength=buckets)
                        held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    return source.mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def _counts_array(counts: DataFrame, buckets: int) -> list[int]:
    out = [0] * buckets
    for r in counts.collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 ln) of the ratio of the buckets' add-one shares, target to corpus."""
    buckets, s_all, t_all = len(corpus), float(sum(corpus)), float(sum(target))
    return np.array([math.floor(1000 * math.log(((t + 1.0) * (s_all + buckets)) / ((s + 1.0) * (t_all + buckets))))
                     for s, t in zip(corpus, target, strict=True)], np.int64)


def score_documents(df: DataFrame, gains: np.ndarray, seed: int, id_col: str = "doc_id", text_col: str = "text",
                    lo: int = 1, hi: int = 1) -> DataFrame:
    """``(id_col, n_words, n_features, weight, score)``, one row for each row of ``df``."""
    source = id_and_text(df, id_col, text_col)
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(ID).cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    source = source.select(ID, noise.cast("long").alias("h"), TEXT)
    id_type = source.schema[ID].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(gains)  # one number for each bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        memo = _Buckets(len(gain))
        for b in row_slices(batches):
            rows = []
            for h, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                words = features = weight = 0
                for found, new in _features(text, memo, lo, hi):
                    words, features, weight = words + new, features + len(found), weight + int(gain[found].sum())
                gumbel = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
                rows.append((words, features, weight, weight + gumbel))
            cols = zip(*rows, strict=True) if rows else ([],) * 4
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in cols]],
                                             names=[id_col, "n_words", "n_features", "weight", "score"])

    return source.mapInArrow(run, f"`{id_col}` {id_type}, n_words bigint, n_features bigint, weight bigint, score bigint")


def kth_key(rows: DataFrame, key: Column, k: int, pivots: int = PIVOTS):
    """The ``k``-th smallest (from 1) of the distinct values of ``key`` over ``rows``
    (a staged table; ``k`` is between 1 and its rows). Every round draws pivots among
    the keys still in question (those with the least hashes in that many parts: a
    partial aggregate, one row a part), counts keys before and at each pivot exactly, and
    narrows to the open range between two of them. A few numbers pass through the
    driver; nothing is sorted."""
    key_type = rows.select(key.alias("key")).schema["key"].dataType
    lit = lambda p: F.struct(*[F.lit(v) for v in p]).cast(key_type)
    lo = hi = None
    base, turn = 0, 0  # ``base`` keys are at or before ``lo``
    while True:
        turn += 1
        inside = rows.select(key.alias("key"))
        if lo is not None:
            inside = inside.filter(F.col("key") > lit(lo))
        if hi is not None:
            inside = inside.filter(F.col("key") < lit(hi))
        draw = F.xxhash64("key", F.lit(turn))
        drawn = inside.groupBy(F.pmod(draw, F.lit(pivots)).alias("p")).agg(F.min(F.struct(draw.alias("d"), "key")).alias("m"))
        at = sorted(r["m"]["key"] for r in drawn.collect())  # at most ``pivots`` rows
        parts = [f for i, p in enumerate(at) for f in (
            F.count_if(F.col("key") < lit(p)).alias(f"before{i}"), F.count_if(F.col("key") == lit(p)).alias(f"at{i}"))]
        count = inside.agg(*parts).first()
        for i, p in enumerate(at):
            before = base + count[f"before{i}"]
            if before < k <= before + count[f"at{i}"]:
                return p
            if k <= before:
                hi = p
                break
            lo = p
        if lo is not None and lo in at:
            i = at.index(lo)
            base += count[f"before{i}"] + count[f"at{i}"]


def resample(df: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, seed: int = 2024, buckets: int = 10_000,
             lo: int = 1, hi: int = 1, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """Draw ``percent`` of the documents of ``min_words`` words or more towards the
    distribution of ``target``: ``(id_col, n_features, weight, score, rank)``, one row for
    each row of ``df``; rank 1, 2, ... by falling score, then rising id, null if not drawn.

    Features are runs of ``lo`` to ``hi`` words of whole texts. Null and wordless texts
    have no features and weight 0. The noise depends on seed and id alone, so rows that
    repeat an id share it; of equal scores and ids the fewer features come first, and
    rows equal in all of these are interchangeable (as many are drawn as fit). A null
    id counts as the empty text and comes before other ids. An empty target gives every
    feature the gain of a target without features; an empty ``df`` gives no rows. Other
    columns of both are not read."""
    gains = bucket_gains(_counts_array(bucket_counts(df, text_col, buckets, lo, hi), buckets),
                         _counts_array(bucket_counts(target, target_col, buckets, lo, hi), buckets))
    scored = staged(score_documents(df, gains, seed, id_col, text_col, lo, hi)
                    .withColumn("row", F.monotonically_increasing_id()), "resample-scored")
    out = ["n_features", "weight", "score"]
    enough = scored.filter(F.col("n_words") >= min_words)
    take = percent * enough.count() // 100
    undrawn = lambda d: d.select(id_col, *out, F.lit(None).cast("long").alias("rank"))
    if not take:
        return undrawn(scored)
    key = F.struct((-F.col("score")).alias("s"), F.col(id_col).alias("i"), F.col("n_features").alias("f"), F.col("row").alias("r"))
    last = F.struct(*[F.lit(v) for v in kth_key(enough, key, take)]).cast(scored.select(key.alias("k")).schema["k"].dataType)
    drawn = (F.col("n_words") >= min_words) & (key <= last)
    place = {"_s": -F.col("score"), "_k": F.col(id_col).isNotNull(), "_i": F.col(id_col), "_f": F.col("n_features"), "_r": F.col("row")}
    won = scored.filter(drawn).select(id_col, *out, *[c.alias(n) for n, c in place.items()])
    ranked = ordered.with_position(won, [], list(place))
    return (ranked.select(id_col, *out, (F.col(ordered.POS) + 1).alias("rank"))
            .unionByName(undrawn(scored.filter(~drawn))))
