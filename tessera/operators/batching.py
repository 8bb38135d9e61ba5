"""Batched labelling (H10 with B20/B21): fixed-size batches in a stable order,
numbered prompt text, a pluggable scorer and per-row labels from the replies."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.replies import DEFAULT_LABEL, RISK_LABELS, extract_json_array, normalize_labels
from tessera.plans import ordered as O


def make_batches(df: DataFrame, order: Sequence[str], text: str, tag: str, size: int = 30) -> DataFrame:
    """Rows in ``order`` dealt into consecutive batches of ``size``; per batch
    the prompt ``"i. [tag] text"`` lines (``i`` from 1), where ``tag`` is the
    batch's first row's tag, the row keys in order and the batch size. The global
    position comes from the ordered plan (no single-task window)."""
    pos = O.with_position(df.withColumn("_txt", F.coalesce(F.col(text), F.lit(""))), [], list(order))
    pos = pos.withColumn("batch_id", F.floor(F.col(O.POS) / F.lit(size)).cast("long")) \
             .withColumn("_i", (F.pmod(F.col(O.POS), F.lit(size)) + F.lit(1)).cast("int"))
    g = pos.groupBy("batch_id").agg(
        F.array_sort(F.collect_list(F.struct("_i", F.struct(*order).alias("_key"), F.col(tag).alias("_tag"),
                                             "_txt"))).alias("_rows"))
    first_tag = F.col("_rows")[0]["_tag"]
    lines = F.transform("_rows", lambda r: F.concat(r["_i"].cast("string"), F.lit(". ["), F.coalesce(first_tag, F.lit("")),
                                                    F.lit("] "), r["_txt"]))
    return g.select("batch_id", F.size("_rows").alias("n"), first_tag.alias("tag"),
                    F.array_join(lines, "\n").alias("prompt"),
                    F.transform("_rows", lambda r: r["_key"]).alias("keys"))


def score_batches(batches: DataFrame, scorer: Callable[[str], str]) -> DataFrame:
    """Plug a scorer (prompt -> reply text) in through ``mapInPandas``; the
    call runs on the executors, one batch per call."""
    def run(it):
        for pdf in it:
            yield pdf.assign(reply=[scorer(p) for p in pdf["prompt"]])

    schema = T.StructType([*batches.schema.fields, T.StructField("reply", T.StringType())])
    return batches.mapInPandas(run, schema)


def labels_from_replies(scored: DataFrame, order: Sequence[str], valid: Sequence[str] = RISK_LABELS,
                        default: str = DEFAULT_LABEL, out: str = "label") -> DataFrame:
    """B20 + B21: parse each reply, normalise the labels, pad/truncate them to the
    batch size (``n_mismatch`` flags a reply of the wrong length) and give every
    row its label, matched by position in the batch."""
    parsed = scored.withColumn("_parsed", extract_json_array(F.col("reply")))
    fixed = parsed.select("batch_id", "keys",
                          F.coalesce(F.size("_parsed") != F.col("n"), F.lit(True)).alias("n_mismatch"),
                          normalize_labels(F.col("_parsed"), F.col("n"), valid, default).alias("_labels"))
    z = fixed.select("batch_id", "n_mismatch", F.explode(F.arrays_zip("keys", "_labels")).alias("_z"))
    return z.select(*[F.col(f"_z.keys.{k}").alias(k) for k in order], "batch_id",
                    F.col("_z._labels").alias(out), "n_mismatch")


def echo_scorer(labels: Sequence[str] = RISK_LABELS) -> Callable[[str], str]:
    """A deterministic offline scorer for tests: one label per numbered item. Items are
    counted by their numbers in sequence, so line breaks inside a text add none."""
    import json

    def score(prompt: str) -> str:
        n = 0
        for line in (prompt or "").split("\n"):
            n += line.startswith(f"{n + 1}. [")
        return json.dumps([labels[i % len(labels)] for i in range(n)])
    return score


__all__ = ["make_batches", "score_batches", "labels_from_replies", "echo_scorer"]
