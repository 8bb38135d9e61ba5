"""Corpus pipeline: the stages a training corpus goes through, in order. Each stage
takes ``(spark, docs, sf_dir)``, works on every document its predecessor kept and
returns documents; its result is written as Parquet and read again as the next one's
input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontam, ngram_join, pii, toxicity
from tessera.llm.common import held_out, staged
from tessera.llm.queries import BYTE_BPE, PII_KEY
from tessera.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1: documents that the toxicity classifiers reject go. Null and empty texts
    score as texts without known words and stay; repeated rows are judged alike and stay
    or go together; without a toxic label nothing goes. Empty in, empty out."""
    labels = table(spark, sf_dir, "labels").filter(~held_out("doc_id"))
    model = toxicity.fit_toxicity(docs.filter(~held_out("doc_id")), labels)
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2: of documents linked by shared five-word shingles (Jaccard similarity of
    0.8 or more) one stays: the smallest id, then the smallest text hash, ids that are null
    last. Documents without words and null texts all stay, rows that share an id but not
    their text are documents of their own. Empty in, empty out."""
    return ngram_join.keep_one_of_each(docs, k=5, num=80, den=100)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3: documents that hold ten consecutive words of a benchmark item (all of a
    shorter one) go, every copy of them. Null and wordless texts stay, as does everything
    where there is no benchmark. Empty in, empty out."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4: personal data become pseudonyms; ``n_chars`` follows the new text. No row
    goes; null, empty and clean texts stay as they are, equal values get equal pseudonyms
    in all rows. Empty in, empty out."""
    found = pii.pseudonymise(docs, PII_KEY, found_col="__pii")
    changed = F.when(F.size("__pii") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", changed).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5: every document's token ids, decoded again to prove the round trip; one row
    for each row, repeated ids too. Null counts as empty: no ids. Empty in, empty out."""
    encoded = bpe.encode(docs, BYTE_BPE)
    kept = encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("ids").alias("__ids"))
    decoded = bpe.decode(kept, BYTE_BPE, "__ids", "__decoded")
    return decoded.select("doc_id", "n_tokens", "ids", F.sha2("__decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram join", drop_near_duplicates),
    ("decontamination", drop_benchmark_text),
    ("pii", hide_personal_data),
    ("bpe", tokenize),
]

#: The classifiers, the permutations and the encoder have no SQL form; the stages are
#: tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
