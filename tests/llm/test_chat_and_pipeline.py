"""Chat formatting (8), the SQL of this subpackage and the pipeline."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import chat, decontam
from tessera.llm.queries import ORACLE, QUERIES
from tessera.sources.tables import TABLES
from tools.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_escape_round_trip():
    rng = random.Random(8)
    bits = [*chat.CONTROL, "\\", "<", ">", "[", "]", "s", "/", "INST", "x", "\n", "é"]
    for _ in range(2000):
        t = "".join(rng.choice(bits) for _ in range(rng.randrange(0, 9)))
        e = chat.escape(t)
        assert chat.unescape(e) == t and not any(c in e for c in chat.CONTROL)
        line = f"<s>user[INST]{e}[/INST]</s>" * 2
        assert chat.read_turns(line) == [("user", t)] * 2


def test_typed_parts(spark):
    rows = [(1, 0, "user", [("text", "see <|image|>", None, None), ("image", None, "a.png", 70), ("document", None, "b.pdf", 2)]),
            (1, 1, "assistant", [("text", "fine", None, None), ("audio", None, "c.wav", 3)]),
            (1, 2, None, []), (1, 2, None, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id int, turn int, role string, parts "
                               "array<struct<type:string,text:string,ref:string,units:int>>, formatted string")
    got = {(r.turn, r.role): r for r in chat.format_turns(df, F.col("parts")).collect()}
    user = got[0, "user"]
    assert user.formatted == "<s>user[INST]see <\\|image|><|image|><|document|>[/INST]</s>"
    assert [(a.kind, a.ref, a.at, a.tokens) for a in user.attachments] == [("image", "a.png", 14, 70), ("document", "b.pdf", 23, 1200)]
    assert user.expanded_tokens == 1270 and user.loss_start == user.loss_end
    said = got[1, "assistant"]
    assert said.formatted[said.loss_start:said.loss_end] == "fine<|audio|>" and said.expanded_tokens == 75
    assert got[2, None].formatted == "<s>[INST][/INST]</s>"


def test_read_back_edges(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (None, 0, "user", "x"), (2, None, "system", ""), (1, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(df, chat.text_part(F.col("text")))).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[2].n_turns, got[None].n_turns) == (3, 2, 1, 1)
    assert got[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\nb\nassistant\nb\n").hexdigest()
    assert chat.read_back(chat.format_turns(df.limit(0), chat.text_part(F.col("text")))).count() == 0


def test_turns_of_one_place_stand_in_the_order_of_their_texts(spark):
    texts = ["a", "aA", "<s", "</s>", "<s>", "\\", "[INST]", "[INST", "", "a["]
    df = spark.createDataFrame([(1, 0, "user", t) for t in texts], "conv_id long, turn long, role string, text string")
    got = chat.read_back(chat.format_turns(df, chat.text_part(F.col("text")))).first()
    want = "".join(f"user\n{t}\n" for t in sorted(texts))
    assert got.turns_sha256 == hashlib.sha256(want.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert compare(QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE[name]).df()) is None


def test_stages_take_odd_rows(spark):
    rows = [(1, None), (1, None), (None, "plain words stand here today"), (2, ""), (2, "other words of the same id"), (2, "other words of the same id"),
            (3, "plain words stand here today"), (None, None), (4, "..."), (5, "lone " * 3000)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    docs = spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], schema)
    left = {"toxicity": 10, "n-gram join": 8, "decontamination": 10, "pii": 10, "bpe": 10}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == left[name], name
        assert name == "bpe" or out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, at = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        at[name] = docs = spark.createDataFrame(docs.toPandas(), docs.schema)
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in at.items()}
    assert ids["toxicity"] >= ids["n-gram join"] >= ids["decontamination"] == ids["pii"]
    assert decontam.find_contamination(at["pii"], spark.read.parquet(f"{SF}/benchmark.parquet")).filter("n_hit > 0").count() == 0
    out = corpus_pipeline.run(spark, SF)
    rows = {r.doc_id: r for r in out.collect()}
    assert set(rows) == ids["pii"]
    for r in at["pii"].collect():
        assert rows[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
        assert rows[r.doc_id].n_tokens == len(rows[r.doc_id].ids) and r.n_chars == len(r.text)
