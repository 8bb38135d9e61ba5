"""BPE (1) and token counts (5) against the tokenizers library itself."""

import random
import unicodedata

import public_tokenizers as P
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import bpe, tokencount
from tessera.llm.byte_bpe import AGREED, PATTERN
from tessera.llm.common import spaced_pieces

PATH = P.path("byte_bpe_50k.json")


def texts():
    rng = random.Random(5)
    marks = [" ", "  ", "\n", " \n", "\n\n", "\t", " ", " ", "\x1c", "\x85", "'s", "'", ",", ". ", "!?", "<|endoftext|>",
             "1", "2024", "é", "ß", "日本", "א", "՘", "\U0001F600", "​", "\x00", "ﬁ", "naïve", "the", " a", "Thtion", "x"]
    made = ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    return [None, "", " ", "\n", "a", "a b", " a", "a ", "a  b", "it's 'tis", "word, word. word", "x" * 5000,
            "the " * 4000, "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", *made]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, t, f"clash{i}") for i, t in enumerate(texts())] + [(1, "", "x"), (None, "null id", "x"), (None, "null id", "x")]
    return spark.createDataFrame(data, "doc_id long, text string, n_tokens string")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def expected(tok, rows):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.text or "", tuple(tok.encode(r.text or "", add_special_tokens=False).ids))
                  for r in rows.collect())


def test_counts_are_the_librarys(spark, rows, tok):
    got = tokencount.count_tokens(rows, PATH).collect()
    want = expected(tok, rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (i, len(t.encode()), len(ids), len(ids) > 512) for i, t, ids in want)


def test_ids_are_the_librarys_and_decode_to_the_text(spark, rows, tok):
    encoded = bpe.encode(rows, PATH)
    got = bpe.decode(encoded.withColumn("again", F.col("ids")), PATH, "again", "text").collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.text, tuple(r.ids)) for r in got) == expected(tok, rows)


def test_decoding_any_ids(spark, tok):
    rng = random.Random(3)
    lists = [[rng.randrange(0, 50257) for _ in range(rng.randrange(0, 30))] for _ in range(200)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)] + [(900, None), (901, [-1, 99999999])], "i int, ids array<int>")
    got = {r.i: r.text for r in bpe.decode(df, PATH).collect()}
    assert all(got[i] == tok.decode(x, skip_special_tokens=False) for i, x in enumerate(lists))
    assert got[900] is None and got[901] == ""


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert tokencount.count_tokens(none, PATH).count() == 0
    assert bpe.decode(bpe.encode(none, PATH), PATH).count() == 0


def test_other_tokenizers_go_through_their_library(spark):
    import sentencepiece

    data = ["", "the nation", "  two  spaces", "Élan"]
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = {r.doc_id: r.n_tokens for r in tokencount.count_tokens(df, P.path("piece_bpe_32k.model")).collect()}
    assert got == {i: len(sp.encode(t)) for i, t in enumerate(data)}
    words = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = {r.doc_id: r.n_tokens for r in tokencount.count_tokens(df, P.path("word_bpe_49k.json")).collect()}
    assert got == {i: len(words.encode(t, add_special_tokens=False).ids) for i, t in enumerate(data)}


def test_whole_tokens_are_proven(tok):
    whole = tokencount.proven_whole_tokens(PATH)
    assert " the" in whole and all(len(tok.encode(s, add_special_tokens=False).ids) == 1 for s in list(whole)[:2000])


def test_pieces_are_independent(tok):
    for t in filter(None, texts()):
        first, *rest = spaced_pieces(t)
        assert first + "".join(" " + p for p in rest) == t
        ids = tok.encode(first, add_special_tokens=False).ids
        for p in rest:
            ids += tok.encode(" " + p, add_special_tokens=False).ids
        assert ids == tok.encode(t, add_special_tokens=False).ids


def test_both_libraries_cut_alike_below_the_agreed_code_point(tok):
    rx = regex.compile(PATTERN)
    for c in map(chr, range(ord(AGREED))):
        s = f"a{c}1{c}  {c}"
        assert [m.span() for m in rx.finditer(s)] == [x[1] for x in tok.pre_tokenizer.pre_tokenize_str(s)], unicodedata.name(c, hex(ord(c)))
