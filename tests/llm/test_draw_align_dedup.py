"""Importance resampling (11), cross-tokenizer alignment (12) and embedding near-dedup
(13) against brute force, with the edge cases of their docstrings."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import alignment, neardup, resampling
from tessera.llm.byte_bpe import byte_of_char

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_draw(docs, target, percent, least, buckets, lo, hi):
    def features(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(lo, hi + 1) for i in range(len(w) - n + 1)]

    s, t = (collections.Counter(f for x in texts for f in features(x)) for texts in ([x for _, x in docs], target))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        f = features(text)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), len(words(text))))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    drawn = [(*r[:4], k + 1) for k, r in enumerate(able[:percent * len(able) // 100])]
    left = collections.Counter(r[:4] for r in rows)
    left.subtract(r[:4] for r in drawn)
    return sorted(drawn + [(*r, None) for r in left.elements()], key=str)


@pytest.mark.parametrize("percent,lo,hi", [(10, 1, 1), (50, 1, 2), (100, 2, 3), (0, 1, 1)])
def test_resampling(spark, monkeypatch, percent, lo, hi):
    rng = random.Random(percent)
    vocab = ["alpha", "Beta", "été", "x1", "of", "the", "Ñu", "日本"]
    docs = [(i, rng.choice([" ", ", ", "-"]).join(rng.choice(vocab) for _ in range(rng.randrange(0, 30)))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "..."), (5, docs[5][1]), (5, docs[5][1]), (7, docs[9][1]), (None, docs[6][1]), (203, "of The " * 900)]
    target = [" ".join(rng.choice(vocab[:4]) for _ in range(40)), None, ""]
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score int, rank int").repartition(3)
    t = spark.createDataFrame([(x, 0) for x in target], "text string, n int")
    monkeypatch.setattr(resampling, "RUN_BYTES", 64)
    got = resampling.resample(d, t, percent, 5, buckets=37, lo=lo, hi=hi)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_draw(docs, target, percent, 5, 37, lo, hi)


def test_resampling_of_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert resampling.resample(d.limit(0), d).count() == 0
    row = resampling.resample(d, d.limit(0), 100, 1, buckets=10).first()
    assert (row.n_features, row["rank"]) == (6, 1)


def test_kth_key_counts_exactly(spark):
    values = [random.Random(3).randrange(50) for _ in range(400)]
    rows = spark.createDataFrame([(v, k) for k, v in enumerate(values)], "v long, k long")
    for k in (1, 77, 400):
        key = resampling.kth_key(rows, F.struct("v", "k"), k, pivots=3)
        assert tuple(key) == sorted((v, i) for i, v in enumerate(values))[k - 1]


def brute_alignment(docs):
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp, of = sentencepiece.SentencePieceProcessor(model_file=B), byte_of_char()
    bytes_a = lambda i: bytes(of[c] for c in tok.id_to_token(i))
    bytes_b = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
    found, held = [], collections.Counter()
    for _, text in docs:
        groups = []
        if text:
            a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            if b"".join(map(bytes_a, a)) == b"".join(map(bytes_b, b)) == (" " + text).encode():
                ends = [np.cumsum([len(f(i)) for i in ids]).tolist() for f, ids in ((bytes_a, a), (bytes_b, b))]
                at = 0, 0
                for end in sorted(set(ends[0]) & set(ends[1])):
                    stop = ends[0].index(end, at[0]) + 1, ends[1].index(end, at[1]) + 1
                    groups.append((a[at[0]:stop[0]], b[at[1]:stop[1]]))
                    at = stop
        found.append(groups)
        held.update({(x, y) for ga, gb in groups for x in ga for y in gb})
    most = collections.Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for (i, _), groups in zip(docs, found):
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        shown = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
                    sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links),
                    hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


@pytest.mark.parametrize("bounds", [{}, {"SLICE_CHARS": 200, "PACK_CHARS": 1_500, "LANE": 3, "LISTED": 5}])
def test_alignment(spark, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(alignment, name, value)
    rng = random.Random(4)
    parts = ["foo", "Bar's", "naïve", "日本語", "🙂🙂🙂", "=====", "x1234567", "<|endoftext|>", "<s>", "\t", "\n", " ", "don't", "  ", "ﬁ",
             "العربية", "12.5%", "<0x41>", "<unk>", "\x00", " "]
    docs = [(i, "".join(rng.choice(parts) + rng.choice([" ", "", "\n"]) for _ in range(rng.randrange(1, 40)))) for i in range(60)]
    docs += [(1000, None), (1001, ""), (1002, " "), (1003, "a▁b c"), (1004, "  a"), (5, docs[5][1]), (5, docs[6][1]), (None, "foo bar"),
             (1005, "ab " * 2000), (1006, "🙂日" * 900), (1007, "=-" * 800)]
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, n_a int, pack int").repartition(2)
    got = alignment.align_tokenizers(d, A, B)
    assert sorted(map(tuple, got.collect()), key=str) == brute_alignment(docs)
    assert alignment.align_tokenizers(d.limit(0), A, B).count() == 0


def brute_groups(rows, threshold):
    ok = [label is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    unit = [np.asarray(v, float) / np.linalg.norm(v) if good else None for good, (_, v, _) in zip(ok, rows)]
    links = [[j for j in range(len(rows)) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j])
              and unit[i] @ unit[j] >= threshold] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = set(links[todo.pop()]) - seen
            seen |= new
            todo += new
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        low = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), low, rows[i][0] == low))
    return sorted(out, key=str)


def near_copies():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(260):
        if i and rng.random() < 0.6:
            _, v, label = rows[rng.integers(len(rows))]
            v = np.asarray(v) + rng.normal(0, rng.choice([0, 0.02, 0.07, 0.1]), len(v))
            label = label if rng.random() < 0.9 else int(rng.integers(3))
        else:
            v, label = rng.normal(0, 0.3, 12), int(rng.integers(3))
        rows.append((i, [float(x) for x in np.float32(v)], label))
    zero, inf = [0.0] * 12, float("inf")
    return rows + [
        (700, None, 1), (701, [], 1), (702, zero, 1), (703, [float("nan"), *zero[1:]], 1), (704, [None, *[1.0] * 11], 1),
        (705, rows[0][1], None), (706, [1.0, 2.0], 1), (707, [2.0, 4.0], 1), (3, *rows[3][1:]), (3, *rows[9][1:]),
        (None, *rows[4][1:]), (None, [5.0] * 12, 2), (None, [5.0] * 12, 2), (708, [inf] * 12, 0), (None, None, None),
        (709, [x * 3 for x in rows[7][1]], rows[7][2]), (710, [x * 1e30 for x in rows[8][1]], rows[8][2])]


@pytest.mark.parametrize("cells,tile", [(None, 2048), (20, 7), (1, 50)])
def test_near_duplicates(spark, monkeypatch, cells, tile):
    rows = near_copies()
    monkeypatch.setattr(neardup, "TILE", tile)
    d = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, n int, kept int").repartition(3)
    got = neardup.near_duplicates(d, cells=cells)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_groups(rows, 0.98)


def test_near_duplicates_of_an_empty_table(spark):
    d = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert neardup.near_duplicates(d).count() == 0
    with pytest.raises(ValueError):
        neardup.near_duplicates(d, threshold=0.0)


def test_borders_of_cells_lose_no_pair():
    """Whatever the centroids, two vectors of a cosine over the threshold share a cell."""
    rng = np.random.default_rng(2)
    c = rng.normal(size=(30, 8))
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    x = rng.normal(size=(3000, 8))
    y = x + rng.normal(scale=0.15, size=x.shape)
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    near = (x * y).sum(axis=1) >= 0.98
    apart = np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T)))
    reach = math.sqrt(1 - 0.98 ** 2) + neardup.SLACK
    for u, v in ((x, y), (y, x)):
        su, sv = u @ c.T, v @ c.T
        hu, hv = su.argmax(1), sv.argmax(1)
        gap = su[np.arange(len(u)), hu] - su[np.arange(len(u)), hv]
        assert (gap <= reach * apart[hu, hv])[near].all()
    assert near.sum() > 300
