"""Decontamination (3), license scans (7), PII (9), n-gram join (10), nearest
neighbours (2) against brute force, with the edge cases of their docstrings."""

import hashlib
import random
import re
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import ann, decontam, license, ngram_join, pii
from tessera.llm.components import connected_components


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_contamination(docs, items, span=10):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, itext in items:
            iw = words(itext)
            n = min(span, len(iw))
            wins = {tuple(iw[s:s + n]) for s in range(len(iw) - n + 1)} if n else set()
            for s in range(len(w) - n + 1 if n else 0):
                if tuple(w[s:s + n]) in wins:
                    hit.update(range(s, s + n))
                    found.add(str(item))
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def test_contamination(spark):
    rng = random.Random(1)
    vocab = ["alpha", "Beta", "été", "x1", "of", "the"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate([14, 25, 10, 11, 40])]
    items += [(20, "Of x1 the!"), (21, "zeta"), (22, ""), (23, None), (20, items[0][1]), (24, "été " * 12)]
    docs = []
    for i in range(60):
        base = [rng.choice(vocab) for _ in range(rng.randrange(0, 40))]
        item = words(rng.choice(items)[1])
        a = rng.randrange(0, len(item) + 1)
        at = rng.randrange(0, len(base) + 1)
        docs.append((i, ", ".join(base[:at] + item[a:a + rng.randrange(5, 15)] + base[at:])))
    docs += [(90, None), (91, ""), (92, "..."), (5, docs[5][1]), (None, docs[6][1]), (6, "été " * 400), (93, "ZETA")]
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, th string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.find_contamination(d, b).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got), key=str) == brute_contamination(docs, items)
    clean = decontam.drop_contaminated(d, b)
    assert clean.columns == d.columns
    want = sorted(((i, t) for (i, t), in zip(docs) if not brute_contamination([(i, t)], items)[0][2]), key=str)
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == want
    assert {r.n_hit for r in decontam.find_contamination(d, b.limit(0)).collect()} == {0}
    assert decontam.find_contamination(d.limit(0), b).count() == 0


def brute_components(rows, k, num, den):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        m = min(k, len(w))
        sets.append((i, {tuple(w[s:s + m]) for s in range(len(w) - m + 1)} if w else set()))
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if x and y and den * len(x & y) >= num * len(x | y):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return sorted((i, len(s), find(i)) for i, s in sets)


@pytest.mark.parametrize(("k", "num", "den"), [(4, 85, 100), (5, 80, 100), (1, 60, 100)])
def test_ngram_components(spark, k, num, den):
    rng = random.Random(k)
    vocab = [f"w{i}" for i in range(60)]
    common = " ".join(rng.choice(vocab) for _ in range(30))
    rows = []
    for g in range(12):
        base = [rng.choice(vocab) for _ in range(rng.randrange(20, 60))]
        for _ in range(rng.choice([1, 2, 8, 25])):
            w = list(base)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            text = " ".join(w) if g % 3 else f"{common} {' '.join(w)}"
            rows.append((len(rows) * 3 % 1009, rng.choice([text, text.upper(), text.replace(" ", "\n")])))
    rows += [(2000, None), (2001, ""), (2002, "  \t"), (2003, "one two"), (2004, "One two"), (2005, " one two")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    got = ngram_join.jaccard_components(df, k=k, num=num, den=den).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, k, num, den)


def test_ngram_links_are_all_similar_pairs(spark):
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(80)]
    rows = [(9000, None), (9001, " "), (None, "a b c d e")]
    for g in range(14):
        base = [rng.choice(vocab) for _ in range(rng.randrange(40, 160))]
        for _ in range(rng.choice([1, 3, 12])):
            w = list(base)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, rep string")
    links, members = ngram_join.similar_links(df, k=4, num=80, den=100)
    sets = {i: {tuple(w[s:s + 4]) for s in range(len(w) - 3)} for i, t in rows if i is not None and t and (w := t.split())}
    low = {i: min(j for j in sets if sets[j] == sets[i]) for i in sets}
    got = {r.doc_id: (r.rep, r.n_shingles) for r in members.collect()}
    assert got == {i: (low[i], len(sets[i])) for i in sets} | {None: (None, 2)}
    want = sorted((a, b) for a in set(low.values()) for b in set(low.values())
                  if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    assert sorted((r.a, r.b) for r in links.collect()) == want and len(want) > 30


def test_ngram_join_edges(spark):
    data = [(3, "a b c d e"), (5, "a b c d e"), (5, "v w x y z"), (4, "v w x y z"), (None, "a b c d e"), (None, "q q q q q"), (7, "")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df).collect()), key=str)
    assert got == sorted([(3, 2, 3), (5, 2, 3), (5, 2, 3), (4, 2, 3), (None, 2, 3), (None, 1, None), (7, 0, 7)], key=str)
    assert ngram_join.jaccard_components(df.limit(0)).count() == 0


def test_one_of_each_loses_no_document(spark):
    near = " ".join(f"w{i}" for i in range(40))
    data = [(1, "x1 x2 x3 x4 x5 x6"), (1, "y1 y2 y3 y4 y5 y6"), (1, "y1 y2 y3 y4 y5 y6"), (3, "a b c d e"), (5, "a b c d e"),
            (5, "v w x y z"), (4, "v w x y z"), (None, "a b c d e"), (None, "q q q q q"), (None, near), (9, near + " w40"),
            (7, ""), (None, None), (None, None), (8, " ")]
    df = spark.createDataFrame([(i, t, "s", n) for n, (i, t) in enumerate(data)], "doc_id long, text string, source string, n_shingles int")
    kept = ngram_join.keep_one_of_each(df.repartition(3))
    assert kept.columns == df.columns
    want = [(1, data[0][1]), (1, data[1][1]), (3, "a b c d e"), (4, "v w x y z"), (None, "q q q q q"), (9, near + " w40"), (7, ""),
            (None, None), (None, None), (8, " ")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    plain = spark.createDataFrame([(3, near), (2, near + " w40"), (1, ""), (0, None), (6, "a b")], "doc_id long, text string")
    assert sorted(r.doc_id for r in ngram_join.keep_one_of_each(plain).collect()) == [0, 1, 2, 6]
    assert ngram_join.keep_one_of_each(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(400 + i, 401 + i) for i in range(60)] + [(1, None)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges[:-1] for n in e}
    for _ in range(400):
        for a, b in edges[:-1]:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: r for n, r in root.items() if any(n in e and e[0] != e[1] for e in edges[:-1])}


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.4, (150, 16)) for c in rng.normal(0, 1, (8, 16))])
    x[100:160] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5100, [None] * 16)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = ann.search(df, df.filter("vec_id % 100 = 0"), k=10).collect()
    right = total = 0
    for q in range(0, 1200, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [int(i) for i in np.lexsort((np.arange(len(x)), d)) if i != q][:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in mine] == list(range(1, 11))
        assert all(abs(s - d[v]) < 1e-9 for _, v, s in mine)
        assert [(s, v) for _, v, s in mine] == sorted((s, v) for _, v, s in mine)
        right += len(set(order) & {v for _, v, _ in mine})
        total += 10
    assert right / total >= 0.9 and {r.query_id for r in got} == set(range(0, 1200, 100))
    same = [r.vec_id for r in sorted((r for r in got if r.query_id == 100), key=lambda r: r["rank"])]
    assert same == list(range(101, 111))


def test_nearest_neighbours_recall_over_hundreds_of_lists(spark, monkeypatch):
    x = np.random.default_rng(6).normal(0, 1, (8_000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    fit, sizes = ann.fit_centroids, []

    def small_lists(vectors):
        sizes.append(len((graph := fit(vectors, list_size=16)).centroids))
        return graph

    monkeypatch.setattr(ann, "fit_centroids", small_lists)
    queries = df.filter("vec_id % 100 = 0")
    got = sorted(map(tuple, ann.search(df, queries, k=10).collect()))
    right = 0
    for q in range(0, 8_000, 100):
        d = ((x - x[q]) ** 2).sum(1)
        right += len(set(np.argsort(d)[1:11].tolist()) & {v for i, _, v, _ in got if i == q})
    assert sizes[0] >= 400 and right / 800 >= 0.97  # 48 lists of a query: 0.92
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    assert sorted(map(tuple, ann.search(df, queries, k=10).collect())) == got


def test_nearest_neighbours_small(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [2.0, 0.0])], "vec_id long, embedding array<float>")
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in ann.search(df, df.filter("vec_id = 0")).collect()]
    assert sorted(got) == [(0, 1, 2, 1.0), (0, 2, 1, 1.414214)]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0


def test_nearest_neighbours_of_repeated_rows(spark):
    """Rows that repeat an id, a vector or both are candidates and queries of their own."""
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(41)]
    rows += [rows[1], (1, rows[7][1]), (0, rows[0][1]), (0, rows[20][1]), (50, [1.0, 2.0]), (60, [3.0]), (None, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, df.filter("vec_id < 2"), k=3).collect()
    want = []
    fit = [(n, i, np.array(v)) for n, (i, v) in enumerate(rows) if i is not None and len(v) == 4]
    for n, i, v in fit:
        if i < 2:
            # of rows of one id and vector it does not matter which is whose own
            near = sorted((float(np.sqrt(((v - u) ** 2).sum())), j) for m, j, u in fit if m != n)[:3]
            want += [(i, r + 1, j, round(s, 9)) for r, (s, j) in enumerate(near)]
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got) == sorted(want)


def test_centroid_graph_finds_near_centroids():
    rng = np.random.default_rng(3)
    graph = ann.CentroidGraph(rng.normal(size=(900, 24)))
    right = 0
    for q in rng.normal(size=(40, 24)):
        at, d = graph.search(q, 60)
        exact = graph.place(q[None, :], 60)
        assert (np.diff(d) >= 0).all() and len(set(at.tolist())) == 60
        right += len(set(at.tolist()) & set(exact[0][0].tolist()))
    assert right / 2400 > 0.97


def test_license_scan_finds_edited_notices_at_the_bound(spark):
    w = words(license.NOTICES["mit"])
    n = len(w) - 4

    def doc(seed):  # four fifths of the notice, then other words; 20 bands missed both
        rng = random.Random(seed)
        other = lambda m: [f"w{rng.randrange(10**9)}" for _ in range(m)]
        return " ".join(other((n // 4) * rng.randrange(3)) + w[:-(-8 * n // 10) + 4] + other(60))

    df = spark.createDataFrame([(i, doc(i)) for i in (8394, 9276)], "doc_id long, text string")
    got = license.scan_licenses(df, license.default_templates(spark).filter("license = 'mit'")).collect()
    assert {r.doc_id for r in got if r.containment >= 0.8} == {8394, 9276}


def test_license_scan(spark):
    rng = random.Random(9)
    filler = lambda n: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"]) for _ in range(n))
    docs, want = [], {}
    names = list(license.NOTICES)
    for i, name in enumerate(names * 3):
        docs.append((i, f"{filler(rng.randrange(0, 200))}\n{license.NOTICES[name].upper()}\n{filler(rng.randrange(0, 200))}"))
        want[i] = name
    docs += [(900, None), (901, ""), (902, filler(500)), (903, "Released under the BSD licence"), (None, "Released under the MIT License.")]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, license string")
    got = license.scan_licenses(df, license.default_templates(spark)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, {})[r.license] = r
    assert set(by) == {*want, None}
    for i, name in want.items():
        r = by[i][name]
        text = words(dict(docs)[i])
        template = words(license.NOTICES[name])
        shingles = lambda w: {tuple(w[s:s + 5]) for s in range(len(w) - 4)}
        window = shingles(text[r.first_word:r.first_word + r.n_words])
        assert r.containment == 1.0 == len(window & shingles(template)) / len(shingles(template))
    assert license.scan_licenses(df.limit(0), license.default_templates(spark)).count() == 0
    assert license.scan_licenses(df, license.default_templates(spark).limit(0)).count() == 0


KEY = "k"


def feistel(v, a, b, kind):
    x, y = divmod(v, b)
    f = lambda i, half, m: int(hashlib.sha256(f"{KEY}|{kind}|{i}|{m}|{half}".encode()).hexdigest()[:12], 16) % m
    for i in range(pii.ROUNDS):
        if i % 2 == 0:
            x = (x + f(i, y, a)) % a
        else:
            y = (y + f(i, x, b)) % b
    return x * b + y


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10


def test_pii(spark):
    card, bad = "4111 1111 1111 1111", "4111 1111 1111 1112"
    day, other = date(2024, 2, 29), "2023-02-29"
    text = (f"Mail a.b@mail1.example.com, or +1 (017) 555-7713; {card} not {bad}. From 10.0.0.255, not 10.0.0.256. "
            f"On {day} (29/02/2024), not {other}; 536-22-1234. Again a.b@mail1.example.com")
    rows = spark.createDataFrame([(1, text, 1), (2, "clean text 12 of 1,000", 1), (3, None, 1), (4, "", 1), (1, text, 1)],
                                 "doc_id long, text string, pii int")
    got = pii.pseudonymise(rows, KEY).collect()
    assert len(got) == 5 and [r.text for r in got if r.doc_id in (2, 4)] == ["clean text 12 of 1,000", ""]
    assert [(r.text, r.pii) for r in got if r.doc_id == 3] == [(None, [])]
    one, again = (r for r in got if r.doc_id == 1)
    assert one == again
    assert [p.kind for p in one.pii] == ["email", "phone", "card", "ipv4", "date", "date", "ssn", "email"]
    values = [p.value for p in one.pii]
    assert values[0] == values[-1] and values[0].endswith("@mail.invalid")
    phone = f"{feistel(175557713, 10**5, 10**5, 'phone'):010d}"
    assert values[1] == f"+1 ({phone[:3]}) {phone[3:6]}-{phone[6:]}"
    payload = f"{feistel(411111111111111, 10**7, 10**8, 'card'):015d}"
    digits = values[2].replace(" ", "")
    assert digits[:-1] == payload and luhn(digits) == 0 and [len(g) for g in values[2].split()] == [4] * 4
    ip = feistel(10 * 2**24 + 255, 2**16, 2**16, "ipv4")
    assert values[3] == ".".join(str(ip >> s & 255) for s in (24, 16, 8, 0))
    moved = date(1700, 1, 1) + timedelta(feistel((day - date(1700, 1, 1)).days, 189, 773, "date"))
    assert values[4] == str(moved) and values[5] == moved.strftime("%d/%m/%Y")
    want = text
    for old, new in zip(["a.b@mail1.example.com", "+1 (017) 555-7713", card, "10.0.0.255", str(day), "29/02/2024", "536-22-1234"], values):
        want = want.replace(old, new)
    assert one.text == want
    assert pii.pseudonymise(rows.limit(0), KEY).count() == 0


def test_feistel_is_a_permutation(spark):
    got = spark.range(189 * 7).select(pii.feistel(F.col("id"), F.lit(189), F.lit(7), KEY, "t").alias("v")).distinct()
    assert got.count() == 189 * 7 and got.agg(F.min("v"), F.max("v")).first() == (0, 189 * 7 - 1)
