"""Language ID (6): word-first backoff.

A text is scored word by word: a known word adds its log frequency in every language;
an unseen word falls back to its character n-grams, longest length first, and takes the
first length of which the model knows any. Frequencies come from all learning rows.

The model is two tables without a cap. With ``n`` the count of a word in a language, its
log frequency is ``log(2n + 1)`` plus a base of the language, so that a word's row holds
only the languages that know it. A model counted as small is gathered and sent to the
tasks; a larger one is joined: documents are dealt into blocks, each block asks for its
distinct words once, in one packed row for each bucket of words, and one packed answer for
each of them returns to the block. The table of words lies in the same buckets.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ID, id_and_text, letters, row_slices, ship_package, staged, text_slices
from tessera.session import staged_by

UNDETERMINED = "und"
#: A model of at most so many words and n-grams, and numbers in all their rows, is
#: gathered; a larger one is joined.
SMALL_ROWS, SMALL_CELLS = 250_000, 4_000_000
#: N-grams, and numbers in all their rows, up to which those are gathered for a joined model.
GRAM_ROWS, GRAM_CELLS = 2_000_000, 16_000_000
#: Buckets of words, and a block's answer for one is a row.
WORD_BUCKETS = 1_024
#: A block's characters, rows and numbers of its score table; unseen words of a bucket.
BLOCK_CHARS, BLOCK_ROWS, CELLS, BUCKET = 24_000_000, 20_000, 4_000_000, 20_000
LENGTHS = (4, 3, 2, 1)
FLUSH = 300_000
MEMO_ENTRIES = 300_000


def word_counts(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``(lang, word, n)`` over all rows with a language."""
    return _word_parts(df, text_col, lang_col).groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _bucket(word: Column) -> Column:
    return F.pmod(F.crc32(word.cast("binary")), F.lit(WORD_BUCKETS)).cast("int")


def _word_parts(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Parts of :func:`word_counts`: combined within each task before the shuffle, so a hot
    language or word is a few rows per task."""
    ship_package(df.sparkSession)
    rows = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))

    def flush(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            merged: Counter = Counter()
            for token, n in c.items():
                if word := letters(token):
                    merged[word] += n
            if merged:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(merged)), pa.array(list(merged)), pa.array(list(merged.values()), pa.int64())],
                    names=["lang", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for b in row_slices(batches):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                counts.setdefault(lang, Counter()).update(text.split())
                if sum(map(len, counts.values())) > FLUSH:
                    yield from flush(counts)
                    counts = {}
        yield from flush(counts)

    return (rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
            .mapInArrow(run, "lang string, word string, n bigint"))


def _grams(word: str, k: int) -> list[str]:
    """Character n-grams; a blank marks both ends of a word for lengths over one."""
    text = f" {word} " if k > 1 else word
    return [text[i:i + k] for i in range(len(text) - k + 1)]


def gram_counts(words: DataFrame) -> DataFrame:
    """``(lang, gram, n)``: character n-grams of the counted words, weighted by count."""

    def flush(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(c)), pa.array(list(c)), pa.array(list(c.values()), pa.int64())],
                names=["lang", "gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for b in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                c = counts.setdefault(lang, Counter())
                for k in LENGTHS:
                    for g in _grams(word, k):
                        c[g] += n
            if sum(map(len, counts.values())) > FLUSH:
                yield from flush(counts)
                counts = {}
        yield from flush(counts)

    return (words.select("lang", "word", "n").mapInArrow(run, "lang string, gram string, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


class BackoffModel:
    """Log frequencies by language of known words and n-grams, in memory."""

    def __init__(self, langs: list[str], words: dict[str, np.ndarray], grams: dict[str, np.ndarray]):
        self.langs = langs
        width = len(langs)
        self.word_at = {w: i for i, w in enumerate(words)}
        self.gram_at = {g: i for i, g in enumerate(grams)}
        self.word_rows = np.array(list(words.values()), dtype=float).reshape(len(words), width)
        self.gram_rows = np.array(list(grams.values()), dtype=float).reshape(len(grams), width)

    def scores(self, words: list[str]) -> np.ndarray:
        """Log score of each word in every language; zeros if not even a character of
        it is known. An unseen word has the mean of its longest known n-grams."""
        out = np.zeros((len(words), len(self.langs)))
        seen = [(i, k) for i, w in enumerate(words) if (k := self.word_at.get(w)) is not None]
        if seen:
            at = np.array(seen)
            out[at[:, 0]] = self.word_rows[at[:, 1]]
        rows, flat, starts = [], [], []
        for i, w in enumerate(words):
            if w in self.word_at:
                continue
            for k in LENGTHS:
                found = [g for x in _grams(w, k) if (g := self.gram_at.get(x)) is not None]
                if found:
                    rows.append(i)
                    starts.append(len(flat))
                    flat += found
                    break
        if rows:
            sums = np.add.reduceat(self.gram_rows[flat], starts, axis=0)
            out[rows] = sums / np.diff([*starts, len(flat)])[:, None]
        return out


@dataclass
class StagedModel:
    """Tables ``(bucket, word, langs, counts, rows)``, in buckets, and ``(gram, langs, rows)``:
    for each word and n-gram the languages that know it (of n-grams their positions in
    ``langs``) and ``log(2n + 1)`` of its counts there; ``word_base`` and ``gram_base`` by
    language complete the log frequencies."""

    langs: list[str]
    words: DataFrame
    grams: DataFrame
    n_words: int
    n_grams: int
    word_base: np.ndarray
    gram_base: np.ndarray

    def small(self) -> bool:
        n = self.n_words + self.n_grams
        return n <= SMALL_ROWS and n * len(self.langs) <= SMALL_CELLS

    def gather(self) -> BackoffModel:
        """The whole model in memory, for a small one."""
        words = self.words.select("word", "langs", "rows").toArrow().combine_chunks()
        words = words.set_column(1, "langs", _places(words.column("langs").combine_chunks(), self.langs))
        return BackoffModel(self.langs, _rows(words, self.word_base), _rows(self.grams.toArrow(), self.gram_base))

    def gather_grams(self) -> tuple[pa.Array, np.ndarray] | None:
        """All n-grams and their rows without the base; None if they are too many."""
        if self.n_grams > GRAM_ROWS or self.n_grams * len(self.langs) > GRAM_CELLS:
            return None
        t = self.grams.toArrow()
        return t.column("gram").combine_chunks().cast(pa.string()), _dense(t, len(self.langs))


def _rows(t: pa.Table, base: np.ndarray) -> dict[str, np.ndarray]:
    return dict(zip(t.column(0).to_pylist(), _dense(t, len(base)) + base, strict=True))


def _places(named: pa.ListArray, langs: list[str]) -> pa.ListArray:
    """Lists of languages as lists of their positions in ``langs``."""
    at = pc.index_in(named.flatten().cast(pa.string()), value_set=pa.array(langs, pa.string()))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(named.value_lengths())]), pa.int32()), at)


def _dense(t: pa.Table, width: int) -> np.ndarray:
    """The list columns ``langs`` and ``rows`` as one row of ``width`` numbers each."""
    out = np.zeros((t.num_rows, width))
    if t.num_rows:
        langs, rows = t.column("langs").combine_chunks(), t.column("rows").combine_chunks()
        lengths = langs.value_lengths().to_numpy(zero_copy_only=False)
        out[np.repeat(np.arange(t.num_rows), lengths), langs.flatten().to_numpy()] = rows.flatten().to_numpy()
    return out


def fit_backoff(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> StagedModel:
    """Learn from all rows of ``df`` with a text and a language: every language, word and
    n-gram is kept. Words cross one exchange, by bucket. The driver receives one row for each
    language."""
    row = F.log(2.0 * F.col("n") + 1.0).alias("row")
    parts = _word_parts(df, text_col, lang_col).withColumn("bucket", _bucket(F.col("word"))).repartition("bucket")
    known = (parts.groupBy("bucket", "word", "lang").agg(F.sum("n").alias("n"))
             .groupBy("bucket", "word").agg(F.collect_list(F.struct("lang", "n", row)).alias("known")))
    words = staged_by(known.select("bucket", "word", F.col("known.lang").alias("langs"), F.col("known.n").alias("counts"),
                                   F.col("known.row").alias("rows")), "langid_words", "bucket")
    counted = words.select("word", F.inline(F.arrays_zip(F.col("langs").alias("lang"), F.col("counts").alias("n"))))
    grams = staged(gram_counts(counted), "langid-grams")

    def totals(counts: DataFrame) -> dict[str, int]:
        return {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}

    in_words, in_grams = totals(counted), totals(grams)
    langs = sorted(in_words)
    places = F.broadcast(df.sparkSession.createDataFrame([(x, i) for i, x in enumerate(langs)], "lang string, place int"))
    known = grams.join(places, "lang").groupBy("gram").agg(F.collect_list(F.struct("place", row)).alias("known"))
    grams = staged(known.select("gram", F.col("known.place").alias("langs"), F.col("known.row").alias("rows")), "langid-gram-rows")

    def base(totals: dict[str, int], known: int) -> np.ndarray:
        return np.log(0.5 / (np.array([totals.get(x, 0) for x in langs], dtype=float) + 0.5 * (known + 1)))

    n_words, n_grams = words.count(), grams.count()
    return StagedModel(langs, words, grams, n_words, n_grams, base(in_words, n_words), base(in_grams, n_grams))


def predict_language(df: DataFrame, model: StagedModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, lang_pred, score)``, one row for each input row. ``und`` with score 0
    if the text is null or has no letter, or the model knows no language; else the
    language of the highest sum of log scores (ties: the first in text order) with its
    posterior probability under equal priors. Whole texts are scored."""
    source = id_and_text(df, id_col, text_col)
    id_type = source.schema[ID].dataType.simpleString()
    if not model.small():
        return _predict_joined(source, model, id_col, id_type)
    shared = df.sparkSession.sparkContext.broadcast(model.gather())  # counted: SMALL_ROWS, SMALL_CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        width = len(m.langs)
        table = np.zeros((0, width + 1))  # last column: 1 for a token with letters
        row_of: dict[str, int] = {}
        for b in row_slices(batches):
            preds, scores = [], []
            for part in text_slices(b.column(1).to_pylist()):
                texts = [t.split() for t in part]
                if len(row_of) > MEMO_ENTRIES:
                    row_of, table = {}, table[:0]
                new = sorted({t for tokens in texts for t in tokens}.difference(row_of))
                if new:
                    words = list(map(letters, new))
                    rows = np.column_stack([m.scores(words), np.array([bool(w) for w in words], dtype=float)])
                    row_of.update(zip(new, range(len(table), len(table) + len(new)), strict=True))
                    table = np.concatenate([table, rows])
                for tokens in texts:
                    at = np.fromiter(map(row_of.__getitem__, tokens), np.intp, count=len(tokens))
                    total = table.take(at, axis=0).sum(axis=0)
                    pred, score = _best(m.langs, total[:width], total[width] > 0)
                    preds.append(pred)
                    scores.append(score)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                                             names=[id_col, "lang_pred", "score"])

    return source.mapInArrow(run, f"`{id_col}` {id_type}, lang_pred string, score double")


def _best(langs: list[str], total: np.ndarray, lettered: bool) -> tuple[str, float]:
    if not langs or not lettered:
        return UNDETERMINED, 0.0
    best = int(np.argmax(total))
    return langs[best], 1.0 / math.fsum(np.exp(np.clip(total - total[best], -700, 0)))


def _pack(*arrays: np.ndarray) -> bytes:
    """Number arrays as compressed bytes, the first bytes of all numbers first."""
    raw = b"".join(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    return np.array([len(raw), *map(len, arrays)], np.int64).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _unpack(packed: bytes, *dtypes: type) -> list[np.ndarray]:
    head = 8 * (len(dtypes) + 1)
    size, *lengths = np.frombuffer(packed[:head], np.int64).tolist()
    raw, at, out = np.frombuffer(pa.decompress(packed[head:], size, "zstd", asbytes=True), np.uint8), 0, []
    for n, t in zip(lengths, map(np.dtype, dtypes), strict=True):
        out.append(np.ascontiguousarray(raw[at:at + n * t.itemsize].reshape(t.itemsize, n).T).reshape(-1).view(t))
        at += n * t.itemsize
    return out


def _pack_words(words: list[str]) -> bytes:
    raw = "\n".join(words).encode()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpack_words(packed: bytes) -> list[str]:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True).decode().split("\n")


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Texts as blocks of at most about ``BLOCK_CHARS`` characters and ``rows`` rows: one
    row with the ids and the packed (word, row, count) of the block, and one row for each
    bucket of its distinct words, which are numbered from ``at`` on by bucket."""
    part = TaskContext.get().partitionId()
    names = ["block", "at", "bucket", "ids", "packed"]
    made = 0

    def flush(ids: list[pa.Array], word_at: dict[str, int], tokens: list[np.ndarray], owners: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        block = (part << 32) | made
        words = list(word_at)
        bucket = np.fromiter((zlib.crc32(w.encode()) % WORD_BUCKETS for w in words), np.int32, count=len(words))
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        pair, n = np.unique((place[np.concatenate(tokens)] << 32) | np.concatenate(owners), return_counts=True)
        steps = [np.diff(x.astype(np.int32), prepend=np.int32(0)) for x in (pair >> 32, pair & 0xFFFFFFFF)]
        held = pa.concat_arrays(ids)
        held = pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held)
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([-1], pa.int32()), pa.array([None], pa.int32()), held,
                                          pa.array([_pack(*steps, n.astype(np.int32))], pa.binary())], names=names)
        asked, at = np.unique(bucket[order], return_index=True)
        ends = [*at[1:].tolist(), len(words)]
        if len(asked):
            packed = [_pack_words([words[i] for i in order[lo:hi]]) for lo, hi in zip(at.tolist(), ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * len(asked), pa.int64()), pa.array(at, pa.int32()), pa.array(asked, pa.int32()),
                 pa.nulls(len(asked), held.type), pa.array(packed, pa.binary())], names=names)

    ids: list[pa.Array] = []
    word_at: dict[str, int] = {}
    place: dict[str, int] = {}
    tokens: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    size = held = 0
    for b in row_slices(batches, min(rows, 1_000)):
        at = 0
        for run in text_slices(b.column(1).to_pylist()):
            split = [t.split() for t in run]
            for t in {t for s in split for t in s}.difference(place):
                w = letters(t)
                place[t] = word_at.setdefault(w, len(word_at)) if w else -1
            for k, s in enumerate(split):
                x = np.fromiter(map(place.__getitem__, s), np.int64, count=len(s))
                x = x[x >= 0]
                tokens.append(x)
                owners.append(np.full(len(x), held + k, np.int64))
            ids.append(b.column(0).slice(at, len(run)))
            at += len(run)
            held += len(run)
            size += sum(map(len, run))
            if size > BLOCK_CHARS or held + min(rows, 1_000) > rows:
                yield from flush(ids, word_at, tokens, owners)
                made += 1
                ids, word_at, place, tokens, owners, size, held = [], {}, {}, [], [], 0, 0
    if held:
        yield from flush(ids, word_at, tokens, owners)


def _unseen_rows(words: DataFrame, model: StagedModel) -> DataFrame:
    """``(word, langs, rows)`` of unseen words of which a character is known: the means of
    their longest known n-grams. Words go into buckets; each asks for its n-grams once."""
    langs, width = model.langs, len(model.langs)
    words = staged(words, "langid-unseen")
    buckets = max(1, math.ceil(words.count() / max(1, min(BUCKET, 20 * BUCKET // width))))
    words = words.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)))

    def ask(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        grams = sorted({g for w in t.column("word").to_pylist() for k in LENGTHS for g in _grams(w, k)})
        return pa.table({"bucket": pa.array([key[0].as_py()] * len(grams), pa.int64()), "gram": pa.array(grams, pa.string())})

    def score(t: pa.Table, g: pa.Table) -> pa.Table:
        unseen = t.column("word").to_pylist()
        got = BackoffModel(langs, {}, dict(zip(g.column("gram").to_pylist(), _dense(g, width), strict=True))).scores(unseen)
        at, cols = np.nonzero(got)
        n = np.bincount(at, minlength=len(unseen))
        ends = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        out = pa.table({"word": pa.array(unseen, pa.string()), "langs": pa.ListArray.from_arrays(ends, pa.array(cols, pa.int32())),
                        "rows": pa.ListArray.from_arrays(ends, pa.array(got[at, cols], pa.float64()))})
        return out.filter(pa.array(n > 0))

    asked = words.groupBy("bucket").applyInArrow(ask, "bucket bigint, gram string")
    found = asked.join(model.grams, "gram").select("bucket", "gram", "langs", "rows")
    return words.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(score, "word string, langs array<int>, rows array<double>")


def _gram_rows(words: list[str], grams: pa.Array, rows: np.ndarray) -> np.ndarray:
    """As :meth:`BackoffModel.scores` of unseen words; ``rows`` are those of ``grams``."""
    out = np.zeros((len(words), rows.shape[1]))
    left = np.arange(len(words))
    for k in LENGTHS:
        cut = [_grams(words[i], k) for i in left.tolist()]
        owner = np.repeat(np.arange(len(left)), list(map(len, cut)))
        at = pc.index_in(pa.array([g for c in cut for g in c], pa.string()), value_set=grams)
        found = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        at, owner = at.fill_null(0).to_numpy()[found], owner[found]
        if not len(at):
            continue
        has, starts, n = np.unique(owner, return_index=True, return_counts=True)
        out[left[has]] = np.add.reduceat(rows[at], starts, axis=0) / n[:, None]
        left = np.delete(left, has)
        if not len(left):
            break
    return out


def _sparse(rows: np.ndarray) -> tuple[pa.ListArray, pa.ListArray]:
    """The positions and values of the numbers other than zero of each row."""
    at, cols = np.nonzero(rows)
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(rows)))]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(cols, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(rows[at, cols], pa.float64()))


def _predict_joined(source: DataFrame, model: StagedModel, id_col: str, id_type: str) -> DataFrame:
    langs, width = model.langs, len(model.langs)
    word_base, gram_base = model.word_base, model.gram_base
    rows = max(1, min(BLOCK_ROWS, CELLS // width))
    blocks = staged(source.mapInArrow(lambda batches: _blocks(batches, rows),
                                      f"block bigint, at int, bucket int, ids array<{id_type}>, packed binary"), "langid-blocks")
    asked = blocks.filter("at >= 0").select("block", "at", "bucket", "packed")
    known = model.words.select("bucket", "word", "langs", "rows")
    gathered = model.gather_grams()
    grams = source.sparkSession.sparkContext.broadcast(gathered) if gathered else None  # counted: GRAM_ROWS, GRAM_CELLS
    if not gathered:
        def missing(a: pa.Table, k: pa.Table) -> pa.Table:
            words = {w for p in a.column("packed").to_pylist() for w in _unpack_words(p)}.difference(k.column("word").to_pylist())
            return pa.table({"word": pa.array(sorted(words), pa.string())})

        unseen = asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(missing, "word string")
        by_gram = staged(_unseen_rows(unseen, model).withColumn("bucket", _bucket(F.col("word"))), "langid-unseen-rows")
        names = F.array(*map(F.lit, langs))
        by_gram = by_gram.select("bucket", "word", F.transform("langs", lambda x: F.get(names, x)).alias("langs"), "rows")
        known = known.withColumn("seen", F.lit(True)).unionByName(by_gram.withColumn("seen", F.lit(False)))
    flagged = not gathered

    def answer(a: pa.Table, k: pa.Table) -> pa.Table:
        """For each block's words of a bucket, packed: how they are known (1: as words, 2: by
        n-grams, 0: not at all), by how many languages, by which, and their rows."""
        if not a.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "at": pa.array([], pa.int32()), "packed": pa.array([], pa.binary())})
        lists = list(map(_unpack_words, a.column("packed").to_pylist()))
        words = pa.array([w for x in lists for w in x], pa.string())
        names, by, values = (k.column(c).combine_chunks() for c in ("word", "langs", "rows"))
        by = _places(by, langs)
        values = pa.ListArray.from_arrays(by.offsets, values.flatten())
        kind = np.where(k.column("seen").to_numpy(), 1, 2) if flagged else np.ones(k.num_rows)
        at = pc.index_in(words, value_set=names.cast(pa.string()))
        if grams is not None and at.null_count:
            unseen = words.filter(at.is_null()).unique()
            more = _sparse(_gram_rows(unseen.to_pylist(), *grams.value))
            at = pc.coalesce(at, pc.add(pc.index_in(words, value_set=unseen), len(names)))
            kind = np.concatenate([kind, np.where(more[0].value_lengths().to_numpy() > 0, 2, 0)])
            by, values = pa.concat_arrays([by, more[0]]), pa.concat_arrays([values, more[1]])
        # the last row is that of words that nothing is known of
        kind = np.concatenate([kind, [0]]).astype(np.int8)
        none = pa.array([0, 0], pa.int32())
        by = pa.concat_arrays([by, pa.ListArray.from_arrays(none, pa.array([], pa.int32()))])
        values = pa.concat_arrays([values, pa.ListArray.from_arrays(none, pa.array([], pa.float64()))])
        at, lo, packed = at.fill_null(len(kind) - 1), 0, []
        for x in lists:
            part = at.slice(lo, len(x))
            lo += len(x)
            which, what = by.take(part), values.take(part)
            packed.append(_pack(kind[part.to_numpy()], which.value_lengths().to_numpy(), which.flatten().to_numpy(), what.flatten().to_numpy()))
        return pa.table({"block": a.column("block"), "at": a.column("at"), "packed": pa.array(packed, pa.binary())})

    found = asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(answer, "block bigint, at int, packed binary")

    def score(b: pa.Table, f: pa.Table) -> pa.Table:
        ids = b.column("ids").combine_chunks().flatten()
        word, row, n = _unpack(b.column("packed")[0].as_py(), np.int32, np.int32, np.int32)
        word, row = np.cumsum(word), np.cumsum(row)
        total, lettered = np.zeros((len(ids), width)), np.zeros(len(ids), bool)
        lettered[row] = True
        step = max(1, CELLS // width)
        for at, packed in zip(f.column("at").to_pylist(), f.column("packed").to_pylist(), strict=True):
            kind, size, which, what = _unpack(packed, np.int8, np.int32, np.int32, np.float64)
            ends = np.concatenate([[0], np.cumsum(size)])
            for lo in range(0, len(kind), step):
                hi = min(lo + step, len(kind))
                dense, s = np.zeros((hi - lo, width)), slice(ends[lo], ends[hi])
                dense[np.repeat(np.arange(hi - lo), size[lo:hi]), which[s]] = what[s]
                dense[kind[lo:hi] == 1] += word_base
                dense[kind[lo:hi] == 2] += gram_base
                # pairs lie in the order of their words
                first, last = np.searchsorted(word, [at + lo, at + hi])
                own, owner, count = word[first:last] - (at + lo), row[first:last], n[first:last]
                for x in range(width):
                    total[:, x] += np.bincount(owner, dense[own, x] * count, len(ids))
        best = [_best(langs, t, has) for t, has in zip(total, lettered, strict=True)]
        return pa.table({id_col: ids, "lang_pred": pa.array([p for p, _ in best], pa.string()), "score": pa.array([s for _, s in best], pa.float64())})

    held = blocks.filter("at < 0").select(F.col("block").alias("owner"), "ids", "packed")
    return held.groupBy("owner").cogroup(found.groupBy("block")).applyInArrow(
        score, f"`{id_col}` {id_type}, lang_pred string, score double")
