"""Cross-tokenizer alignment (12): lockstep vectorised merging.

Two tokenizers cut the same bytes into tokens. Where tokens of both end, the text is cut
into groups; tokens of one group are linked. All texts of a batch are merged at once: a
numpy state vector holds a pointer into either token list for every text, and each step
advances all of them, emits the pairs that overlap and the places where both end, and
drops the finished texts. A long text is several lanes of the vector, cut at tokens
that end together.

How many documents link an id pair is a statistic of the whole corpus. Tasks pack
the links of some MB of text as numbers of their distinct pairs; the packs ask a table of
all pairs once for each distinct one, and put the answers back by number.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.byte_bpe import AGREED, byte_bpe, load_tokenizer, piece_bytes
from tessera.llm.common import _SINGLE_SPACE, ID, TEXT, id_and_text, row_slices, spaced_pieces, staged

#: Tokens of a lane, characters that are tokens at a time, and characters of a pack.
LANE, SLICE_CHARS, PACK_CHARS = 256, 1_000_000, 8_000_000
#: Token pairs of a group up to which they are listed one by one.
LISTED = 4_096
_OTHER = re.compile(f"[^\\x00-{chr(ord(AGREED) - 1)}]")
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def lane_cuts(end_a: np.ndarray, end_b: np.ndarray, doc_a: np.ndarray, lane: int) -> tuple[np.ndarray, np.ndarray]:
    """Where lanes end: at the documents' ends (``doc_a``, in tokens of A), and at every
    ``lane``-th token of A that ends with a token of B."""
    at = np.union1d(doc_a, np.arange(lane, len(end_a), lane))
    at = at[at > 0]
    to = np.searchsorted(end_b, end_a[at - 1])
    good = end_b[to] == end_a[at - 1]
    return np.concatenate([[0], at[good]]), np.concatenate([[0], to[good] + 1])


def merge_lockstep(end_a: np.ndarray, end_b: np.ndarray, from_a: np.ndarray, from_b: np.ndarray):
    """Merge all lanes at once. ``end_*`` are the tokens' byte ends over the whole batch,
    ``from_*`` the lanes' first tokens and, as last entry, the number of tokens; both
    ends of every lane agree. Returns the overlapping token pairs ``(i, j)`` in any order,
    and the pairs that end together ``(cut_i, cut_j)`` in the order of the tokens."""
    i, j, last = from_a[:-1].copy(), from_b[:-1].copy(), from_a[1:]
    links, cuts = [], []
    while len(i):
        a, b = end_a[i], end_b[j]
        links.append((i, j))
        both = a == b
        cuts.append((i[both], j[both]))
        i, j = i + (a <= b), j + (b <= a)
        live = i < last
        if not live.all():
            i, j, last = i[live], j[live], last[live]
    none = (np.zeros(0, np.int64),) * 2
    i, j = map(np.concatenate, zip(*(links or [none]), strict=True))
    # no two cuts share a token, so each side can be sorted alone
    return (i, j, *(np.sort(np.concatenate(c)) for c in zip(*(cuts or [none]), strict=True)))


def group_links(a, b, i, j, cut_i, cut_j):
    """All links of tokens that share a group, as ``(token of A, id pair, times)``, from
    the overlapping pairs and the cuts: only groups with several tokens on both sides
    hold others. Very wide groups are folded to their distinct id pairs."""
    p, q = np.diff(cut_i, prepend=-1), np.diff(cut_j, prepend=-1)
    wide = (p > 1) & (q > 1)
    keep = ~wide[np.searchsorted(cut_i, i)]
    i, j = i[keep], j[keep]
    if wide.any():
        few = wide & (p * q <= LISTED)
        n, q_few = (p * q)[few], q[few]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        i = np.concatenate([i, np.repeat((cut_i - p + 1)[few], n) + at // np.repeat(q_few, n)])
        j = np.concatenate([j, np.repeat((cut_j - q + 1)[few], n) + at % np.repeat(q_few, n)])
    out = [(i, (a[i] << 32) | b[j], np.ones(len(i), np.int64))]
    for g in np.flatnonzero(wide & (p * q > LISTED)):
        x, nx = np.unique(a[cut_i[g] - p[g] + 1:cut_i[g] + 1], return_counts=True)
        y, ny = np.unique(b[cut_j[g] - q[g] + 1:cut_j[g] + 1], return_counts=True)
        key = ((x[:, None] << 32) | y).ravel()
        out.append((np.full(len(key), cut_i[g]), key, np.outer(nx, ny).ravel()))
    return tuple(map(np.concatenate, zip(*out, strict=True)))


class _Tokenizers:
    """Both tokenizers, with the bytes and the text of their ids."""

    def __init__(self, path_a: str, path_b: str):
        from tokenizers import Tokenizer

        self.fast, self.cuttable = byte_bpe(path_a).fast, byte_bpe(path_a).cuttable
        self.lib_a = Tokenizer.from_file(path_a)
        self.lib_a.no_truncation()
        self.lib_a.no_padding()
        self.lib_a.encode_special_tokens = True  # their strings are plain text
        self.lib_b = load_tokenizer(path_b)
        self.bytes_a = [b or b"" for b in piece_bytes(path_a)]
        pieces = [self.lib_b.id_to_piece(k) for k in range(self.lib_b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.lib_b.is_byte(k) else p.replace("▁", " ").encode()
                        for k, p in enumerate(pieces)]
        # no merge crosses a space between words if no piece holds one after another character
        self.cuttable = self.cuttable and not any("▁" in p.lstrip("▁") for p in pieces)
        self.sizes = [np.array([len(b) for b in t], np.int64) for t in (self.bytes_a, self.bytes_b)]
        text_a, text_b = ([str(k).encode() for k in range(len(t))] for t in (self.bytes_a, self.bytes_b))
        # ids in text, each before a separator: A inside and at the end of a side, then B
        self.shown = [t + s for t, s in ((text_a, b","), (text_a, b"|"), (text_b, b","), (text_b, b";")) for t in t]
        self.base = len(text_a), len(text_b)

    def _encode_a(self, text: str) -> list[int]:
        if self.fast and not _OTHER.search(text):
            return self.fast(" " + text)
        if not (self.fast and self.cuttable):
            return self.lib_a.encode(" " + text, add_special_tokens=False).ids
        # only the words with other characters need the file's own library
        out = []
        for word in spaced_pieces(text):
            out += self.fast(" " + word) if not _OTHER.search(word) else self.lib_a.encode(" " + word, add_special_tokens=False).ids
        return out

    def parts(self, text: str) -> list[tuple[list[int], list[int]]]:
        """Ids of the text (with a space before it) by A and B, in parts of bounded size
        where a cut is sure not to matter. No parts for a text without tokens."""
        if not text:
            return []
        found = [(self._encode_a(p), self.lib_b.encode(p, num_threads=1)) for p in self._cut(text)]
        data = (" " + text).encode()
        # byte-level merges of a text that nothing normalises lose no byte
        for side, table in ((1, self.bytes_b),) if self.cuttable else ((0, self.bytes_a), (1, self.bytes_b)):
            if b"".join([b"".join(map(table.__getitem__, f[side])) for f in found]) != data:
                return []
        return found

    def _cut(self, text: str) -> Iterator[str]:
        at = 0
        while True:
            far = self.cuttable and len(text) - at > SLICE_CHARS
            cut = _SINGLE_SPACE.search(text, at + SLICE_CHARS) if far else None
            yield text[at:cut.start()] if cut else text[at:]
            if not cut:
                return
            at = cut.end()


_TOKENIZERS: dict[tuple[str, str], _Tokenizers] = {}


def _tokenizers(path_a: str, path_b: str) -> _Tokenizers:
    if (path_a, path_b) not in _TOKENIZERS:
        _TOKENIZERS[path_a, path_b] = _Tokenizers(path_a, path_b)
    return _TOKENIZERS[path_a, path_b]


class _Pack:
    """Alignments of some documents: counts, group hashes, and links by pair."""

    def __init__(self, tokenizers: _Tokenizers):
        self.tok = tokenizers
        self.ids, self.counts, self.hashes, self.links = [], [], [], []
        self.chars = 0
        self._new()

    def _new(self):
        self.a, self.b, self.part_a, self.part_doc = [], [], [], []

    def add(self, key, text: str):
        doc = len(self.ids)
        self.ids.append(key)
        self.counts.append(np.zeros(len(COUNTS), np.int64))
        self.hashes.append(None)
        self.chars += len(text)
        for a, b in self.tok.parts(text):
            self.a += a
            self.b += b
            self.part_a.append(len(self.a))
            self.part_doc.append(doc)
            if len(self.a) * 3 > SLICE_CHARS:
                self.align()

    def align(self):
        """Align what is held; only its counts, hashes and links are kept."""
        if not self.a:
            return
        a, b = np.array(self.a, np.int64), np.array(self.b, np.int64)
        part_a, docs = np.array(self.part_a, np.int64), np.array(self.part_doc, np.int64)
        end_a, end_b = np.cumsum(self.tok.sizes[0][a]), np.cumsum(self.tok.sizes[1][b])
        i, j, cut_i, cut_j = merge_lockstep(end_a, end_b, *lane_cuts(end_a, end_b, part_a, LANE))
        doc_of = lambda token: docs[np.searchsorted(part_a, token, side="right")]
        p, q = np.diff(cut_i, prepend=-1), np.diff(cut_j, prepend=-1)
        first, doc = docs[0], doc_of(cut_i)
        for c, n in enumerate((p, q, np.ones(len(p), np.int64), p * q)):
            for k, total in enumerate(np.bincount(doc - first, weights=n).astype(np.int64).tolist()):
                self.counts[first + k][c] += total
        self._hash(a, b, p, q, cut_i, part_a)
        token, key, times = group_links(a, b, i, j, cut_i, cut_j)
        self.links.append((doc_of(token), key, times))
        self._new()

    def _hash(self, a, b, p, q, cut_i, part_a):
        """Continue the documents' digests of ``a1,a2|b1;...``: each token's text with the
        separator after it, all in the order A tokens, B tokens of one group after the other."""
        base_a, base_b = self.tok.base
        a_text, b_text = a.copy(), b + 2 * base_a
        a_text[cut_i] += base_a
        b_text[np.cumsum(q) - 1] += base_b
        group_a, group_b = np.repeat(np.arange(len(p)), p), np.repeat(np.arange(len(q)), q)
        line = np.empty(len(a) + len(b), np.int64)
        line[np.arange(len(a)) + (np.cumsum(q) - q)[group_a]] = a_text
        line[np.arange(len(b)) + np.cumsum(p)[group_b]] = b_text
        ends = np.concatenate([[0], np.cumsum(p + q)])[np.searchsorted(cut_i, part_a, side="left")]
        text, at = list(map(self.tok.shown.__getitem__, line.tolist())), 0
        for doc, end in zip(self.part_doc, ends.tolist(), strict=True):
            if end > at:
                piece = b"".join(text[at:end])[:-1]
                if self.hashes[doc] is None:
                    self.hashes[doc] = hashlib.sha256(piece)
                else:
                    self.hashes[doc].update(b";" + piece)
            at = end

    def _wide(self) -> bool:
        return len(self.ids).bit_length() + sum(int(n).bit_length() for n in self.tok.base) > 62

    def batch(self, id_type: pa.DataType) -> pa.RecordBatch:
        self.align()
        doc, key, times = (np.concatenate(c) for c in zip(*self.links, strict=True)) if self.links else (np.zeros(0, np.int64),) * 3
        at = np.lexsort((key, doc)) if self._wide() or (times > 1).any() else None
        if at is None:  # one number holds document and pair: far faster to sort
            bits = [int(x).bit_length() for x in (self.tok.base[0], self.tok.base[1])]
            whole = np.sort((doc << sum(bits)) | ((key >> 32) << bits[1]) | (key & 0xFFFFFFFF))
            doc, key = whole >> sum(bits), (((whole >> bits[1]) & ((1 << bits[0]) - 1)) << 32) | (whole & ((1 << bits[1]) - 1))
        else:
            doc, key, times = doc[at], key[at], times[at]
        new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])) if len(doc) else np.zeros(0, np.int64)
        doc, key, times = doc[new], key[new], np.add.reduceat(times, new) if len(new) else times
        pairs = np.unique(key)
        code = np.searchsorted(pairs, key)
        starts = np.searchsorted(doc, np.arange(len(self.ids) + 1))
        counts = np.stack(self.counts) if self.counts else np.zeros((0, len(COUNTS)), np.int64)
        shown = ["" if h is None else h.hexdigest() for h in self.hashes]
        return pa.RecordBatch.from_arrays(
            [pa.array([self.ids], pa.list_(id_type)), *[pa.array([c], pa.list_(pa.int64())) for c in counts.T],
             pa.array([shown], pa.list_(pa.string())), pa.array([_packed(starts, "<i8")], pa.binary()),
             pa.array([_packed(code, "<i4")], pa.binary()), pa.array([_packed(times, "<i8")], pa.binary()),
             pa.array([_packed(np.diff(pairs, prepend=0), "<i8")], pa.binary()),
             pa.array([_packed(np.bincount(code, minlength=len(pairs)), "<i4")], pa.binary())],
            names=["ids", *COUNTS, "groups_sha256", "starts", "codes", "times", "pairs", "docs"])


def _packed(values: np.ndarray, kind: str) -> bytes:
    """Numbers, bytes of equal weight together, compressed."""
    planes = values.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 3)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _packs(source: DataFrame, path_a: str, path_b: str) -> DataFrame:
    id_type = source.schema[ID].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, pack, arrow_id = _tokenizers(path_a, path_b), None, None
        for b in row_slices(batches):
            arrow_id = b.column(0).type
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                pack = pack or _Pack(tok)
                pack.add(key, text)
                if pack.chars > PACK_CHARS:
                    yield pack.batch(arrow_id)
                    pack = None
        if pack:
            yield pack.batch(arrow_id)

    schema = T.StructType([T.StructField("ids", T.ArrayType(id_type)), *[T.StructField(c, T.ArrayType(T.LongType())) for c in COUNTS],
                           T.StructField("groups_sha256", T.ArrayType(T.StringType())),
                           *[T.StructField(c, T.BinaryType()) for c in ("starts", "codes", "times", "pairs", "docs")]])
    return source.mapInArrow(run, schema)


def _asked(packs: DataFrame) -> DataFrame:
    """``(pack, at, a, b, docs)``: every distinct pair of every pack, with its number
    and the documents of the pack that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for pack, pairs, docs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                pairs, docs = np.cumsum(_unpacked(pairs, "<i8")), _unpacked(docs, "<i4")
                for at in range(0, len(pairs), 100_000):
                    key = pairs[at:at + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), pack, np.int64)), pa.array(np.arange(at, at + len(key), dtype=np.int32)),
                         pa.array((key >> 32).astype(np.int32)), pa.array((key & 0xFFFFFFFF).astype(np.int32)),
                         pa.array(docs[at:at + 100_000])], names=["pack", "at", "a", "b", "docs"])

    return packs.select("pack", "pairs", "docs").mapInArrow(run, "pack bigint, at int, a int, b int, docs int")


def align_tokenizers(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Align the tokens of every whole text by a byte-level BPE file (A, of a space and the
    text) and a sentencepiece model (B, which adds the space): ``(id_col, n_a, n_b,
    n_groups, n_links, n_best, count_sum, groups_sha256)``, one row for each row.

    ``n_links`` counts linked occurrences; the count of an id pair is the number of rows
    that hold it linked, ``count_sum`` its sum over the links, and ``n_best`` the links
    whose count is the highest of their A id. ``groups_sha256`` digests
    ``a1,a2|b1;a3|b2``. Null and empty texts, and those whose tokens of either side do not
    join to a space and the text, have no tokens: zeros and an empty digest. Repeated rows
    and ids count as rows of their own; special strings are plain text; an empty table
    gives no rows; other columns are not read. The files lie at ``path_*`` everywhere."""
    packs = staged(_packs(id_and_text(df, id_col, text_col), path_a, path_b).withColumn("pack", F.monotonically_increasing_id()), "align-packs")
    asked = _asked(packs)
    # a pair that every pack holds is added up before the shuffle; an id has at most B's vocabulary of pairs
    counts = staged(asked.groupBy("a", "b").agg(F.sum("docs").alias("n")), "align-pairs")
    best = counts.groupBy("a").agg(F.max("n").alias("most"))
    answers = asked.select("pack", "at", "a", "b").join(
        counts.join(best, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), ["a", "b"]).select("pack", "at", "n", "best")
    id_type = packs.schema["ids"].dataType.elementType
    out = T.StructType([T.StructField(id_col, id_type), *[T.StructField(c, T.LongType()) for c in (*COUNTS, "n_best", "count_sum")],
                        T.StructField("groups_sha256", T.StringType())])

    def put_back(pack: pa.Table, answer: pa.Table) -> pa.Table:
        if not pack.num_rows:
            return pa.table([pa.array([], pack.column("ids").type.value_type), *[pa.array([], pa.int64())] * 6, pa.array([], pa.string())],
                            names=out.names)
        one = {c: pack.column(c)[0] for c in pack.column_names}
        n, is_best = np.zeros(answer.num_rows, np.int64), np.zeros(answer.num_rows, np.int64)
        at = answer.column("at").to_numpy()
        n[at], is_best[at] = answer.column("n").to_numpy(), answer.column("best").to_numpy()
        starts = _unpacked(one["starts"].as_py(), "<i8")
        code, times = _unpacked(one["codes"].as_py(), "<i4"), _unpacked(one["times"].as_py(), "<i8")
        total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[starts])
        return pa.table([one["ids"].values, *[one[c].values for c in COUNTS], pa.array(total(is_best[code] * times)),
                         pa.array(total(n[code] * times)), one["groups_sha256"].values], names=out.names)

    return packs.drop("pairs", "docs").groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(put_back, out)
