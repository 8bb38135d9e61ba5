"""BPE encoding and decoding (1): distinct-word table.

Texts are split into words; every distinct word of the corpus is encoded once, in one
table; its ids are joined back to the words' positions. Positions need not pass through
a shuffle one by one: documents are dealt into blocks of bounded size, the
table takes each block's distinct words, and the block puts their ids in their places.
Decoding looks ids up in one array of the vocabulary's pieces.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.byte_bpe import AGREED, byte_bpe, piece_bytes
from tessera.llm.common import ID, TEXT, id_and_text, row_slices, single_white, spaced_pieces

#: Text bytes of a block (a block holds whole documents, so a longer one is its own).
BLOCK_BYTES = 24 << 20
#: Text bytes a task holds before it sends what it has packed.
HELD_BYTES = 32 << 20
#: Bytes of packed pieces that a block looks up at a time.
RUN_BYTES = 2 << 20
#: Marks that are a pre-token of their own after a letter or digit.
TAILS = frozenset(",.;:!?")


def _before_tail() -> str:
    """Pattern of a mark of ``TAILS`` after a letter or digit, at the end."""
    spans: list[list[int]] = []
    for c in range(ord(AGREED)):
        if chr(c).isalnum():
            if spans and spans[-1][1] == c - 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
    return "[" + "".join(f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in spans) + "][,.;:!?]$"


_TAIL = _before_tail()


def _words_of(pieces: pa.StringArray) -> tuple[pa.StringArray, pa.StringArray]:
    """Each piece as its word and the mark after it (empty if it has none)."""
    tailed = pc.match_substring_regex(pieces, _TAIL)
    return (pc.if_else(tailed, pc.utf8_slice_codeunits(pieces, 0, -1), pieces),
            pc.if_else(tailed, pc.utf8_slice_codeunits(pieces, -1), ""))


def _numbered(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """Where each document starts, its positions' piece numbers, and the pieces (with
    the space before them), for documents cut into lists."""
    starts = lists.offsets.to_numpy()
    coded = lists.flatten().dictionary_encode()
    found = coded.dictionary
    codes = coded.indices.to_numpy().astype(np.int64)
    bare = np.zeros(len(codes) + 1, np.int64)  # 1: no space before it
    bare[starts[:-1]] = 1
    feed = pc.index(found, "\n").as_py()
    if feed >= 0:
        feeds = np.flatnonzero(codes == feed)
        bare[feeds] = bare[feeds + 1] = 1
    keys = codes * 2 + bare[:-1]
    used = np.flatnonzero(np.bincount(keys, minlength=2 * len(found)))
    place = np.zeros(2 * len(found), "<u4")
    place[used] = np.arange(len(used), dtype="<u4")
    pieces = found.take(pa.array(used >> 1))
    spaced = pc.binary_join_element_wise(" ", pieces, "")
    return starts, place[keys], pc.if_else(pa.array(used % 2 == 1), pieces, spaced)


def _cut(texts: list[str]) -> Iterator[tuple[list[int], pa.ListArray]]:
    """Documents (by their place in ``texts``) cut into pieces, in at most two groups.
    Where all white space is single characters, texts are cut at spaces and a line feed
    is a piece of its own; others are cut only where that is sure to be right."""
    plain = [i for i, t in enumerate(texts) if single_white(t)]
    if plain:
        yield plain, pc.split_pattern(pa.array([texts[i].replace("\n", " \n ") for i in plain], pa.string()), " ")
    other = sorted({*range(len(texts))}.difference(plain))
    if other:
        yield other, pa.array([spaced_pieces(texts[i]) for i in other], pa.list_(pa.string()))


_PACKED = ("starts", "codes", "piece_sizes", "pieces")


def _pack(source: DataFrame, blocks: int) -> DataFrame:
    """``(block, ids, ...)``: documents of one task and block as numbers of distinct
    pieces, compressed."""
    id_type = source.schema[ID].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        size, arrow_id = 0, None

        def flush():
            for block in sorted(held):
                ids, texts = held.pop(block)
                for at, lists in _cut(texts):
                    starts, codes, pieces = _numbered(lists)
                    planes = np.ascontiguousarray(codes.view(np.uint8).reshape(-1, 4).T)
                    sizes, data = _packed_strings(pieces)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int32()), pa.array([[ids[i] for i in at]], pa.list_(arrow_id)),
                         pa.array([zstandard.compress(starts.astype("<u4").tobytes(), 3)], pa.binary()),
                         pa.array([zstandard.compress(planes.tobytes(), 3)], pa.binary()),
                         pa.array([sizes], pa.binary()), pa.array([data], pa.binary())], names=["block", "ids", *_PACKED])

        for b in row_slices(batches):
            arrow_id = b.column(1).type
            for block, key, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids, texts = held.setdefault(block, ([], []))
                ids.append(key)
                texts.append(text)
                size += len(text)
            if size > HELD_BYTES:
                yield from flush()
                size = 0
        yield from flush()

    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("ids", T.ArrayType(id_type)),
                           *[T.StructField(c, T.BinaryType()) for c in _PACKED]])
    rows = source.select(F.pmod(F.xxhash64(ID, TEXT), F.lit(blocks)).cast("int").alias("block"), ID, TEXT)
    return rows.mapInArrow(run, schema)


def _block_words(packed: DataFrame) -> DataFrame:
    """``(block, word)``: every distinct word of every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found = None, []

        def done():
            words = pc.unique(pa.chunked_array([*found, pa.array([], pa.string())])).drop_null()
            words = words.take(pc.sort_indices(words))
            for at in range(0, len(words), 20_000):
                part = words.slice(at, 20_000)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), now, np.int32)), part], names=["block", "word"])

        for b in batches:
            for block, sizes, data in zip(*(b.column(c).to_pylist() for c in ("block", "piece_sizes", "pieces")), strict=True):
                if block != now:
                    yield from done()
                    now, found = block, []
                found += [pc.unique(w) for w in _words_of(_unpacked_strings(sizes, data))]
        yield from done()

    # all columns, so that this and the cogroup read one and the same exchange
    return packed.sortWithinPartitions("block").mapInArrow(run, "block int, word string")


def _packed_strings(values: pa.Array) -> tuple[bytes, bytes]:
    """Strings or byte strings as their lengths and their concatenation, compressed."""
    sizes = pc.binary_length(values).to_numpy(zero_copy_only=False).astype("<u4")
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(pa.binary())), b"")
    return zstandard.compress(sizes.tobytes(), 3), zstandard.compress(whole[0].as_py(), 3)


def _unpacked_strings(sizes: bytes, data: bytes, kind: pa.DataType | None = None) -> pa.Array:
    ends = np.cumsum(np.frombuffer(zstandard.decompress(sizes), "<u4"), dtype=np.int64)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(zstandard.decompress(data))]
    return pa.Array.from_buffers(kind or pa.string(), len(ends), buffers)


_ENCODED = ("word_sizes", "words", "id_sizes", "ids")


def _encoded_words(words: DataFrame, path: str) -> DataFrame:
    """The distinct-word table with its places: rows come sorted by word, so that every
    distinct word is encoded once, whichever blocks it stands in. The result goes back
    by block, many words with their ids to a row, compressed."""
    held_words = 150_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        held: dict[int, tuple[list, list]] = {}
        n, last, ids = 0, None, b""

        def flush():
            rows = [(block, *_packed_strings(pa.array(known, pa.string())), *_packed_strings(pa.array(found, pa.binary())))
                    for block, (known, found) in sorted(held.items())]
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                              names=["block", *_ENCODED])

        for b in batches:
            for block, word in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if word != last:
                    last, ids = word, np.asarray(bpe.encode(word), "<u4").tobytes()
                known, found = held.setdefault(block, ([], []))
                known.append(word)
                found.append(ids)
                n += 1
            if n > held_words:
                yield flush()
                held, n = {}, 0
        if n:
            yield flush()

    return (words.repartition("word").sortWithinPartitions("word", "block")
            .mapInArrow(run, "block int, " + ", ".join(f"{c} binary" for c in _ENCODED)))


def _runs(packed: pa.Table, most: int) -> Iterator[pa.Table]:
    """Rows in runs of about ``most`` bytes of packed pieces."""
    start, held = 0, 0
    for i, n in enumerate(pc.binary_length(packed.column("pieces")).to_pylist()):
        if i > start and held + n > most:
            yield packed.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < packed.num_rows:
        yield packed.slice(start)


def _place(packed: pa.Table, coded: pa.Table, id_col: str) -> pa.Table:
    id_type = packed.schema.field("ids").type.value_type
    batches = [pa.RecordBatch.from_arrays([pa.array([], id_type), pa.array([], pa.list_(pa.int32()))], names=[id_col, "ids"])]
    if not packed.num_rows:
        return pa.Table.from_batches(batches)
    rows = list(zip(*(coded.column(c).to_pylist() for c in _ENCODED), strict=True))
    words = pa.concat_arrays([_unpacked_strings(r[0], r[1]) for r in rows] + [pa.array([""])])
    ids = pa.concat_arrays([_unpacked_strings(r[2], r[3], pa.binary()) for r in rows] + [pa.array([b""])])
    # a few packed rows at a time: the table is looked up by a hash index made for each run
    for run in _runs(packed, RUN_BYTES):
        pieces = [_unpacked_strings(s, d) for s, d in zip(*(run.column(c).to_pylist() for c in ("piece_sizes", "pieces")), strict=True)]
        parts = [ids.take(pc.index_in(w, value_set=words)) for w in _words_of(pa.concat_arrays(pieces))]
        ids_of = pc.binary_join_element_wise(*parts, b"")
        del parts
        first = 0
        for row, own in enumerate(pieces):
            keys, starts, codes = (run.column(c)[row].as_py() for c in ("ids", "starts", "codes"))
            planes = np.frombuffer(zstandard.decompress(codes), np.uint8).reshape(4, -1)
            numbers = np.ascontiguousarray(planes.T).view("<u4").ravel()
            placed = ids_of.slice(first, len(own)).take(pa.array(numbers))
            first += len(own)
            starts = np.frombuffer(zstandard.decompress(starts), "<u4")
            _, ends, data = placed.buffers()
            ends = np.frombuffer(ends, np.int32)[:len(placed) + 1][starts] // 4
            values = pa.array(np.frombuffer(data, "<i4") if data else np.zeros(0, np.int32), pa.int32())
            batches.append(pa.RecordBatch.from_arrays(
                [pa.array(keys, id_type), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], names=[id_col, "ids"]))
    pa.default_memory_pool().release_unused()
    return pa.Table.from_batches(batches)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ids)`` with the token ids of every row's whole text, one row for each
    input row, as the library of ``path`` (a byte-level BPE file) gives them without
    special tokens added. A null or empty text has no ids; repeated ids and null ids are
    kept as rows of their own; an empty input gives no rows."""
    if not byte_bpe(path).cuttable:
        raise ValueError(f"not a byte-level BPE file without normalizer: {path}")
    source = id_and_text(df, id_col, text_col)
    spark = df.sparkSession
    size = source.agg(F.sum(F.octet_length(TEXT))).first()[0] or 0
    blocks = max(spark.sparkContext.defaultParallelism, math.ceil(size / BLOCK_BYTES))
    packed = _pack(source, blocks).repartition(blocks, "block")
    coded = _encoded_words(_block_words(packed), path)
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return packed.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(
        lambda left, right: _place(left, right, id_col), schema)


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``df`` with ``ids_col`` replaced by ``text_col``: each id is joined with its piece
    of the vocabulary (one constant table, bounded by the vocabulary and looked up by
    id), pieces are put together in order, and bytes that are no UTF-8 become U+FFFD.
    Ids without a piece, and null ids, add nothing; a null list gives a null text. A
    column named ``text_col`` is overwritten. Built-in functions only: a byte of a piece
    is the Latin-1 character of its number until the whole is put together."""
    kept = [c for c in df.columns if c not in (ids_col, text_col)]
    between = "\u0100"
    table = F.split(F.lit(between.join((p or b"").decode("latin-1") for p in piece_bytes(path))), between, -1)
    ids = F.col(f"`{ids_col}`").cast("array<int>")
    joined = F.array_join(F.transform(ids, lambda i: F.coalesce(F.get(table, i), F.lit(""))), "")
    text = F.call_function("make_valid_utf8", F.encode(joined, "ISO-8859-1").cast("string"))
    return df.select(*[f"`{c}`" for c in kept], text.alias(text_col))
