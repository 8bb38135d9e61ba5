"""Token counts (5): whole-token shortcut.

Offline, every string of the vocabulary is encoded alone; those that give exactly
their own token are the proven whole tokens. Texts are cut where encodings are
independent (``spaced_pieces``); a pre-token that is a proven whole token counts as
one without any merge, and only the rest is merged, each distinct one once per
bounded memo.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.byte_bpe import byte_bpe, load_tokenizer
from tessera.llm.common import ID, TEXT, id_and_text, row_slices, spaced_pieces

MEMO_ENTRIES = 600_000


def proven_whole_tokens(path: str) -> set[str]:
    """Strings of the vocabulary (decoded to text) whose encoding alone is their own
    single token. Proven by encoding each of them with the library."""
    tok = load_tokenizer(path)
    ids = sorted(tok.get_vocab().values())
    strings = tok.decode_batch([[i] for i in ids], skip_special_tokens=False)
    encoded = tok.encode_batch(strings, add_special_tokens=False)
    return {s for i, s, e in zip(ids, strings, encoded, strict=True) if e.ids == [i]}


class _Lengths(dict):
    """Tokens of each piece that follows a space: 1 for the proven whole tokens, the
    rest merged when first met. Emptied back to the proven ones when full."""

    def __init__(self, path: str, proven: frozenset[str]):
        self.bpe = byte_bpe(path)
        self.whole = {s[1:]: 1 for s in proven if s.startswith(" ") and s != " "}
        super().__init__(self.whole)

    def __missing__(self, piece: str) -> int:
        if len(self) > MEMO_ENTRIES + len(self.whole):
            self.clear()
            self.update(self.whole)
        self[piece] = n = len(self.bpe.encode(" " + piece))
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        first, *rest = spaced_pieces(text)
        return len(self.bpe.encode(first)) + sum(map(self.__getitem__, rest))


_COUNTERS: dict[str, Callable[[str], int]] = {}


def _counter(path: str, proven: frozenset[str]) -> Callable[[str], int]:
    if path not in _COUNTERS:
        tok = load_tokenizer(path)
        if path.endswith(".model"):
            _COUNTERS[path] = lambda text: len(tok.encode(text, num_threads=1))
        elif byte_bpe(path).cuttable:
            _COUNTERS[path] = _Lengths(path, proven).count
        else:
            _COUNTERS[path] = lambda text: len(tok.encode(text, add_special_tokens=False))
    return _COUNTERS[path]


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """Token count of every row's whole text: ``(id_col, n_bytes, n_tokens,
    over_limit)``, one row for each input row (also for repeated ids and a null id).
    A null or empty text has 0 bytes and 0 tokens. Special strings inside a text are
    handled as the library does by default. ``path`` names the tokenizer file on every
    executor. Tokenizers other than byte-level BPE have no proven cut and go through
    the library whole. An empty input gives no rows; other columns are not read."""
    source = id_and_text(df, id_col, text_col)
    id_type = source.schema[ID].dataType.simpleString()

    # proven once, here; at most as many strings as the vocabulary has
    cuttable = not path.endswith(".model") and byte_bpe(path).cuttable
    shared = df.sparkSession.sparkContext.broadcast(frozenset(proven_whole_tokens(path)) if cuttable else frozenset())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path, shared.value)
        for b in row_slices(batches):
            n = list(map(count, b.column(2).to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())],
                                             names=[id_col, "n_bytes", "n_tokens"])

    rows = source.select(ID, F.octet_length(TEXT).cast("long").alias("n_bytes"), TEXT)
    out = rows.mapInArrow(run, f"`{id_col}` {id_type}, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
