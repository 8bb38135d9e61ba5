"""Chat formatting (8): typed content parts.

A visitor walks the parts of a turn (text, image, audio, document) and flattens them
into text with ordered placeholders; it records which attachment stands at which
placeholder and how many tokens that will expand to. The template marks turns with
control strings; control strings inside texts are escaped, so every formatted turn can
be read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import ship_package

OPEN, HEAD_END, BODY_END, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
KINDS = ("image", "audio", "document")
#: Strings with a meaning in formatted text; each ends where no other can begin.
CONTROL = (OPEN, CLOSE, HEAD_END, BODY_END, *[f"<|{k}|>" for k in KINDS])
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)) + r"|\\")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<s>((?:[^\\]|\\.)*?)\[INST\]((?:[^\\]|\\.)*?)\[/INST\]</s>", re.DOTALL)


def escape(text: str) -> str:
    """A backslash goes before every backslash and inside every control string, after
    its first character."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


@dataclass
class Flattened:
    """What the visitor made of one turn."""

    text: str = ""
    attachments: list[dict] = field(default_factory=list)
    tokens: int = 0


class PartVisitor:
    """One method for each kind of part; ``units`` is its size in its own measure
    (pixels' patches, seconds, pages) and ``TOKENS`` what a unit expands to."""

    TOKENS = {"image": 1, "audio": 25, "document": 600}

    def visit(self, parts: list[dict]) -> Flattened:
        out = Flattened()
        for part in parts:
            kind = part.get("type")
            if kind == "text":
                out.text += escape(part.get("text") or "")
            elif kind in KINDS:
                self.attach(out, kind, part)
            else:
                raise ValueError(f"unknown content part: {kind!r}")
        return out

    def attach(self, out: Flattened, kind: str, part: dict) -> None:
        expands = self.TOKENS[kind] * int(part.get("units") or 0)
        out.attachments.append({"kind": kind, "ref": part.get("ref"), "at": len(out.text), "tokens": expands})
        out.text += f"<|{kind}|>"
        out.tokens += expands


PART = T.StructType([T.StructField("type", T.StringType()), T.StructField("text", T.StringType()),
                     T.StructField("ref", T.StringType()), T.StructField("units", T.IntegerType())])
_ATTACHMENT = T.StructType([T.StructField("kind", T.StringType()), T.StructField("ref", T.StringType()),
                            T.StructField("at", T.IntegerType()), T.StructField("tokens", T.IntegerType())])


def text_part(text: Column) -> Column:
    """The parts of a turn that is plain text (null: empty)."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text.cast("string"), F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units")))


def format_turns(df: DataFrame, parts: Column, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", learn_from: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row for each input row: ``(conv_col, turn_col, role_col, formatted, loss_start,
    loss_end, attachments, expanded_tokens)``. ``formatted`` is the turn in the template,
    a conversation's text is its turns' joined in order; ``loss_start`` to ``loss_end``
    are the code points of ``formatted`` that are learned from (empty for other roles).
    Turns are independent rows here, so no conversation is gathered. ``parts`` is an
    array of ``PART``; null or empty parts give an empty turn, a null role an empty one;
    an unknown part kind is an error. Repeated turns are rows of their own."""
    ship_package(df.sparkSession)
    conv, turn = df.schema[conv_col].dataType, df.schema[turn_col].dataType
    schema = T.StructType([
        T.StructField(conv_col, conv), T.StructField(turn_col, turn), T.StructField(role_col, T.StringType()),
        T.StructField("formatted", T.StringType()), T.StructField("loss_start", T.IntegerType()),
        T.StructField("loss_end", T.IntegerType()), T.StructField("attachments", T.ArrayType(_ATTACHMENT)),
        T.StructField("expanded_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        visitor = PartVisitor()
        for b in batches:
            rows = []
            for role, content in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                flat = visitor.visit(content or [])
                head = OPEN + escape(role or "") + HEAD_END
                end = len(head) + (len(flat.text) if role in learn_from else 0)
                rows.append((head + flat.text + BODY_END + CLOSE, len(head), end, flat.attachments, flat.tokens))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            attachment = pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int32()), ("tokens", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
                 pa.array(cols[3], pa.list_(attachment)), pa.array(cols[4], pa.int64())], names=[f.name for f in schema])

    rows = df.select(conv_col, turn_col, F.col(role_col).cast("string").alias(role_col), parts.alias("__parts"))
    return rows.mapInArrow(run, schema)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """``(role, text)`` of every turn in formatted text. Placeholders stay as such."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


class _Digest:
    """What is read back of one conversation, turn by turn."""

    def __init__(self):
        self.turns, self.turns_hash = 0, hashlib.sha256()
        self.loss_chars, self.loss_hash, self.chars = 0, hashlib.sha256(), 0

    def add(self, formatted: str, start: int, end: int) -> None:
        for role, text in read_turns(formatted):
            self.turns += 1
            self.turns_hash.update(f"{role}\n{text}\n".encode())
        learned = unescape(formatted[start:end])
        self.loss_chars += len(learned)
        self.loss_hash.update(learned.encode())
        self.chars += len(formatted)


def read_back(formatted: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role") -> DataFrame:
    """One row for each conversation, read from formatted turns: ``(conv_col, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars)``. Turns stream past in the
    order of (turn, role, text), nulls first; a task holds one batch and one
    digest, however long a conversation is. A digest is a chain over a conversation's
    whole text, so that one conversation is digested in one task; formatting is not. Null
    conversation ids are one conversation."""
    ship_package(formatted.sparkSession)
    conv = formatted.schema[conv_col].dataType
    schema = T.StructType([
        T.StructField(conv_col, conv), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, rows, key_type = None, None, [], None

        def done():
            rows.append((now, digest.turns, digest.turns_hash.hexdigest(), digest.loss_chars,
                         digest.loss_hash.hexdigest(), digest.chars))

        def batch():
            cols = list(zip(*rows, strict=True))
            types = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                              names=[f.name for f in schema])

        for b in batches:
            key_type = b.column(0).type
            for conv_id, text, start, end in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if digest is None or conv_id != now:
                    if digest:
                        done()
                    now, digest = conv_id, _Digest()
                digest.add(text, start, end)
            if len(rows) >= 5_000:
                yield batch()
                rows.clear()
        if digest:
            done()
        if rows:
            yield batch()

    # turns of one place and role stand in the order of their texts, not of the escaped and closed ones
    closed = F.char_length("formatted") - F.lit(len(BODY_END + CLOSE))
    text = F.regexp_replace(F.substring(F.col("formatted"), F.lit(1), closed), F.lit(r"(?s)\\(.)"), F.lit("$1"))
    ordered = formatted.repartition(conv_col).sortWithinPartitions(conv_col, turn_col, role_col, text)
    return ordered.select(conv_col, "formatted", "loss_start", "loss_end").mapInArrow(run, schema)
