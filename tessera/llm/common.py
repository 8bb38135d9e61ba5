"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import broadcast_if_small, staged  # noqa: F401 (shared by the operators)

ID, TEXT = "__id", "__text"

_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_LETTERS = re.compile(r"[^\W\d_]+")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (``addPyFile``, once per application), so that
    functions of it can run there wherever the driver found it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    copy = Path(tempfile.mkdtemp(prefix="tessera-"))
    shutil.copytree(root, copy / "src" / root.name, ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(str(copy / root.name), "zip", copy / "src"))
    _SHIPPED.add(app)


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator needs, under private names, so that no
    extra column of the caller can clash with a result column. Null text: empty."""
    ship_package(df.sparkSession)
    return df.select(F.col(id_col).alias(ID), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(TEXT))


def learning_fold(id_col: str | Column) -> Column:
    """crc32 of the id as text, modulo 4. Remainder 2 is held out of every fit."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(4))


def held_out(id_col: str | Column) -> Column:
    return F.coalesce(learning_fold(id_col) == 2, F.lit(False))


def letters(token: str) -> str:
    """The letters of a token in lower case (empty if it has none)."""
    return "".join(_LETTERS.findall(token.lower()))


def row_slices(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that few texts are Python
    strings at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def text_slices(texts: list[str], chars: int = 2_000_000) -> Iterator[list[str]]:
    """A batch's texts in runs of about ``chars`` characters (a longer text alone), for
    work that holds all tokens of a run."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > chars:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def spaced_pieces(text: str) -> list[str]:
    """Cut before every space that stands between two characters that are not white
    space; the space is dropped. No pre-token of a byte-level BPE can cross such a
    place (a pre-token holds a space only as its first character or in a run of white
    space) and no look-ahead can see past it, so ``pieces[0]`` and every
    ``" " + piece`` after it encode independently of each other."""
    if single_white(text):
        return text.split(" ")
    return _SINGLE_SPACE.split(text)


def single_white(text: str) -> bool:
    """Whether every run of white space is one space or line feed, inside the text."""
    return " ".join(text.split()) == text.replace("\n", " ")
