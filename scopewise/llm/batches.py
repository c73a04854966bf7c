"""Bounded pieces of Arrow streams, and compact forms of their columns."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from scopewise.session import ship_package

#: Text that a task holds at once, in bytes; a longer single text makes a piece of its own.
PIECE_BYTES = 4 << 20


def map_batches(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` on executors that have this package.

    Workers serve one task after another; each gives its memory back when its task ends.
    """
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return memory that this process has freed to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def pieces(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut every batch into runs of rows whose ``column`` holds about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False
        )
        part = np.cumsum(sizes.astype(np.int64)) // limit
        edges = np.r_[0, np.flatnonzero(np.diff(part)) + 1, batch.num_rows]
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            yield batch.slice(int(begin), int(end - begin))


def texts(piece: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a piece, null as the empty text."""
    return [text or "" for text in piece.column(column).to_pylist()]


def encoded(piece: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a piece as UTF-8, null as the empty text."""
    return [data or b"" for data in piece.column(column).cast(pa.binary()).to_pylist()]


def factorize(words: list[str]) -> tuple[np.ndarray, list[str]]:
    """Number of every word and the distinct words, exact for any characters."""
    unique = list(dict.fromkeys(words))
    index = dict(zip(unique, range(len(unique)), strict=True))
    return np.fromiter(map(index.__getitem__, words), np.int64, len(words)), unique


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every (start, length), one after another."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - before, lengths)
