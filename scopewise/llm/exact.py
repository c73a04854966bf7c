"""Exact deduplication by Grace hashing.

1. Every task collapses equal texts of its pieces in an open-addressing table, so that a text that
   makes up a third of all rows leaves a piece once. The collapsed pieces are stored in the shared
   folder: one row per document, the text on one row per distinct text of a piece.
2. The distinct texts are shuffled by hash. A task fills an open-addressing table that compares whole
   contents; when the contents outgrow its memory, table and remaining rows are dealt by the next
   hash digit to spill files, and every file is handled the same way.
3. The verdicts go back to the documents by the key of the collapsed group. No key has more rows
   than a piece has documents.

Defined cases: a null text equals the empty text; a null doc_id counts as smaller than any other;
repeated rows of a document are copies and each gets a row; columns besides doc_id and text are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from scopewise.llm.batches import encoded, map_batches, pieces
from scopewise.session import discard, materialize

#: Memory that a table may take before its rows are dealt to spill files, and what a text and a group of
#: copies take beside their content.
TABLE_BYTES = 64 << 20
ENTRY_BYTES = 400
#: Spill files of one level; a level uses four bits of the hash.
FAN_OUT = 16

COLLAPSED = "doc_id long, member_of string, text_sha256 string, copies long, text binary"
VERDICT = "member_of string, keep_id long, group_size long"


class OpenTable:
    """Contents by hash in one array of slots with linear probing; equality is of whole contents."""

    def __init__(self, slots: int = 1024):
        self.slots = np.full(slots, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def place(self, hashed: int, content: bytes) -> int:
        """The number of ``content``, entered if new."""
        mask = len(self.slots) - 1
        at = hashed & mask
        while (found := int(self.slots[at])) >= 0:
            if self.hashes[found] == hashed and self.contents[found] == content:
                return found
            at = (at + 1) & mask
        self.slots[at] = number = len(self.contents)
        self.hashes.append(hashed)
        self.contents.append(content)
        self.bytes += len(content) + ENTRY_BYTES
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return number

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for number, hashed in enumerate(self.hashes):
            at = hashed & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = number


def _larger(one: int | None, other: int | None) -> int | None:
    return other if one is None else one if other is None else max(one, other)


def _short(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little")


def collapse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``COLLAPSED``: equal texts of a piece share ``member_of``; one of them has the text."""
    for piece in pieces(batches, limit=8 << 20):
        table, name = OpenTable(), uuid.uuid4().hex
        ids, contents = piece.column("doc_id").to_pylist(), encoded(piece)
        digests = [hashlib.sha256(content).digest() for content in contents]
        numbers = [table.place(_short(d), c) for d, c in zip(digests, contents, strict=True)]
        counts = np.bincount(numbers, minlength=len(table.contents)).tolist()
        top: list[int | None] = [None] * len(counts)
        for number, doc_id in zip(numbers, ids, strict=True):
            top[number] = _larger(top[number], doc_id)
        copies: list[int | None] = [None] * len(ids)
        kept: list[bytes | None] = [None] * len(ids)
        open_ = [True] * len(counts)
        for row, (number, doc_id) in enumerate(zip(numbers, ids, strict=True)):
            if open_[number] and doc_id == top[number]:
                open_[number], copies[row], kept[row] = False, counts[number], contents[row]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([f"{name}:{number}" for number in numbers]),
                pa.array([digest.hex() for digest in digests]),
                pa.array(copies, pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "member_of", "text_sha256", "copies", "text"],
        )


def _resolve(rows: Iterator[tuple], level: int, limit: int, folder: Path) -> Iterator[tuple]:
    """(content, all found) of every distinct content of (digest, content, found) rows; found are lists."""
    table, members = OpenTable(), []
    for digest, content, found in rows:
        number = table.place(_short(digest[::-1]), content)
        if number == len(members):
            members.append((digest, []))
        members[number][1].extend(found)
        table.bytes += ENTRY_BYTES * len(found)
        if table.bytes > limit and len(members) > 1 and level < 48:
            break
    else:
        for (_, found), content in zip(members, table.contents, strict=True):
            yield content, found
        return
    inner = folder / uuid.uuid4().hex
    inner.mkdir()
    files = [(inner / str(i)).open("wb") for i in range(FAN_OUT)]

    def deal(row: tuple) -> None:
        byte = row[0][8 + level // 2]
        pickle.dump(row, files[byte >> 4 if level % 2 else byte & 15])

    for (digest, found), content in zip(members, table.contents, strict=True):
        deal((digest, content, found))
    del table, members
    for row in rows:
        deal(row)
    for file in files:
        file.close()
    for i in range(FAN_OUT):
        path = inner / str(i)
        if path.stat().st_size:
            yield from _resolve(_stored(path), level + 1, limit, folder)
        path.unlink()


def _stored(path: Path) -> Iterator[tuple]:
    with path.open("rb") as file:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


def grace(batches: Iterable[pa.RecordBatch], limit: int = TABLE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows of ``VERDICT`` for the distinct texts of one hash partition."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("text_sha256", "text", "member_of", "doc_id", "copies")]
            for digest, content, member_of, doc_id, copies in zip(*columns, strict=True):
                yield bytes.fromhex(digest), content, [(member_of, doc_id, copies)]

    def batch(found: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64())
        arrays = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["member_of", "keep_id", "group_size"])

    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        found: list[tuple] = []
        for _, group in _resolve(rows(), 0, limit, Path(folder)):
            keep, size = None, 0
            for _, doc_id, copies in group:
                keep, size = _larger(keep, doc_id), size + copies
            found += [(member_of, keep, size) for member_of, _, _ in group]
            if len(found) >= 10_000:
                yield batch(found)
                found = []
        if found:
            yield batch(found)


def _candidates(batches: Iterable[pa.RecordBatch], names: list[str], digest: str) -> Iterator[pa.RecordBatch]:
    """Of the rows of a piece with one text, the one with the largest doc_id; its digest goes with it."""
    for piece in pieces(batches, limit=8 << 20):
        table = OpenTable()
        rows: list[tuple[int, int, bytes]] = []
        for row, (doc_id, content) in enumerate(zip(piece.column("doc_id").to_pylist(), encoded(piece), strict=True)):
            digested = hashlib.sha256(content).digest()
            number = table.place(_short(digested), content)
            if number == len(rows):
                rows.append((doc_id, row, digested))
            elif doc_id > rows[number][0]:
                rows[number] = (doc_id, row, digested)
        _, places, digests = zip(*rows, strict=True)
        kept = piece.take(pa.array(places))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(digests, pa.binary())], [*names, digest])


def _survivors(batches: Iterable[pa.RecordBatch], names: list[str], digest: str, limit: int) -> Iterator[pa.RecordBatch]:
    """One row per distinct text of a hash partition, that with the largest doc_id."""
    schema: list[pa.Schema] = []

    def rows() -> Iterator[tuple]:
        for batch in batches:
            schema[:] = [batch.select(names).schema]
            others = [batch.column(n).to_pylist() for n in names if n != "text"]
            ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for digested, content, doc_id, *row in zip(
                batch.column(digest).to_pylist(), texts, ids, *others, strict=True
            ):
                # A null text equals the empty one; which of the two it was stays with the row.
                yield digested, content or b"", [(doc_id, content is None, row)]

    def batch(found: list[tuple]) -> pa.RecordBatch:
        columns = {n: list(c) for n, c in zip([n for n in names if n != "text"], zip(*(r for r, _ in found)), strict=True)}
        texts = pa.array([content for _, content in found], pa.binary()).cast(schema[0].field("text").type)
        arrays = [texts if f.name == "text" else pa.array(columns[f.name], f.type) for f in schema[0]]
        return pa.RecordBatch.from_arrays(arrays, names)

    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        found, size = [], 0
        for content, group in _resolve(rows(), 0, limit, Path(folder)):
            _, null, row = max(group, key=lambda member: member[0])
            found.append((row, None if null else content))
            size += len(content)
            if len(found) >= 2_000 or size >= 8 << 20:
                yield batch(found)
                found, size = [], 0
        if found:
            yield batch(found)


def drop_duplicates(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay: of equal texts one row, with the largest doc_id.

    Texts are shuffled once, with all columns of the row that may stay. Rows without doc_id all stay.
    """
    digest = "digest"
    while digest in docs.columns:
        digest += "_"
    names, schema = docs.columns, docs.schema
    candidates = docs.where(F.col("doc_id").isNotNull()).transform(
        map_batches, lambda batches: _candidates(batches, names, digest), StructType([*schema, StructField(digest, BinaryType())])
    )
    kept = candidates.repartition(digest).transform(
        map_batches, lambda batches: _survivors(batches, names, digest, table_bytes), schema
    )
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))


def exact_duplicates(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Of equal texts the row with the largest doc_id stays.
    """
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    collapsed = materialize(slim.transform(map_batches, collapse, COLLAPSED), "collapsed")
    verdicts = (
        collapsed.where(F.col("copies").isNotNull())
        .repartition("text_sha256")
        .transform(map_batches, lambda batches: grace(batches, table_bytes), VERDICT)
    )
    found = (
        collapsed.select("doc_id", "member_of", "text_sha256")
        .join(verdicts, "member_of")
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256",
        )
    )
    found = materialize(found, "exact")
    discard(collapsed)
    return found
