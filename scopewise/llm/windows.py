"""Windows that occur in several documents, found without shuffling every window.

Every window of ``size`` units (bytes or words) has an anchor: the leftmost of its grams (``gram`` units)
with the smallest hash. Equal windows have equal anchors at equal places, and about a dozen consecutive
windows share one. So documents are compared in runs of windows with one anchor:

1. ``store_slices`` packs documents into slices of a few megabytes, one row each, with the distinct
   anchor grams of the slice.
2. ``flag_grams`` deals the grams to bins and finds those that occur in at least two documents. A slice
   contributes a gram once, however many of its documents have it.
3. ``slice_candidates`` cuts the runs with such grams out of the documents: one string per distinct run of a
   slice with its smallest and largest document, dealt to bins again. The windows of a gram that occurs in
   more than ``hot_docs`` documents travel alone and are dealt by their own hash, as one bin would
   otherwise have to take all surroundings of a very frequent passage.

Rows hold arrays as binary columns; the number of bins follows the number of slices.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scopewise.llm.batches import encoded, map_batches, pieces, ragged
from scopewise.llm.shingles import hashes_at, mix, window_hashes

#: Text per slice, in bytes; a longer document makes a slice of its own.
SLICE_BYTES = 2 << 20
#: Documents of one gram whose runs may meet in one bin.
HOT_DOCS = 4096
#: Slices whose grams one bin would hold, if each had only its share.
SLICES_PER_BIN = 2
#: Bins at most.
MAX_BINS = 1 << 16
#: Windows whose anchors are found at once.
_BLOCK = 1 << 17
_PLACE = np.uint64((1 << 24) - 1)
#: Stands for a missing doc_id: no document is larger.
NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Units:
    """What windows are made of: ``split`` gives the units of joined texts.

    It returns a hash per unit, the number of units per text, and each unit's first and last byte.
    """

    split: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    size: int
    gram: int


@dataclass(frozen=True)
class Runs:
    """Maximal runs of windows with one anchor; ``start`` and ``anchor`` count units of the slice."""

    doc: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    gram: np.ndarray


def anchors(values: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and gram hash of the anchor of every window; meant for one block of text."""
    width = size - gram + 1
    grams = window_hashes(values, gram)
    count = len(grams) - width + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:count], least[width - span :])
    place = (least & _PLACE).astype(np.int64)
    return place, grams[place]


def find_runs(values: np.ndarray, counts: np.ndarray, units: Units) -> Runs:
    """Runs of the windows inside the texts, whose units stand one after another in ``values``.

    Goes block by block, so that little more than the runs is held.
    """
    ends = np.cumsum(counts)
    parts = [Runs(*(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0, np.uint64))]
    for begin in range(0, max(0, len(values) - units.size + 1), _BLOCK):
        place, hashed = anchors(values[begin : begin + _BLOCK + units.size - 1], units.size, units.gram)
        start = np.arange(begin, begin + len(place))
        doc = np.searchsorted(ends, start, side="right")
        inside = start + units.size <= ends[doc]
        place, hashed, start, doc = place[inside] + begin, hashed[inside], start[inside], doc[inside]
        if len(start):
            new = np.flatnonzero(np.r_[True, (np.diff(place) != 0) | (np.diff(doc) != 0)])
            parts.append(Runs(doc[new], start[new], np.diff(np.r_[new, len(start)]), place[new], hashed[new]))
    doc, start, windows, anchor, gram = (
        np.concatenate([getattr(part, name) for part in parts]) for name in ("doc", "start", "windows", "anchor", "gram")
    )
    if not len(doc):
        return parts[0]
    # a run that a block end has cut
    new = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(doc) != 0)])
    # anchors have small hashes, as they were chosen so; mixed once more they fill all bins alike
    return Runs(doc[new], start[new], np.add.reduceat(windows, new), anchor[new], mix(gram[new]))


def _keys(hashed: np.ndarray) -> np.ndarray:
    """48 bits of a hash: enough to tell grams apart, few enough to store."""
    return hashed >> np.uint64(16)


def _bins(keys: np.ndarray, bins: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(bins) >> np.uint64(16)).astype(np.int64)


def _distinct(runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct gram keys and the number of documents of each (255 for more)."""
    keys = _keys(runs.gram)
    order = np.argsort(keys, kind="stable")
    keys, docs = keys[order], runs.doc[order]
    if not len(keys):
        return keys, np.zeros(0, np.uint8)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    new_doc = np.r_[True, (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])]
    return keys[first], np.minimum(np.add.reduceat(new_doc, first, dtype=np.int64), 255).astype(np.uint8)


_packer = zstandard.ZstdCompressor
_unpacker = zstandard.ZstdDecompressor


def _pack_keys(keys: np.ndarray) -> bytes:
    """Upper halves packed, lower halves as they are: they hold nothing to pack."""
    upper = _packer(3).compress((keys >> np.uint64(32)).astype("<u2").tobytes())
    return len(upper).to_bytes(4, "little") + upper + keys.astype("<u4").tobytes()


def _unpack_keys(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:4], "little")
    upper = np.frombuffer(_unpacker().decompress(data[4 : 4 + size]), "<u2").astype(np.uint64)
    return upper << np.uint64(32) | np.frombuffer(data[4 + size :], "<u4")


SLICES = "slice string, ids binary, sizes binary, packed binary, keys binary, docs binary"


def unpack(packed: bytes, sizes: bytes) -> list[bytes]:
    """The texts of a slice."""
    whole = _unpacker().decompress(packed)
    ends = np.cumsum(np.frombuffer(sizes, "<i8")).tolist()
    return [whole[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _slices(batches: Iterable[pa.RecordBatch], units: Units) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, limit=SLICE_BYTES):
        contents = encoded(piece)
        values, counts, *_ = units.split(contents)
        keys, docs = _distinct(find_runs(values, counts, units))
        ids = np.array([NO_ID if i is None else i for i in piece.column("doc_id").to_pylist()], "<i8")
        row = {
            "slice": uuid.uuid4().hex,
            "ids": ids.tobytes(),
            "sizes": np.fromiter(map(len, contents), "<i8", len(contents)).tobytes(),
            "packed": _packer(3).compress(b"".join(contents)),
            "keys": _pack_keys(keys),
            "docs": _packer(3).compress(docs.tobytes()),
        }
        yield pa.RecordBatch.from_pylist([row])


def slice_rows(docs: DataFrame, units: Units) -> DataFrame:
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    return map_batches(slim, lambda batches: _slices(batches, units), SLICES)


def number_of_bins(slices: DataFrame) -> int:
    return min(MAX_BINS, max(8, slices.count() // SLICES_PER_BIN))


def _deal_keys(batches: Iterable[pa.RecordBatch], bins: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            keys = _unpack_keys(row["keys"])
            docs = np.frombuffer(_unpacker().decompress(row["docs"]), np.uint8)
            edges = np.searchsorted(_bins(keys, bins), np.arange(bins + 1))
            rows = [
                {"bin": i, "slice": row["slice"], "keys": _pack_keys(keys[a:b]), "docs": docs[a:b].tobytes()}
                for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
                if b > a
            ]
            for at in range(0, len(rows), 1024):
                yield pa.RecordBatch.from_pylist(
                    rows[at : at + 1024],
                    pa.schema([("bin", pa.int64()), ("slice", pa.string()), ("keys", pa.binary()), ("docs", pa.binary())]),
                )


def _flag(key: tuple, group: pd.DataFrame, hot_docs: int) -> pd.DataFrame:
    """Per slice and gram of a bin: 1 if at least two documents have the gram, 2 if very many."""
    parts = [_unpack_keys(data) for data in group["keys"]]
    keys = np.concatenate(parts)
    docs = np.frombuffer(b"".join(group["docs"]), np.uint8).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0])
    total = np.add.reduceat(docs[order], first)
    flags = np.empty(len(keys), np.uint8)
    flags[order] = np.repeat((total > 1) + (total > hot_docs).astype(np.int64), np.diff(np.r_[first, len(keys)]))
    edges = np.cumsum([0, *map(len, parts)])
    packed = [_packer(3).compress(flags[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pd.DataFrame({"slice": group["slice"], "bin": key[0], "flags": packed})


def flag_grams(slices: DataFrame, bins: int, hot_docs: int = HOT_DOCS) -> DataFrame:
    """(slice, flags): flags of the slice's grams in ascending order, bin by bin."""
    dealt = map_batches(
        slices.select("slice", "keys", "docs"),
        lambda batches: _deal_keys(batches, bins),
        "bin long, slice string, keys binary, docs binary",
    )
    flagged = dealt.groupBy("bin").applyInPandas(
        lambda key, group: _flag(key, group, hot_docs), "slice string, bin long, flags binary"
    )
    parts = flagged.groupBy("slice").agg(F.array_sort(F.collect_list(F.struct("bin", "flags"))).alias("parts"))
    return parts.select("slice", F.col("parts.flags").alias("flags"))


RUNS = "slice string, bin long, data binary, sizes binary, anchors binary, least binary, most binary, strings binary"
_RUNS = pa.schema(
    [("slice", pa.string()), ("bin", pa.int64())]
    + [(name.split()[0], pa.binary()) for name in RUNS.split(", ")[2:]]
)


@dataclass(frozen=True)
class Candidates:
    """The distinct strings of a slice's flagged runs, and where each run stands."""

    texts: list[bytes]
    keys: np.ndarray
    anchors: np.ndarray
    least: np.ndarray
    most: np.ndarray
    string: np.ndarray
    doc: np.ndarray
    start: np.ndarray


def slice_candidates(contents: list[bytes], ids: np.ndarray, flags: list[bytes] | None, units: Units) -> Candidates:
    """Cut out the runs whose gram is flagged; the same slice and flags give the same numbers."""
    flag = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(_unpacker().decompress(f), np.uint8) for f in flags or [])])
    values, counts, first_byte, last_byte, data = units.split(contents)
    runs = find_runs(values, counts, units)
    if len(runs.doc):
        flag = flag[np.searchsorted(_distinct(runs)[0], _keys(runs.gram))]
    cold, hot = np.flatnonzero(flag == 1), np.flatnonzero(flag == 2)
    # runs of very frequent grams become one run per window
    singles = ragged(runs.start[hot], runs.windows[hot])
    own = np.repeat(hot, runs.windows[hot])
    start = np.r_[runs.start[cold], singles]
    doc = np.r_[runs.doc[cold], runs.doc[own]]
    windows = np.r_[runs.windows[cold], np.ones(len(singles), np.int64)]
    anchor = np.r_[runs.anchor[cold], runs.anchor[own]] - start
    key = _keys(np.r_[runs.gram[cold], hashes_at(values, singles, units.size)])
    begin, end = first_byte[start], last_byte[start + windows + units.size - 2]
    number: dict[bytes, int] = {}
    whole = data.tobytes()
    string = np.fromiter(
        (number.setdefault(whole[a:b], len(number)) for a, b in zip(begin.tolist(), end.tolist(), strict=True)),
        np.int64,
        len(start),
    )
    least = np.full(len(number), NO_ID, np.int64)
    most = np.full(len(number), np.iinfo(np.int64).min, np.int64)
    np.minimum.at(least, string, ids[doc])
    np.maximum.at(most, string, ids[doc])
    where = np.empty(len(number), np.int64)
    where[string] = np.arange(len(string))
    return Candidates(list(number), key[where], anchor[where], least, most, string, doc, start)


def _candidates(batches: Iterable[pa.RecordBatch], units: Units, bins: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            (row,) = batch.slice(at, 1).to_pylist()
            contents, ids = unpack(row["packed"], row["sizes"]), np.frombuffer(row["ids"], "<i8")
            rows = list(_by_bin(row["slice"], slice_candidates(contents, ids, row["flags"], units), bins))
            for begin in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist(rows[begin : begin + 256], _RUNS)


def _by_bin(name: str, found: Candidates, bins: int) -> Iterator[dict]:
    bin_of = _bins(found.keys, bins)
    order = np.argsort(bin_of, kind="stable")
    edges = np.searchsorted(bin_of[order], np.arange(bins + 1))
    packer = _packer(3)
    for i in np.flatnonzero(np.diff(edges)).tolist():
        mine = order[edges[i] : edges[i + 1]]
        texts = [found.texts[m] for m in mine.tolist()]
        yield {
            "slice": name,
            "bin": i,
            "data": packer.compress(b"".join(texts)),
            "sizes": np.fromiter(map(len, texts), "<i4", len(texts)).tobytes(),
            "anchors": found.anchors[mine].astype("<i4").tobytes(),
            "least": found.least[mine].astype("<i8").tobytes(),
            "most": found.most[mine].astype("<i8").tobytes(),
            "strings": mine.astype("<i4").tobytes(),
        }


def flagged_slices(slices: DataFrame, flags: DataFrame) -> DataFrame:
    """Slices with their flags. What reads this twice shares the shuffle of the packed texts."""
    return slices.select("slice", "ids", "sizes", "packed").join(flags, "slice", "left")


def candidate_runs(flagged: DataFrame, units: Units, bins: int) -> DataFrame:
    """Rows with the distinct run strings per slice and bin, and their smallest and largest document."""
    return map_batches(flagged, lambda batches: _candidates(batches, units, bins), RUNS)


def binary(group: pd.DataFrame, column: str, kind: str) -> np.ndarray:
    """The arrays of a binary column, one after another."""
    return np.frombuffer(b"".join(group[column]), kind)


def distinct_strings(group: pd.DataFrame) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct strings of a bin, the number of every listed string, and each string's least document."""
    ends = np.cumsum(binary(group, "sizes", "<i4").astype(np.int64)).tolist()
    unpacker = _unpacker()
    whole = b"".join([unpacker.decompress(data) for data in group["data"]])
    number: dict[bytes, int] = {}
    of = np.fromiter(
        (number.setdefault(whole[a:b], len(number)) for a, b in zip([0, *ends], ends, strict=False)), np.int64, len(ends)
    )
    least = np.full(len(number), NO_ID, np.int64)
    np.minimum.at(least, of, binary(group, "least", "<i8"))
    return list(number), of, least


@dataclass(frozen=True)
class Stretches:
    """Maximal runs of windows of a string with the same smallest document."""

    owner: np.ndarray
    first: np.ndarray
    last: np.ndarray
    least: np.ndarray


def stretches(found: np.ndarray, begins: np.ndarray) -> Stretches:
    """``found`` has the smallest document per window; string i has the windows from ``begins[i]`` on."""
    new = np.r_[True, np.diff(found) != 0]
    new[begins] = True
    at = np.flatnonzero(new)
    owner = np.searchsorted(begins, at, side="right") - 1
    last = np.r_[at[1:], len(found)] - 1 - begins[owner]
    return Stretches(owner, at - begins[owner], last, found[at])


def removals(group: pd.DataFrame, of: np.ndarray, runs: Stretches, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Listed strings and their stretches that some document of the slice loses, and the cuts between rows.

    ``of`` numbers the listed strings, ``count`` strings in all.
    """
    begin = np.searchsorted(runs.owner, np.arange(count))
    length = np.diff(np.r_[begin, len(runs.owner)])
    stretch = ragged(begin[of], length[of])
    entry = np.repeat(np.arange(len(of)), length[of])
    smaller = runs.least[stretch] < binary(group, "most", "<i8")[entry]
    stretch, entry = stretch[smaller], entry[smaller]
    ends = np.cumsum([len(most) // 8 for most in group["most"]])
    return entry, stretch, np.searchsorted(entry, np.r_[0, ends])
