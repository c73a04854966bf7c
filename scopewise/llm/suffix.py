"""Substring deduplication with a sparse suffix array, sorted deep-shallow.

``windows`` brings the runs of 50-byte windows with one anchor together. In a bin, the suffixes that begin
at anchors and the reversed prefixes before them are sorted like suffix arrays:

* *shallow*: multikey quicksort by words of eight bytes, down to ``SHALLOW`` bytes;
* *deep*: groups that still agree are ordered by a blind trie (only branching bytes are looked at on the
  way down, one comparison with the leaf finds the common prefix), which also gives common prefix lengths.

Two windows with anchors at the same place are equal if the common prefix of their suffixes and that of
their reversed prefixes reach far enough; both follow from the sorted orders, so windows are never
compared in pairs. A window is removed if a document with a smaller doc_id has it.

Defined cases: a null text is empty; texts shorter than a window lose nothing; a null doc_id is larger
than any other and removes nothing; repeated rows of a document remove nothing from each other; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scopewise.llm import windows
from scopewise.llm.batches import map_batches, ragged
from scopewise.llm.shingles import mix
from scopewise.session import materialize

#: Bytes of a window.
WINDOW = 50
#: Bytes of an anchor.
GRAM = 28
#: Bytes that the multikey quicksort looks at; a multiple of eight.
SHALLOW = 24
#: Partitions of fewer suffixes are left to a plain sort of their shallow keys.
SMALL = 24

_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))


def _split(contents: list[bytes]) -> tuple:
    data = np.frombuffer(b"".join(contents), np.uint8)
    at = np.arange(len(data) + 1, dtype=np.int64)
    counts = np.fromiter(map(len, contents), np.int64, len(contents))
    return _BYTE_VALUES[data], counts, at[:-1], at[1:], data


UNITS = windows.Units(_split, WINDOW, GRAM)


# Deep-shallow sorting


def multikey_order(keys: np.ndarray) -> np.ndarray:
    """Order of rows of 64-bit words by multikey quicksort: split by one word in three, recurse."""
    order = np.arange(len(keys))
    todo = [(0, len(keys), 0)]
    while todo:
        begin, end, depth = todo.pop()
        if end - begin < 2 or depth == keys.shape[1]:
            continue
        part = order[begin:end]
        if end - begin < SMALL:
            rows = keys[part, depth:].tolist()
            order[begin:end] = part[sorted(range(len(rows)), key=rows.__getitem__)]
            continue
        word = keys[part, depth]
        pivot = np.partition(word[:: max(1, len(word) // 9)], 4 if len(word) >= 9 else 0)[4 if len(word) >= 9 else 0]
        low, equal = word < pivot, word == pivot
        one, two = int(low.sum()), int(equal.sum())
        order[begin:end] = np.concatenate([part[low], part[equal], part[~(low | equal)]])
        todo += [(begin, begin + one, depth), (begin + one, begin + one + two, depth + 1), (begin + one + two, end, depth)]
    return order


def common_prefix(one: bytes, two: bytes) -> int:
    size = min(len(one), len(two))
    difference = int.from_bytes(one[:size], "big") ^ int.from_bytes(two[:size], "big")
    return size - (difference.bit_length() + 7) // 8


class BlindTrie:
    """Strings in a trie that keeps only branching bytes.

    An inner node is [depth, {byte or -1 at the end: child}]; a leaf is a list of equal strings' numbers.
    """

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | None = None

    @staticmethod
    def _inner(node: list) -> bool:
        return len(node) == 2 and isinstance(node[1], dict)

    def insert(self, number: int) -> None:
        text = self.strings[number]
        if self.root is None:
            self.root = [number]
            return
        node = self.root
        while self._inner(node):  # blindly down to any leaf
            depth, children = node
            node = children.get(text[depth] if depth < len(text) else -1) or next(iter(children.values()))
        other = self.strings[node[0]]
        shared = common_prefix(text, other)
        if shared == len(text) == len(other):
            node.append(number)
            return
        parent, edge, node = None, None, self.root
        while self._inner(node) and node[0] < shared:
            parent, edge = node, text[node[0]] if node[0] < len(text) else -1
            node = node[1][edge]
        mine = text[shared] if shared < len(text) else -1
        if self._inner(node) and node[0] == shared:
            node[1][mine] = [number]
            return
        theirs = other[shared] if shared < len(other) else -1
        new = [shared, {mine: [number], theirs: node}]
        if parent is None:
            self.root = new
        else:
            parent[1][edge] = new

    def ordered(self) -> tuple[list[int], list[int]]:
        """Numbers in order, and the common prefix of each with the one before (0 for the first)."""
        numbers: list[int] = []
        shared: list[int] = []
        todo: list[tuple[list, int]] = [(self.root, 0)] if self.root else []
        while todo:
            node, before = todo.pop()
            if self._inner(node):
                depth, children = node
                edges = sorted(children)
                todo += [(children[e], depth) for e in reversed(edges[1:])]
                todo.append((children[edges[0]], before))
            else:
                numbers += node
                shared += [before, *[len(self.strings[node[0]])] * (len(node) - 1)]
        return numbers, shared


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the strings and the common prefix of each with the one before."""
    count = len(strings)
    if not count:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.frombuffer(b"".join([s[:shallow].ljust(shallow, b"\0") for s in strings]), np.uint8).reshape(count, shallow)
    # the length tells an end from a zero byte
    sizes = np.minimum(np.fromiter(map(len, strings), np.int64, count), shallow)
    keys = np.column_stack([heads.view(">u8").astype(np.uint64), sizes.astype(np.uint64)])
    order = multikey_order(keys)
    shared = np.zeros(count, np.int64)
    if count > 1:
        one, two = heads[order[:-1]], heads[order[1:]]
        differ = one != two
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), shallow)
        shared[1:] = np.minimum(first, np.minimum(sizes[order[:-1]], sizes[order[1:]]))
    new = np.r_[True, (keys[order[1:]] != keys[order[:-1]]).any(axis=1)]
    first = np.flatnonzero(new)
    lengths = np.diff(np.r_[first, count])
    for begin, length in zip(first[lengths > 1].tolist(), lengths[lengths > 1].tolist(), strict=True):
        trie = BlindTrie(strings)
        for number in order[begin : begin + length].tolist():
            trie.insert(number)
        numbers, depths = trie.ordered()
        order[begin : begin + length] = numbers
        shared[begin + 1 : begin + length] = depths[1:]
    return order, shared


def _classes(order: np.ndarray, shared: np.ndarray, reach: int) -> np.ndarray:
    """A number per string, equal for strings with the same first ``reach`` bytes."""
    numbers = np.empty(len(order), np.int64)
    numbers[order] = np.cumsum(shared < reach)
    return numbers


def least_documents(
    strings: list[bytes], anchor: np.ndarray, least: np.ndarray, size: int = WINDOW
) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every string, the smallest document that has it; and each string's first window.

    ``anchor`` is the place of a string's anchor, ``least`` the smallest document that has the string.
    """
    right, right_shared = deep_shallow([s[a:] for s, a in zip(strings, anchor.tolist(), strict=True)])
    left, left_shared = deep_shallow([s[:a][::-1] for s, a in zip(strings, anchor.tolist(), strict=True)])
    counts = np.fromiter(map(len, strings), np.int64, len(strings)) - size + 1
    begins = np.cumsum(counts) - counts
    found = np.empty(int(counts.sum()), np.int64)
    for before in range(size):
        start = anchor - before
        mine = np.flatnonzero((start >= 0) & (start < counts))
        if not len(mine):
            continue
        one = _classes(right, right_shared, size - before)[mine]
        two = _classes(left, left_shared, before)[mine]
        key = one * (len(strings) + 1) + two
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
        smallest = np.minimum.reduceat(least[mine][order], first)
        found[begins[mine[order]] + start[mine[order]]] = np.repeat(smallest, np.diff(np.r_[first, len(mine)]))
    return found, begins


VERDICT = "slice string, string binary, first binary, last binary, least binary"


def _judge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Per slice, the stretches of windows of its strings that a smaller document has."""
    strings, of, least = windows.distinct_strings(group)
    anchor = np.empty(len(strings), np.int64)
    anchor[of] = windows.binary(group, "anchors", "<i4")
    runs = windows.stretches(*least_documents(strings, anchor, least))
    entry, stretch, cuts = windows.removals(group, of, runs, len(strings))
    names = windows.binary(group, "strings", "<i4")[entry]
    columns = [(names, "<i4"), (runs.first[stretch], "<i4"), (runs.last[stretch], "<i4"), (runs.least[stretch], "<i8")]
    rows = [
        (name, *(values[a:b].astype(kind).tobytes() for values, kind in columns))
        for name, a, b in zip(group["slice"], cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
        if b > a
    ]
    return pd.DataFrame(rows, columns=["slice", "string", "first", "last", "least"])


DEDUPED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, removed array<struct<start:long,end:long>>"


def _cover(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for at in range(batch.num_rows):
            (row,) = batch.slice(at, 1).to_pylist()
            contents = windows.unpack(row["packed"], row["sizes"])
            ids = np.frombuffer(row["ids"], "<i8")
            lengths = np.fromiter(map(len, contents), np.int64, len(contents))
            covered = _covered(contents, ids, row, int(lengths.sum()))
            ends = np.cumsum(lengths)
            out = []
            for doc_id, content, end in zip(ids.tolist(), contents, ends.tolist(), strict=True):
                own = covered[end - len(content) : end]
                edge = np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8)))
                kept = np.frombuffer(content, np.uint8)[~own].tobytes() if len(edge) else content
                spans = [{"start": a, "end": b} for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True)]
                out.append((None if doc_id == windows.NO_ID else doc_id, len(content), int(own.sum()), len(spans), kept, spans))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), span)
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "removed"]
            for begin in range(0, len(out), 2000):
                columns = zip(*out[begin : begin + 2000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _covered(contents: list[bytes], ids: np.ndarray, row: dict, size: int) -> np.ndarray:
    """Which bytes of a slice lie in a removed window."""
    change = np.zeros(size + 1, np.int32)
    if row["verdicts"]:
        runs = windows.slice_candidates(contents, ids, row["flags"], UNITS)
        string, first, last, least = (
            np.frombuffer(b"".join(v[c] for v in row["verdicts"]), k)
            for c, k in (("string", "<i4"), ("first", "<i4"), ("last", "<i4"), ("least", "<i8"))
        )
        order = np.argsort(string, kind="stable")
        begin = np.searchsorted(string[order], runs.string, "left")
        count = np.searchsorted(string[order], runs.string, "right") - begin
        stretch = order[ragged(begin, count)]
        run = np.repeat(np.arange(len(runs.string)), count)
        smaller = least[stretch] < ids[runs.doc[run]]
        run, stretch = run[smaller], stretch[smaller]
        np.add.at(change, runs.start[run] + first[stretch], 1)
        np.add.at(change, runs.start[run] + last[stretch] + WINDOW, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, hot_docs: int = windows.HOT_DOCS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) and removed spans of every row.

    A byte goes if a window of ``WINDOW`` bytes around it also starts in a document of smaller doc_id.
    """
    slices = materialize(windows.slice_rows(docs, UNITS), "slices")
    bins = windows.number_of_bins(slices)
    flags = materialize(windows.flag_grams(slices, bins, hot_docs), "gram-flags")
    flagged = windows.flagged_slices(slices, flags)
    judged = windows.candidate_runs(flagged, UNITS, bins).groupBy("bin").applyInPandas(_judge, VERDICT)
    verdicts = judged.groupBy("slice").agg(F.collect_list(F.struct("string", "first", "last", "least")).alias("verdicts"))
    whole = flagged.join(verdicts, "slice", "left")
    return map_batches(whole, _cover, DEDUPED)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
