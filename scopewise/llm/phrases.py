"""Passage deduplication with automata of repeated phrases.

``windows`` brings runs of 13-word windows with one anchor together. In a bin the windows that recur are
confirmed word by word and joined to passages (maximal stretches of windows with the same smallest
document). Every slice of documents gets the passages that recur in it, as shards of ``SHARD`` passages;
each shard is compiled into an Aho-Corasick automaton over word numbers, and all documents of the slice
are streamed through it to locate every occurrence. A word goes if an occurrence of a passage that a
smaller document has covers it. Hashes of words bring candidates together; words are equal if their bytes are.

Defined cases: a null text has no words; texts of fewer words lose nothing; a null doc_id is larger than
any other and removes nothing; repeated rows of a document remove nothing from each other; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scopewise.llm import windows
from scopewise.llm.batches import map_batches, ragged
from scopewise.llm.shingles import exact_numbers, exact_windows, joined, mix, same_words, window_hashes, words
from scopewise.session import materialize

#: Words of a window.
WINDOW = 13
#: Words of an anchor.
GRAM = 4
#: Passages of one automaton.
SHARD = 10_000
#: Characters per word in an automaton.
WIDTH = 3


def _split(contents: list[bytes]) -> tuple:
    data, begins = joined(contents)
    start, end, hashed, counts = words(data, begins)
    return hashed, counts, start, end, data


UNITS = windows.Units(_split, WINDOW, GRAM)

VERDICT = "slice string, passages array<binary>, least array<long>"
#: Mixed into word hashes for a second, independent hash of a window.
_SECOND = np.uint64(0xA0761D6478BD642F)


def least_documents(hashed: np.ndarray, numbers: np.ndarray, counts: np.ndarray, least: np.ndarray) -> tuple:
    """For every window of every string, the smallest document that has it; and each string's first window.

    ``numbers`` are equal for equal words only. Windows are sorted by two hashes of their words and then
    compared number by number; should different windows share both hashes, windows are numbered exactly.
    """
    count = np.maximum(0, counts - WINDOW + 1)
    start = ragged(np.cumsum(counts) - counts, count)
    one = window_hashes(hashed, WINDOW)[start]
    two = window_hashes(mix(hashed ^ _SECOND), WINDOW)[start]
    order = np.lexsort((two, one))
    new = np.r_[True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])]
    at = start[order]
    rep = at[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))] if len(at) else at
    if not all((numbers[at + i] == numbers[rep + i]).all() for i in range(WINDOW)):
        name = exact_windows(numbers, WINDOW)[start]
        order = np.argsort(name, kind="stable")
        new = np.r_[True, name[order][1:] != name[order][:-1]]
    first = np.flatnonzero(new[: len(order)])
    smallest = np.minimum.reduceat(np.repeat(least, count)[order], first)
    found = np.empty(len(start), np.int64)
    found[order] = np.repeat(smallest, np.diff(np.r_[first, len(start)]))
    return found, np.cumsum(count) - count


def _confirm(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Per slice, the passages of its strings that a smaller document has."""
    strings, of, least = windows.distinct_strings(group)
    data, begins = joined(strings)
    start, end, hashed, counts = words(data, begins)
    numbers = exact_numbers(data, start, end, hashed)
    runs = windows.stretches(*least_documents(hashed, numbers, counts, least))
    entry, stretch, cuts = windows.removals(group, of, runs, len(strings))
    first = (np.cumsum(counts) - counts)[runs.owner]
    begin, stop = start[first + runs.first].tolist(), end[first + runs.last + WINDOW - 1].tolist()
    whole = data.tobytes()
    rows = []
    for name, a, b in zip(group["slice"], cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b > a:
            mine = stretch[a:b].tolist()
            rows.append((name, [whole[begin[i] : stop[i]] for i in mine], runs.least[mine].tolist()))
    return pd.DataFrame(rows, columns=["slice", "passages", "least"])


def _characters(numbers: np.ndarray, known: int) -> str:
    """``WIDTH`` characters per word number, each place with letters of its own.

    Few letters keep the nodes of an automaton narrow: it looks through the edges of a node one by one.
    """
    base = 1
    while base**WIDTH <= known:
        base += 1
    digits = numbers[:, None] // base ** np.arange(WIDTH) % base + base * np.arange(WIDTH)
    return (digits + 1).astype("<u4").tobytes().decode("utf-32-le")


@dataclass
class Shard:
    """An automaton over numbers of words (from 1 on) that finds passages by their place in the shard."""

    automaton: ahocorasick.Automaton
    #: Hashes of the distinct words of the passages, sorted, their numbers, and their bytes in ``data``.
    hashes: np.ndarray
    number: np.ndarray
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    #: Words of every passage.
    lengths: np.ndarray

    def numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        """The number of every word, 0 for words of no passage; words are compared by their bytes."""
        found = np.zeros(len(hashed), np.int64)
        at = np.searchsorted(self.hashes, hashed)
        left = np.arange(len(hashed))
        while True:  # more than once only if two words share a hash
            at = np.minimum(at, len(self.hashes) - 1)
            here = np.flatnonzero(self.hashes[at] == hashed[left])
            at, left = at[here], left[here]
            own, known = (data, start[left], end[left]), (self.data, self.start[at], self.end[at])
            same = same_words(own, known)
            found[left[same]] = self.number[at[same]]
            at, left = at[~same] + 1, left[~same]
            inside = at < len(self.hashes)
            at, left = at[inside], left[inside]
            if not len(left):
                return found


def shards(passages: list[bytes]) -> Iterator[Shard]:
    """Automata over word numbers of the passages."""
    for begin in range(0, len(passages), SHARD):
        data, begins = joined(passages[begin : begin + SHARD])
        start, end, hashed, counts = words(data, begins)
        numbers = exact_numbers(data, start, end, hashed)
        _, first = np.unique(numbers, return_index=True)
        known = first[np.argsort(hashed[first], kind="stable")]
        line, ends = _characters(numbers + 1, len(first)), (WIDTH * np.cumsum(counts)).tolist()
        found = ahocorasick.Automaton()
        for i, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
            found.add_word(line[a:b], i)
        found.make_automaton()
        yield Shard(found, hashed[known], numbers[known] + 1, data, start[known], end[known], counts)


DEDUPED = "doc_id long, n_words long, n_removed long, kept binary, removed array<struct<start:long,end:long>>"


def _locate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), span)
    names = ["doc_id", "n_words", "n_removed", "kept", "removed"]
    for batch in batches:
        for at in range(batch.num_rows):
            (row,) = batch.slice(at, 1).to_pylist()
            passages: dict[bytes, int] = {}
            for verdict in row["verdicts"] or []:
                passages.update(zip(verdict["passages"], verdict["least"], strict=True))
            out = list(_stream(windows.unpack(row["packed"], row["sizes"]), np.frombuffer(row["ids"], "<i8").tolist(), passages))
            for begin in range(0, len(out), 2000):
                columns = zip(*out[begin : begin + 2000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _stream(contents: list[bytes], ids: list[int], passages: dict[bytes, int]) -> Iterator[tuple]:
    """Rows of ``DEDUPED`` of all documents of a slice."""
    data, begins = joined(contents)
    start, end, hashed, counts = words(data, begins)
    covered = _covered((data, start, end, hashed), counts, np.array(ids, np.int64), passages)
    # kept words with the byte behind each, which becomes the space between them
    left = np.flatnonzero(~covered)
    sizes = end[left] - start[left] + 1
    text = data[ragged(start[left], sizes)]
    stops = np.cumsum(sizes)
    text[stops - 1] = 32
    kept_ends = np.r_[0, stops][np.searchsorted(left, np.cumsum(counts))].tolist()
    ends = np.cumsum(counts).tolist()
    for doc_id, a, b, c, d in zip(ids, [0, *ends], ends, [0, *kept_ends], kept_ends, strict=False):
        edge = np.flatnonzero(np.diff(np.r_[False, covered[a:b], False].astype(np.int8)))
        spans = [{"start": i, "end": j} for i, j in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True)]
        gone = int(covered[a:b].sum())
        yield (None if doc_id == windows.NO_ID else doc_id, b - a, gone, text[c : max(c, d - 1)].tobytes(), spans)


def _covered(found: tuple, counts: np.ndarray, ids: np.ndarray, passages: dict[bytes, int]) -> np.ndarray:
    """Which of the words (data, start, end, hash) of a slice lie in a passage that a smaller document has."""
    n = len(found[3])
    change = np.zeros(n + 1, np.int32)
    # a place without a word between documents keeps matches inside them
    place = np.arange(n) + np.repeat(np.arange(len(counts)), counts)
    owner = np.repeat(ids, counts)
    texts, least = list(passages), np.array(list(passages.values()), np.int64)
    for begin, shard in zip(range(0, len(texts), SHARD), shards(texts), strict=True):
        line = np.zeros(n + len(counts), np.int64)
        line[place] = shard.numbers(*found)
        matches = np.array(list(shard.automaton.iter(_characters(line, len(shard.hashes)))), np.int64).reshape(-1, 2)
        last, passage = np.searchsorted(place, matches[:, 0] // WIDTH), matches[:, 1]
        smaller = least[begin + passage] < owner[last]
        last, passage = last[smaller], passage[smaller]
        np.add.at(change, last + 1 - shard.lengths[passage], 1)
        np.add.at(change, last + 1, -1)
    return np.cumsum(change[:-1]) > 0


def remove_passages(docs: DataFrame, hot_docs: int = windows.HOT_DOCS) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the remaining words) and removed spans of words of every row.

    A word goes if a window of ``WINDOW`` words around it also starts in a document of smaller doc_id.
    """
    slices = materialize(windows.slice_rows(docs, UNITS), "slices")
    bins = windows.number_of_bins(slices)
    flags = materialize(windows.flag_grams(slices, bins, hot_docs), "gram-flags")
    flagged = windows.flagged_slices(slices, flags)
    runs = windows.candidate_runs(flagged, UNITS, bins).select("slice", "bin", "data", "sizes", "least", "most")
    confirmed = runs.groupBy("bin").applyInPandas(_confirm, VERDICT)
    verdicts = confirmed.groupBy("slice").agg(F.collect_list(F.struct("passages", "least")).alias("verdicts"))
    whole = flagged.join(verdicts, "slice", "left")
    return map_batches(whole, _locate, DEDUPED)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
