"""Language model scores from a probabilistic suffix tree over words.

The tree holds contexts of up to ``max_context`` words. A node is kept if its next-word distribution diverges
from that of its parent (the context without its oldest word) by more than its parameters are worth, or if a
kept node is below it. The probability of a token comes from the state of the longest kept suffix of the words
before it: tokens seen there have discounted frequencies, the rest goes to the parent state, down to the root,
whose distribution adds a half to every count. So every state is a distribution over all tokens and one
unknown one.

Every run of words that occurs ``least_count`` times in training is in the tree, whatever the size of the input
(``least_share`` asks for a share of the tokens too; it is 0 unless a caller wants a smaller tree):

1. All words of all texts are counted (one shuffle of words with counts). The most frequent, at most ``_HEAD``,
   get numbers.
2. Texts become arrays of word numbers, stored. A filter of a bounded size tells of other words whether they may
   occur twice; those have codes of 62 bits of a cryptographic digest.
3. Where the tokens are few enough that no length can have more than ``_HEAD`` runs, runs are counted level by
   level, the tree is fitted in memory, and every document is scored in one pass without a shuffle.
4. Otherwise every place of every text goes, with the three words before it, to the bin of the word before it (one
   shuffle). All contexts that end with a word are in its bin, and so is what comes after them: the bin counts runs,
   fits its part of the tree and scores its places. Sums per text go back by blocks of rows.
5. Contexts that more than ``_GROUP`` words follow are heavy. Their counts are made by a shuffle beforehand and given
   to several bins, over which places are dealt by the next word before, down to single places. Whether a heavy
   context is kept for the sake of a longer one is known when all bins are done, so what it adds is given apart.
6. Places with a repeated word without number pass the bin of that word first, which counts it and brings its part
   of the base score.

Defined cases: null and empty texts have one token, the end; a null doc_id is not held out; repeated rows each
count and each get a row; without training rows all tokens have the probability of the unknown one; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scopewise.llm.batches import encoded, give_back, map_batches, pieces
from scopewise.llm.runs import blocks
from scopewise.llm.shingles import mix
from scopewise.session import discard, materialize, scratch_tables

#: Words of context at most.
MAX_CONTEXT = 3
#: Share of the tokens that a run of words needs to be in the tree.
LEAST_SHARE = 0.0
#: Occurrences that a run of words needs to be in the tree.
LEAST_COUNT = 2
#: Taken from every count of a next word and given to words not seen in the context.
DISCOUNT = 0.75
#: The end of a text as a token; no word is empty.
END = ""
#: Distinct words that a task counts before it gives them on, and runs of words that it sorts at once.
_COUNTED, _SORTED = 500_000, 1 << 20
#: Words that get numbers, and runs of a length in a tree in memory, at most.
_HEAD = 1_000_000
#: Bits of a filter at most, and bits for each word in it.
_FILTER, _FILTER_EACH = 1 << 27, 16
#: Words that may follow a context before it is dealt to several bins; other bins have about a third as many.
_GROUP = 3 << 19
#: Bins at least.
_BINS = 32
#: Bits of the numbers of rows whose scores are added up together.
_BLOCK = 12
#: What marks codes of words without numbers, among all words and among those of a bin.
_HASHED = np.int64(1 << 62)
_FAR = np.int64(1 << 30)
_HIGH = np.int64(32)
_LOW = np.int64((1 << 32) - 1)
_LAST = np.int64((1 << 22) - 1)


def held_out() -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _words(data: bytes) -> Iterator[list[bytes]]:
    for block in blocks(data.lower()):
        yield block.split()


# Words


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[bool, Counter[bytes]] = {False: Counter(), True: Counter()}

    def give() -> Iterator[pa.RecordBatch]:
        for held, counts in seen.items():
            n = pa.array(list(counts.values()), pa.int64())
            trained = pa.array(np.zeros(len(counts), np.int64)) if held else n
            names = pa.array(list(counts), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([names, n, trained], ["word", "n", "trained"])
            counts.clear()

    for piece in pieces(batches):
        for held, data in zip(piece.column("held_out").to_pylist(), encoded(piece), strict=True):
            counts = seen[held]
            for words in _words(data):
                counts.update(words)
            counts[END.encode()] += 1
            if len(counts) >= _COUNTED:
                yield from give()
    yield from give()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n, trained): occurrences in all rows of ``docs`` (text, held_out) and in those not held out."""
    return (
        docs.select("text", "held_out")
        .transform(map_batches, _count_words, "word string, n long, trained long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"), F.sum("trained").alias("trained"))
    )


# Texts as word numbers


def _word_code(word: bytes) -> int:
    """63 bits for a word without a number, apart from all numbers."""
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "big") >> 2 | 1 << 62


def _filter_bits(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = [_word_code(word) for word in encoded(batch, "word")]
        bit = _places(np.array(codes, np.int64), n)
        bits = (np.uint64(1) << (bit & 63).astype(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(bit >> 6), pa.array(bits)], ["place", "bits"])


def _filter(words: DataFrame) -> np.ndarray:
    """A bit for every one of ``words`` (word) by its hash; words share bits, more so once the filter has its full size."""
    n = max(64, min(_FILTER, 1 << (_FILTER_EACH * words.count()).bit_length()))
    found = (
        words.select("word")
        .transform(map_batches, lambda batches: _filter_bits(batches, n), "place long, bits long")
        .groupBy("place")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    bits = np.zeros(n >> 6, np.int64)
    bits[found["place"].to_numpy()] = found["bits"].to_numpy()
    return bits.view(np.uint64)


def _passed(codes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the filter has each code."""
    bit = _places(codes, len(bits) * 64)
    return (bits[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) > 0


def _encode(
    batches: Iterable[pa.RecordBatch], number: dict[bytes, int], bits: np.ndarray | None, id_type: pa.DataType
) -> Iterator[pa.RecordBatch]:
    """Numbers of the words of every text; -1 for words without one, -2 if the filter tells that they occur once."""
    end = np.array([number[END.encode()]], np.int32)
    for piece in pieces(batches):
        ids, codes = [], []
        for data in encoded(piece):
            own, unnumbered = [], []
            for words in _words(data):
                found = np.fromiter(map(number.get, words, repeat(-2)), np.int32, len(words))
                if bits is not None:
                    at = np.flatnonzero(found < 0)
                    code = np.fromiter((_word_code(words[i]) for i in at.tolist()), np.int64, len(at))
                    passed = _passed(code, bits)
                    found[at[passed]] = -1
                    unnumbered.append(code[passed])
                own.append(found)
            codes.append(b"".join(code.tobytes() for code in unnumbered))
            ids.append(np.concatenate([*own, end]).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                piece.column("row"),
                piece.column("doc_id").cast(id_type),
                piece.column("held_out"),
                pa.array(ids, pa.binary()),
                pa.array(codes, pa.binary()),
            ],
            ["row", "doc_id", "held_out", "ids", "codes"],
        )


def _joined(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all texts of a piece, a -1 behind each text and for words without one, where each text begins,
    and which words occur once.
    """
    ids = [np.frombuffer(own, np.int32) for own in piece.column("ids").to_pylist()]
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    begins = np.cumsum(lengths + 1) - lengths - 1
    joined = np.full(int(lengths.sum()) + len(ids), -1, np.int64)
    for begin, own in zip(begins.tolist(), ids, strict=True):
        joined[begin : begin + len(own)] = own
    return np.maximum(joined, -1), begins, joined == -2


# The tree


@dataclass
class Level:
    """Frequent runs of one length. The number of a run is its place in ``keys``."""

    #: Number of the run without its last word, times 2**32, plus the number of that word; sorted.
    keys: np.ndarray
    counts: np.ndarray
    #: Number of the run without its first word, one level above.
    suffix: np.ndarray
    #: log10 probability of the last word after the others.
    log_p: np.ndarray
    #: Whether the run is a context of the tree, and log10 of the share its parent gets of words not seen after it.
    kept: np.ndarray
    log_rest: np.ndarray

    def numbers(self, prefix: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Numbers of runs, -1 for those that are not frequent."""
        known = (prefix >= 0) & (last >= 0)
        if not len(self.keys):
            return np.full(len(prefix), -1, np.int64)
        key = (prefix << _HIGH) + last
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(known & (self.keys[at] == key), at, -1)


def run_numbers(ids: np.ndarray, levels: list[Level]) -> list[np.ndarray]:
    """For every length the number of the frequent run that ends at each place, or -1."""
    found = [ids]
    for level in levels[1:]:
        before = np.concatenate([[-1], found[-1][:-1]])
        found.append(level.numbers(before, ids))
    return found


def _count_runs(batches: Iterable[pa.RecordBatch], levels: list[Level]) -> Iterator[pa.RecordBatch]:
    """Runs one word longer than those of the last level, where both their parts are frequent."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return keys, np.bincount(place, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)

    for piece in pieces(batches, "ids"):
        ids, _, _ = _joined(piece)
        ends = run_numbers(ids, levels)[-1]
        at = np.flatnonzero((ends[1:] >= 0) & (ends[:-1] >= 0)) + 1
        if len(at):
            held.append(np.unique((ends[at - 1] << _HIGH) + ids[at], return_counts=True))
        if sum(len(k) for k, _ in held) > _SORTED:
            held = [merged()]
            if len(held[0][0]) > _SORTED // 2:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, held[0])), ["key", "n"])
                held = []
    if held:
        yield pa.RecordBatch.from_arrays(list(map(pa.array, merged())), ["key", "n"])


def _next_level(texts: DataFrame, levels: list[Level], least: int) -> Level:
    """Count the runs that are one word longer; at most tokens / ``least`` of them reach the driver."""
    shared = texts.sparkSession.sparkContext.broadcast(levels)
    found = (
        texts.select("ids")
        .transform(map_batches, lambda batches: _count_runs(batches, shared.value), "key long, n long")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
        .toArrow()
        .to_pandas()
        .sort_values("key")
    )
    keys, counts = found["key"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
    prefix, last = keys >> _HIGH, keys & _LOW
    suffix = last if len(levels) == 1 else levels[-1].numbers(levels[-1].suffix[prefix], last)
    none = np.zeros(len(keys))
    return Level(keys, counts, suffix, none, none.astype(bool), none)


def fit(levels: list[Level], discount: float = DISCOUNT) -> None:
    """Next-word distributions of all contexts, and the contexts that are kept.

    The root's distribution, ``levels[0].log_p``, is given.
    """
    for above, level in zip(levels, levels[1:], strict=False):
        if not len(level.keys):
            continue
        prefix = level.keys >> _HIGH
        n, size = above.counts[prefix], len(above.keys)
        p = (level.counts - discount) / n
        parent = 10.0 ** above.log_p[level.suffix]
        rest = np.maximum(1.0 - np.bincount(prefix, p, size), 1e-12)
        parent_rest = np.maximum(1.0 - np.bincount(prefix, parent, size), 1e-12)
        level.log_p = np.log10(p)
        above.log_rest = np.log10(rest / parent_rest)
        # Divergence from the parent, with all words not seen here as one, against half a log per parameter.
        seen = np.bincount(prefix, minlength=size)
        divergence = np.bincount(prefix, p * np.log(p / parent), size) + rest * np.log(rest / parent_rest)
        counts = np.maximum(above.counts, 1)
        above.kept = (seen > 0) & (counts * divergence > 0.5 * seen * np.log(counts))
    # Kept nodes keep the path to the root.
    for above, level in zip(reversed(levels[:-1]), reversed(levels[1:]), strict=True):
        above.kept[level.suffix[level.kept]] = True


@dataclass
class Model:
    levels: list[Level]
    #: Training tokens and distinct ones.
    tokens: int
    types: int

    def root(self, count):
        """log10 probability of a token that occurs ``count`` times, without context."""
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.types + 1)))


def train(texts: DataFrame, counts: np.ndarray, tokens: int, types: int, max_context: int, least: int) -> Model:
    """Fit a tree on ``texts`` (ids); ``counts`` are the training counts of the frequent words by number."""
    n = np.arange(len(counts), dtype=np.int64)
    model = Model([Level(n, counts, np.zeros(len(n), np.int64), n * 0.0, n < 0, n * 0.0)], tokens, types)
    model.levels[0].log_p = model.root(counts)
    for _ in range(max_context):
        level = _next_level(texts, model.levels, least)
        if not len(level.keys):
            break
        model.levels.append(level)
    fit(model.levels)
    return model


# The tree in bins


def _codes(piece: pa.RecordBatch, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words of a piece, 0 for words that are in no run and behind each text, and where each begins."""
    ids, begins, single = _joined(piece)
    # _joined puts -1 behind each text, so a word without number is a -1 at any other place.
    inside = ~single
    inside[np.r_[begins[1:], len(ids)] - 1] = False
    codes = np.where((ids >= 0) & known[ids], ids + 1, 0)
    codes[(ids < 0) & inside] = np.frombuffer(b"".join(piece.column("codes").to_pylist()), np.int64)
    return codes, begins


@dataclass
class Deal:
    """How contexts are dealt to bins.

    A context that more than ``_GROUP`` words follow is heavy. All its words are heavy words, which have numbers.
    Heavy contexts of one word are numbered first, then those of two words, then three.
    """

    #: Bins of words that are not heavy.
    light: int
    #: Codes of heavy words, sorted.
    words: np.ndarray
    #: For two and three words: number of the context without its first word, times the heavy words, plus the
    #: first word's place among them; sorted.
    keys: list[np.ndarray]
    #: Training occurrences and all, of every heavy context.
    trained: np.ndarray
    total: np.ndarray

    def first(self, level: int) -> int:
        """Number of the first heavy context of so many words."""
        return 0 if level == 1 else len(self.words) + sum(map(len, self.keys[: level - 2]))

    def places(self, words: np.ndarray) -> np.ndarray:
        """Places of codes among the heavy words, or -1."""
        if not len(self.words):
            return np.full(len(words), -1, np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, -1)

    def heavy(self, contexts: list[np.ndarray]) -> list[np.ndarray]:
        """For every length the number of the heavy context at each place, or -1; the nearest word comes first."""
        found = [self.places(contexts[0])]
        for level, keys in enumerate(self.keys, 2):
            above, place = found[-1], self.places(contexts[level - 1])
            key = above * len(self.words) + place
            if not len(keys):
                found.append(np.full(len(key), -1, np.int64))
                continue
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            found.append(np.where((above >= 0) & (place >= 0) & (keys[at] == key), at + self.first(level), -1))
        return found

    @property
    def parents(self) -> np.ndarray:
        """Number of the context without its first word, -1 for single words."""
        return np.concatenate([np.full(len(self.words), -1, np.int64), *[k // len(self.words) for k in self.keys]])

    @property
    def spread(self) -> np.ndarray:
        """Bins over which the words after a heavy context are dealt."""
        return self.total // (_GROUP // 2) + 1

    @property
    def begins(self) -> np.ndarray:
        """First bin of every heavy context."""
        return self.light + np.cumsum(self.spread) - self.spread

    @property
    def bins(self) -> int:
        return self.light + int(self.spread.sum())

    def members(self) -> list[tuple[int, ...]]:
        """The words of every heavy context, nearest first."""
        found = [(int(word),) for word in self.words]
        for keys in self.keys:
            found += [(*found[k // len(self.words)], int(self.words[k % len(self.words)])) for k in keys.tolist()]
        return found

    def needed(self) -> list[np.ndarray]:
        """Bins that need the counts of every heavy context: its own and those of contexts that it ends."""
        own = [np.arange(b, b + n) for b, n in zip(self.begins.tolist(), self.spread.tolist(), strict=True)]
        for at, parent in reversed(list(enumerate(self.parents.tolist()))):
            if parent >= 0:
                own[parent] = np.r_[own[parent], own[at]]
        return own


@dataclass
class Windows:
    """Places of texts: the words before, nearest first, the word, and the text, as a place in ``rows``.

    A 0 is a word that is in no run or none. Training counts of words without numbers are given where they are known.
    """

    contexts: list[np.ndarray]
    words: np.ndarray
    text: np.ndarray
    rows: np.ndarray
    held: np.ndarray
    trained: dict[int, int]

    def blob(self, bin_: int, at: np.ndarray) -> tuple:
        """Some of the places as a row of ``_DEALT``."""
        own, index = np.unique(self.text[at], return_inverse=True)
        columns = [*(c[at] for c in self.contexts), self.words[at], index << 1 | self.held[self.text[at]]]
        return _blob(bin_, -1, columns, self.rows[own], self.trained)


def _windows(
    batches: Iterable[pa.RecordBatch], known: np.ndarray, end: int, max_context: int, rare: bool = False
) -> Iterator[Windows]:
    """All places of texts after a word that may be in a run and with a word that has a number, or, with ``rare``,
    all places whose word has none but does not occur once. Or places that are stored already.
    """
    for batch in batches:
        if "ids" not in batch.schema.names:
            for blob in batch.to_pylist():
                codes, last, rows = _unblob(blob, max_context + 1)
                held = np.zeros(len(rows), np.int64)
                held[last >> 1] = last & 1
                far = np.frombuffer(blob["far"], np.int64).tolist()
                trained = dict(zip(far, np.frombuffer(blob["far_n"], np.int64).tolist(), strict=True))
                yield Windows(list(codes[:-1]), codes[-1], last >> 1, rows, held, trained)
            continue
        for piece in pieces([batch], "ids"):
            words, begins = _codes(piece, known)
            text = np.repeat(np.arange(len(begins)), np.diff(np.r_[begins, len(words)]))
            before = np.r_[0, words[:-1]]
            before[before == end] = 0
            at = np.flatnonzero(words >= _HASHED if rare else (before > 0) & (words < _HASHED))
            contexts = [before[at]]
            for level in range(2, max_context + 1):
                # A text has a 0 behind it, so no word of another text is reached.
                contexts.append(np.where((at >= level) & (contexts[-1] > 0), words[np.maximum(at - level, 0)], 0))
            held = piece.column("held_out").to_numpy(zero_copy_only=False).astype(np.int64)
            yield Windows(contexts, words[at], text[at], piece.column("row").to_numpy(), held, {})


def _count_heavy(batches: Iterable[pa.RecordBatch], shared, level: int) -> Iterator[pa.RecordBatch]:
    """(key, n, trained): contexts of ``level`` words that may be heavy."""
    deal, *how = shared
    for found in _windows(batches, *how):
        above, place = deal.heavy(found.contexts)[-1], deal.places(found.contexts[level - 1])
        at = np.flatnonzero((above >= 0) & (place >= 0))
        learned = 1 - found.held[found.text[at]]
        key, index = np.unique((above * len(deal.words) + place)[at], return_inverse=True)
        n = [np.bincount(index, weights, len(key)).astype(np.int64) for weights in (None, learned)]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, (key, *n))), ["key", "n", "trained"])


def _count_after_heavy(batches: Iterable[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """(h, w, n, n_w): words after heavy contexts in training, and their own training counts if they have no number."""
    deal, *how = shared
    for found in _windows(batches, *how):
        learned = (found.held[found.text] == 0) & (found.words > 0)
        for heavy in deal.heavy(found.contexts):
            at = np.flatnonzero((heavy >= 0) & learned)
            code, index = np.unique(found.words[at], return_inverse=True)
            key, n = np.unique(heavy[at] * (len(code) + 1) + index, return_counts=True)
            h, w = key // (len(code) + 1), code[key % (len(code) + 1)] if len(code) else key
            own = np.fromiter((found.trained.get(c, 0) for c in w.tolist()), np.int64, len(w))
            yield pa.RecordBatch.from_arrays(list(map(pa.array, (h, w, n, own))), ["h", "w", "n", "n_w"])


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).reshape(n)


_DEALT = "bin long, h long, n long, places binary, m long, rows binary, f long, far binary, far_n binary"
_DEALT_NAMES = [part.split()[0] for part in _DEALT.split(", ")]


def _blob(bin_, h, columns: list[np.ndarray], rows: np.ndarray, trained: dict[int, int]) -> tuple:
    """A row of ``_DEALT``: columns of codes, then one of other numbers, in 32 bits each.

    Codes without numbers are replaced by places among ``far``.
    """
    codes = np.stack(columns[:-1])
    at = codes >= _HASHED
    far = np.unique(codes[at])
    codes[at] = _FAR + np.searchsorted(far, codes[at])
    n = np.fromiter((trained.get(c, 0) for c in far.tolist()), np.int64, len(far))
    numbers = np.concatenate([codes.ravel(), columns[-1]]).astype(np.int32)
    return (bin_, h, len(columns[0]), _packed(numbers), len(rows), _packed(np.diff(rows, prepend=0)), len(far), far.tobytes(), n.tobytes())


def _unblob(blob: dict, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The columns of codes, the other numbers, and the rows of a row of ``_DEALT``."""
    n = blob["n"]
    numbers = _unpacked(blob["places"], n * (columns + 1), np.int32).astype(np.int64).reshape(columns + 1, n)
    codes = numbers[:-1]
    if blob["f"]:
        at = codes >= _FAR
        codes[at] = np.frombuffer(blob["far"], np.int64)[codes[at] - _FAR]
    return codes, numbers[-1], np.cumsum(_unpacked(blob["rows"], blob["m"], np.int64))


def _dealt(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary() if name in ("places", "rows", "far", "far_n") else pa.int64() for name in _DEALT_NAMES]
    columns = zip(*found, strict=True) if found else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _DEALT_NAMES)


def _blobs(found: Windows, bins: np.ndarray) -> Iterator[pa.RecordBatch]:
    # The order within a bin makes the columns small.
    order = np.argsort((bins << 44) + ((found.contexts[0] & _LAST) << 22) + (found.words & _LAST))
    parts = np.split(order, np.flatnonzero(np.diff(bins[order])) + 1)
    yield _dealt([found.blob(int(bins[at[0]]), at) for at in parts if len(at)])


def _deal_rare(batches: Iterable[pa.RecordBatch], how: tuple, bins: int) -> Iterator[pa.RecordBatch]:
    """Every place with a word without number to the bin of that word."""
    for found in _windows(batches, *how, rare=True):
        yield from _blobs(found, _places(found.words, bins))


def _count_rare(table: pa.Table, model: Model, least: int, max_context: int) -> pa.Table:
    """The places of a bin with the training counts of their words, and, with -2 as ``h``, what these words add to rows."""
    contexts, words, text, rows, held, n_rows = [], [], [], [], [], 0
    for blob in table.to_pylist():
        codes, last, own = _unblob(blob, max_context + 1)
        contexts.append(codes[:-1])
        words.append(codes[-1])
        text.append(n_rows + (last >> 1))
        held.append(np.zeros(len(own), np.int64))
        held[-1][last >> 1] = last & 1
        rows.append(own)
        n_rows += len(own)
    contexts = np.concatenate(contexts, axis=1)
    words, text, rows, held = map(np.concatenate, (words, text, rows, held))
    codes, place = np.unique(words, return_inverse=True)
    n = np.bincount(place, 1 - held[text], len(codes)).astype(np.int64)
    trained = dict(zip(codes.tolist(), n.tolist(), strict=True))
    out = []
    at = np.flatnonzero(contexts[0] > 0)
    if len(at):
        in_runs = np.where(n[place] >= least, words, 0)
        out.append(Windows(list(contexts), in_runs, text, rows, held, trained).blob(0, at))
    known = np.bincount(text, n[place] > 0, len(rows)).astype(np.int64)
    base = np.bincount(text, model.root(n[place]), len(rows))
    for part in _by_block(rows):
        block = int(rows[part[0]] >> _BLOCK)
        out.append((block, -2, 0, b"", 0, _in_block(rows[part]), 0, base[part].tobytes(), known[part].tobytes()))
    return pa.Table.from_batches([_dealt(out)])


def _by_block(rows: np.ndarray) -> list[np.ndarray]:
    """Places of rows, by their blocks."""
    order = np.argsort(rows)
    parts = np.split(order, np.flatnonzero(np.diff(rows[order] >> _BLOCK)) + 1)
    return [part for part in parts if len(part)]


def _in_block(rows: np.ndarray) -> bytes:
    return (rows & ((1 << _BLOCK) - 1)).astype(np.int32).tobytes()


def _deal(batches: Iterable[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Every place of every text, with the words before it, to the bin of the word before it."""
    deal, *how = shared
    for found in _windows(batches, *how):
        bins = _places(found.contexts[0], deal.light)
        for level, heavy in enumerate(deal.heavy(found.contexts), 1):
            at = np.flatnonzero(heavy >= 0)
            h = heavy[at]
            # Places without a further word are in no longer context; they may be in any of the bins.
            further = found.contexts[level][at] if level < len(found.contexts) else np.zeros(len(at), np.int64)
            further = np.where(further > 0, further, -1 - at)
            bins[at] = deal.begins[h] + _places(further, deal.spread[h])
        yield from _blobs(found, bins)


def _deal_heavy(batches: Iterable[pa.RecordBatch], deal: Deal, max_context: int) -> Iterator[pa.RecordBatch]:
    """The words after every heavy context, with their counts, to all bins that need them."""
    members, needed = deal.members(), deal.needed()
    for batch in batches:
        h, w, n, own = (batch.column(i).to_numpy() for i in range(4))
        trained = dict(zip(w.tolist(), own.tolist(), strict=True))
        for one in np.unique(h).tolist():
            at = np.flatnonzero(h == one)
            context = [*members[one], *[0] * max_context][:max_context]
            columns = [*(np.full(len(at), c) for c in context), w[at], np.zeros(len(at), np.int64)]
            _, *rest = _blob(0, one, columns, n[at], trained)
            yield _dealt([(int(bin_), *rest) for bin_ in needed[one]])


def _places(codes: np.ndarray, n) -> np.ndarray:
    """Hashes of codes below ``n``."""
    return (mix(codes.astype(np.uint64)) % np.asarray(n, np.uint64)).astype(np.int64)


def _dense(numbers: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """Ranks of numbers below ``size`` among those that occur and 0, and how many bits they need."""
    present = np.zeros(size, bool)
    present[numbers] = True
    present[0] = True
    rank = np.cumsum(present) - 1
    return rank[numbers], int(rank[-1]).bit_length()


def _key(columns: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """One number per row, in the order of the columns (numbers, bits)."""
    key, bits = columns[0]
    for numbers, more in columns[1:]:
        if bits + more > 63:
            distinct, key = np.unique(key, return_inverse=True)
            bits = len(distinct).bit_length()
        key, bits = (key << more) | numbers, bits + more
    return key


def _read_bin(table: pa.Table, columns: int, head: int) -> tuple[np.ndarray, ...]:
    """Of all rows of a bin: the columns of codes, numbers of rows and of heavy contexts (-1), whether held out,
    counts of heavy contexts; then the rows, and the training counts of words without numbers. Those follow the
    head in the numbering.
    """
    parts, owns, hs, held, counts, rows, n_rows = [], [], [], [], [], [], 0
    blobs = table.to_pylist()
    far, place = np.unique(
        np.concatenate([np.frombuffer(blob["far"], np.int64) for blob in blobs]), return_inverse=True
    )
    trained = np.zeros(len(far), np.int64)
    np.maximum.at(trained, place, np.concatenate([np.frombuffer(blob["far_n"], np.int64) for blob in blobs]))
    for blob in blobs:
        n, h = blob["n"], blob["h"]
        codes, last, own = _unblob(blob, columns)
        if blob["f"]:
            at = codes >= _HASHED
            codes[at] = head + 1 + np.searchsorted(far, codes[at])
        parts.append(codes)
        hs.append(np.full(n, h))
        if h < 0:
            owns.append(n_rows + (last >> 1))
            held.append((last & 1).astype(bool))
            counts.append(np.zeros(n, np.int64))
            rows.append(own)
            n_rows += len(own)
        else:
            owns.append(np.full(n, -1))
            held.append(np.ones(n, bool))
            counts.append(own)
    joined = [np.concatenate(part) for part in (owns, hs, held, counts)]
    return np.concatenate(parts, axis=1), *joined, np.concatenate([np.zeros(0, np.int64), *rows]), trained


def _score_bin(table: pa.Table, shared) -> pa.Table:
    """(block, h, rows, sums): what the contexts of a bin add to the scores of rows.

    The rules are those of ``fit`` and ``token_scores``. A bin has all places after its contexts, or, of heavy ones,
    some of the places and all counts. Whether a heavy context is kept can depend on longer ones in other
    bins: what it adds if it is has its number as ``h``, and a row without sums tells that it is kept.
    """
    deal, own_counts, model, max_context, least, discount = shared
    codes, own, h, held, counts, rows, far_counts = _read_bin(table, max_context + 1, len(own_counts))
    word_counts = np.r_[0, own_counts, far_counts]
    dense = [_dense(column, len(word_counts)) for column in codes]
    key = _key(dense)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    gram = np.cumsum(np.r_[True, key[1:] != key[:-1]]) - 1
    grams = codes[:, order[first]]
    words, n = grams[-1], np.add.reduceat((~held[order]).astype(np.int64), first)
    size = len(first)
    # Counts of heavy contexts, and their numbers, are at the runs that brought them.
    given, number = np.zeros(size, np.int64), np.full(size, -1)
    brought = h[order] >= 0
    given[gram[brought]] = counts[order][brought]
    number[gram[brought]] = h[order][brought]
    lengths = 1 + np.searchsorted([deal.first(level) for level in range(2, max_context + 1)], number, "right")

    root = model.root(word_counts[words])
    above_log, levels = root, []
    new = np.arange(size) == 0
    for level in range(1, max_context + 1):
        word = grams[level - 1]
        new = new | np.r_[True, word[1:] != word[:-1]]
        context = np.cumsum(new) - 1
        n_contexts = int(context[-1]) + 1
        valid = word > 0
        _, run = np.unique((context << _HIGH) + dense[-1][0][order[first]], return_inverse=True)
        n_runs = int(run.max()) + 1
        at_heavy = (number >= 0) & (lengths == level)
        heavy = np.full(n_contexts, -1)
        heavy[context[at_heavy]] = number[at_heavy]
        is_heavy = heavy >= 0
        weight = np.where(is_heavy[context], np.where(at_heavy, given, 0), n)
        n_context = np.bincount(context, weight, n_contexts)
        n_context[is_heavy] = deal.trained[heavy[is_heavy]]
        n_run = np.bincount(run, weight, n_runs)
        some = np.zeros(n_runs, np.int64)
        some[run] = np.arange(size)
        in_tree = (n_run >= least) & (valid & (words > 0))[some]
        some, of = some[in_tree], context[some[in_tree]]
        p, parent = (n_run[in_tree] - discount) / n_context[of], 10.0 ** above_log[some]
        rest = np.maximum(1.0 - np.bincount(of, p, n_contexts), 1e-12)
        ratio = rest / np.maximum(1.0 - np.bincount(of, parent, n_contexts), 1e-12)
        seen = np.bincount(of, minlength=n_contexts)
        divergence = np.bincount(of, p * np.log(p / parent), n_contexts) + rest * np.log(ratio)
        total = np.maximum(n_context, 1)
        kept = (seen > 0) & (total * divergence > 0.5 * seen * np.log(total))
        log_run = np.zeros(n_runs)
        log_run[in_tree] = np.log10(p)
        above_log = log_run[run]
        levels.append((context, valid, heavy, kept, in_tree[run], above_log - root, np.log10(ratio)))
    # Kept nodes keep the path to the root.
    for shorter, longer in zip(reversed(levels[:-1]), reversed(levels[1:]), strict=True):
        context, valid, _, kept, *_ = longer
        shorter[3][shorter[0][valid & kept[context]]] = True

    score, if_kept, found = np.zeros(size), np.zeros(size), []
    for context, valid, heavy, kept, seen, after, log_rest in levels:
        on = valid & kept[context]
        perhaps = valid & ~on & (heavy[context] >= 0)
        score = np.where(on, np.where(seen, after, score + log_rest[context]), score)
        more = np.where(seen, after, if_kept + log_rest[context])
        for one in np.unique(heavy[context[perhaps]]).tolist():
            found.append((one, np.where(perhaps & (heavy[context] == one), more - if_kept, 0.0)))
        if_kept = np.where(on | perhaps, more, if_kept)
        found += [(one, None) for one in np.unique(heavy[kept & (heavy >= 0)]).tolist()]
    # A row may have come several times.
    rows, place = np.unique(rows, return_inverse=True)
    own = own[order]
    gram, own = gram[own >= 0], place[own[own >= 0]]
    out = []
    for one, value in [(-1, score), *found]:
        if value is None:
            out.append((-1, one, b"", b""))
            continue
        sums = np.bincount(own, value[gram], len(rows))
        some = np.flatnonzero(sums)
        for part in _by_block(rows[some]):
            part = some[part]
            out.append((int(rows[part[0]] >> _BLOCK), one, _in_block(rows[part]), sums[part].tobytes()))
    columns = zip(*out, strict=True) if out else [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["block", "h", "rows", "sums"])


def _add_blocks(table: pa.Table) -> pa.Table:
    """(row, tree_score, rare_score, rare_known) of a block of rows."""
    sums = np.zeros((3, 1 << _BLOCK))
    for blob in table.to_pylist():
        rows = np.frombuffer(blob["rows"], np.int32)
        for own, name, kind in zip(sums, ("sums", "base", "known"), (float, float, np.int64), strict=True):
            if blob[name]:
                own[rows] += np.frombuffer(blob[name], kind)
    at = np.flatnonzero(sums.any(axis=0))
    found = [at + (table.column("block")[0].as_py() << _BLOCK), sums[0, at], sums[1, at], sums[2, at].astype(np.int64)]
    return pa.Table.from_arrays(list(map(pa.array, found)), ["row", "tree_score", "rare_score", "rare_known"])


def _grouped(df: DataFrame, n: int, column: str, function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        try:
            return function(table)
        finally:
            give_back()

    return df.repartition(n, column).groupBy(column).applyInArrow(run, schema)


def heavy_contexts(texts: DataFrame, frequent: np.ndarray, trained: np.ndarray, tokens: int, how: tuple) -> Deal:
    """Contexts that more than ``_GROUP`` words follow; ``frequent`` are the counts of words by number."""
    _, end, max_context = how
    words = np.flatnonzero(frequent > _GROUP) + 1
    words = words[words != end]
    light = max(_BINS, tokens // (_GROUP // 3) + 1)
    deal = Deal(light, words, [], trained[words - 1], frequent[words - 1])
    context = texts.sparkSession.sparkContext
    for level in range(2, max_context + 1):
        keys = np.zeros(0, np.int64)
        if deal.first(level - 1) < len(deal.total):
            shared = context.broadcast((deal, *how))
            found = (
                texts.transform(
                    map_batches,
                    lambda batches, shared=shared, level=level: _count_heavy(batches, shared.value, level),
                    "key long, n long, trained long",
                )
                .groupBy("key")
                .agg(F.sum("n").alias("n"), F.sum("trained").alias("trained"))
                .where(F.col("n") > _GROUP)
                .toArrow()
                .sort_by("key")
            )
            keys = found["key"].to_numpy()
            deal.trained = np.r_[deal.trained, found["trained"].to_numpy()]
            deal.total = np.r_[deal.total, found["n"].to_numpy()]
        deal.keys.append(keys)
    return deal


def rare_places(texts: DataFrame, rare: int, model: Model, how: tuple, least: int) -> DataFrame:
    """Places of about ``rare`` words without numbers, with their training counts, and what these words add to rows,
    stored; see ``_count_rare``.
    """
    max_context, bins = how[-1], max(_BINS, rare // (_GROUP // 3) + 1)
    shared = texts.sparkSession.sparkContext.broadcast(how)
    dealt = texts.transform(map_batches, lambda batches: _deal_rare(batches, shared.value, bins), _DEALT)
    slim = Model([], model.tokens, model.types)
    return materialize(
        _grouped(dealt, bins, "bin", lambda table: _count_rare(table, slim, least, max_context), _DEALT), "rare-places"
    )


def binned_sums(
    texts: DataFrame,
    rare: DataFrame | None,
    frequent: np.ndarray,
    trained: np.ndarray,
    model: Model,
    how: tuple,
    least: int,
    discount: float = DISCOUNT,
) -> DataFrame:
    """(block, rows, sums): what the tree adds to the base scores of texts, stored; see ``_score_bin``.

    ``frequent`` and ``trained`` are the counts of words by number, in all texts and in training.
    """
    context, max_context = texts.sparkSession.sparkContext, how[-1]
    deal = heavy_contexts(texts, frequent, trained, int(frequent.sum()), how)
    shared = context.broadcast((deal, *how))
    places = [texts, *([rare.where("h = -1")] if rare is not None else [])]

    def all_places(function: Callable, schema: str) -> DataFrame:
        return reduce(DataFrame.union, [place.transform(map_batches, function, schema) for place in places])

    dealt = all_places(lambda batches: _deal(batches, shared.value), _DEALT)
    if len(deal.total):
        after = (
            all_places(lambda batches: _count_after_heavy(batches, shared.value), "h long, w long, n long, n_w long")
            .groupBy("h", "w")
            .agg(F.sum("n").alias("n"), F.max("n_w").alias("n_w"))
            .where(F.col("n") >= least)
        )
        dealt = dealt.union(
            after.transform(map_batches, lambda batches: _deal_heavy(batches, shared.value[0], max_context), _DEALT)
        )
    fixed = context.broadcast((deal, trained, Model([], model.tokens, model.types), max_context, least, discount))
    schema = "block long, h long, rows binary, sums binary"
    found = materialize(_grouped(dealt, deal.bins, "bin", lambda table: _score_bin(table, fixed.value), schema), "bin-sums")
    sums = found.where("block >= 0 and h < 0").drop("h")
    if len(deal.total):
        kept = found.where("block < 0").select("h").distinct()
        sums = sums.union(found.where("block >= 0 and h >= 0").join(kept, "h", "left_semi").drop("h"))
    return sums


# Scores


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Let Spark remove the shuffle files of a query when it ends, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def token_scores(ids: np.ndarray, model: Model) -> np.ndarray:
    """log10 probability of the token at every place; without the root's share where the number is -1."""
    ends = run_numbers(ids, model.levels)
    first = model.levels[0]
    score = np.where(ids >= 0, first.log_p[ids], 0.0)
    for level, below, run, longer in zip(model.levels, model.levels[1:], ends, ends[1:], strict=False):
        state = np.concatenate([[-1], run[:-1]])
        at = np.flatnonzero((state >= 0) & level.kept[state])
        seen = longer[at]
        score[at] = np.where(seen >= 0, below.log_p[seen], level.log_rest[state[at]] + score[at])
    return score


def _score(batches: Iterable[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Sums of every row over words with numbers and those that occur once."""
    first = model.levels[0]
    for piece in pieces(batches, "ids"):
        ids, begins, single = _joined(piece)
        score = token_scores(ids, model)
        at_end = np.r_[begins[1:], len(ids)] - 1
        score[at_end] = 0.0
        known = ids >= 0
        # A word that occurs once was learned if its own text was.
        learned = ~piece.column("held_out").to_numpy(zero_copy_only=False)
        singles = np.add.reduceat(single.astype(np.int64), begins)
        of_singles = singles * np.where(learned, model.root(1), model.root(0))
        sums = [
            at_end - begins,
            np.add.reduceat(np.where(known, first.counts[ids] > 0, False).astype(np.int64), begins) + singles * learned,
            np.add.reduceat(np.where(known, first.log_p[ids], 0.0), begins) + of_singles,
            np.add.reduceat(score, begins) + of_singles,
        ]
        yield pa.RecordBatch.from_arrays(
            [piece.column("row"), piece.column("doc_id"), piece.column("held_out"), *map(pa.array, sums)],
            ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
        )


def log_probabilities(
    docs: DataFrame, max_context: int = MAX_CONTEXT, least_share: float = LEAST_SHARE, least_count: int = LEAST_COUNT
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``
    (doc_id, text), learned from those that are not held out.
    """
    id_type = docs.schema["doc_id"].dataType
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    with scratch_tables() as keep, _shuffles_removed(docs.sparkSession):
        counts = keep(materialize(word_counts(rows), "word-counts"))
        everything, tokens, types = counts.agg(
            F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("trained"), F.lit(0)), F.count_if(F.col("trained") > 0)
        ).first()
        # The least count that gives at most ``_HEAD`` words a number.
        most = max(least_count, math.ceil(everything / _HEAD))
        by_count = dict(
            counts.where(F.col("n") >= least_count).groupBy(F.least("n", F.lit(most)).alias("n")).count().collect()
        )
        common = most
        while common > least_count and sum(n for count, n in by_count.items() if count >= common - 1) <= _HEAD:
            common -= 1
        numbered = (F.col("n") >= common) | (F.col("word") == END)
        frequent = counts.where(numbered).toArrow().to_pandas().sort_values(["n", "word"], ascending=[False, True])
        number = {word.encode(): i for i, word in enumerate(frequent["word"])}
        number.setdefault(END.encode(), len(number))
        all_counts, own_counts = np.zeros((2, len(number)), np.int64)
        all_counts[: len(frequent)] = frequent["n"]
        own_counts[: len(frequent)] = frequent["trained"]
        repeated = counts.where(~numbered & (F.col("n") > 1))
        bits = _filter(repeated) if common > 2 else None

        least = max(least_count, math.ceil(least_share * tokens))
        in_memory = not max_context or everything <= least * _HEAD

        shared_numbers = docs.sparkSession.sparkContext.broadcast((number, bits))
        arrow_id = pa.int64() if id_type.simpleString() == "bigint" else pa.int32()
        texts = keep(
            materialize(
                rows.withColumn("row", F.monotonically_increasing_id()).transform(
                    map_batches,
                    lambda batches: _encode(batches, *shared_numbers.value, arrow_id),
                    f"row long, doc_id {id_type.simpleString()}, held_out boolean, ids binary, codes binary",
                ),
                "word-numbers",
            )
        )
        trained = texts.where(~F.col("held_out"))
        model = train(trained, own_counts, tokens, types, max_context if in_memory else 0, least)
        places = texts.select("row", "held_out", "ids", "codes")
        how = (own_counts >= least, number[END.encode()] + 1, max(1, max_context))
        rare, parts = None, []
        if bits is not None:
            rare = rare_places(places, everything - int(all_counts.sum()), model, how, least)
            base = F.col("far").alias("base"), F.col("far_n").alias("known")
            parts.append(
                rare.where("h = -2").select(F.col("bin").alias("block"), "rows", F.lit(b"").alias("sums"), *base)
            )
        if not in_memory:
            tree = binned_sums(places, rare, all_counts, own_counts, model, how, least)
            parts.append(tree.withColumn("base", F.lit(b"")).withColumn("known", F.lit(b"")))
        sums = None
        if parts:
            n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            schema = "row long, tree_score double, rare_score double, rare_known long"
            sums = keep(materialize(_grouped(reduce(DataFrame.union, parts), n, "block", _add_blocks, schema), "sums"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = texts.select("row", "doc_id", "held_out", "ids").transform(
        map_batches,
        lambda batches: _score(batches, shared.value),
        f"row long, doc_id {id_type.simpleString()}, held_out boolean, "
        "n_tokens long, n_known long, base_score double, score double",
    )
    names = ("tree_score", "rare_score", "rare_known")
    if sums is None:
        more = {name: F.lit(0) for name in names}
    else:
        scored = scored.join(sums, "row", "left")
        more = {name: F.coalesce(name, F.lit(0)) for name in names}
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + more["rare_known"]).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + more["rare_score"]).alias("base_score"),
        (F.col("score") + more["tree_score"] + more["rare_score"]).alias("score"),
    )
