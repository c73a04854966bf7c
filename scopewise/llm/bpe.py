"""Byte-level BPE with a minimal acyclic transducer for frequent words.

1. One pass over all texts counts pre-tokens with a bounded heavy-hitter summary per task; the most
   frequent ones of the corpus become the lexicon (``lexicon_size`` words, a fixed size).
2. The lexicon is compiled into an automaton that shares prefixes and suffixes. Every edge carries the
   number of words before it, so that a path sums up to the word's number, which selects its ids.
   The arrays travel as one blob; every worker maps them into memory from an unnamed file.
3. Texts are cut into pre-tokens; distinct ones of a piece are looked up together, a byte per step.
   Words outside the lexicon are merged exactly by rank.

The lexicon affects speed only; ids equal those of the tokenizer file. Defined cases: a null text is
empty and has no ids; the strings of added tokens become their ids; a null doc_id is passed on; repeated
rows each get a row; no other column is read.
"""

from __future__ import annotations

import heapq
import json
import mmap
import tempfile
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import compress
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scopewise.llm.batches import factorize, map_batches, pieces, ragged, texts
from scopewise.session import discard, materialize

#: Words in the transducer.
LEXICON_SIZE = 150_000
#: Counters of a task's heavy-hitter summary.
COUNTERS = 1 << 17
#: Text, or ids, that a worker encodes or decodes at once.
PIECE = 1 << 20
#: Longest word, in bytes, that may enter the lexicon.
MAX_WORD = 48
#: Merged words that a worker remembers.
REMEMBERED = 100_000

#: Fixed value: the pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files, and the byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, bytes and merge ranks of a byte-level tokenizer file."""

    def __init__(self, source: bytes):
        content = json.loads(source)
        letters = byte_letters()
        ids = content["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in content["added_tokens"]}
        size = max([*ids.values(), *self.added.values()]) + 1
        self.bytes = [b""] * size
        for token, number in ids.items():
            self.bytes[number] = bytes(letters[c] for c in token)
        for token, number in self.added.items():
            self.bytes[number] = token.encode()
        self.single = [0] * 256
        for letter, byte in letters.items():
            self.single[byte] = ids[letter]
        #: (left id, right id) -> rank and new id in one number.
        self.merges: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(content["model"]["merges"]):
            self.merges.setdefault((ids[left], ids[right]), rank << 32 | ids[left + right])
        self.words = regex.compile(PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")

    def split(self, text: str) -> list[str]:
        """Pre-tokens; an added token stands as itself, which no pre-token can equal."""
        found, at = [], 0
        for special in self.special.finditer(text):
            found += self.words.findall(text[at : special.start()])
            found.append(special[0])
            at = special.end()
        return found + self.words.findall(text[at:])

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank is merged first, the leftmost of equals."""
        ids = [self.single[byte] for byte in word]
        if len(ids) > 40:
            return self._merge_long(ids)
        merges, last = self.merges, 1 << 62
        pairs = [merges.get(pair, last) for pair in zip(ids, ids[1:], strict=False)]
        while pairs and (best := min(pairs)) < last:
            at = pairs.index(best)
            ids[at : at + 2] = [best & 0xFFFFFFFF]
            del pairs[at]
            if at:
                pairs[at - 1] = merges.get((ids[at - 1], ids[at]), last)
            if at < len(pairs):
                pairs[at] = merges.get((ids[at], ids[at + 1]), last)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and linked neighbours, for long words."""
        merges, n = self.merges, len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(found, i) for i, pair in enumerate(zip(ids, ids[1:], strict=False)) if (found := merges.get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            found, at = heapq.heappop(heap)
            right = after[at]
            if ids[at] < 0 or right >= n or merges.get((ids[at], ids[right])) != found:
                continue
            ids[at], ids[right] = found & 0xFFFFFFFF, -1
            after[at] = after[right]
            if after[at] < n:
                before[after[at]] = at
                if (found := merges.get((ids[at], ids[after[at]]))) is not None:
                    heapq.heappush(heap, (found, at))
            if before[at] >= 0 and (found := merges.get((ids[before[at]], ids[at]))) is not None:
                heapq.heappush(heap, (found, before[at]))
        return [i for i in ids if i >= 0]


def vocabulary(source: bytes) -> Vocabulary:
    return Vocabulary(source)


# The transducer


State = tuple[bool, bytes, tuple[int, ...]]


def _minimal(words: list[bytes]) -> list[State]:
    """States (accepts, bytes of the edges, their targets) of the minimal automaton of sorted distinct words.

    Targets come before their sources; the last state is the root.
    """
    states: list[State] = []
    known: dict[State, int] = {}

    def freeze(accepts: bool, edges: dict[int, int]) -> int:
        state = (accepts, bytes(edges), tuple(edges.values()))
        if state not in known:
            known[state] = len(states)
            states.append(state)
        return known[state]

    path: list[list] = [[False, {}]]  # states of the last word, not yet frozen
    last = b""
    for word in [*words, None]:
        shared = 0
        if word is not None:
            limit = min(len(word), len(last))
            while shared < limit and word[shared] == last[shared]:
                shared += 1
        for depth in range(len(last), shared, -1):
            accepts, edges = path.pop()
            path[-1][1][last[depth - 1]] = freeze(accepts, edges)
        if word is None:
            break
        path += [[False, {}] for _ in range(len(word) - shared)]
        path[-1][0] = True
        last = word
    accepts, edges = path[0]
    states.append((accepts, bytes(edges), tuple(edges.values())))
    return states


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """One blob: edge keys (state, byte), targets, words passed, acceptance, and ids by word number."""
    words = sorted(entries)
    states = _minimal(words)
    counts = [0] * len(states)
    keys, targets, passed = array("q"), array("q"), array("q")
    for state, (accepts, labels, ahead) in enumerate(states):
        total = int(accepts)
        for byte, target in zip(labels, ahead, strict=True):
            keys.append(state << 8 | byte)
            targets.append(target)
            passed.append(total)
            total += counts[target]
        counts[state] = total
    sizes = np.array([len(entries[word]) for word in words], np.int64)
    parts = [
        np.array(keys, np.int64),
        np.array(targets, np.int64),
        np.array(passed, np.int64),
        np.array([accepts for accepts, *_ in states], np.int64),
        np.r_[0, np.cumsum(sizes)].astype(np.int64),
        np.fromiter((i for word in words for i in entries[word]), np.int64, int(sizes.sum())),
    ]
    return b"".join([np.array([len(p) for p in parts], np.int64).tobytes(), *(p.tobytes() for p in parts)])


class Lexicon:
    """The compiled transducer, mapped into memory."""

    def __init__(self, blob: bytes):
        with tempfile.TemporaryFile() as file:  # unnamed: nothing stays when the worker ends
            file.write(blob)
            file.flush()
            mapped = np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), np.int64)
        edges = np.cumsum(np.r_[6, mapped[:6]])
        self.keys, self.targets, self.passed, self.accepts, self.first, self.ids = (
            mapped[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)
        )

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of every word, -1 outside the lexicon; all words advance together."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        number = np.zeros(len(words), np.int64)
        state = np.full(len(words), len(self.accepts) - 1, np.int64)
        alive = np.flatnonzero((lengths <= MAX_WORD) & (len(self.keys) > 0))
        number[lengths > MAX_WORD] = -1
        if not len(self.keys):
            return np.full(len(words), -1, np.int64)
        step = 0
        while True:
            ended = lengths[alive] == step
            done = alive[ended]
            number[done] = np.where(self.accepts[state[done]] == 1, number[done], -1)
            alive = alive[~ended]
            if not len(alive):
                return number
            key = state[alive] << 8 | data[starts[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[at] == key
            number[alive[~known]] = -1
            alive, at = alive[known], at[known]
            number[alive] += self.passed[at]
            state[alive] = self.targets[at]
            step += 1


# Frequent words


def _frequent(batches: Iterable[pa.RecordBatch], source: bytes) -> Iterator[pa.RecordBatch]:
    """Heavy hitters of a task: when counters run out, all sink by the same count.

    Stretches between spaces are counted and then split, each with a space before it, as most of them have.
    """
    vocab, stretches = vocabulary(source), Counter()
    for piece in pieces(batches, limit=PIECE):
        for text in texts(piece):
            stretches.update(text.split(" "))
        if len(stretches) > COUNTERS:
            sink = int(np.partition(np.fromiter(stretches.values(), np.int64, len(stretches)), -COUNTERS // 2)[-COUNTERS // 2])
            stretches = Counter({word: n - sink for word, n in stretches.items() if n > sink})
    counts = Counter()
    for stretch, n in stretches.items():
        for word in vocab.split(f" {stretch}"):
            counts[word] += n
    kept = [(word, n) for word, n in counts.items() if len(word.encode()) <= MAX_WORD and word not in vocab.added]
    for at in range(0, len(kept), 10_000):
        words, numbers = zip(*kept[at : at + 10_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(numbers, pa.int64())], ["word", "n"])


def build_lexicon(docs: DataFrame, source: bytes, size: int = LEXICON_SIZE) -> bytes:
    """Compile the most frequent pre-tokens of all texts; at most ``size`` short words reach the driver."""
    shared = docs.sparkSession.sparkContext.broadcast(source)
    counted = materialize(
        docs.select("text")
        .transform(map_batches, lambda batches: _frequent(batches, shared.value), "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n")),
        "pre-tokens",
    )
    # Words per class of counts, about 1,000 classes; the lexicon takes whole classes from the top.
    level = F.floor(16 * F.log2("n"))
    classes = counted.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    room, least = size, None
    for row in classes:
        room -= row["count"]
        if room < 0:
            break
        least = row["level"]
    kept = counted.where(level >= least) if least is not None else counted.limit(0)
    frequent = kept.select("word").toPandas()["word"]
    discard(counted)
    vocab = vocabulary(source)
    return compile_lexicon({word: vocab.merge(word) for word in map(str.encode, frequent)})


# Encoding and decoding


def encode_texts(whole: list[str], vocab: Vocabulary, frequent: Lexicon, merged: dict[str, list[int]]) -> list[np.ndarray]:
    """Ids of every text. ``merged`` remembers words outside the lexicon."""
    found = [vocab.split(text) for text in whole]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    if not lengths.sum():
        return [np.zeros(0, "<u4")] * len(whole)
    codes, unique = factorize([word for own in found for word in own])
    del found
    numbers = frequent.numbers([word.encode() for word in unique])
    known = numbers >= 0
    if len(merged) > REMEMBERED:
        merged.clear()
    rest: list[list[int]] = []
    for word in compress(unique, ~known):
        if (ids := merged.get(word)) is None:
            ids = [vocab.added[word]] if word in vocab.added else vocab.merge(word.encode())
            if len(ids) < MAX_WORD:
                merged[word] = ids
        rest.append(ids)
    new = np.fromiter((i for ids in rest for i in ids), np.int64)
    sizes = np.zeros(len(unique), np.int64)
    first = np.zeros(len(unique), np.int64)
    first[known] = frequent.first[numbers[known]]
    sizes[known] = frequent.first[numbers[known] + 1] - first[known]
    sizes[~known] = np.fromiter(map(len, rest), np.int64, len(rest))
    first[~known] = len(frequent.ids) + np.cumsum(sizes[~known]) - sizes[~known]
    place = ragged(first[codes], sizes[codes])
    old = place < len(frequent.ids)
    flat = np.empty(len(place), "<u4")
    flat[old] = frequent.ids[place[old]]
    flat[~old] = new[place[~old] - len(frequent.ids)]
    ends = np.cumsum(np.r_[0, sizes[codes]])[np.cumsum(lengths)]
    return np.split(flat, ends[:-1])


def _encode(batches: Iterable[pa.RecordBatch], vocab: Vocabulary, blob: bytes) -> Iterator[pa.RecordBatch]:
    frequent, merged = Lexicon(blob), {}
    for piece in pieces(batches, limit=PIECE):
        ids = encode_texts(texts(piece), vocab, frequent, merged)
        yield pa.RecordBatch.from_arrays(
            [
                piece.column("doc_id"),
                pa.array([len(own) for own in ids], pa.int64()),
                pa.array([own.tobytes() for own in ids], pa.binary()),
            ],
            ["doc_id", "n_tokens", "ids"],
        )


def encode(docs: DataFrame, vocabulary_file: str, lexicon_size: int = LEXICON_SIZE) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit numbers) of every row."""
    source = Path(vocabulary_file).read_bytes()
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((source, build_lexicon(docs, source, lexicon_size)))
    return docs.select(F.col("doc_id").cast("long"), "text").transform(
        map_batches,
        lambda batches: _encode(batches, vocabulary(shared.value[0]), shared.value[1]), "doc_id long, n_tokens long, ids binary"
    )


def _decode(batches: Iterable[pa.RecordBatch], vocab: Vocabulary) -> Iterator[pa.RecordBatch]:
    sizes = np.fromiter(map(len, vocab.bytes), np.int64)
    first = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(vocab.bytes), np.uint8)
    for piece in pieces(batches, "ids", PIECE):
        decoded = []
        for own in piece.column("ids").to_pylist():
            ids = np.frombuffer(own or b"", "<u4")
            decoded.append(data[ragged(first[ids], sizes[ids])].tobytes().decode("utf-8", "replace"))
        at = piece.schema.get_field_index("ids")
        yield piece.set_column(at, "decoded", pa.array(decoded, pa.string()))


def decode(encoded: DataFrame, vocabulary_file: str) -> DataFrame:
    """The same rows with ``decoded`` text in place of ``ids``; bytes that are not UTF-8 are replaced."""
    shared = encoded.sparkSession.sparkContext.broadcast(Path(vocabulary_file).read_bytes())
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema]
    kinds[encoded.columns.index("ids")] = "decoded string"
    return encoded.transform(map_batches, lambda batches: _decode(batches, vocabulary(shared.value)), ", ".join(kinds))


def _round_trip(batches: Iterable[pa.RecordBatch], source: bytes, blob: bytes) -> Iterator[pa.RecordBatch]:
    vocab = vocabulary(source)
    for encoded in _encode(batches, vocab, blob):
        for piece in pieces([encoded], "ids", PIECE):
            for decoded in _decode([piece], vocab):
                columns = [*piece.columns, decoded.column("decoded")]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded"])


def round_trip(docs: DataFrame, vocabulary_file: str, lexicon_size: int = LEXICON_SIZE) -> DataFrame:
    """``encode`` and ``decode`` in one pass of one worker per task: doc_id, n_tokens, ids and decoded."""
    source = Path(vocabulary_file).read_bytes()
    shared = docs.sparkSession.sparkContext.broadcast((source, build_lexicon(docs, source, lexicon_size)))
    return map_batches(
        docs.select(F.col("doc_id").cast("long"), "text"),
        lambda batches: _round_trip(batches, *shared.value),
        "doc_id long, n_tokens long, ids binary, decoded string",
    )
