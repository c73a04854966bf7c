"""FM-index over delimited words and its one-error search, for many words at once.

The words are written one after another with a delimiter behind each, and the suffixes of that text are
ranked. A pattern is a range of ranks; ``step`` puts one symbol in front of the pattern. An index of
reversed words extends patterns to the right, one of the words themselves to the left: the two directions
of a bidirectional index. A search scheme matches the half of a word in which no error is allowed and then
extends across the other half, so it needs the direction that starts with its exact half only; callers
build the index of the direction they search in.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from scopewise.llm.batches import ragged

#: Words that are searched at once.
_BLOCK = 1 << 14
#: Characters read between two looks for equal patterns; few words are longer than twice as many.
_MERGE_ROUNDS = 16


@dataclass
class Index:
    """Suffix ranks of delimited words, which are matched from their ends to their beginnings."""

    #: Distinct words in code point order.
    words: list[str]
    #: Code points by symbol number; symbol 0 is the delimiter.
    symbols: np.ndarray
    #: The symbol in front of every suffix, by rank.
    before: np.ndarray
    #: symbol * len(before) + rank of every suffix, sorted.
    keys: np.ndarray

    def step(self, symbol: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The rank of symbol + suffix for suffixes from ``rank`` on (border of a range)."""
        return np.searchsorted(self.keys, symbol * len(self.before) + rank)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of words whose characters all occur in the index, where each word begins, and its length."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        return np.searchsorted(self.symbols, points), np.cumsum(lengths) - lengths, lengths


def build(words: list[str]) -> Index:
    """Index of distinct words without the character U+0000, sorted by code points."""
    points = np.frombuffer("".join(f"{w}\0" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols, text = np.unique(points, return_inverse=True)
    text = text.astype(np.int64)
    n = len(text)
    ends = np.flatnonzero(text == 0)
    word = np.searchsorted(ends, np.arange(n))
    to_end = ends[word] - np.arange(n)
    # Doubling: after a round with width k suffixes are ranked by their first 2 k symbols, up to the delimiter.
    rank, k = text, 1
    while k <= int(to_end.max()):
        reach = np.flatnonzero(to_end >= k)
        follow = np.zeros(n, np.int64)
        follow[reach] = rank[reach + k] + 1
        rank = np.unique(rank * (n + 2) + follow, return_inverse=True)[1].astype(np.int64)
        k *= 2
    # Equal suffixes go by the next word; the last word is followed by the first one.
    order = np.argsort(rank * len(words) + (word + 1) % len(words), kind="stable")
    before = text[order - 1]
    by_symbol = np.argsort(before, kind="stable")
    return Index(words, symbols, before, before[by_symbol] * n + by_symbol)


def one_error(index: Index, queries: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query number, word number) of all words with one inserted, deleted or replaced character.

    ``queries`` are read backwards like the words; the last ``exact[i]`` characters of query i are matched
    exactly. All queries must be words of the index.
    """
    found = [
        _search(index, queries[at : at + _BLOCK], exact[at : at + _BLOCK], at) for at in range(0, len(queries), _BLOCK)
    ]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([q for q, _ in found]), np.concatenate([w for _, w in found])


def _search(index: Index, queries: list[str], exact: np.ndarray, offset: int) -> tuple[np.ndarray, np.ndarray]:
    symbols, begins, lengths = index.encode(queries)
    ends = begins + lengths
    n = len(queries)
    # Suffixes that begin with the delimiter behind a word.
    low, high = np.zeros(n, np.int64), np.full(n, len(index.words), np.int64)
    for t in range(int(exact.max(initial=0))):
        on = np.flatnonzero(exact > t)
        symbol = symbols[ends[on] - 1 - t]
        low[on], high[on] = index.step(symbol, low[on]), index.step(symbol, high[on])

    # Patterns without and with an error: (query, characters read, range of ranks).
    clean = (np.arange(n), np.asarray(exact, np.int64), low, high)
    erred = tuple(np.zeros(0, np.int64) for _ in range(4))
    hits: list[np.ndarray] = []
    rounds = 0
    while len(clean[0]) or len(erred[0]):
        rounds += 1
        if rounds % _MERGE_ROUNDS == 0:
            erred = _merged(*erred)
        erred, done = _advance(index, symbols, ends, lengths, *erred)
        hits.append(done)
        erred = tuple(
            np.concatenate(parts) for parts in zip(erred, *_errors(index, symbols, ends, lengths, *clean), strict=True)
        )
        query, read, low, high = clean
        clean, _ = _advance(index, symbols, ends, lengths, query, read, low, high, final=False)
    # The same word may be reached by an error at several places.
    key = np.unique(np.concatenate(hits))
    return key // len(index.words) + offset, key % len(index.words)


def _merged(query, read, low, high):
    """The distinct patterns: in a run of equal characters, errors at any place lead to one."""
    order = np.lexsort((high, low, read, query))
    columns = [c[order] for c in (query, read, low, high)]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return tuple(c[new] for c in columns)


def _advance(index, symbols, ends, lengths, query, read, low, high, final=True):
    """Read the next character of every query; patterns that have read all are closed with a delimiter.

    Gives the patterns that still occur and query * words + word of closed ones that are words.
    """
    more = read < lengths[query]
    q, r = query[more], read[more]
    symbol = symbols[ends[q] - 1 - r]
    l, h = index.step(symbol, low[more]), index.step(symbol, high[more])  # noqa: E741
    kept = l < h
    closed = np.zeros(0, np.int64)
    if final and not more.all():
        first, last = index.step(np.int64(0), low[~more]), index.step(np.int64(0), high[~more])
        # A delimiter in front: the suffix of rank r begins with the delimiter before word r, which is whole.
        whole = first < last
        closed = query[~more][whole] * len(index.words) + first[whole]
    return (q[kept], r[kept] + 1, l[kept], h[kept]), closed


def _errors(index, symbols, ends, lengths, query, read, low, high):
    """Patterns after one error at the next place: deletion, insertion, replacement."""
    more = read < lengths[query]
    yield query[more], read[more] + 1, low[more], high[more]
    at, symbol = _next_symbols(index, low, high)
    l, h = index.step(symbol, low[at]), index.step(symbol, high[at])  # noqa: E741
    here = l < h
    at, symbol, l, h = at[here], symbol[here], l[here], h[here]  # noqa: E741
    yield query[at], read[at], l, h
    other = np.flatnonzero(more[at])
    other = other[symbols[ends[query[at[other]]] - 1 - read[at[other]]] != symbol[other]]
    yield query[at[other]], read[at[other]] + 1, l[other], h[other]


def _next_symbols(index: Index, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pattern, symbol) pairs to try: the symbols in front of short ranges, all symbols for long ones."""
    size = len(index.symbols)
    short = np.flatnonzero(high - low <= size)
    width = high[short] - low[short]
    seen = np.unique(np.repeat(short, width) * size + index.before[ragged(low[short], width)])
    wide = np.flatnonzero(high - low > size)
    every = (wide[:, None] * size + np.arange(size)).ravel()
    pairs = np.concatenate([seen, every])
    pairs = pairs[pairs % size > 0]
    return pairs // size, pairs % size
