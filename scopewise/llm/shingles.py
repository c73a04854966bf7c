"""Words and word shingles of many texts at once, as numbers.

Polynomial hashes serve searches; what decides about equality compares bytes or 128-bit digests.
"""

from __future__ import annotations

import hashlib

import numpy as np

from scopewise.llm.batches import factorize, ragged

#: Words per shingle.
SHINGLE_WORDS = 5

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Words that are hashed at once.
_BLOCK = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a number over all of it (the finish of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    """The first powers of the base modulo 2**64."""
    factors = np.full(max(1, n), _BASE, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def joined(contents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, a line end after each, and where each begins."""
    lengths = np.fromiter(map(len, contents), np.int64, len(contents))
    data = np.frombuffer(b"\n".join(contents) + b"\n", np.uint8)
    return data, np.cumsum(lengths + 1) - lengths - 1


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def word_edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of all words: runs of bytes other than space and 0x09 to 0x0D."""
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.r_[True, gap, True].astype(np.int8)))
    return edge[0::2], edge[1::2]


def words(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of all words, and the number of words per text."""
    start, end = word_edges(data)
    size = end - start
    power = _powers(int(size.max(initial=0)))
    hashed = np.empty(len(start), np.uint64)
    for at in range(0, len(start), _BLOCK):
        own = size[at : at + _BLOCK]
        first = np.cumsum(own) - own
        places = ragged(start[at : at + _BLOCK], own)
        hashed[at : at + _BLOCK] = np.add.reduceat(data[places] * power[ragged(np.zeros(len(own)), own)], first)
    hashed = mix(hashed + size.astype(np.uint64) * _STEP)
    count = np.diff(np.r_[np.searchsorted(start, begins), len(start)])
    return start, end, hashed, count


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive values, without regard to text ends.

    Windows of one, two, four ... values are built from halves and put together.
    """
    count = len(values) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total, have, block, width = np.zeros(len(values), np.uint64), 0, values, 1
    while True:
        factor = np.uint64(pow(int(_STEP), width, 1 << 64))
        if size & width:
            total = total[: len(values) - have - width + 1] * factor + block[have : len(values) - width + 1]
            have += width
        if 2 * width > size:
            return mix(total + np.uint64(size))
        block = block[:-width] * factor + block[width:]
        width *= 2


def hashes_at(values: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hash of the windows that begin at some places only."""
    factors = np.array([pow(int(_STEP), size - 1 - i, 1 << 64) for i in range(size)], np.uint64)
    found = np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), 4096):
        rows = values[starts[at : at + 4096, None] + np.arange(size)]
        found[at : at + 4096] = (rows * factors).sum(axis=1, dtype=np.uint64)
    return mix(found + np.uint64(size))


def same_words(
    one: tuple[np.ndarray, np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray, np.ndarray]
) -> np.ndarray:
    """Whether words (data, start, end) are equal byte by byte, pair by pair."""
    (data, start, end), (other, begin, stop) = one, two
    size = end - start
    same = size == stop - begin
    for at in range(0, len(start), _BLOCK):
        own = np.flatnonzero(same[at : at + _BLOCK]) + at
        if len(own):
            first = np.cumsum(size[own]) - size[own]
            equal = data[ragged(start[own], size[own])] == other[ragged(begin[own], size[own])]
            same[own] = np.logical_and.reduceat(equal, first)
    return same


def exact_numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """A number per word, equal for equal words only; the hash serves as long as no two words share one."""
    _, first, number = np.unique(hashed, return_index=True, return_inverse=True)
    rep = first[number]
    if same_words((data, start, end), (data, start[rep], end[rep])).all():
        return number
    whole = data.tobytes()
    return factorize([whole[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)])[0]


def exact_windows(numbers: np.ndarray, size: int) -> np.ndarray:
    """A number per window of ``size`` consecutive numbers, equal for equal windows only."""
    block, width, total, have = numbers, 1, None, 0
    while True:
        if size & width:
            if total is None:
                total = block
            else:
                n = len(numbers) - have - width + 1
                total = _pairs(total[: max(0, n)], block[have : have + max(0, n)])
            have += width
        if 2 * width > size:
            return total
        block = _pairs(block[:-width], block[width:])
        width *= 2


def _pairs(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    factor = int(two.max(initial=0)) + 1
    return np.unique(one * factor + two, return_inverse=True)[1]


#: Bytes of a word that fit into one number.
_SHORT = 8
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(_SHORT + 1)], np.uint64)


def word_codes(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128 bits per word, as two arrays, and the number of words per text.

    Words of up to eight bytes are coded by their bytes and length, longer ones by a cryptographic digest.
    """
    start, end = word_edges(data)
    size = end - start
    # the eight bytes from every place on, as numbers
    line = np.concatenate([data, np.zeros(_SHORT, np.uint8)])
    eight = np.ndarray(len(data), "<u8", line, strides=(1,))
    own = eight[start] & _MASKS[np.minimum(size, _SHORT)]
    one, two = mix(own + size.astype(np.uint64) * _STEP), mix((own ^ size.astype(np.uint64)) * _BASE + _STEP)
    long = np.flatnonzero(size > _SHORT)
    if len(long):
        whole = data.tobytes()
        digests = b"".join(
            hashlib.blake2b(whole[a:b], digest_size=16).digest()
            for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)
        )
        one[long], two[long] = np.frombuffer(digests, "<u8").reshape(-1, 2).T
    return one, two, np.diff(np.r_[np.searchsorted(start, begins), len(start)])


def shingle_digests(contents: list[bytes], size: int = SHINGLE_WORDS) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct shingles of every text, A-Z lowered, as 128 bits in two arrays sorted by the first.

    A text of fewer words has one shingle, all its words; a text without words has none.
    """
    data, begins = joined(contents)
    codes = word_codes(lowered(data), begins)
    whole = [window_hashes(half, size) for half in codes[:2]]
    sets, begin = [], 0
    for n in codes[2].tolist():
        if n < size:
            few = [window_hashes(half[begin : begin + n], n) if n else half[:0] for half in codes[:2]]
            sets.append((few[0], few[1]))
        else:
            one, two = (half[begin : begin + n - size + 1] for half in whole)
            order = np.argsort(one)
            one, two = one[order], two[order]
            again = one[1:] == one[:-1]
            if again.any():
                order = np.lexsort((two, one))
                one, two = one[order], two[order]
                new = np.r_[True, ~again | (two[1:] != two[:-1])]
                one, two = one[new], two[new]
            sets.append((one, two))
        begin += n
    return sets


def common(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> int:
    """Shingles that two sets share."""
    if not len(two[0]):
        return 0
    at = np.minimum(np.searchsorted(two[0], one[0]), len(two[0]) - 1)
    return int(((two[0][at] == one[0]) & (two[1][at] == one[1])).sum())


def shingle_sets(contents: list[bytes], size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The first halves of ``shingle_digests``: 64 bits per distinct shingle, for signatures."""
    return [one for one, _ in shingle_digests(contents, size)]
