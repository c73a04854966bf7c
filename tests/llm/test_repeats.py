import hashlib
import random
import re

import numpy as np
import pytest
from scopewise.llm import phrases, shingles, suffix, windows


def brute(rows, size):
    """Covered flags of every (doc_id, units) by windows of a smaller document."""
    least = {}
    for doc_id, units in rows:
        for i in range(len(units) - size + 1):
            key = units[i : i + size]
            least[key] = min(least.get(key, doc_id), doc_id)
    out = []
    for doc_id, units in rows:
        gone = np.zeros(len(units), bool)
        for i in range(len(units) - size + 1):
            if least[units[i : i + size]] < doc_id:
                gone[i : i + size] = True
        out.append(gone)
    return out


def expected_bytes(rows):
    rows = [(windows.NO_ID if i is None else i, t.encode()) for i, t in rows]
    found = []
    for (doc_id, data), gone in zip(rows, brute(rows, 50), strict=True):
        spans = int(np.sum(np.diff(np.r_[False, gone].astype(int)) == 1))
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        doc_id = None if doc_id == windows.NO_ID else doc_id
        found.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


def expected_words(rows):
    rows = [(windows.NO_ID if i is None else i, tuple(re.findall(r"[^\x20\x09-\x0D]+", t))) for i, t in rows]
    found = []
    for (doc_id, own), gone in zip(rows, brute(rows, 13), strict=True):
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        doc_id = None if doc_id == windows.NO_ID else doc_id
        found.append((doc_id, len(own), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(found, key=str)


def copied(seed, alphabet, n=60):
    """Texts made of copied pieces of each other, cut anywhere."""
    rnd = random.Random(seed)
    made = []
    for _ in range(n):
        text = "".join(rnd.choices(alphabet, k=rnd.randrange(5, 300)))
        for _ in range(rnd.randrange(4)):
            if made:
                other = rnd.choice(made)
                a = rnd.randrange(len(other))
                piece = other[a : a + rnd.randrange(1, 400)]
                at = rnd.randrange(len(text) + 1)
                text = text[:at] + piece + text[at:]
        made.append(text)
    return list(enumerate(rnd.sample(made, len(made))))


SAMPLES = {
    "letters": copied(1, "abcd efgh ij\n"),
    "few letters": copied(2, "ab "),
    "one letter": [(1, "a" * 300), (2, "a" * 49), (3, "ba" * 200), (4, "a" * 60 + "b" + "a" * 60)],
    "zero bytes": copied(3, "\x00\x01 é"),
    "words": [(i, re.sub("x", " ", t)) for i, t in copied(4, "abxcxdx")],
}


@pytest.mark.parametrize("name", SAMPLES)
@pytest.mark.parametrize("hot", [windows.HOT_DOCS, 2])
def test_small(spark, name, hot):
    docs = spark.createDataFrame(SAMPLES[name], "doc_id long, text string").repartition(3)
    found = suffix.digest(suffix.remove_repeats(docs, hot)).collect()
    assert sorted(map(tuple, found), key=str) == expected_bytes(SAMPLES[name])
    found = phrases.digest(phrases.remove_passages(docs, hot)).collect()
    assert sorted(map(tuple, found), key=str) == expected_words(SAMPLES[name])


def test_whole_tables(odd_docs, documents, no_docs, texts_of):
    for docs in (odd_docs, documents):
        rows = texts_of(docs)
        found = suffix.digest(suffix.remove_repeats(docs)).collect()
        assert sorted(map(tuple, found), key=str) == expected_bytes(rows)
        found = phrases.digest(phrases.remove_passages(docs)).collect()
        assert sorted(map(tuple, found), key=str) == expected_words(rows)
    assert suffix.remove_repeats(no_docs).collect() == phrases.remove_passages(no_docs).collect() == []


@pytest.mark.parametrize("shallow", [8, 24])
@pytest.mark.parametrize("alphabet", [b"ab", b"\x00\x01", bytes(range(256))])
def test_deep_shallow(shallow, alphabet):
    rnd = random.Random(len(alphabet) + shallow)
    strings = [bytes(rnd.choices(alphabet, k=rnd.randrange(70))) for _ in range(400)]
    strings += [s[:k] + b"\x00" for s in strings[:99] for k in (5, 30)] + strings[:50]
    order, shared = suffix.deep_shallow(strings, shallow)
    ordered = [strings[i] for i in order]
    assert ordered == sorted(strings)
    for i in range(1, len(ordered)):
        one, two = ordered[i - 1], ordered[i]
        assert shared[i] == next((k for k, (a, b) in enumerate(zip(one, two)) if a != b), min(len(one), len(two)))


def test_equal_windows_have_equal_anchors():
    rnd = np.random.default_rng(0)
    text = rnd.integers(0, 3, 5000).astype(np.uint64)
    place, hashed = windows.anchors(text, 50, 16)
    again, also = windows.anchors(text[777:], 50, 16)
    assert (place[777:] == again + 777).all() and (hashed[777:] == also).all()


def test_runs_do_not_depend_on_blocks(monkeypatch):
    rnd = np.random.default_rng(2)
    values = rnd.integers(0, 2, 9000).astype(np.uint64)
    counts = np.array([0, 4000, 30, 49, 50, 4871])
    whole = windows.find_runs(values, counts, suffix.UNITS)
    monkeypatch.setattr(windows, "_BLOCK", 64)
    cut = windows.find_runs(values, counts, suffix.UNITS)
    for name in ("doc", "start", "windows", "anchor", "gram"):
        assert (getattr(whole, name) == getattr(cut, name)).all()
    assert whole.windows.sum() == np.maximum(0, counts - 49).sum()


def test_bins_are_even():
    rnd = np.random.default_rng(6)
    values = rnd.integers(0, 1 << 60, 300_000).astype(np.uint64)
    runs = windows.find_runs(values, np.array([len(values)]), suffix.UNITS)
    share = np.bincount(windows._bins(windows._keys(runs.gram), 16), minlength=16) / len(runs.gram)
    assert share.max() < 2 * share.min()


def test_words_with_one_hash_are_told_apart(spark):
    """Thue-Morse words collide in every polynomial hash modulo 2**64."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, two = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    data, begins = shingles.joined([one.encode(), two.encode()])
    assert len(set(shingles.words(data, begins)[2].tolist())) == 1
    rest = " ".join(f"w{i}" for i in range(12))
    texts = [f"{one} {rest}", f"{two} {rest}", f"{one} {rest}", f"{two} {rest} {one} {rest}"]
    rows = list(enumerate(texts, 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["n_removed"] for r in phrases.remove_passages(docs).collect()}
    assert found == {1: 0, 2: 0, 3: 13, 4: 26}


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(phrases, "window_hashes", lambda values, size: np.zeros(len(values) - size + 1, np.uint64))
    numbers = np.array([*range(13), 99, *range(13), *range(1, 13), 5])
    counts, least = np.array([14, 13, 13]), np.array([7, 3, 9])
    found, first = phrases.least_documents(numbers.astype(np.uint64), numbers, counts, least)
    assert found.tolist() == [3, 7, 3, 9] and first.tolist() == [0, 2, 3]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 13])
def test_exact_windows(size):
    numbers = np.random.default_rng(size).integers(0, 3, 400)
    found = shingles.exact_windows(numbers, size)
    rows = [tuple(numbers[i : i + size]) for i in range(400 - size + 1)]
    assert len(found) == len(rows)
    assert len(set(zip(found.tolist(), rows, strict=True))) == len(set(rows)) == len(set(found.tolist()))
