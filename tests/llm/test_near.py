import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from scopewise.llm import near
from scopewise.llm.components import components
from scopewise.llm.shingles import hashes_at, joined, lowered, shingle_sets, window_hashes, words


def verdicts(found):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}


def test_whole_table(documents, texts_of):
    found = near.near_duplicates(documents)
    assert verdicts(found) == brute.near(texts_of(documents))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found.collect())


def edited(rnd, words, share):
    return [rnd.choice("abcdefgh") + "x" if rnd.random() < share else w for w in words]


def test_chains_and_near_misses(spark):
    """Groups whose members drift apart, so that links do not all lead to the smallest document."""
    rnd = random.Random(11)
    texts = []
    for _ in range(25):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(rnd.randrange(60, 250))]
        for _ in range(12):
            texts.append(" ".join(words))
            words = edited(rnd, words, 0.015)
    rows = list(enumerate(rnd.sample(texts, len(texts))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = brute.near(rows)
    assert len({c for _, c in expected.values()}) < len(rows) / 2
    assert verdicts(near.near_duplicates(docs)) == expected


def between(rnd, low, high):
    """Texts of two documents whose similarity is between two shares."""
    while True:
        length = rnd.choice([8, 9, 12, 30, 60, 150, 300])
        words = [f"w{rnd.randrange(10**6)}" for _ in range(length)]
        other = list(words)
        for at in rnd.sample(range(length), rnd.randrange(2 + length // 30)):
            other[at] = f"x{rnd.randrange(10**6)}"
        other = other[rnd.randrange(3) :]
        one, two = brute.shingles(" ".join(words)), brute.shingles(" ".join(other))
        if low <= len(one & two) / len(one | two) < high:
            return " ".join(words), " ".join(other)


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_thresholds(spark, documents, texts_of, percent):
    """Pairs on both sides of a threshold, small and large, and whole tables."""
    rnd = random.Random(percent)
    pairs = [between(rnd, low, low + 0.05) for low in (0.75, 0.8) for _ in range(60)]
    rows = list(enumerate(rnd.sample([t for pair in pairs for t in pair], 240)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert verdicts(near.near_duplicates(docs, percent)) == brute.near(rows, percent)
    assert sum(v[1] != i for i, v in brute.near(rows, percent).items()) == (60 if percent == 80 else 0)
    assert verdicts(near.near_duplicates(documents, percent)) == brute.near(texts_of(documents), percent)


def test_sizes():
    assert near.sizes(85)[0] == 26 and near.sizes(80)[0] > 41
    assert near.sizes(80)[1] < near.sizes(85)[1] <= 0.70 < near.sizes(95)[1]
    with pytest.raises(ValueError, match="50 percent"):
        near.sizes(50)


def test_many_partners_in_blocks(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*words, f"end{i}"])) for i in range(700)]
    rows += [(1000 + i, " ".join(edited(rnd, words, 0.05))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert verdicts(near.near_duplicates(docs)) == brute.near(rows)


def test_a_crowd_of_near_copies(spark, monkeypatch):
    """Many links lie between documents that are not the smallest of any bucket they share."""
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rnd, words, rnd.uniform(0.01, 0.05)))) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    later = []
    whole = near.link_open_buckets
    monkeypatch.setattr(near, "link_open_buckets", lambda *args: later.append(whole(*args)) or later[-1])
    assert verdicts(near.near_duplicates(docs)) == brute.near(rows)


def test_blocks_of_a_bucket_find_what_stars_miss(spark):
    """All documents in one bucket whose smallest is linked with none of them."""
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base[:100]))] + [(i, " ".join([*base, *(f"x{j}" for j in range(i))])) for i in range(1, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signed = docs.transform(near.map_batches, near._sign, near.SIGNED)
    packed = docs.transform(near.map_batches, near._packed, "doc_id long, packed binary")
    shared = signed.select("doc_id", "n_shingles", F.element_at("bands", 1).alias("bucket")).collect()
    buckets = {r["bucket"] for r in shared}
    open_rows = spark.createDataFrame(
        [(r["bucket"], r["doc_id"], r["n_shingles"], r["doc_id"], min(x["doc_id"] for x in shared if x["bucket"] == r["bucket"])) for r in shared],
        "bucket long, doc_id long, n long, component long, main long",
    )
    found = {tuple(r) for r in near.link_open_buckets(open_rows, signed, packed).collect()}
    sets = {i: brute.shingles(t) for i, t in rows}
    assert all(100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) for a, b in found)
    if len(buckets) == 1:
        assert len(found) >= 4


def test_odd_rows(odd_docs, no_docs):
    found = near.near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    for i in (1, 2, 3, 10):
        assert (by_id[i]["n_shingles"], by_id[i]["component_id"], by_id[i]["kept"]) == (0, i, True)
    assert by_id[4]["n_shingles"] == by_id[9]["n_shingles"] == by_id[8]["n_shingles"] == 1
    assert by_id[6]["component_id"] == 5 and not by_id[6]["kept"]
    assert all(r["component_id"] is None and r["kept"] for r in found if r["doc_id"] is None)
    assert near.near_duplicates(no_docs).collect() == []


def test_signature_agreement_follows_similarity():
    rnd = np.random.default_rng(1)
    pool = rnd.integers(0, 1 << 63, 3000, np.uint64)
    one, two = np.unique(pool[:2000]), np.unique(pool[500:2500])
    found = near.signatures([one, two])
    assert found.shape[1] == 2 * near.BANDS * near.PERMUTATIONS
    assert abs((found[0] == found[1]).mean() - 1500 / 2500) < 0.12


@pytest.mark.parametrize("n", [1, 40])
def test_components(spark, n):
    path = [(i, i + 1) for i in range(n)] + [(100, 101), (105, 101), (200, 200)]
    found = components(spark.createDataFrame(path, "a long, b long"))
    expected = {i: 0 for i in range(n + 1)} | {100: 100, 101: 100, 105: 100}
    assert {r["node"]: r["component"] for r in found.collect()} == expected


def test_words():
    contents = ["A b\tc\x0bd\x0ce \r\n f", "", "é x  ", "  g"]
    data, begins = joined([c.encode() for c in contents])
    start, end, hashed, count = words(lowered(data), begins)
    assert count.tolist() == [6, 0, 2, 1]
    assert [lowered(data)[a:b].tobytes() for a, b in zip(start, end, strict=True)][:2] == [b"a", b"b"]
    assert len(set(hashed.tolist())) == 9
    again = shingle_sets([b"x y z", b"q x y z", b"x y", b"X Y"])
    assert (again[2] == again[3]).all() and not set(again[0]) & set(again[1])
    values = np.arange(20, dtype=np.uint64)
    for size in (1, 2, 3, 5, 13, 16):
        assert (window_hashes(values, size)[4:] == window_hashes(values[4:], size)).all()
        assert len(set(window_hashes(values, size).tolist())) == 21 - size
        assert (hashes_at(values, np.array([4, 0]), size) == window_hashes(values, size)[[4, 0]]).all()


def test_words_with_one_hash_are_not_linked(spark):
    """Thue-Morse words collide in every polynomial hash modulo 2**64; their shingles differ all the same."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, two = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    rows = [(1, " ".join([one] * 5)), (2, " ".join([two] * 5)), (3, " ".join([one] * 9))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert verdicts(near.near_duplicates(docs)) == brute.near(rows) == {1: (1, 1), 2: (1, 2), 3: (1, 1)}
