import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from scopewise.llm import fmindex, variants


def near(a, b):
    """Whether b is a with one character inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, damage=31, min_length=7, min_count=2, factor=10):
    """(word, form, root, n, n_near, form_n) of all words of (doc_id, text) rows."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {word: c for word, c in counts.items() if len(word) >= min_length and c >= min_count}
    # Two words are near if they share what is left of one, or of both at one place, without a character.
    holes = defaultdict(list)
    for word in n:
        if len(word) > 5000:
            holes["long", None].append(word)
            continue
        holes[word, None].append(word)
        for i in range(len(word)):
            holes[word[:i] + word[i + 1 :], i].append(word)
            holes[word[:i] + word[i + 1 :], None].append(word)
    linked = defaultdict(set)
    for found in holes.values():
        for a in found:
            linked[a].update(b for b in found if b != a and near(a, b))
    form = {}
    for word, others in linked.items():
        best = min(others, key=lambda w: (-n[w], w)) if others else None
        if best and n[best] >= factor * n[word]:
            form[word] = best
    rows = []
    for word in n:
        root = word
        while root in form:
            root = form[root]
        rows.append((word, form.get(word), root, n[word], len(linked[word]), n.get(form.get(word))))
    return sorted(rows)


def result(found):
    return sorted(map(tuple, found.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def invented(seed, letters, n_words, lengths, n_docs=30):
    pick = random.Random(seed)
    words = ["".join(pick.choice(letters) for _ in range(pick.randint(*lengths))) for _ in range(n_words)]
    weights = [1 / (i + 1) for i in range(n_words)]
    return [(i, " ".join(pick.choices(words, weights, k=400))) for i in range(n_docs)]


@pytest.mark.parametrize("seed", range(40))
def test_index_finds_all_words_with_the_error_in_front(seed):
    pick = random.Random(seed)
    letters = "ab" if seed % 2 else "aé\U0001f600"
    words = sorted({"".join(pick.choice(letters) for _ in range(pick.randint(2, 7))) for _ in range(pick.randint(1, 40))})
    exact = np.array([len(word) // 2 for word in words])
    found = set(zip(*(a.tolist() for a in fmindex.one_error(fmindex.build(words), words, exact)), strict=True))
    assert found == {
        (i, j)
        for i, a in enumerate(words)
        for j, b in enumerate(words)
        if near(a, b) and a[len(a) - exact[i] :] == b[len(b) - exact[i] :]
    }


def test_long_ranges_try_all_symbols():
    words = sorted({f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}zzzz" for i in range(3000)})
    found = fmindex.one_error(fmindex.build(words), words, np.full(len(words), 4))
    known, letters = set(words), list(map(chr, range(97, 123)))
    assert len(found[0]) == sum(
        a[:p] + c + a[p + 1 :] in known for a in words for p in range(3) for c in letters if c != a[p]
    )


def test_equals_brute_force_on_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    found = result(variants.variants(documents))
    assert found == brute(rows)
    assert sum(row[1] is not None for row in found) >= 10


@pytest.mark.parametrize("hot", [1, 3, 1 << 15])
@pytest.mark.parametrize("letters", ["ab", "abcé"])
def test_split_halves_equal_brute_force(spark, letters, hot):
    rows = invented(len(letters), letters, 400, (6, 11))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = variants.variants(docs, hot_words=hot, bin_rows=200)
    expected = brute(rows)
    assert result(found) == expected
    assert sum(row[4] for row in expected) > 50


def test_chains_end_at_the_root(spark):
    steps = ["abcdefg", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk", "abcdefghijkl"]
    rows = [(i, " ".join([word] * (2 * 10**i))) for i, word in enumerate(steps)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {row[2] for row in result(variants.variants(docs, damage=0))} == {steps[-1]}


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert result(variants.variants(odd_docs, 31, 2, 1)) == brute(rows, 31, 2, 1)
    assert variants.variants(no_docs).count() == 0
    ties = [(1, "AAAAAAAb aaaaaaab aaaaaaac aaaaaaac aaaaaaa " * 40 + "aaaaaaaÿ aaaaaaaÿ Ñandúes×÷ñandúes")]
    docs = spark.createDataFrame(ties, "doc_id long, text string")
    assert result(variants.variants(docs)) == brute(ties)


def test_one_long_word(spark):
    word = "ab" * 1000
    rows = [(1, f"{word} {word} {word}x {word}x x{word[1:]} x{word[1:]}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [row[4] for row in result(variants.variants(docs, damage=0))] == [2, 1, 1]
