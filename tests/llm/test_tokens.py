import hashlib
import random

import public_tokenizers
import pytest
import regex
from scopewise.llm import bpe, counts
from tokenizers import Tokenizer

FILE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocab():
    with open(FILE, "rb") as file:
        return bpe.vocabulary(file.read())


def test_transducer(vocab):
    rnd = random.Random(1)
    words = sorted({bytes(rnd.choices(b"abc\x00\xff", k=rnd.randrange(1, 8))) for _ in range(800)})
    entries = {word: [i, *word] for i, word in enumerate(words)}
    lexicon = bpe.Lexicon(bpe.compile_lexicon(entries))
    asked = words + [w + b"a" for w in words] + [w[:-1] for w in words] + [b"zz", b""]
    for word, number in zip(asked, lexicon.numbers(asked).tolist(), strict=True):
        if word in entries:
            assert lexicon.ids[lexicon.first[number] : lexicon.first[number + 1]].tolist() == entries[word]
        else:
            assert number == -1
    assert len(lexicon.accepts) < sum(map(len, words)) / 2  # suffixes are shared


def test_empty_lexicon():
    assert bpe.Lexicon(bpe.compile_lexicon({})).numbers([b"a", b""]).tolist() == [-1, -1]


@pytest.mark.parametrize("size", [50, 5000])
def test_equals_the_library(spark, odd_docs, documents, texts_of, size):
    library = Tokenizer.from_file(FILE)
    for docs in (odd_docs, documents):
        coded = bpe.encode(docs, FILE, size)
        back = {}
        for row in bpe.decode(coded.withColumn("same", coded["ids"]), FILE).collect():
            back.setdefault(row["doc_id"], set()).add((row["n_tokens"], bytes(row["same"]), row["decoded"]))
        for doc_id, text in texts_of(docs):
            ids = library.encode(text, add_special_tokens=False).ids
            line = b"".join(i.to_bytes(4, "little") for i in ids)
            assert (len(ids), line, library.decode(ids, skip_special_tokens=False)) in back[doc_id]


def test_all_characters(vocab):
    library = Tokenizer.from_file(FILE)
    lexicon = bpe.Lexicon(bpe.compile_lexicon({b" a": [257]}))
    for gap in ("", " "):
        whole = [gap.join(chr(c) for c in range(a, a + 64)) for a in range(0, 0xD800, 64)]
        ids = bpe.encode_texts(whole, vocab, lexicon, {})
        for text, own in zip(whole, ids, strict=True):
            assert own.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_words(vocab):
    library = Tokenizer.from_file(FILE)
    rnd = random.Random(2)
    for text in ["a" * 5000, "".join(rnd.choices("abetin", k=3000)), "é" * 999]:
        assert vocab.merge(text.encode()) == library.encode(text, add_special_tokens=False).ids


def test_round_trip_is_encode_and_decode(odd_docs, documents):
    for docs in (odd_docs, documents):
        coded = bpe.encode(docs, FILE, 500)
        apart = bpe.decode(coded.withColumn("kept", coded["ids"]), FILE).select("doc_id", "n_tokens", "kept", "decoded")
        both = bpe.round_trip(docs, FILE, 500)
        assert sorted(map(str, both.collect())) == sorted(map(str, apart.withColumnRenamed("kept", "ids").collect()))


def test_encode_empty_table(no_docs):
    assert bpe.decode(bpe.encode(no_docs, FILE), FILE).collect() == []


# Token counts


def best_count(word, scores):
    best = [(0.0, 0, ())]
    for end in range(1, len(word) + 1):
        best.append(
            max(
                (best[b][0] + scores[word[b:end]], end - b, best[b][2] + (word[b:end],))
                for b in range(end)
                if word[b:end] in scores
            )
        )
    return len(best[-1][2])


def best_count_of_long(word, scores):
    """The same for words of any length: pieces no longer than the longest, counts instead of pieces."""
    longest = max(map(len, scores))
    best = [(0.0, 0, 0)]
    for end in range(1, len(word) + 1):
        reachable = range(max(0, end - longest), end)
        best.append(
            max((best[b][0] + scores[word[b:end]], end - b, best[b][2] + 1) for b in reachable if word[b:end] in scores)
        )
    return best[-1][2]


def test_counts_brute_force(odd_docs, documents, texts_of, no_docs):
    with open(RANKS, "rb") as file:
        scores = counts.piece_scores(file.read())
    split = regex.compile(bpe.PATTERN).findall
    short = documents.where("n_chars < 1500")
    for docs in (odd_docs.where("coalesce(length(text), 0) < 100"), short):
        expected = sorted(
            ((i, len(split(t)), sum(best_count(w.encode(), scores) for w in split(t))) for i, t in texts_of(docs)), key=str
        )
        for nodes in (counts.MAX_NODES, 30):
            assert sorted(map(tuple, counts.token_counts(docs, RANKS, nodes).collect()), key=str) == expected
    assert counts.token_counts(odd_docs, RANKS).count() == odd_docs.count()
    assert counts.token_counts(no_docs, RANKS).collect() == []


def test_counts_of_whole_texts(documents, texts_of):
    """Every row of the table, long texts too, through the query."""
    from scopewise.llm.queries import RUN

    with open(RANKS, "rb") as file:
        scores = counts.piece_scores(file.read())
    known, split = {}, regex.compile(bpe.PATTERN).findall

    def tokens(word):
        if word not in known:
            known[word] = best_count_of_long(word.encode(), scores)
        return known[word]

    expected = sorted((i, len(split(t)), sum(map(tokens, split(t)))) for i, t in texts_of(documents))
    found = RUN["op5_token_counts"](documents.sparkSession, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, found)) == expected
    assert documents.where("n_chars >= 1500").count() > 0


def test_long_pre_tokens(spark, monkeypatch):
    """Pre-tokens beyond the bound make no nodes, and count as in the trie."""
    with open(RANKS, "rb") as file:
        scores = counts.piece_scores(file.read())
    rnd = random.Random(9)
    words = ["a" * 9000, "".join(rnd.choices("abetin", k=8000)), "é" * 3000, " " * 5000, "".join(rnd.choices("theraion", k=300))]
    trie = counts.SharedTrie(scores)
    assert [trie.count(word) for word in words] == [best_count_of_long(word.encode(), scores) for word in words]
    assert len(trie.best) <= 301
    assert best_count(words[4].encode(), scores) == trie.rolling(words[4].encode())
    monkeypatch.setattr(counts, "LONG_WORD", 1 << 30)
    whole = counts.SharedTrie(scores)
    assert [whole.count(word) for word in words] == [trie.rolling(word.encode()) for word in words]
    monkeypatch.undo()
    docs = spark.createDataFrame([(1, "z" * 2_000_000), (2, "\t" * 500_000), (3, " ".join(words))], "doc_id long, text string")
    found = {r["doc_id"]: r["n_words"] for r in counts.token_counts(docs, RANKS).collect()}
    assert found[1] == 1 and set(found) == {1, 2, 3}


def test_a_prefix_is_computed_once():
    trie = counts.SharedTrie({bytes([b]): -1.0 for b in b"abc"} | {b"ab": -1.5})
    assert [trie.count(w) for w in ("abc", "abca", "ab", "abc")] == [2, 3, 1, 2]
    assert len(trie.best) == 5


def test_digests_of_queries(spark):
    from scopewise.llm.queries import RUN

    library = Tokenizer.from_file(FILE)
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = RUN["op10_bpe"](spark, sf).collect()
    assert {r["doc_id"] for r in found} == set(docs)
    for row in found:
        ids = library.encode(docs[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(docs[row["doc_id"]].encode()).hexdigest()
