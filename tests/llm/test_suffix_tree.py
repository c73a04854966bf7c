import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from scopewise.llm import suffix_tree


def tokens_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return (*re.findall(r"[^\x20\x09-\x0D]+", lowered), "")


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


class Brute:
    """The tree over tuples of words, one dictionary per length."""

    def __init__(self, rows, max_context=3, least=2, discount=0.75):
        train = [tokens_of(text) for doc_id, text in rows if not is_held_out(doc_id)]
        self.counts = Counter(t for own in train for t in own)
        self.n, self.v = sum(self.counts.values()), len(self.counts)
        runs = Counter(
            own[i : i + k] for own in train for k in range(2, max_context + 2) for i in range(len(own) - k + 1)
        )
        runs = {run: c for run, c in runs.items() if c >= least}
        whole = Counter(own[i : i + k] for own in train for k in range(1, max_context + 1) for i in range(len(own) - k + 1))
        follow = defaultdict(dict)
        for run, c in runs.items():
            follow[run[:-1]][run[-1]] = (c - discount) / whole[run[:-1]]
        self.follow, self.rest, self.kept = follow, {}, set()
        for context in sorted(follow, key=len, reverse=True):
            seen = follow[context]
            parents = {t: self.parent(context[1:], t) for t in seen}
            rest = max(1 - sum(seen.values()), 1e-12)
            parent_rest = max(1 - sum(parents.values()), 1e-12)
            self.rest[context] = rest / parent_rest
            divergence = sum(p * math.log(p / parents[t]) for t, p in seen.items()) + rest * math.log(rest / parent_rest)
            if whole[context] * divergence > 0.5 * len(seen) * math.log(whole[context]):
                self.kept |= {context[i:] for i in range(len(context))}

    def root(self, token):
        return (self.counts[token] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def parent(self, context, token):
        return self.follow[context][token] if context else self.root(token)

    def probability(self, before, token):
        context = before[-3:]
        while context and context not in self.kept:
            context = context[1:]
        factor = 1.0
        while context:
            if token in self.follow[context]:
                return factor * self.follow[context][token]
            factor *= self.rest[context]
            context = context[1:]
        return factor * self.root(token)

    def row(self, doc_id, text):
        own = tokens_of(text)
        return (
            doc_id,
            is_held_out(doc_id),
            len(own),
            sum(self.counts[t] > 0 for t in own),
            self.n,
            sum(math.log10(self.root(t)) for t in own),
            sum(math.log10(self.probability(own[:i], t)) for i, t in enumerate(own)),
        )


def ordered(rows):
    rows = [tuple(v if v is None else round(v, 6) if isinstance(v, float) else v for v in row) for row in rows]
    return sorted(rows, key=lambda row: tuple((v is None, v or 0) for v in row))


@pytest.mark.parametrize("least_share", [1e-6, 2e-4])
def test_equals_brute_force_on_documents(documents, least_share):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    n = sum(len(tokens_of(text)) for doc_id, text in rows if not is_held_out(doc_id))
    found = suffix_tree.log_probabilities(documents, least_share=least_share).collect()
    if least_share < 1e-5:
        model = Brute(rows)
        assert len(model.kept) > 1000
        assert ordered(found) == ordered(model.row(*row) for row in rows)
    else:
        # Fewer runs are kept and many words are scored by the join.
        model = Brute(rows, least=math.ceil(least_share * n))
        assert [r[:6] for r in ordered(found)] == [r[:6] for r in ordered(model.row(*row) for row in rows)]


def test_model_beats_base_on_held_out_texts(documents):
    found = [r for r in suffix_tree.log_probabilities(documents).collect() if r["held_out"]]
    assert sum(r["score"] for r in found) > 0.95 * sum(r["base_score"] for r in found)
    assert len(found) > 20


def test_states_are_distributions(documents):
    model = Brute([tuple(r) for r in documents.select("doc_id", "text").limit(30).collect()])
    contexts = sorted(model.kept)[:: max(1, len(model.kept) // 20)]
    unknown = 0.5 / (model.n + 0.5 * (model.v + 1))
    assert sum(model.root(t) for t in model.counts) + unknown == pytest.approx(1)
    for context in contexts:
        total = sum(model.probability(context, t) for t in model.counts) + model.probability(context, "\0unknown")
        assert total == pytest.approx(1)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    found = suffix_tree.log_probabilities(odd_docs)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    model = Brute(rows)
    assert ordered(found.collect()) == ordered(model.row(*row) for row in rows)
    assert suffix_tree.log_probabilities(no_docs).count() == 0
    only_held = [(i, "a b") for i in range(200) if is_held_out(i)]
    docs = spark.createDataFrame(only_held, "doc_id long, text string")
    assert {tuple(r)[2:] for r in suffix_tree.log_probabilities(docs).collect()} == {(3, 0, 0, 0.0, 0.0)}


def test_runs_that_cross_blocks(monkeypatch, spark):
    from scopewise.llm import runs

    rows = [(i, "The cat sat on the mat and the cat ran. " * (i + 1)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    monkeypatch.setattr(suffix_tree, "blocks", lambda data: runs.blocks(data, 11))
    found = suffix_tree.log_probabilities(docs).collect()
    model = Brute(rows)
    assert ordered(found) == ordered(model.row(*row) for row in rows)


def test_numbers_of_runs():
    first = suffix_tree.Level(np.arange(3), *[np.zeros(3)] * 5)
    pairs = suffix_tree.Level(np.array([1, (1 << 32) + 2]), *[np.zeros(2)] * 5)
    ids = np.array([0, 1, 2, -1, 1, 2, 0])
    assert suffix_tree.run_numbers(ids, [first, pairs])[1].tolist() == [-1, 0, 1, -1, -1, 1, -1]


@pytest.mark.parametrize(("head", "filter_bits"), [(300, 1 << 27), (1, 64)])
def test_a_tree_beyond_memory_is_whole(monkeypatch, spark, odd_docs, documents, head, filter_bits):
    """As many runs as occur twice, whatever share of the tokens that is and whatever the filters let pass."""
    rows = [tuple(r) for r in documents.select("doc_id", "text").limit(150).collect()]
    rows += [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(suffix_tree, "_HEAD", head)
    monkeypatch.setattr(suffix_tree, "_FILTER", filter_bits)
    model = Brute(rows)
    assert ordered(suffix_tree.log_probabilities(docs).collect()) == ordered(model.row(*row) for row in rows)


def test_no_share_of_the_tokens_is_needed(spark):
    """Runs that occur twice among more than two million tokens are in the tree."""
    rows = [(i, "a b c d e f g h i j " * 12_000) for i in range(25)]
    ids = range(25, 100)
    learned = [i for i in ids if not is_held_out(i)][:2]
    rare = {*learned, next(i for i in ids if is_held_out(i))}
    rows += [(i, "one rare phrase of five words") for i in rare]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    model = Brute(rows)
    assert model.n > 2_000_000
    found = suffix_tree.log_probabilities(docs).where("doc_id >= 25").collect()
    assert ordered(found) == ordered(model.row(*row) for row in rows if row[0] in rare)
    assert all(r["score"] > r["base_score"] + 10 for r in found)


@pytest.mark.parametrize(("head", "group"), [(600, 40), (200, 100)])
def test_contexts_with_many_words_are_dealt_to_many_bins(monkeypatch, spark, odd_docs, documents, head, group):
    """Heavy words, pairs and triples; texts that are equal, and words that are often together."""
    rows = [tuple(r) for r in documents.select("doc_id", "text").limit(20).collect()]
    rows += [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    rows += [(5000 + i, "one and the same text, again and again and again and again") for i in range(45)]
    rows += [(6000 + i, f"x{i % 7} x{i % 5} common x{i % 11} x{i % 3}") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(suffix_tree, "_HEAD", head)
    monkeypatch.setattr(suffix_tree, "_GROUP", group)
    seen, heavy_contexts = [], suffix_tree.heavy_contexts
    monkeypatch.setattr(suffix_tree, "heavy_contexts", lambda *given: seen.append(heavy_contexts(*given)) or seen[-1])
    model = Brute(rows)
    assert ordered(suffix_tree.log_probabilities(docs).collect()) == ordered(model.row(*row) for row in rows)
    assert len(seen[0].words) > 1
    if group < 100:
        assert all(len(keys) for keys in seen[0].keys)
