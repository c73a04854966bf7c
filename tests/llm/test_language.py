import bisect
import functools
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from scopewise.llm import language


@pytest.fixture
def model(documents):
    return language.train(documents.where(~language.held_out()))


def test_held_out_accuracy(documents, model):
    found = language.identify(documents, model).withColumn("held_out", language.held_out())
    rows = found.join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 20
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.98


def words_of(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def bucket_of(trigram):
    a, b, c = map(ord, trigram)
    return ((((a * 0x9E3779B1 + b) * 0x85EBCA77 + c) * 0xC2B2AE3D27D4EB4F) % 2**64) >> 48


def buckets_of(word):
    marked = f"\x01{word}\x01"
    return [bucket_of(marked[i : i + 3]) for i in range(len(word))]


def script_of(word):
    return language.SCRIPTS[bisect.bisect_right(language.SCRIPT_STARTS.tolist(), ord(word[0])) - 1]


def plain_model(rows):
    """Counts in dictionaries: trigram scores and scripts per language of (text, lang) rows."""
    grams, letters = defaultdict(Counter), defaultdict(Counter)
    for text, lang in rows:
        for word in words_of(text):
            grams[lang].update(buckets_of(word))
            letters[lang][script_of(word)] += len(word)
    langs = sorted(grams)
    total = {lang: sum(grams[lang].values()) + 0.1 * language.BUCKETS for lang in langs}

    def score(word, lang):
        allowed = [x for x in langs if letters[x][script_of(word)] >= 0.001 * max(1, sum(letters[x].values()))]
        if allowed and lang not in allowed:
            return -1e6
        return sum(math.log((grams[lang][b] + 0.1) / total[lang]) for b in buckets_of(word))

    return langs, functools.cache(score)


def plain_label(text, langs, score, switch=12.0):
    """lang_pred and score by a Viterbi path over lists."""
    words = [word for word in words_of(text) if any(map(str.isalpha, word))]
    if not words or not langs:
        return "und", 0.0
    value, back = [score(words[0], lang) for lang in langs], []
    for word in words[1:]:
        best = max(range(len(langs)), key=value.__getitem__)
        came = [i if value[i] >= value[best] - switch else best for i in range(len(langs))]
        value = [max(value[i], value[best] - switch) + score(word, lang) for i, lang in enumerate(langs)]
        back.append(came)
    path = [max(range(len(langs)), key=value.__getitem__)]
    for came in reversed(back):
        path.append(came[path[-1]])
    share = [0] * len(langs)
    for label, word in zip(reversed(path), words, strict=True):
        share[label] += len(word)
    best = max(range(len(langs)), key=share.__getitem__)
    return langs[best], share[best] / sum(share)


def test_query_equals_plain_python(spark, documents):
    """Model, scores and paths of every row of the whole table, by dictionaries and lists."""
    from scopewise.llm.queries import RUN

    rows = documents.select("doc_id", "text", "lang").collect()
    out = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows}
    langs, score = plain_model([(r["text"], r["lang"]) for r in rows if not out[r["doc_id"]] and r["lang"] and r["text"]])
    found = {r["doc_id"]: r for r in RUN["op4_language_id"](spark, "/root/testdata/sf0.001").collect()}
    assert len(found) == len(rows)
    for row in rows:
        lang, share = plain_label(row["text"], langs, score)
        own = found[row["doc_id"]]
        assert (own["held_out"], own["lang_pred"]) == (out[row["doc_id"]], lang)
        assert own["score"] == pytest.approx(share, abs=1e-9)


def test_mixed_rows_equal_plain_python(spark, documents, model):
    """Texts that change their language and script, and words in a script of no language."""
    rows = [r for r in documents.where("text is not null and lang is not null").collect()]
    langs, score = plain_model(
        [(r["text"], r["lang"]) for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    )
    mixed = [
        (i, " ".join(rows[(7 * i + k) % len(rows)]["text"][40 * k : 40 * k + 150 + 30 * k] for k in range(5)) + " 中文 ½ жжж")
        for i in range(40)
    ]
    found = language.identify(spark.createDataFrame(mixed, "doc_id long, text string"), model).collect()
    expected = {i: plain_label(text, langs, score) for i, text in mixed}
    assert {r["doc_id"]: r["lang_pred"] for r in found} == {i: lang for i, (lang, _) in expected.items()}
    assert all(r["score"] == pytest.approx(expected[r["doc_id"]][1], abs=1e-9) for r in found)
    assert any(share < 0.9 for _, share in expected.values())


def test_mixed_text_has_spans(spark, documents, model):
    first = {r["lang"]: r["text"][:600] for r in documents.where("lang in ('en', 'de') and n_chars > 900").collect()}
    text = first["en"] + " " + first["de"]
    row = language.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    langs = [(s["lang"], s["start"], s["end"]) for s in row["spans"]]
    assert [lang for lang, *_ in langs] == ["en", "de"]
    assert abs(langs[0][2] - len(first["en"])) < 40 and langs[-1][2] == len(text)
    assert 0.4 < row["score"] < 0.65


def test_viterbi_brute_force():
    rnd = np.random.default_rng(3)
    lengths = np.array([4, 1, 5, 3])
    starts = np.cumsum(lengths) - lengths
    scores = rnd.normal(size=(13, 3)).astype(np.float32) * 3
    path = language.viterbi(scores, starts, lengths, 2.0)
    for start, length in zip(starts, lengths, strict=True):
        own = scores[start : start + length]

        def value(labels, own=own):
            return sum(own[i, x] for i, x in enumerate(labels)) - 2.0 * sum(a != b for a, b in itertools.pairwise(labels))

        best = max(itertools.product(range(3), repeat=int(length)), key=value)
        assert value(best) == pytest.approx(value(path[start : start + length]), abs=1e-4)


def test_scripts_narrow_candidates(spark):
    rows = [(i, f"{word} {word}о", lang) for i, (word, lang) in enumerate([("привет мир", "ru"), ("hello world", "en")] * 20)]
    rows = [(i, text if lang == "ru" else text.rstrip("о"), lang) for i, text, lang in rows]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    docs = spark.createDataFrame([(1, "жжж"), (2, "zzz"), (3, "中文")], "doc_id long, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, model).collect()}
    assert found[1] == "ru" and found[2] == "en" and found[3] in ("en", "ru")


def test_odd_rows(odd_docs, no_docs, model):
    found = language.identify(odd_docs, model).select("doc_id", "lang_pred", "score").collect()
    assert len(found) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in found if r["doc_id"]}
    assert all(by_id[i]["lang_pred"] == language.UNKNOWN for i in (1, 2, 3, 10, 11))
    assert by_id[8]["lang_pred"] in model.languages
    assert language.identify(no_docs, model).collect() == []


def test_nothing_to_learn(odd_docs, documents):
    model = language.train(documents.limit(0))
    assert {r["lang_pred"] for r in language.identify(odd_docs, model).collect()} == {language.UNKNOWN}
