import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from scopewise.llm import resample


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def features_of(text):
    words = words_of(text)
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, target, percent, min_words):
    """doc_id, n_features, weight, score, rank of every row, in the order of the rows."""
    bucket = lambda x: zlib.crc32(x.encode()) % 10_000
    s = Counter(bucket(x) for _, text in docs for x in features_of(text))
    t = Counter(bucket(x) for text in target for x in features_of(text))
    all_s, all_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
    rows = []
    for doc_id, text in docs:
        own = features_of(text)
        weight = sum(gain(bucket(x)) for x in own)
        name = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"42:{name}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    may = [i for i, (_, text) in enumerate(docs) if len(words_of(text)) >= min_words]
    may.sort(key=lambda i: (-rows[i][3], rows[i][0] is None, rows[i][0] or 0))
    ranks = {i: rank for rank, i in enumerate(may[: percent * len(may) // 100], 1)}
    return [(*row, ranks.get(i)) for i, row in enumerate(rows)]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, v or 0) for v in r))


def test_equals_brute_force(spark, odd_docs, documents):
    docs = odd_docs.select("doc_id", "text").union(documents.select("doc_id", "text").limit(40))
    target = spark.createDataFrame([("a b c d",), (None,), ("same text",)], "text string")
    rows = [tuple(r) for r in docs.collect()]
    texts = [r["text"] for r in target.collect()]
    stored = spark.createDataFrame(rows, "doc_id long, text string")
    for percent, min_words in ((5, 20), (50, 0), (100, 1)):
        found = resample.resample(stored, target, percent, min_words)
        assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
        expected = brute(rows, texts, percent, min_words)
        assert ordered(found.drop("n_words").collect()) == ordered(expected)


def test_blocks_do_not_change_features(monkeypatch):
    data = ("Alpha beta-gamma 12 é\tx " * 50 + "y" * 500 + " z q").encode()
    whole = [b.tolist() for _, b in resample.features(data)]
    assert len(whole) == 1
    small = lambda data: resample_blocks(data, 7)
    from scopewise.llm.runs import blocks as resample_blocks

    monkeypatch.setattr(resample, "blocks", small)
    cut = list(resample.features(data))
    assert len(cut) > 20
    assert sorted(x for _, b in cut for x in b.tolist()) == sorted(whole[0])
    assert sum(n for n, _ in cut) == len(words_of(data.decode()))


def test_ties_are_cut_by_doc_id(spark):
    rows = [(i, 30, 1, 0, 7 if 100 <= i < 1000 else (9 if i < 100 else 1)) for i in range(2000)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    drawn = resample.draw(scored, 25, 20).where("rank is not null").orderBy("rank").collect()
    assert [r["doc_id"] for r in drawn] == list(range(500))
    assert [r["rank"] for r in drawn] == list(range(1, 501))


def test_tied_repeated_rows_and_null_ids(spark):
    rows = [(None, 30, 1, 0, 5)] * 3 + [(4, 30, 1, 0, 5)] * 4 + [(5, 3, 1, 0, 9)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    found = resample.draw(scored, 30, 20)
    assert found.count() == 8
    assert [tuple(r) for r in found.where("rank is not null").select("doc_id", "rank").orderBy("rank").collect()] == [
        (4, 1), (4, 2),
    ]
    assert [r["doc_id"] for r in resample.draw(scored, 90, 20).where("rank is not null").orderBy("rank").collect()] == [
        4, 4, 4, 4, None, None,
    ]


def test_empty_tables(spark, no_docs):
    target = spark.createDataFrame([], "text string")
    found = resample.resample(no_docs, target)
    assert found.count() == 0 and found.columns[-1] == "rank"
    alone = resample.resample(spark.createDataFrame([(1, "a " * 40)], "doc_id int, text string"), target, 100)
    assert alone.select("rank").first()["rank"] == 1


def test_no_text_is_shuffled(spark, documents):
    plan = resample.scores(documents, documents.select("text"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert documents.select(F.col("doc_id")).count() == 200
