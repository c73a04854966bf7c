import hashlib

import brute
import corpus_pipeline
import public_tokenizers
from scopewise.llm import language
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def keep_exact(rows):
    last = {}
    for doc_id, text in rows:
        last[text] = max(last.get(text, doc_id), doc_id)
    return [(i, t) for i, t in dict(rows).items() if last[t] == i]


def keep_near(rows):
    verdict = brute.near(rows)
    return [(i, t) for i, t in rows if verdict[i][1] == i]


def keep_clean(rows, items):
    found = {i for i, _ in brute.contained(rows, items)}
    return [(i, t) for i, t in rows if i not in found]


def test_run_equals_brute_force(spark, documents, texts_of):
    model = language.train(documents.where(~language.held_out()))
    labels = {r["doc_id"]: r for r in language.identify(documents, model).collect()}
    rows = [
        (i, t) for i, t in texts_of(documents)
        if labels[i]["lang_pred"] != "und" and labels[i]["score"] >= corpus_pipeline.MIN_LANGUAGE_SHARE
    ]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = keep_clean(keep_near(keep_exact(rows)), items)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = set()
    for doc_id, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        line = b"".join(i.to_bytes(4, "little") for i in ids)
        expected.add((doc_id, len(ids), hashlib.sha256(line).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    found = corpus_pipeline.run(spark, SF).collect()
    assert len(found) == len(expected) < documents.count()
    assert set(map(tuple, found)) == expected


def test_stages_keep_columns_and_handle_odd_rows(spark, odd_docs, no_docs):
    rows = [(20, "same text, twice", "en"), (21, "quite another one here", "en")]
    wide = odd_docs.unionByName(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"), allowMissingColumns=True
    ).withColumn("source", odd_docs["keep_id"])
    for docs in (wide, wide.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SF)
            assert after.columns == docs.columns and after.dtypes == docs.dtypes
            docs = spark.createDataFrame(after.collect(), docs.schema)
        kept = sorted((r["doc_id"] or 0 for r in docs.collect()))
        assert corpus_pipeline.encode_stage(spark, docs, SF).count() == len(kept)
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (None, "c")], "doc_id long, text string")
    found = corpus_pipeline.exact_stage(spark, twice, SF).collect()
    assert sorted(map(tuple, found), key=str) == [(1, "a b"), (None, "a b"), (None, "c")]


def test_exact_stage_with_clashing_doc_ids(spark):
    """Only equal rows collapse; a text is judged by itself, not by the other texts of its doc_id."""
    rows = [(1, "a"), (1, "b"), (1, "b"), (2, "a"), (3, "c"), (3, "c"), (4, "d"), (4, "e"), (5, None), (4, "f"), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = corpus_pipeline.exact_stage(spark, docs, SF)
    assert sorted(map(tuple, found.collect())) == [(1, "b"), (2, "a"), (3, "c"), (4, "d"), (4, "e"), (4, "f"), (6, "")]


def test_entry_registers_everything():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
