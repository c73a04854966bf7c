import hashlib
from collections import defaultdict

import pyarrow as pa
import pytest
from scopewise.llm import exact


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text].append(doc_id)
    out = []
    for doc_id, text in rows:
        keep = max((i for i in groups[text] if i is not None), default=None)
        out.append((doc_id, keep, len(groups[text]), doc_id == keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("table_bytes", [exact.TABLE_BYTES, 20])
def test_brute_force(odd_docs, documents, texts_of, table_bytes):
    for docs in (odd_docs, documents):
        found = exact.exact_duplicates(docs, table_bytes).collect()
        assert sorted(map(tuple, found), key=str) == expected(texts_of(docs))


def test_empty(no_docs):
    assert exact.exact_duplicates(no_docs).collect() == []


def test_hash_ties_are_told_apart_by_content():
    table = exact.OpenTable(2)
    numbers = [table.place(7, bytes([i % 50])) for i in range(200)]
    assert numbers == [i % 50 for i in range(200)]


def test_collapse_sends_a_text_once_per_piece():
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(1000)), "text": ["copy"] * 1000})
    (found,) = exact.collapse([rows])
    assert [t for t in found.column("text").to_pylist() if t is not None] == [b"copy"]
    assert [c for c in found.column("copies").to_pylist() if c is not None] == [1000]


@pytest.mark.parametrize("table_bytes", [exact.TABLE_BYTES, 20])
def test_rows_that_stay(odd_docs, documents, table_bytes):
    for docs in (odd_docs, documents.withColumn("digest", documents["lang"])):
        found = exact.drop_duplicates(docs, table_bytes)
        assert found.dtypes == docs.dtypes
        rows, last = docs.collect(), {}
        for r in rows:
            if r["doc_id"] is not None:
                last[r["text"] or ""] = max(last.get(r["text"] or "", r["doc_id"]), r["doc_id"])
        stay = {r for r in rows if r["doc_id"] is None or last[r["text"] or ""] == r["doc_id"]}
        assert sorted(map(str, found.collect())) == sorted(map(str, stay))


def test_texts_are_shuffled_once(documents):
    found = exact.drop_duplicates(documents)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
    assert "Join" not in plan
