import random

import brute
import pytest
from scopewise.llm import decontaminate

SF = "/root/testdata/sf0.001"


def pairs(found):
    return {(r["doc_id"], r["item_id"]): r["containment"] for r in found.collect()}


@pytest.mark.parametrize("bound", [decontaminate.BROADCAST_BYTES, 0])
def test_whole_table(spark, documents, texts_of, bound, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", bound)
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(r["item_id"], r["text"]) for r in items.collect()]
    expected = brute.contained(texts_of(documents), rows)
    assert expected and pairs(decontaminate.find_items(documents, items)) == expected


def test_hidden_items(spark):
    """Items of all sizes in long texts: whole, damaged, spread over two places, and too damaged."""
    rnd = random.Random(4)
    word = lambda: f"w{rnd.randrange(10**5)}"
    items, docs = [], []
    for i, size in enumerate([1, 3, 5, 6, 9, 12, 17, 40, 70, 130, 400] * 3):
        words = [word() for _ in range(size)]
        items.append((i, " ".join(words)))
        filler = [word() for _ in range(rnd.randrange(3000))]
        at = rnd.randrange(len(filler) + 1)
        if i % 3 == 0:
            text = filler[:at] + words + filler[at:]
        elif i % 3 == 1:
            half = size // 2
            text = words[: half + 2] + filler + words[max(0, half - 2) :]
        else:
            text = filler[:at] + [w.upper() if rnd.random() > 0.06 else "zz" for w in words] + filler[at:]
        docs.append((i, "\n".join(text)))
        docs.append((1000 + i, " ".join(words)))
    docs = docs + docs[:5]
    found = decontaminate.find_items(
        spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, position int"),
        spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, code string"),
    )
    expected = brute.contained(docs, items)
    assert 40 < len(expected) < len(docs) + 40
    assert pairs(found) == pytest.approx(expected)


def test_items_below_five_words(spark):
    """Found anywhere in a document, also where several short items of different lengths lie close together."""
    words = [f"w{i % 23}" for i in range(400)]
    docs = [(1, " ".join(words)), (2, "W1 w2\nw3"), (3, "w3 w2 w1"), (4, "w1"), (5, "x " * 50 + "w22 w0"), (6, "w1 x w2 x w3 x")]
    texts = [" ".join(words[i : i + n]) for n in range(1, 6) for i in range(0, 23)]
    items = list(enumerate([*texts, "w1  w2", "w2 w1", "x", "absent", "", None]))
    expected = brute.contained(docs, items)
    assert {len((items[i][1]).split()) for d, i in expected if d == 1} == {1, 2, 3, 4, 5}
    found = decontaminate.find_items(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert pairs(found) == expected


def test_short_items_in_sql(spark, tmp_path):
    """The SQL and the operator agree on items below five words."""
    import duckdb
    from scopewise.llm.queries import RUN, SQL

    rows = {
        "documents": ("doc_id long, text string", [(1, "a b c d e f g"), (2, "b C"), (3, None), (4, ""), (5, "c"), (6, "f g h")]),
        "benchmark": ("item_id long, text string", [(1, "b c"), (2, "C"), (3, "a b c d e f"), (4, "f g h i"), (5, None), (6, "e f g")]),
    }
    base = duckdb.connect()
    for name, (schema, data) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found = RUN["op6_decontaminate"](spark, str(tmp_path))
    expected = base.execute(f"SELECT {', '.join(found.columns)} FROM ({SQL['op6_decontaminate']})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert len(expected) == 7


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame(
        [(1, None), (2, ""), (None, "a"), (3, "a"), (4, "same text, twice"), (5, "word " * 7), (3, "a")],
        "item_id long, text string",
    )
    assert set(pairs(decontaminate.find_items(odd_docs, items))) == {(4, 3), (5, 4), (6, 4), (8, 5)}
    assert pairs(decontaminate.find_items(no_docs, items)) == {}
    assert pairs(decontaminate.find_items(odd_docs, items.limit(0))) == {}


def test_no_python_in_plan(spark, documents):
    found = decontaminate.find_items(documents, spark.read.parquet(f"{SF}/benchmark.parquet"))
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
