import pytest

SF = "/root/testdata/sf0.001"

ODD_TEXTS = [
    (1, None), (2, ""), (3, " \t\r\n"), (4, "a"), (5, "same text, twice"), (6, "same text, twice"),
    (6, "same text, twice"), (7, "é\x00ü\x1c😀 \u2028 \u00a0 z"), (8, "word " * 30_000), (9, "x" * 100_000),
    (10, None), (None, "no id"), (None, None), (11, "12 34 !! ½ ²"), (12, "a@b.c <|endoftext|> a@b"),
]


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with names that operators use."""
    rows = [(i, text, i, "n", 1.0, True) for i, text in ODD_TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, member_of long, keep_id string, score double, kept boolean"
    )


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def texts_of():
    return lambda docs: [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
