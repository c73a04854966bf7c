import pytest
from pyspark.sql import functions as F

from scopewise.functions import numeric as N
from scopewise.functions import text as X


def apply(spark, expression, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


PADDED = [
    " a ", "\ta\n", " a　", " a ", "\u0085a\x1f", "\x1ca", "﻿a", "​a",
    "a b", "é", " été ", "", "   ", "a\n", None,
]


def test_strip_equals_python(spark):
    expected = [v.strip() if v is not None else None for v in PADDED]
    assert apply(spark, X.strip_text, PADDED) == expected


def test_blank(spark):
    expected = [v is None or v.strip() == "" for v in PADDED]
    assert apply(spark, X.is_blank, PADDED) == expected


@pytest.mark.parametrize("name", ["Gujarat", " GUJARAT\t", "gujarat "])
def test_scope_key_ignores_spelling(spark, name):
    assert apply(spark, X.scope_key, [name]) == ["gujarat"]
    assert apply(spark, X.scope_label, [name]) == ["GUJARAT"]


def test_scope_key_folds_like_python(spark):
    names = ["Straße", "ﬁx", "İ", "AΣB"]
    assert apply(spark, X.scope_key, names) == [n.casefold() for n in names]


COUNTS = {
    "7": 7, " 7 ": 7, "+5": 5, "1e3": 1000, "7.0": 7, "7.": 7, "-3": -3, " 7\t": 7,
    "9007199254740993": 9007199254740993, "12.5": None, "12.0000001": None, "1,000": None,
    "0x10": None, "1_0": None, "": None, "inf": None, "NaN": None, "5d": None, "5f": None,
    "1e300": None, ".": None, "e5": None, "1-2": None, "Infinity": None, None: None,
}


def test_parse_count(spark):
    assert apply(spark, N.parse_count, list(COUNTS)) == list(COUNTS.values())


def test_parse_number_and_fraction(spark):
    texts = ["12.5", ".5", "3", "1e-1", "12.0000001", "abc", "5d", "nan", "0x1p3"]
    assert apply(spark, N.parse_number, texts) == [12.5, 0.5, 3.0, 0.1, 12.0000001] + [None] * 4
    fractional = apply(spark, lambda c: N.is_fractional(N.parse_number(c)), texts)
    assert fractional == [True, True, False, True, True] + [None] * 4


def test_column_rounding_is_half_even(spark):
    df = spark.createDataFrame([(1, 128), (1, 640), (3, 128), (0, 0), (5, 0)], "n long, d long")
    shares = [r[0] for r in df.select(N.safe_pct(F.col("n"), F.col("d"))).collect()]
    assert shares == [0.7812, 0.1562, 2.3438, 0.0, 0.0]


def test_column_rounding_equals_numpy(spark):
    np = pytest.importorskip("numpy")
    values = [n / d * 100 for n in range(0, 60) for d in range(1, 90)]
    assert apply(spark, lambda c: N.round_column(c, 4), values, "double") == list(np.round(values, 4))


def test_value_rounding_equals_python(spark):
    values = [2.675, 2.665, 1.005, 0.125, 91765.6666, 1e9 + 0.335, 0.0, 107 / 40, 12345678.125]
    assert apply(spark, lambda c: N.round_value(c, 2), values, "double") == [
        round(v, 2) for v in values
    ]


def test_dominant_category(spark):
    rows = [(1, 0, 0), (0, 2, 1), (0, 1, 3), (5, 5, 1), (0, 4, 4), (2, 2, 2), (0, 0, 0)]
    df = spark.createDataFrame(rows, "micro long, small long, medium long")
    labels = [r[0] for r in df.select(N.dominant_category(["micro", "small", "medium"])).collect()]
    assert labels == ["MICRO", "SMALL", "MEDIUM", "TIE", "TIE", "TIE", "NO_REGISTRATIONS"]


def test_text_output(spark):
    assert apply(spark, X.thousands, [3028267, 0], "long") == ["3,028,267", "0"]
    assert apply(spark, X.flatten_list, [["b", "a"]], "array<string>") == ["a | b"]
    found = apply(spark, lambda c: X.mentions_name(c, "Owner_Name"), ['{"OWNER_NAME": 1}', '{"owner": 1}'])
    assert found == [True, False]
