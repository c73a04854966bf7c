import pytest
from pyspark.sql import functions as F

from scopewise.operators import measures as E
from scopewise.operators import pages as P
from scopewise.operators import reconcile as K
from scopewise.operators.metrics import entity_metrics
from scopewise.spec import DataQualityError


@pytest.fixture
def metrics(fact):
    rows = [("GUJARAT", "24", f"E{i:02d}", str(i), 100 * i, 10 * i, i) for i in range(1, 13)]
    return entity_metrics(fact([*rows, ("GOA", "30", "E01", "g1", 0, 0, 7)]))


def test_measures_in_context(metrics):
    row = E.measures(metrics, context=E.FilterContext(outer={"entity_name": ["E01", "E02"]})).first()
    assert row["total_registered"] == 7 + 111 + 222
    assert row["entity_count"] == 3
    assert row["average_per_entity"] == 340 / 3
    assert row["medium_share"] == 10 / 340


def test_empty_context(metrics):
    empty = E.FilterContext(outer={"scope_name": ["NOWHERE"]})
    row = E.measures(metrics, context=empty).first()
    assert row["total_registered"] is None and row["micro_registered"] is None
    assert (row["entity_count"], row["average_per_entity"], row["micro_share"]) == (0, 0.0, 0.0)
    flags = E.measure_flags(metrics, context=empty).first()
    assert (flags["top_10"], flags["bottom_10"]) == (1, 1)
    assert E.selected_contribution(metrics, context=empty).first()["selected_contribution"] == 0.0


def test_missing_code_counts_once(fact):
    df = fact([("A", "1", "X", None, 1, 0, 0), ("A", "1", "Y", None, 1, 0, 0), ("A", "1", "Z", "1", 1, 0, 0)])
    assert E.measures(df).first()["entity_count"] == 2


def test_contribution_ignores_entity_filters_only(metrics):
    context = E.FilterContext(outer={"scope_name": ["GUJARAT"]}, inner={"entity_name": ["E01"]})
    row = E.selected_contribution(metrics, context=context).first()
    assert row["selected_contribution"] == 111 / 8658
    tips = {r["entity_code"]: r for r in E.tooltip(metrics, context).collect()}
    assert set(tips) == {"1"} and tips["1"]["selected_contribution"] == 111 / 8658


def test_extremes_over_outer_filters(fact):
    df = fact([("A", "1", n, c, t, 0, 0) for n, c, t in (("B", "1", 5), ("A", "2", 5), ("C", "3", 1))])
    context = E.FilterContext(inner={"entity_name": ["C"]})
    assert tuple(E.measure_extremes(df, context=context).first()) == ("A", "C")


def test_highlight_keeps_totals(metrics):
    row = E.cross_highlight(metrics, F.col("entity_name") == "E02", ["scope_name"], ["total"])
    found = {r["scope_name"]: (r["total_all"], r["total_highlighted"]) for r in row.collect()}
    assert found == {"GUJARAT": (8658, 222), "GOA": (7, 0)}


def test_flags_and_drillthrough(metrics):
    flags = E.measure_flags(metrics, ["entity_code"]).collect()
    assert {r["entity_code"] for r in flags if not r["top_10"]} == {"1", "2"}
    chosen = metrics.where("entity_name = 'E01'").select("entity_name", "entity_code")
    kept = E.FilterContext(outer={"scope_name": ["GUJARAT"]})
    rows = E.drillthrough(metrics, chosen, kept).collect()
    assert [(r["entity_code"], r["total_registered"]) for r in rows] == [("1", 111)]


def test_pages_only_show_fact_columns(metrics):
    assert P.top10_bar(metrics).count() == 11
    assert P.stacked_composition(metrics).count() == 39
    with pytest.raises(DataQualityError, match="owner"):
        P.fields(metrics, ["entity_name", "owner"])
    with pytest.raises(DataQualityError, match="owner"):
        E.measures(metrics, context=E.FilterContext(outer={"owner": ["x"]}))


def test_keyed_reorder(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    assert [r["k"] for r in K.keyed_reorder(df, "k", ["c", "a"]).collect()] == ["c", "a"]
    assert K.missing_order_keys(df, "k", ["c", "x", "a"]) == ["x"]


def test_manifest_status(spark):
    schema = "relative_path string, size_bytes long, sha256 string"
    listed = spark.createDataFrame(
        [("a", 1, "x"), ("b", 1, "x"), ("c", 1, "x"), ("d", None, "x"), ("e", 1, "x")], schema
    )
    actual = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 1, "y"), ("d", 9, "x")], schema)
    assert dict(map(tuple, K.verify_manifest(listed, actual).collect())) == {
        "a": "ok", "b": "size_mismatch", "c": "checksum_mismatch", "d": "ok", "e": "missing",
    }


def test_keys_and_references(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    right = spark.createDataFrame([(2,), (3,), (3,)], "k int")
    assert dict(map(tuple, K.reconcile_keys(left, right, ["k"]).collect())) == {
        1: "missing", 2: "ok", 3: "unexpected",
    }
    assert [r[0] for r in K.shared_keys(left, right, ["k"]).collect()] == [2]
    assert K.unknown_references(left, "k", right, "k").count() == 2
    assert [r[0] for r in K.values_outside(left, "k", [1]).collect()] == [2]
