import pytest
from pyspark.sql import functions as F

from scopewise.operators import contexts as C
from scopewise.operators import measures as E
from scopewise.operators.metrics import entity_metrics
from scopewise.spec import DataQualityError

#: Ten visuals: without filters, per part, both parts, several values, no rows, no values.
VISUALS = {
    "all": E.FilterContext(),
    "scope": E.FilterContext(outer={"scope_name": ["GUJARAT"]}),
    "two scopes": E.FilterContext(outer={"scope_name": ["GUJARAT", "GOA"]}),
    "entities": E.FilterContext(outer={"scope_name": ["GUJARAT"], "entity_name": ["E01", "E02"]}),
    "inner": E.FilterContext(inner={"dominant_category": ["MICRO"]}),
    "both": E.FilterContext(outer={"scope_name": ["GUJARAT"]}, inner={"scope_name": ["GOA"]}),
    "flag": E.FilterContext(outer={"top_10_flag": [True]}, inner={"entity_code": ["3", "g1"]}),
    "ranks": E.FilterContext(outer={"rank_total": [1, 2, 11]}),
    "share": E.FilterContext(outer={"medium_share_pct": [100.0]}),
    "nobody": E.FilterContext(outer={"scope_name": ["NOWHERE"]}),
    "no values": E.FilterContext(outer={"scope_name": []}),
}


@pytest.fixture
def metrics(fact):
    rows = [("GUJARAT", "24", f"E{i:02d}", str(i), 100 * i, 10 * i, i) for i in range(1, 13)]
    rows += [("GOA", "30", "E01", "g1", 0, 0, 7), ("GOA", "30", "E02", None, 5, 0, 1)]
    return entity_metrics(fact(rows))


def single(metrics, context, by):
    """The same measures by one call each; groups that one of them lacks have no rows there."""
    found = {}
    for measure in (E.measures, E.selected_contribution, E.measure_extremes, E.measure_flags):
        for row in measure(metrics, by, context).collect():
            values = row.asDict()
            values.pop("selected_total", None)
            found.setdefault(tuple(values[c] for c in by), {}).update(values)
    return found


@pytest.mark.parametrize("by", [(), ("scope_name",), ("scope_name", "dominant_category")])
def test_equals_single_calls(spark, metrics, by):
    metrics = metrics.cache()
    result = C.context_measures(metrics, C.context_rows(spark, VISUALS), by)
    found = {}
    for row in result.collect():
        values = row.asDict()
        found.setdefault(values.pop("context"), {})[tuple(values[c] for c in by)] = values
    for name, context in VISUALS.items():
        expected = single(metrics, context, by)
        assert set(found.get(name, {})) == set(expected), name
        for group, values in expected.items():
            for measure, value in values.items():
                assert found[name][group][measure] == value, (name, group, measure)


def test_one_scan_of_the_fact(spark, metrics, tmp_path):
    metrics.write.parquet(f"{tmp_path}/fact")
    stored = spark.read.parquet(f"{tmp_path}/fact")
    visuals = {f"v{i}": E.FilterContext(outer={"scope_name": ["GOA"], "rank_total": [i]}) for i in range(10)}
    result = C.context_measures(stored, C.context_rows(spark, visuals))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{tmp_path}/fact") == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert result.count() == 10


def test_without_broadcast(spark, metrics):
    rows = C.context_rows(spark, VISUALS)
    expected = sorted(C.context_measures(metrics, rows, ["scope_name"]).collect(), key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(C.context_measures(metrics, rows, ["scope_name"]).collect(), key=str) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_values_that_are_none_of_their_column(spark, metrics):
    rows = [("a", "outer", "rank_total", "many"), ("b", "outer", "rank_total", "many"), ("b", "outer", "rank_total", "1"),
            ("a", "outer", "rank_total", None), (None, None, None, None)]
    result = {r["context"]: r for r in C.context_measures(metrics, spark.createDataFrame(rows, C.CONTEXT_SCHEMA)).collect()}
    assert (result["a"]["total_registered"], result["a"]["entity_count"]) == (None, 0)
    assert result["b"]["entity_count"] == 2
    assert result[None]["entity_count"] == 14


def test_empty_tables(spark, metrics):
    none = spark.createDataFrame([], C.CONTEXT_SCHEMA)
    assert C.context_measures(metrics, none).collect() == []
    row = C.context_measures(metrics.limit(0), C.context_rows(spark, {"all": E.FilterContext()})).first()
    assert (row["total_registered"], row["entity_count"], row["selected_contribution"]) == (None, 0, 0.0)


def test_refusals(spark, metrics):
    def rows(part, column):
        return spark.createDataFrame([("a", part, column, "1")], C.CONTEXT_SCHEMA)

    with pytest.raises(DataQualityError, match="does not offer: secret"):
        C.context_measures(metrics, rows("outer", "secret"))
    with pytest.raises(DataQualityError, match="neither outer nor inner"):
        C.context_measures(metrics, rows("page", "scope_name"))
    with pytest.raises(ValueError, match="entity"):
        C.context_measures(metrics, rows("outer", "scope_name"), ["entity_code"])
    with pytest.raises(ValueError, match="no list of values"):
        C.context_rows(spark, {"a": E.FilterContext(entity_pick=F.col("rank_total") < 3)})
