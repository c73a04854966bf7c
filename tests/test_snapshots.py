from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from scopewise.operators.metrics import entity_metrics
from scopewise.operators.provenance import Source
from scopewise.plans import snapshots as S
from scopewise.spec import DEFAULT_SPEC, DataQualityError

SPEC = replace(DEFAULT_SPEC, snapshot_cols=("as_of",))
SOURCE = Source("S", "s.csv")


@pytest.fixture
def small(fact):
    places = (("GUJARAT", "24"), ("GOA", "30"))
    return fact([(name, code, f"E{i:02d}", f"{code}-{i}", 10 * i, i, 1) for name, code in places for i in range(12)])


def of(df, *names):
    return df.crossJoin(df.sparkSession.createDataFrame([(n,) for n in names], "as_of string"))


def rows(df):
    return sorted(tuple(r) for r in df.select(*SPEC.output_cols).collect())


def test_repeated_snapshot_is_replaced_alone(spark, small, tmp_path):
    table = str(tmp_path / "t")
    S.write_snapshots(of(small, "007", "2024-01-01"), table, SOURCE, SPEC)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t/metrics/as_of=007").iterdir()}
    scope = small.select("scope_name").first()[0]
    later = small.where(F.col("scope_name") != scope)
    assert later.count()
    stored = S.write_snapshots(of(later, "2024-01-01"), table, SOURCE, SPEC)
    assert rows(stored.where("as_of = '007'")) == rows(entity_metrics(of(small, "007"), SPEC))
    assert rows(stored.where("as_of <> '007'")) == rows(entity_metrics(of(later, "2024-01-01"), SPEC))
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "t/metrics/as_of=007").iterdir()}
    told = S.read_provenance(spark, table, SPEC, as_of="2024-01-01")
    assert scope not in {r["scope_name"] for r in told.collect()}
    assert S.torn_snapshots(spark, table, SPEC).count() == 0


def test_one_snapshot_is_read_alone(spark, small, tmp_path):
    table = str(tmp_path / "t")
    S.write_snapshots(of(small, "a", "b", "c"), table, SOURCE, SPEC)
    one = S.read_snapshots(spark, table, SPEC, as_of="b")
    assert {r["as_of"] for r in one.collect()} == {"b"} and len(one.inputFiles()) > 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(as_of" in plan
    with pytest.raises(ValueError, match="scope_name"):
        S.read_snapshots(spark, table, SPEC, scope_name="x")


def test_refused_facts_replace_nothing(spark, small, tmp_path):
    table = str(tmp_path / "t")
    S.write_snapshots(of(small, "a"), table, SOURCE, SPEC)
    expected = rows(S.read_snapshots(spark, table, SPEC))
    for bad in (of(small, "a").limit(0), of(small, "a", None), of(small, "a", " ")):
        with pytest.raises(DataQualityError):
            S.write_snapshots(bad, table, SOURCE, SPEC)
    with pytest.raises(DataQualityError):
        S.write_snapshots(small, table, SOURCE, SPEC)
    with pytest.raises(ValueError, match="snapshot_cols"):
        S.write_snapshots(small, table, SOURCE, DEFAULT_SPEC)
    assert rows(S.read_snapshots(spark, table, SPEC)) == expected


def test_run_that_ends_between_both_tables_is_found_and_mended(spark, small, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    S.write_snapshots(of(small, "a", "b"), table, SOURCE, SPEC)
    swap, later = S._swap, of(small, "b").withColumns({"micro": F.col("micro") + 1, "total": F.col("total") + 1})

    def breaks(df, path, spec):
        if path.endswith("provenance"):
            raise RuntimeError("lost")
        swap(df, path, spec)

    with monkeypatch.context() as patch:
        patch.setattr(S, "_swap", breaks)
        with pytest.raises(RuntimeError, match="lost"):
            S.write_snapshots(later, table, SOURCE, SPEC)
    assert {r["as_of"] for r in S.torn_snapshots(spark, table, SPEC).collect()} == {"b"}
    S.write_snapshots(later, table, SOURCE, SPEC)
    assert S.torn_snapshots(spark, table, SPEC).count() == 0
