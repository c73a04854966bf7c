import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from scopewise.operators import conflicts as C
from scopewise.operators import scoping
from scopewise.operators.quality import count_duplicate_rows
from scopewise.plans.release import check_scope, qualification_of_scopes
from scopewise.spec import DEFAULT_SPEC, DataQualityError, FactSpec

KEY = DEFAULT_SPEC.key
NATIONAL = [
    ("Gujarat", "24", "ALPHA", "101", 10, 5, 1),
    ("GUJARAT", "24", "BETA", "102", 20, 6, 2),
    ("RAJASTHAN", "8", "JAIPUR", "102", 50, 5, 1),
    ("RAJASTHAN", "8", "DUDU", "102", 5, 1, 0),
    ("GOA", "30", "X", "1", 1, 0, 0),
    ("GOA", "30", "X", "1", 1, 0, 0),
]
IN_GUJARAT = scoping.in_scope


def values_of(rows, column):
    found = defaultdict(set)
    for r in rows:
        if r["column"] == column:
            found[r["scope_id"], r["entity_code"]].add(r["value"])
    return found


def test_conflict_groups(fact):
    rows = C.key_conflicts(fact(NATIONAL), KEY, IN_GUJARAT("Gujarat")).collect()
    verdicts = {(r["scope_id"], r["entity_code"], r["row_count"], r["conflicting"], r["contains_scope"]) for r in rows}
    assert verdicts == {("30", "1", 2, False, False), ("8", "102", 2, True, False)}
    assert values_of(rows, "entity_name") == {("30", "1"): {"X"}, ("8", "102"): {"DUDU", "JAIPUR"}}
    assert values_of(rows, "scope_name")["8", "102"] == {"RAJASTHAN"}


def test_conflict_detail(fact):
    columns = ("scope_name", "entity_name", "medium", "micro", "small", "total")
    rows = C.conflict_detail(fact(NATIONAL), KEY, columns, IN_GUJARAT("Gujarat")).collect()
    found = {r["scope_id"]: r for r in rows}
    assert found["8"]["changing_columns"] == "entity_name | medium | micro | small | total"
    assert values_of(rows, "micro")["8", "102"] == {"5", "50"}
    assert found["30"]["changing_columns"] == ""
    assert found["30"]["exact_duplicate_group"] and not found["30"]["conflicting_group"]


def test_null_keys_and_null_values(spark):
    rows = [(None, "1", "a"), (None, "1", None), (None, None, "x"), (None, None, "x"), ("k", None, "y")]
    df = spark.createDataFrame(rows, "a string, b string, v string")
    detail = C.conflict_detail(df, ["a", "b"], ["v"], F.col("v") == "x").collect()
    found = {(r["a"], r["b"]): r for r in detail}
    assert set(found) == {(None, "1"), (None, None)}
    assert found[None, "1"]["changing_columns"] == "v" and found[None, "1"]["conflicting_group"]
    assert {r["value"] for r in detail if r["b"] == "1"} == {"a", None}
    assert found[None, None]["exact_duplicate_group"] and found[None, None]["contains_scope"]
    assert {tuple(r) for r in C.conflict_rows(df, ["a", "b"]).collect()} == {(None, "1", "a"), (None, "1", None)}
    assert C.duplicate_members(df, ["a", "b"]).count() == 4
    analysis = C.dedupe_analysis(df, ["a", "b"]).first()
    assert (analysis["source_rows"], analysis["duplicate_groups"], analysis["rows_after_dedupe"]) == (5, 2, 4)


def many_rows(seed=5, n=900):
    """One key holds a third of the rows, with copies and conflicts."""
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        code = "HOT" if i % 3 == 0 else str(pick.randrange(250))
        scope = pick.choice(["A", "B", "C"])
        rows.append((scope, "1", f"N{pick.randrange(60)}", code, pick.randrange(3), 0, 0))
    return rows


def brute_force(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1], r[3]].append(r)
    return {
        key: (
            len(members),
            len(set(members)),
            sorted({m[0] for m in members}),
            sorted({m[2] for m in members}),
            any(m[0] == "B" for m in members),
        )
        for key, members in groups.items()
        if len(members) > 1
    }


def test_groups_equal_brute_force(fact):
    rows = many_rows()
    found = C.key_conflicts(fact(rows), KEY, IN_GUJARAT("b")).collect()
    expected = brute_force(rows)
    verdicts = {(r["scope_id"], r["entity_code"]): r for r in found}
    assert set(verdicts) == set(expected)
    scopes, names = values_of(found, "scope_name"), values_of(found, "entity_name")
    for key, (count, distinct, own_scopes, own_names, touches) in expected.items():
        r = verdicts[key]
        assert (r["row_count"], r["conflicting"], r["contains_scope"]) == (count, distinct > 1, touches)
        assert (scopes[key], names[key]) == (set(own_scopes), set(own_names))


def test_conflict_rows_and_dedupe(fact):
    rows = many_rows()
    df = fact(rows)
    expected = brute_force(rows)
    conflicting = {k for k, v in expected.items() if v[1] > 1}
    found = C.conflict_rows(df, KEY)
    assert found.count() == sum(expected[k][0] for k in conflicting)
    assert {(r["scope_id"], r["entity_code"]) for r in found.collect()} == conflicting
    analysis = C.dedupe_analysis(df, KEY).first()
    assert analysis["source_rows"] == len(rows)
    assert analysis["duplicate_rows"] == sum(v[0] for v in expected.values())
    assert analysis["duplicate_rows"] == count_duplicate_rows(df, KEY).first()[0]
    assert analysis["conflicting_groups"] == len(conflicting)
    assert analysis["rows_after_dedupe"] == len(set(rows))
    assert analysis["remaining_duplicate_rows"] == sum(expected[k][1] for k in conflicting)
    assert not analysis["dedupe_resolves_all"]


def test_exact_copies_are_resolved(fact):
    analysis = C.dedupe_analysis(fact(NATIONAL[:2] + NATIONAL[4:]), KEY).first()
    assert analysis["exact_groups"] == 1 and analysis["dedupe_resolves_all"]


def test_scope_qualification(fact):
    scopes = qualification_of_scopes(scoping.canonical_scope(fact(NATIONAL)))
    found = {r["scope_name"]: r for r in scopes.collect()}
    good = found["GUJARAT"]
    assert good["qualified"] and good["unique_in_scope"]
    assert (good["national_rows"], good["national_conflicting_groups"], good["national_conflicting_rows"]) == (6, 1, 2)
    assert (good["scope_rows"], good["scope_entities"], good["scope_total"]) == (2, 2, 44)
    assert not found["RAJASTHAN"]["qualified"]
    assert found["GOA"]["qualified"] and not found["GOA"]["unique_in_scope"]
    assert check_scope(scopes, " gujarat ").first()["scope_rows"] == 2
    for target in ("Rajasthan", "Goa", "Kerala"):
        with pytest.raises(DataQualityError):
            check_scope(scopes, target)


def test_snapshots_are_judged_one_by_one(fact):
    spec = FactSpec(snapshot_cols=("as_of",))
    old = fact(NATIONAL[:3]).withColumn("as_of", F.lit("2025"))
    new = fact(NATIONAL).withColumn("as_of", F.lit("2026"))
    df = scoping.canonical_scope(old.unionByName(new))
    rows = {(r["as_of"], r["scope_name"]): r for r in qualification_of_scopes(df, spec).collect()}
    assert len(rows) == 5
    assert rows["2025", "RAJASTHAN"]["qualified"] and rows["2025", "RAJASTHAN"]["national_rows"] == 3
    assert rows["2025", "GUJARAT"]["unique_in_scope"]
    assert not rows["2026", "RAJASTHAN"]["qualified"]
    assert rows["2026", "GUJARAT"]["national_conflicting_rows"] == 2


def test_policies_differ(fact, raw):
    df = fact(NATIONAL)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    with pytest.raises(DataQualityError, match="Duplicate rows"):
        scoping.validate_then_filter(df, "Gujarat")
    assert scoping.filter_then_validate(text, "Gujarat").count() == 2
    with pytest.raises(DataQualityError, match="Duplicate rows"):
        scoping.filter_then_validate(text, "Goa")
    with pytest.raises(DataQualityError, match="no Kerala"):
        scoping.filter_then_validate(text, "Kerala")
    clean = fact(NATIONAL[:3])
    scoped = scoping.validate_then_filter(clean, "gujarat")
    assert {r["scope_name"] for r in scoped.collect()} == {"GUJARAT"}
    with pytest.raises(DataQualityError, match="No Kerala"):
        scoping.validate_then_filter(clean, "Kerala")


def test_scoped_path_keeps_spelling(fact):
    df = fact(NATIONAL)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    scoped = scoping.filter_then_validate(text, "GUJARAT")
    assert {r["scope_name"] for r in scoped.collect()} == {"Gujarat", "GUJARAT"}


@pytest.fixture
def shuffled_joins(spark):
    """Joins that always shuffle, and partitions that are not put together again."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def half_null(spark):
    """Half of all rows have no key; the rest have keys of two rows."""
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    odd = F.col("l_linenumber") % 2 == 0
    return lines.select(
        F.when(odd, F.col("l_orderkey")).alias("k"), F.when(odd, "x").alias("l"), "l_quantity", "l_partkey"
    )


def test_heavy_keys_are_dealt_to_all_tasks(spark, shuffled_joins):
    df = half_null(spark)
    assert df.where("k IS NULL").count() > 0.5 * df.count()
    plain, none = C._members(df, ["k", "l"])
    dealt, heavy = C._members(df, ["k", "l"], heavy_rows=1000)
    assert none == [] and len(heavy) == 1
    assert largest_share(plain) > 0.5 and largest_share(dealt) < 0.45
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))


def test_heavy_keys_change_no_report(spark, monkeypatch):
    df = half_null(spark)
    columns = ["l_quantity", "l_partkey"]
    reports = (
        lambda: C.conflict_detail(df, ["k", "l"], columns, F.col("l_quantity") > 49),
        lambda: C.conflict_rows(df, ["k", "l"]),
        lambda: C.dedupe_analysis(df, ["k", "l"]),
    )
    plain = [sorted(map(str, report().collect())) for report in reports]
    original = C.heavy_keys
    monkeypatch.setattr(C, "heavy_keys", lambda keys, key, **_: original(keys, key, heavy_rows=3))
    assert original(C.duplicate_keys(df, ["k", "l"]), ["k", "l"], heavy_rows=3)
    assert [sorted(map(str, report().collect())) for report in reports] == plain
