import pytest
from pyspark.sql import functions as F
from small_fact import SMALL

from scopewise.operators import metrics as M
from scopewise.operators import quality as Q
from scopewise.operators.registry import registry_messages, registry_violations
from scopewise.operators.summaries import null_profile, value_counts
from scopewise.sources.tables import REGISTRY_COLUMNS
from scopewise.spec import DataQualityError


def basic(spark, rows):
    return spark.createDataFrame(rows, "district string, registrations long")


def checks():
    return Q.basic_checks(["district", "registrations"], ["district"], ["registrations"])


def test_sound_rows_pass(spark):
    Q.enforce(basic(spark, [("A", 1), ("B", 0)]), checks())


@pytest.mark.parametrize(
    ("rows", "message"),
    [
        ([], "no rows"),
        ([("A", None), (None, 2)], "'district' is missing in 1 rows"),
        ([("A", 1), ("A", 2), ("B", 3)], r"Duplicate rows: 2 rows share \(district\)"),
        ([("A", 1), ("B", -1)], "1 negative values"),
    ],
)
def test_first_broken_rule(spark, rows, message):
    with pytest.raises(DataQualityError, match=message):
        Q.enforce(basic(spark, rows), checks())


def test_missing_columns_are_listed_in_order(spark):
    with pytest.raises(DataQualityError, match="Missing required columns: x, y"):
        Q.require_columns(basic(spark, [("A", 1)]), ["x", "district", "y"])


def test_empty_key_is_no_check(spark):
    Q.enforce(basic(spark, [("A", 1), ("A", 1)]), Q.basic_checks())


def test_text_is_not_numeric(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    with pytest.raises(DataQualityError, match="no number in 1 rows"):
        Q.enforce(df, [Q.numeric("v"), Q.nonnegative("v")])


def test_null_key_parts_are_equal(spark):
    df = basic(spark, [(None, 1), (None, 2), ("A", 3)])
    assert Q.count_duplicate_rows(df, ["district"]).first()[0] == 2


def test_strict_suite_order(fact):
    broken = fact([(" ", "24", "A", "1", -1, 0, 0), ("G", "24", "B", "1", 1, 1, 1)], totals=[5, 3])
    messages = Q.broken_rules(broken, Q.strict_checks())
    assert [m.split(".")[0] for m in messages] == [
        "'scope_name' is blank in 1 rows",
        "'micro' has 1 negative values",
        "Duplicate rows: 2 rows share (scope_id, entity_code)",
        "'total' differs from micro + small + medium in 1 rows",
    ]


def test_lenient_suite(raw):
    df = raw(
        [
            ("G", "24", "A", "1", "1", "x", "1", "3"),
            ("G", "24", None, "2", "-1", "1", "1", "1"),
            ("G", "24", " ", "3", "0.5", "1", "1", "2.5"),
            ("G", "24", "D", "4", "1", "1", "1", "4"),
        ]
    )
    assert Q.broken_rules(df, Q.lenient_row_checks()) == [
        "'entity_name' is missing in 1 rows.",
        "'entity_name' is blank in 1 rows.",
        "'medium' has 1 negative values.",
        "'medium' has a fraction in 1 rows.",
        "'micro' is no number in 1 rows.",
        "'total' has a fraction in 1 rows.",
        "'total' must equal micro + small + medium; 1 rows differ.",
    ]


def test_prohibited_and_allowed(spark):
    df = spark.createDataFrame([(1, 2)], "Owner_Name int, total int")
    assert Q.prohibited_columns(df, ["owner_name", "pan"]) == ["Owner_Name"]
    with pytest.raises(DataQualityError, match="Owner_Name"):
        Q.require_no_prohibited(df, ["OWNER_NAME"])
    with pytest.raises(DataQualityError, match="pan"):
        Q.require_allowed(["total", "pan"], df.columns, "fact")


def test_single_scope(fact):
    mixed = fact([*SMALL, ("GOA", "30", "X", "9", 1, 0, 0)])
    with pytest.raises(DataQualityError, match="Gujarat-only"):
        Q.require_single_scope(mixed, "Gujarat")
    with pytest.raises(DataQualityError):
        Q.require_single_scope(mixed.limit(0), "Gujarat")
    Q.require_single_scope(mixed.where("scope_id = '24'"), " gujarat")


@pytest.mark.parametrize(
    ("column", "value", "message"),
    [
        ("micro_share_pct", "101.0D", "above 100"),
        ("micro_share_pct", "-1.0D", "below 0"),
        ("micro_share_pct", "50.0D", "do not add up to 100"),
        ("rank_total", "1L", "rank_total does not"),
        ("rank_total_ascending", "rank_total_ascending + 1", "rank_total_ascending does not"),
        ("dominant_category", "'LARGE'", "unknown label"),
        ("top_10_flag", "false", "Top-10 flags"),
        ("bottom_10_flag", "cast(null as boolean)", "Bottom-10 flags"),
        ("scope_total_share_pct", "scope_total_share_pct / 2", "contributions of a scope"),
    ],
)
def test_metric_rules(small, column, value, message):
    broken = M.entity_metrics(small).withColumn(column, F.expr(value))
    with pytest.raises(DataQualityError, match=message):
        Q.enforce_metrics(broken)


def test_wrong_contributions_that_cancel_out(small):
    swapped = F.when(F.col("entity_name") == "ALPHA", F.col("scope_total_share_pct") + 0.01).when(
        F.col("entity_name") == "BETA", F.col("scope_total_share_pct") - 0.01
    ).otherwise(F.col("scope_total_share_pct"))
    broken = M.entity_metrics(small).withColumn("scope_total_share_pct", swapped)
    with pytest.raises(DataQualityError, match="differs from total"):
        Q.enforce_metrics(broken)


def test_zero_rows_need_zero_shares(small):
    wrong = F.when(F.col("total") == 0, 1.0).otherwise(F.col("micro_share_pct"))
    broken = M.entity_metrics(small).withColumn("micro_share_pct", wrong)
    with pytest.raises(DataQualityError, match="has category shares"):
        Q.enforce_metrics(broken)


def test_profiles(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("a", 1)], "x string, y int")
    assert {tuple(r) for r in null_profile(df, ["x", "y"]).collect()} == {("x", 1), ("y", 2)}
    assert {tuple(r) for r in value_counts(df, "x").collect()} == {("a", 2), (None, 1)}


def registry(spark, *rows):
    base = dict.fromkeys(REGISTRY_COLUMNS, "v") | {"priority": "primary", "status": "approved"}
    data = [tuple((base | row)[c] for c in REGISTRY_COLUMNS) + (i + 2,) for i, row in enumerate(rows)]
    schema = ", ".join(f"{c} string" for c in REGISTRY_COLUMNS) + ", row_no long"
    return spark.createDataFrame(data, schema)


def test_registry_rules(spark):
    df = registry(
        spark,
        {"source_id": "A"},
        {"source_id": " "},
        {"source_id": "A", "priority": "urgent"},
        {"source_id": "B", "licence": "", "access_date": " "},
        {"source_id": "C", "status": "rejected"},
        {"source_id": "D", "status": "unknown", "priority": "optional"},
    )
    found = registry_messages(registry_violations(df, strict=True)).orderBy("rule", "row_no", "key")
    assert [r["message"] for r in found.collect()] == [
        "Row 3 names no source.",
        "Several rows are called A.",
        "B (row 5) was approved without access_date, licence",
        "Unknown priority: urgent",
        "Unknown status: unknown",
        "C is primary but its status is rejected",
    ]
    assert registry_violations(registry(spark, {"source_id": "A"}), strict=True).isEmpty()


def test_every_violation_is_reported(spark):
    ids = spark.range(1500).select(F.col("id").cast("string").alias("source_id"))
    df = registry(spark, {"source_id": "A"}).drop("source_id").crossJoin(ids)
    broken = df.withColumn("licence", F.lit(" "))
    assert registry_messages(registry_violations(broken)).where("rule = 'incomplete_approval'").count() == 1500


def test_empty_scope_needs_exact_zero(fact):
    rows = [("A", "1", "X", "1", 0, 0, 0), ("A", "1", "Y", "2", 0, 0, 0)]
    broken = M.entity_metrics(fact(rows)).withColumn("scope_total_share_pct", F.lit(0.02))
    assert Q.metric_checks_per_scope(broken).first()["contribution_off"] == 1


def test_unknown_fields_are_refused_by_all_measures(small):
    from scopewise.operators import measures as E

    bad = E.FilterContext(outer={"pan": ["x"]})
    metrics = M.entity_metrics(small)
    for measure in (E.measures, E.selected_contribution, E.measure_extremes, E.measure_flags):
        with pytest.raises(DataQualityError, match="pan"):
            measure(metrics, context=bad)
    with pytest.raises(DataQualityError, match="pan"):
        E.tooltip(metrics, bad)


def test_all_keys_in_one_scan(spark, tmp_path):
    rows = [("A", 1, None), ("A", 2, None), (None, 2, "x"), (None, 2, "y"), ("B", 3, "x"), ("B", 3, "x")]
    spark.createDataFrame(rows, "a string, b int, c string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    keys = [("a",), ("b", "a"), ("c",), ("a", "b")]
    checks = [Q.non_empty(), Q.no_nulls("a"), *map(Q.unique, keys), Q.no_nulls("c")]
    report = Q.rule_report(df, checks)
    found = [r["violations"] for r in report.orderBy("ordinal").collect()]
    shared = []
    for key in keys:
        values = [tuple(row["abc".index(c)] for c in key) for row in rows]
        shared.append(sum(values.count(v) for v in set(values) if values.count(v) > 1))
    assert found == [0, 2, *shared, 2]
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    empty = Q.rule_report(df.limit(0), checks).orderBy("ordinal").collect()
    assert [r["violations"] for r in empty] == [1, 0, 0, 0, 0, 0, 0]
