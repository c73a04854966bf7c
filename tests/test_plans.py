"""Shapes of physical plans that decide how queries behave at scale."""

import re

from pyspark.sql import functions as F

from scopewise.operators import conflicts as C
from scopewise.operators import metrics as M
from scopewise.operators import ranking as R
from scopewise.operators import summaries as S
from scopewise.operators.quality import rule_report, strict_checks
from scopewise.operators.scoping import stored_scope
from scopewise.plans.bundle import write_fact
from scopewise.queries import bindings as B

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_share_one_sort_and_one_shuffle(small):
    text = plan(M.entity_metrics(small, strategy="window"))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert len(re.findall(r"- Sort ", text)) == 1
    assert "SinglePartition" not in text


def test_top_n_is_cut_before_the_shuffle(small):
    text = plan(R.top_n(small, 10))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_ranks_never_gather_a_scope(spark, fact):
    """A scope with nearly all rows, most of them tied, is dealt by slices and runs inside them."""
    rows = [("HOT", "1", f"E{i}", str(i), i % 3, 0, 0) for i in range(300)] + [("B", "2", "X", "900", 1, 0, 0)]
    text = plan(R.add_ranks(fact(rows)))
    assert "SinglePartition" not in text
    assert "BroadcastHashJoin" in text
    (keys,) = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert "_slice" in keys and "total" in keys


def test_counting_scopes_does_not_read_the_orders(spark):
    sizes = B.entity(spark, SF_DIR).groupBy("scope_name").agg(F.count("*").alias("n"))
    assert "orders.parquet" not in plan(sizes)


def test_scans_read_only_what_is_needed(spark):
    text = plan(S.scope_totals(B.entity(spark, SF_DIR)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any(s.startswith("o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string") for s in schemas)
    assert all("o_totalprice" not in s and "c_acctbal" not in s for s in schemas)
    since = plan(B.entity_since(spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate" in since


def test_row_rules_share_one_pass(spark):
    text = plan(rule_report(B.line_fact(spark, SF_DIR), strict_checks(with_key=False)))
    assert text.count("FileScan") == 1


def test_duplicate_keys_shuffle_keys_and_counts_only(spark):
    text = plan(C.duplicate_keys(B.line_fact(spark, SF_DIR), ["scope_id", "entity_code"]))
    assert "partial_count" in text
    assert "l_returnflag" not in text


def test_small_tables_go_to_the_rows(spark):
    """Offsets, totals and duplicate keys are joined without moving the rows."""
    fact = B.entity(spark, SF_DIR)
    assert "BroadcastHashJoin" in plan(M.add_scope_share(fact))
    lines = B.line_fact(spark, SF_DIR)
    text = plan(C.duplicate_members(lines, ["scope_id", "entity_code"]))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_stored_scope_reads_one_folder(spark, small, tmp_path):
    stored = write_fact(small, str(tmp_path / "fact"))
    text = plan(stored_scope(stored, " gujarat"))
    assert re.search(r"PartitionFilters: \[[^]]*scope_name[^]]*= GUJARAT", text)


def test_no_python_in_the_core(spark, small):
    for df in (
        M.entity_metrics(small), S.executive_summary(small), rule_report(small, strict_checks()),
    ):
        assert "Python" not in plan(df) and "Pandas" not in plan(df)
