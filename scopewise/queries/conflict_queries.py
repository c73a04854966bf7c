"""Duplicate keys and scope qualification on line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from scopewise.operators import conflicts as C
from scopewise.operators import scoping
from scopewise.operators.quality import count_duplicate_rows
from scopewise.operators.summaries import source_profile
from scopewise.queries import bindings as B
from scopewise.queries.registry import query


def _in_scope():
    return F.col("l_returnflag") == "R"


_DISTINCT_ROWS = (
    "copies AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, count(*) AS n "
    "FROM line GROUP BY ALL)"
)
_SAME = "{0}.l_orderkey IS NOT DISTINCT FROM {1}.l_orderkey AND {0}.l_linenumber IS NOT DISTINCT FROM {1}.l_linenumber"


def _differs(column: str) -> str:
    return f"count(DISTINCT {column}) + CAST(bool_or({column} IS NULL) AS INT) > 1"


_GROUPS = (
    "grouped AS (SELECT l_orderkey, l_linenumber, CAST(sum(n) AS BIGINT) AS row_count, "
    "count(*) AS distinct_full_row_count, bool_or(l_returnflag = 'R') AS contains_scope, "
    "concat_ws(' | ', "
    + ", ".join(f"CASE WHEN {_differs(c)} THEN '{c}' END" for c in ("l_returnflag", "l_linestatus"))
    + ") AS changing_columns FROM copies GROUP BY l_orderkey, l_linenumber HAVING sum(n) > 1)"
)
_VALUES = "long AS (" + " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{c}' AS \"column\", {c} AS \"value\", CAST(sum(n) AS BIGINT) AS \"rows\" "
    f"FROM copies GROUP BY l_orderkey, l_linenumber, {c}"
    for c in ("l_returnflag", "l_linestatus")
) + ")"
_WITH_GROUPS = f"WITH {B.LINES}, {_DISTINCT_ROWS}, {_GROUPS}"
_WITH_VALUES = f"{_WITH_GROUPS}, {_VALUES}"
_EACH_VALUE = f"FROM grouped g JOIN long v ON {_SAME.format('g', 'v')}"


@query(
    f"{_WITH_VALUES} SELECT g.l_orderkey, g.l_linenumber, row_count, distinct_full_row_count > 1 AS conflicting, "
    f'contains_scope, v."column", v."value", v."rows" {_EACH_VALUE}'
)
def q_key_conflicts(spark, sf_dir):
    """Verdicts and names, with keys and names partly null."""
    return C.key_conflicts(B.line_key(spark, sf_dir), B.LINE_KEY, _in_scope(), B.LINE_SPEC)


@query(
    f"{_WITH_VALUES} SELECT g.l_orderkey, g.l_linenumber, row_count, distinct_full_row_count, "
    "distinct_full_row_count = 1 AS exact_duplicate_group, "
    "distinct_full_row_count > 1 AS conflicting_group, changing_columns, contains_scope, "
    f'v."column", v."value", v."rows" {_EACH_VALUE}'
)
def q_conflict_detail(spark, sf_dir):
    columns = ("l_returnflag", "l_linestatus")
    return C.conflict_detail(B.line_key(spark, sf_dir), B.LINE_KEY, columns, _in_scope())


@query(
    f'{_WITH_VALUES} SELECT v.* FROM long v JOIN grouped g ON {_SAME.format("v", "g")}'
)
def q_conflict_values(spark, sf_dir):
    """The values alone."""
    members = C.duplicate_members(B.line_key(spark, sf_dir), B.LINE_KEY)
    return C.conflict_values(members, B.LINE_KEY, ("l_returnflag", "l_linestatus"))


@query(
    f"{_WITH_GROUPS} SELECT line.* FROM line JOIN grouped ON {_SAME.format('line', 'grouped')} "
    "WHERE distinct_full_row_count > 1"
)
def q_conflict_rows(spark, sf_dir):
    return C.conflict_rows(B.line_key(spark, sf_dir), B.LINE_KEY)


@query(
    f"WITH {B.LINES}, {_DISTINCT_ROWS}, k AS (SELECT sum(n) AS r, count(*) AS d FROM copies "
    "GROUP BY l_orderkey, l_linenumber) SELECT CAST(sum(r) AS BIGINT) AS source_rows, "
    "count(*) FILTER (WHERE r > 1) AS duplicate_groups, "
    "CAST(coalesce(sum(r) FILTER (WHERE r > 1), 0) AS BIGINT) AS duplicate_rows, "
    "count(*) FILTER (WHERE d > 1) AS conflicting_groups, "
    "CAST(coalesce(sum(r) FILTER (WHERE d > 1), 0) AS BIGINT) AS conflicting_rows, "
    "count(*) FILTER (WHERE r > 1 AND d = 1) AS exact_groups, "
    "CAST(coalesce(sum(r) FILTER (WHERE r > 1 AND d = 1), 0) AS BIGINT) AS exact_rows, "
    "CAST(sum(d) AS BIGINT) AS rows_after_dedupe, "
    "CAST(coalesce(sum(d) FILTER (WHERE d > 1), 0) AS BIGINT) AS remaining_duplicate_rows, "
    "coalesce(sum(d) FILTER (WHERE d > 1), 0) = 0 AS dedupe_resolves_all FROM k"
)
def q_dedupe_test(spark, sf_dir):
    return C.dedupe_analysis(B.line_key(spark, sf_dir), B.LINE_KEY)


@query(
    f"WITH {B.LINES}, g AS (SELECT count(*) AS n FROM line GROUP BY l_orderkey, l_linenumber) "
    "SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows FROM g WHERE n > 1"
)
def q_duplicate_rows(spark, sf_dir):
    return count_duplicate_rows(B.line_key(spark, sf_dir), B.LINE_KEY)


@query(
    "SELECT count(*) AS row_count, count(DISTINCT l_returnflag) AS scope_count, "
    "count(DISTINCT l_orderkey) AS code_count FROM lineitem"
)
def q_source_profile(spark, sf_dir):
    return source_profile(B.table(spark, sf_dir, "lineitem"), "l_returnflag", "l_orderkey")


_QUALIFY = """WITH line AS (SELECT CASE WHEN l_suppkey % 10 <> 3 THEN l_orderkey END AS l_orderkey,
  nullif(l_linenumber, 7) AS l_linenumber, nullif(l_returnflag, 'A') AS l_returnflag,
  l_linestatus, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem),
copies AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, quantity, count(*) AS n
  FROM line GROUP BY ALL),
bad AS (SELECT l_orderkey, l_linenumber, sum(n) AS n FROM copies
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1),
touched AS (SELECT l_returnflag, count(DISTINCT (line.l_orderkey, line.l_linenumber)) AS g
  FROM line JOIN bad ON line.l_orderkey IS NOT DISTINCT FROM bad.l_orderkey
    AND line.l_linenumber IS NOT DISTINCT FROM bad.l_linenumber GROUP BY l_returnflag),
repeats AS (SELECT l_returnflag, sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS r FROM (
  SELECT l_returnflag, l_orderkey, l_linenumber, count(*) AS n FROM line GROUP BY ALL)
  GROUP BY l_returnflag),
scopes AS (SELECT l_returnflag, count(*) AS scope_rows,
  count(DISTINCT l_linenumber) AS scope_entities, sum(quantity) AS scope_total
  FROM line GROUP BY l_returnflag)
SELECT scopes.l_returnflag, (SELECT count(*) FROM line) AS national_rows,
  (SELECT count(*) FROM bad) AS national_conflicting_groups,
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM bad) AS national_conflicting_rows,
  scope_rows, scope_entities, coalesce(g, 0) AS scope_conflicting_groups,
  CAST(r AS BIGINT) AS scope_duplicate_rows, CAST(scope_total AS BIGINT) AS scope_total,
  coalesce(g, 0) = 0 AS qualified, r = 0 AS unique_in_scope
FROM scopes LEFT JOIN touched ON scopes.l_returnflag IS NOT DISTINCT FROM touched.l_returnflag
JOIN repeats ON scopes.l_returnflag IS NOT DISTINCT FROM repeats.l_returnflag"""


@query(_QUALIFY)
def q_scope_qualification(spark, sf_dir):
    lines = B.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_suppkey") % 10 != 3, F.col("l_orderkey")).alias("l_orderkey"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("l_linenumber"),
        F.nullif(F.col("l_returnflag"), F.lit("A")).alias("l_returnflag"),
        "l_linestatus",
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    return C.scope_qualification(lines, B.LINE_KEY, "l_returnflag", "l_linenumber", "quantity")


@query(
    "WITH g AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_linenumber = 6) + "
    "2 * count(*) FILTER (WHERE CAST(l_quantity AS BIGINT) = 50) AS b FROM lineitem GROUP BY l_orderkey, l_linenumber), "
    "v AS (SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) + sum(b) AS BIGINT) AS violations FROM g) "
    "SELECT l_returnflag AS scope_name, count(*) AS scope_rows, "
    "(SELECT violations FROM v) AS violations, (SELECT violations FROM v) = 0 AS accepted "
    "FROM lineitem GROUP BY l_returnflag"
)
def q_validate_then_filter(spark, sf_dir):
    return scoping.scopes_after_full_check(B.damaged_lines(spark, sf_dir))


@query(
    "WITH g AS (SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE l_linenumber = 6) + "
    "2 * count(*) FILTER (WHERE CAST(l_quantity AS BIGINT) = 50) AS b FROM lineitem "
    "GROUP BY l_returnflag, l_orderkey, l_linenumber) "
    "SELECT l_returnflag AS scope_name, CAST(sum(n) AS BIGINT) AS scope_rows, "
    "CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows, "
    "(SELECT CAST(sum(b) AS BIGINT) FROM g) AS row_violations, (SELECT sum(b) FROM g) = 0 "
    "AND coalesce(sum(n) FILTER (WHERE n > 1), 0) = 0 AS accepted FROM g GROUP BY l_returnflag"
)
def q_filter_then_validate(spark, sf_dir):
    return scoping.scopes_after_scoped_check(B.damaged_lines(spark, sf_dir))
