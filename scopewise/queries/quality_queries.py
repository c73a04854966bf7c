"""Quality rules, profiles, parsing and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from scopewise.functions import numeric as N
from scopewise.functions import text as X
from scopewise.operators import quality as Q
from scopewise.operators import summaries as S
from scopewise.operators.metrics import entity_metrics
from scopewise.operators.ranking import add_position
from scopewise.operators.reconcile import qualification_decision, values_outside
from scopewise.operators.registry import RegistrySpec, approved_sources, registry_violations, unapproved_primaries
from scopewise.operators.scoping import filter_scope
from scopewise.queries import bindings as B
from scopewise.queries.registry import query
from scopewise.spec import DEFAULT_SPEC as SPEC


def report_sql(source: str, checks: list[tuple[str, str, str]]) -> str:
    """SQL of a rule report: (rule, subject, count expression) per line."""
    counts = ", ".join(f"{count} AS c{i}" for i, (_, _, count) in enumerate(checks, 1))
    lines = " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{rule}' AS rule, '{subject}' AS subject, "
        f"CAST(c{i} AS BIGINT) AS violations FROM r"
        for i, (rule, subject, _) in enumerate(checks, 1)
    )
    return f"{source}, r AS (SELECT {counts} FROM t) {lines}"


def broken(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


_NON_EMPTY = ("non_empty", "*", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END")
_STRICT = [
    _NON_EMPTY,
    *[("not_blank", c, broken(f"trim(coalesce({c}, '')) = ''")) for c in SPEC.text_cols],
    *[
        line
        for c in SPEC.count_cols
        for line in (
            ("numeric", c, broken(f"{c} IS NULL")),
            ("nonnegative", c, broken(f"{c} < 0")),
        )
    ],
    (
        "unique",
        "scope_id, entity_code",
        "(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM t "
        "GROUP BY scope_id, entity_code) WHERE n > 1)",
    ),
    ("sum_identity", "total", broken("total <> micro + small + medium")),
]


@query(report_sql(f"WITH {B.ENTITY}, {B.DAMAGED_FACT}", _STRICT))
def q_rule_report(spark, sf_dir):
    """The strict suite on a fact that breaks each of its rules."""
    return Q.rule_report(B.damaged_fact(spark, sf_dir), Q.strict_checks())


_BASIC = [
    _NON_EMPTY,
    ("no_nulls", "entity_name", broken("entity_name IS NULL")),
    ("no_nulls", "medium", broken("medium IS NULL")),
    (
        "unique",
        "entity_name",
        "(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM t GROUP BY entity_name) WHERE n > 1)",
    ),
    ("numeric", "scope_name", broken("TRY_CAST(scope_name AS DOUBLE) IS NULL")),
    ("nonnegative", "scope_name", "0"),
    ("numeric", "micro", "0"),
    ("nonnegative", "micro", broken("micro < 0")),
]


@query(report_sql(f"WITH {B.ENTITY}, {B.DAMAGED_FACT}", _BASIC))
def q_basic_checks(spark, sf_dir):
    """The basic suite: rows, nulls, a key, numbers."""
    checks = Q.basic_checks(["entity_name", "medium"], ["entity_name"], ["scope_name", "micro"])
    return Q.rule_report(B.damaged_fact(spark, sf_dir), checks)


_SHARED = "(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM t GROUP BY {}) WHERE n > 1)"
_LINE_KEYS = (("l_orderkey", "l_linenumber"), ("l_orderkey",), ("l_returnflag", "l_linestatus", "l_linenumber"))


@query(
    report_sql(
        f"WITH {B.LINES}, t AS (SELECT * FROM line)",
        [
            _NON_EMPTY,
            ("no_nulls", "l_linenumber", broken("l_linenumber IS NULL")),
            *[("unique", ", ".join(key), _SHARED.format(", ".join(key))) for key in _LINE_KEYS],
        ],
    )
)
def q_unique_keys(spark, sf_dir):
    """Three keys of the line items, judged in one scan and one shuffle."""
    checks = Q.basic_checks(["l_linenumber"], _LINE_KEYS[0], further_keys=_LINE_KEYS[1:])
    return Q.rule_report(B.line_key(spark, sf_dir), checks)


def _lenient_sql() -> str:
    source = """WITH t AS (SELECT l_returnflag AS scope_name, l_linestatus AS scope_id,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS entity_name,
  CASE WHEN l_linenumber = 7 THEN chr(160) ELSE CAST(l_linenumber AS VARCHAR) END AS entity_code,
  CASE WHEN l_linestatus = 'F' THEN l_discount END AS medium, l_quantity AS micro,
  l_linenumber - 2.0 AS small, l_quantity + l_linenumber - 2.0 AS total FROM lineitem)"""
    checks = [_NON_EMPTY]
    for c in SPEC.text_cols:
        blank = f"trim({c}) IN ('', chr(160))"
        checks += [("null_text", c, broken(f"{c} IS NULL")), ("blank_text", c, broken(blank))]
    for c in SPEC.count_cols:
        checks += [
            ("nonnumeric", c, broken(f"{c} IS NULL")),
            ("negative", c, broken(f"{c} < 0")),
            ("fractional", c, broken(f"{c} <> floor({c})")),
        ]
    whole = " AND ".join(f"{c} = floor({c})" for c in SPEC.count_cols)
    checks.append(("sum_identity", "total", broken(f"{whole} AND total <> micro + small + medium")))
    return report_sql(source, checks)


@query(_lenient_sql())
def q_rule_report_lenient(spark, sf_dir):
    number = F.col("l_linenumber")
    lines = B.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("scope_name"),
        F.col("l_linestatus").alias("scope_id"),
        F.when(F.col("l_returnflag") != "N", F.col("l_orderkey").cast("string")).alias("entity_name"),
        F.when(number == 7, F.lit(" ")).otherwise(number.cast("string")).alias("entity_code"),
        F.when(F.col("l_linestatus") == "F", F.col("l_discount").cast("string"))
        .otherwise(F.lit("n/a"))
        .alias("medium"),
        F.col("l_quantity").cast("string").alias("micro"),
        (number - 2.0).cast("string").alias("small"),
        (F.col("l_quantity") + number - 2.0).cast("string").alias("total"),
    )
    return Q.rule_report(lines, Q.lenient_row_checks())


_CLASSED = {
    "quantity": "CAST(l_quantity AS VARCHAR)",
    "discount": "CAST(l_discount AS VARCHAR)",
    "margin": "CAST(l_quantity - 25 AS VARCHAR)",
    "flag": "CASE WHEN l_returnflag = 'A' THEN 'n/a' ELSE CAST(l_linenumber AS VARCHAR) END",
}


def _classes_sql() -> str:
    cols = ", ".join(f"{sql} AS {name}" for name, sql in _CLASSED.items())
    checks = []
    for name in _CLASSED:
        number = f"TRY_CAST({name} AS DOUBLE)"
        checks += [
            ("nonnumeric", name, broken(f"{number} IS NULL")),
            ("negative", name, broken(f"{number} < 0")),
            ("fractional", name, broken(f"{number} <> floor({number})")),
        ]
    return report_sql(f"WITH t AS (SELECT {cols} FROM lineitem)", checks)


@query(_classes_sql())
def q_numeric_classes(spark, sf_dir):
    lines = B.table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").cast("string").alias("quantity"),
        F.col("l_discount").cast("string").alias("discount"),
        (F.col("l_quantity") - 25).cast("string").alias("margin"),
        F.when(F.col("l_returnflag") == "A", F.lit("n/a"))
        .otherwise(F.col("l_linenumber").cast("string"))
        .alias("flag"),
    )
    checks = [
        check
        for name in _CLASSED
        for check in Q.numeric_class_checks(name, F.col(f"_number_{name}"))
    ]
    return Q.rule_report(lines, Q.Suite(tuple(checks), Q.numeric_helpers(tuple(_CLASSED))))


@query("""SELECT o_orderkey,
  o_orderpriority <> '5-LOW' AS is_numeric,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '4-NOT SPECIFIED'
    THEN o_totalprice <> floor(o_totalprice) ELSE false END AS is_fractional,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN o_orderkey
    WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_totalprice = floor(o_totalprice)
    THEN CAST(o_totalprice AS BIGINT) END AS whole_value FROM orders""")
def q_parse_counts(spark, sf_dir):
    """Every order number or price in one of five spellings, parsed back."""
    key = F.col("o_orderkey").cast("string")
    spelled = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("  "), key, F.lit("\t")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("+"), key))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(key, F.lit(".0")))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("1,"), key))
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", spelled.alias("spelled"))
    number = N.parse_number(F.col("spelled"))
    return orders.select(
        "o_orderkey",
        number.isNotNull().alias("is_numeric"),
        N.is_fractional(number).alias("is_fractional"),
        N.parse_count(F.col("spelled")).alias("whole_value"),
    )


_SPACE = r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query(
    "SELECT conv_id, turn, regexp_replace(chr(160) || chr(9) || \"text\" || chr(12288) || chr(31), "
    f"'^{_SPACE}+|{_SPACE}+$', '', 'g') AS \"text\" FROM conversations"
)
def q_trim_text(spark, sf_dir):
    padded = F.concat(F.lit(" \t"), F.col("text"), F.lit("　\x1f"))
    return B.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", X.strip_text(padded).alias("text")
    )


@query(
    "SELECT 'text' AS column_name, count(*) FILTER (WHERE trim(coalesce(\"text\", '')) = '') AS blanks "
    "FROM conversations UNION ALL "
    "SELECT 'other_role', count(*) FILTER (WHERE coalesce(nullif(role, 'user'), '') = '') FROM conversations "
    "UNION ALL SELECT 'first_turn', count(*) FILTER (WHERE turn = 0) FROM conversations"
)
def q_blank_counts(spark, sf_dir):
    first = F.when(F.col("turn") == 0, F.lit(" \t ")).otherwise(F.col("text"))
    return S.blank_profile(
        B.table(spark, sf_dir, "conversations"),
        {
            "text": X.is_blank(F.col("text")),
            "other_role": X.is_blank(F.nullif(F.col("role"), F.lit("user"))),
            "first_turn": X.is_blank(first),
        },
    )


@query(
    f"WITH {B.ENTITY} SELECT scope_name, count(*) AS \"rows\", "
    "count(*) FILTER (WHERE total <> micro + small + medium) AS wrong_totals, "
    "count(*) FILTER (WHERE total <> micro + small) AS without_medium FROM entity GROUP BY scope_name"
)
def q_sum_identity(spark, sf_dir):
    return (
        B.entity(spark, sf_dir)
        .groupBy("scope_name")
        .agg(
            F.count("*").alias("rows"),
            Q.violations(F.col("total") != N.row_sum(SPEC.categories)).alias("wrong_totals"),
            Q.violations(F.col("total") != N.row_sum(["micro", "small"])).alias("without_medium"),
        )
    )


@query(
    f"WITH {B.ENTITY} SELECT 'all' AS part, count(*) AS \"rows\", "
    "count(*) FILTER (WHERE scope_name <> 'ASIA') AS other_scope_rows, "
    "bool_and(scope_name = 'ASIA') AS single_scope FROM entity UNION ALL "
    "SELECT 'scoped', count(*), 0, count(*) > 0 FROM entity WHERE scope_name = 'ASIA'"
)
def q_single_scope(spark, sf_dir):
    fact = B.entity(spark, sf_dir)
    parts = [
        Q.single_scope(df, "Asia").select(F.lit(part).alias("part"), "*")
        for part, df in (("all", fact), ("scoped", filter_scope(fact, "asia")))
    ]
    return parts[0].unionByName(parts[1])


_RANK_DOMAIN = " UNION ALL ".join(
    f"SELECT scope_name, '{r}' AS rank_column, count(*) AS \"rows\", "
    f"min({r}) = 1 AND max({r}) = count(*) AND count(DISTINCT {r}) = count(*) AS complete "
    "FROM damaged GROUP BY scope_name"
    for r in ("rank_total", "rank_total_ascending")
)


_DAMAGED = f"WITH {B.ENTITY}, {B.METRICS}, {B.DAMAGED_METRICS}"


def _damaged(spark, sf_dir):
    return B.damaged_metrics(entity_metrics(B.entity(spark, sf_dir)))


@query(f"{_DAMAGED} {_RANK_DOMAIN}")
def q_rank_domain(spark, sf_dir):
    return Q.rank_domain(_damaged(spark, sf_dir))


def _scope_rules(metrics, *columns):
    return Q.metric_checks_per_scope(metrics).select("scope_name", "rows", *columns)


_BOUNDS = [f"{side}_{p}" for p in SPEC.pct_cols for side in ("negative", "above_100")]


@query(
    f"{_DAMAGED} SELECT scope_name, count(*) AS \"rows\", "
    + ", ".join(
        f"count(*) FILTER (WHERE {p} < 0 OR {p} IS NULL) AS negative_{p}, "
        f"count(*) FILTER (WHERE {p} > 100) AS above_100_{p}"
        for p in SPEC.pct_cols
    )
    + " FROM damaged GROUP BY scope_name"
)
def q_pct_bounds(spark, sf_dir):
    return _scope_rules(_damaged(spark, sf_dir), *_BOUNDS)


_SHARE_SUM = "(micro_share_pct + small_share_pct + medium_share_pct)"


@query(
    f"{_DAMAGED} SELECT scope_name, count(*) AS \"rows\", "
    f"count(*) FILTER (WHERE total > 0 AND abs({_SHARE_SUM} - 100) > 0.01) AS share_sum_off, "
    f"count(*) FILTER (WHERE total = 0 AND abs({_SHARE_SUM}) > 0.01) AS zero_row_shares "
    "FROM damaged GROUP BY scope_name"
)
def q_share_sum(spark, sf_dir):
    return _scope_rules(_damaged(spark, sf_dir), "share_sum_off", "zero_row_shares")


@query(
    f"{_DAMAGED}, s AS (SELECT scope_name, count(*) AS n, sum(total) AS whole, "
    "sum(scope_total_share_pct) AS s FROM damaged GROUP BY scope_name) "
    "SELECT scope_name, n AS \"rows\", round_even(s * 100e0, 0) / 100e0 AS share_sum, "
    "CAST(abs(s - CASE WHEN whole = 0 THEN 0 ELSE 100 END) > "
    "CASE WHEN whole = 0 THEN 0.01 ELSE greatest(0.05, n * 5e-5) END AS BIGINT) AS contribution_off FROM s"
)
def q_contribution_sum(spark, sf_dir):
    return _damaged(spark, sf_dir).groupBy("scope_name").agg(
        F.count("*").alias("rows"),
        N.round_column(F.sum("scope_total_share_pct"), 2).alias("share_sum"),
        Q.contribution_off().cast("bigint").alias("contribution_off"),
    )


@query(
    f"{_DAMAGED}, t AS (SELECT *, sum(total) OVER (PARTITION BY scope_name) AS whole "
    "FROM damaged) SELECT scope_name, count(*) AS \"rows\", count(*) FILTER (WHERE abs("
    "scope_total_share_pct - CASE WHEN whole = 0 THEN 0 ELSE CAST(total AS DOUBLE) / CAST(whole AS DOUBLE) * 100 END)"
    " > 1e-4) AS share_value_off FROM t GROUP BY scope_name"
)
def q_contribution_values(spark, sf_dir):
    return Q.contribution_values(_damaged(spark, sf_dir))


@query(
    f"{_DAMAGED} SELECT scope_name, count(*) AS \"rows\", "
    "count(*) FILTER (WHERE top_10_flag IS DISTINCT FROM (rank_total <= 10)) AS bad_top_flag, "
    "count(*) FILTER (WHERE bottom_10_flag IS DISTINCT FROM (rank_total_ascending <= 10)) AS bad_bottom_flag, "
    f"count(*) FILTER (WHERE dominant_category NOT IN {SPEC.dominant_labels}) AS bad_category "
    "FROM damaged GROUP BY scope_name"
)
def q_flag_consistency(spark, sf_dir):
    """Flags against ranks, and category labels against their list."""
    return _scope_rules(_damaged(spark, sf_dir), "bad_top_flag", "bad_bottom_flag", "bad_category")


@query(
    "SELECT 'o_orderpriority' AS column_name, count(*) AS nulls FROM orders "
    "WHERE o_orderpriority = '5-LOW' HAVING count(*) > 0 UNION ALL "
    "SELECT 'o_orderstatus', count(*) FROM orders WHERE o_orderstatus = 'P' HAVING count(*) > 0"
)
def q_null_profile(spark, sf_dir):
    holed = B.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
    )
    return S.null_profile(holed, holed.columns)


@query("SELECT nullif(o_orderpriority, '5-LOW') AS priority, count(*) AS \"rows\" FROM orders GROUP BY 1")
def q_value_counts(spark, sf_dir):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority")
    return S.value_counts(B.table(spark, sf_dir, "orders").select(priority), "priority")


_ALLOWED = ("1-URGENT", "2-HIGH", "3-MEDIUM")


@query(
    "SELECT DISTINCT nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority FROM orders "
    f"WHERE coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), '') NOT IN {_ALLOWED}"
)
def q_enum_outliers(spark, sf_dir):
    """Values outside a list; null is outside of every list."""
    priority = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("o_orderpriority")
    return values_outside(B.table(spark, sf_dir, "orders").select(priority), "o_orderpriority", _ALLOWED)


_REGISTRY = RegistrySpec(
    source_id="source_id",
    priority="o_orderpriority",
    status="o_orderstatus",
    priorities=_ALLOWED,
    statuses=("F", "O"),
    primary="1-URGENT",
    approved="F",
    approval_fields=("publisher", "licence"),
)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def q_filter_enum(spark, sf_dir):
    return approved_sources(B.table(spark, sf_dir, "orders"), _REGISTRY).select("o_orderkey", "o_orderstatus")


@query(
    "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders "
    "WHERE o_orderpriority = '1-URGENT' AND NOT o_orderstatus = 'F'"
)
def q_filter_negation(spark, sf_dir):
    return unapproved_primaries(B.table(spark, sf_dir, "orders"), _REGISTRY).select(
        "o_orderkey", "o_orderpriority", "o_orderstatus"
    )


@query(f"""WITH t AS (SELECT o_orderpriority, o_orderstatus,
  CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN ' '
    ELSE CAST(o_custkey AS VARCHAR) END AS source_id,
  row_number() OVER (ORDER BY o_orderkey) + 1 AS row_no,
  CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'p' END AS publisher,
  CASE WHEN o_totalprice < 100000 THEN ' ' ELSE 'l' END AS licence FROM orders)
SELECT 'blank_id' AS rule, row_no, source_id AS "key", '' AS detail FROM t WHERE trim(source_id) = ''
UNION ALL SELECT 'duplicate_id', 0, source_id, '' FROM t GROUP BY source_id HAVING count(*) > 1
UNION ALL SELECT DISTINCT 'invalid_priority', 0, o_orderpriority, '' FROM t
  WHERE o_orderpriority NOT IN {_ALLOWED}
UNION ALL SELECT DISTINCT 'invalid_status', 0, o_orderstatus, '' FROM t
  WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'incomplete_approval', row_no, source_id, concat_ws(', ',
    CASE WHEN trim(publisher) = '' THEN 'publisher' END,
    CASE WHEN trim(licence) = '' THEN 'licence' END) FROM t
  WHERE o_orderstatus = 'F' AND (trim(publisher) = '' OR trim(licence) = '')
UNION ALL SELECT 'unapproved_primary', row_no, source_id, o_orderstatus FROM t
  WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F'""")
def q_collect_all_rules(spark, sf_dir):
    blank = (F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_orderstatus") == "P")
    orders = B.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        "o_orderstatus",
        F.when(blank, F.lit(" ")).otherwise(F.col("o_custkey").cast("string")).alias("source_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.lit("p")).alias("publisher"),
        F.when(F.col("o_totalprice") < 100000, F.lit(" ")).otherwise(F.lit("l")).alias("licence"),
    )
    numbered = add_position(orders, ["o_orderkey"]).withColumn("row_no", F.col("position") + 1)
    return registry_violations(numbered, _REGISTRY, strict=True)


@query(
    "SELECT column_name FROM (VALUES ('C_PHONE'), (' c_address ')) AS v(column_name) WHERE EXISTS (FROM customer)"
)
def q_prohibited_columns(spark, sf_dir):
    """Columns of a table that must not be published, whatever their spelling."""
    customers = B.table(spark, sf_dir, "customer")
    spelled = customers.select(
        "c_custkey", F.col("c_name").alias("C_PHONE"), F.col("c_mktsegment").alias(" c_address "), "c_nationkey"
    )
    found = Q.prohibited_columns(spelled, ["c_phone", "C_ADDRESS", "c_comment"])
    names = F.explode(F.array(*[F.lit(name) for name in found])).alias("column_name")
    return spelled.select(names).distinct()


@query(
    "SELECT f.field, f.allowed, count(*) AS \"rows\" FROM orders, "
    "(VALUES ('o_orderkey', true), ('o_custkey', true), ('o_comment', false), ('pan', false)) AS f(field, allowed) "
    "GROUP BY ALL"
)
def q_allow_list(spark, sf_dir):
    """Requested fields of a dataset against those it offers."""
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    requested = ["o_orderkey", "o_custkey", "o_comment", "pan"]
    outside = Q.not_allowed(requested, orders.columns)
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(f not in outside).alias("allowed")) for f in requested])
    return orders.select(F.inline(fields)).groupBy("field", "allowed").agg(F.count("*").alias("rows"))


@query(
    "SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing_qualification' "
    "WHEN quality <> 1 THEN 'status' WHEN toxic <> 0 THEN 'privacy' ELSE 'approved' END AS decision "
    "FROM documents d LEFT JOIN labels l USING (doc_id)"
)
def q_gate_decision(spark, sf_dir):
    return qualification_decision(
        B.table(spark, sf_dir, "documents"),
        B.table(spark, sf_dir, "labels"),
        "doc_id",
        F.col("quality") == 1,
        F.col("toxic") == 0,
    )


@query(
    "SELECT event_type, count(*) AS events, count(*) FILTER (WHERE contains(lower(props), '\"k\"')) "
    "AS mentions FROM events GROUP BY event_type"
)
def q_prohibited_tokens(spark, sf_dir):
    return (
        B.table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(
            F.count("*").alias("events"),
            F.count_if(X.mentions_name(F.col("props"), "K")).alias("mentions"),
        )
    )
