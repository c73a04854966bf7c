"""Ranks, shares, flags, KPIs and ranking views."""

from __future__ import annotations

from pyspark.sql import functions as F

from scopewise.functions.numeric import dominant_category
from scopewise.functions.text import thousands
from scopewise.operators import metrics as M
from scopewise.operators import ranking as R
from scopewise.operators import summaries as S
from scopewise.operators.conflicts import exact_dedupe
from scopewise.operators.scoping import filter_scope
from scopewise.operators.views import ranking_view
from scopewise.queries import bindings as B
from scopewise.queries.registry import query
from scopewise.spec import DEFAULT_SPEC as SPEC

KEY = ("scope_name", "entity_code")


@query(f"WITH {B.ENTITY}, {B.METRICS} SELECT * FROM metrics")
def q_entity_metrics(spark, sf_dir):
    return M.entity_metrics(B.entity(spark, sf_dir))


@query(f"WITH {B.ENTITY_SINCE}, {B.METRICS} SELECT * FROM metrics")
def q_entity_metrics_since(spark, sf_dir):
    return M.entity_metrics(B.entity_since(spark, sf_dir))


@query(f"WITH {B.WORLD}, {B.METRICS} SELECT * FROM metrics")
def q_entity_metrics_one_scope(spark, sf_dir):
    """All entities in one scope, ranked without sorting it in one task."""
    return M.entity_metrics(B.world(spark, sf_dir), strategy="range")


@query(f"WITH {B.ENTITY}, {B.METRICS} SELECT scope_name, entity_code, total, rank_total FROM metrics")
def q_rank_desc(spark, sf_dir):
    return R.add_ranks(B.entity(spark, sf_dir)).select(*KEY, "total", "rank_total")


@query(
    f"WITH {B.ENTITY}, {B.METRICS} "
    "SELECT scope_name, entity_code, total, rank_total_ascending FROM metrics"
)
def q_rank_asc(spark, sf_dir):
    return R.add_ranks(B.entity(spark, sf_dir)).select(*KEY, "total", "rank_total_ascending")


@query(
    f"WITH {B.ENTITY}, {B.METRICS} "
    "SELECT scope_name, entity_code, total, scope_total_share_pct FROM metrics"
)
def q_total_share(spark, sf_dir):
    return M.add_scope_share(B.entity(spark, sf_dir)).select(*KEY, "total", "scope_total_share_pct")


_FLAGS = "scope_name, entity_code, top_10_flag, bottom_10_flag"


@query(
    f"WITH {B.ENTITY}, {B.METRICS}, big AS (SELECT 'entity' AS grain, {_FLAGS} FROM metrics) "
    f"SELECT * FROM big UNION ALL SELECT 'nation', * FROM "
    f"(WITH {B.NATION}, {B.METRICS} SELECT {_FLAGS} FROM metrics)"
)
def q_flags(spark, sf_dir):
    parts = [
        M.entity_metrics(fact).select(F.lit(grain).alias("grain"), *_FLAGS.split(", "))
        for grain, fact in (
            ("entity", B.entity(spark, sf_dir)),
            ("nation", B.nation(spark, sf_dir)),
        )
    ]
    return parts[0].unionByName(parts[1])


_SHARES = ", ".join(f"{B.pct(c, 'total')} AS {c}_share_pct" for c in SPEC.categories)


@query(f"WITH {B.ENTITY_SINCE} SELECT scope_name, entity_code, {_SHARES} FROM entity")
def q_category_shares(spark, sf_dir):
    return M.category_shares(B.entity_since(spark, sf_dir)).select(*KEY, *SPEC.share_cols)


@query(
    f"WITH {B.ENTITY_SINCE}, {B.METRICS} SELECT scope_name, entity_code, dominant_category FROM metrics"
)
def q_dominant_category(spark, sf_dir):
    label = dominant_category(SPEC.categories).alias("dominant_category")
    return B.entity_since(spark, sf_dir).select(*KEY, label)


_BASE = "scope_name, scope_id, entity_name, entity_code, medium, micro, small, total"


@query(f"WITH {B.ENTITY} SELECT {_BASE} FROM entity ORDER BY entity_name, entity_code")
def q_canonical_sort(spark, sf_dir):
    return R.canonical_sort(B.entity(spark, sf_dir))


@query(f"WITH {B.ENTITY} SELECT {_BASE} FROM entity WHERE scope_name = 'ASIA'")
def q_scope_filter(spark, sf_dir):
    return filter_scope(B.entity(spark, sf_dir), " Asia ")


def _end_sql(rank: str) -> str:
    return (
        f"WITH {B.ENTITY}, {B.METRICS} SELECT {_BASE}, CAST({rank} AS INTEGER) AS ranking_position "
        f"FROM metrics WHERE {rank} <= 10"
    )


@query(_end_sql("rank_total"))
def q_top_n(spark, sf_dir):
    return R.top_n(B.entity(spark, sf_dir), 10)


@query(_end_sql("rank_total_ascending"))
def q_bottom_n(spark, sf_dir):
    return R.bottom_n(B.entity(spark, sf_dir), 10)


@query(
    f"WITH {B.ENTITY}, {B.METRICS} "
    "SELECT 'TOP' AS ranking_group, CAST(rank_total AS INTEGER) AS ranking_position, * "
    "FROM metrics WHERE rank_total <= 10 UNION ALL "
    "SELECT 'BOTTOM', CAST(rank_total_ascending AS INTEGER), * "
    "FROM metrics WHERE rank_total_ascending <= 10"
)
def q_ranking_view(spark, sf_dir):
    return ranking_view(M.entity_metrics(B.entity(spark, sf_dir)), 10)


_TOTALS = ", ".join(
    f"CAST(sum({c}) AS BIGINT) AS {c}_total" for c in (*SPEC.categories, SPEC.total)
)


@query(f"WITH {B.ENTITY} SELECT scope_name, {_TOTALS} FROM entity GROUP BY scope_name")
def q_scope_totals(spark, sf_dir):
    return S.scope_totals(B.entity(spark, sf_dir))


@query(
    f"WITH {B.ENTITY} SELECT scope_name, count(*) AS row_count, "
    "count(DISTINCT entity_code) AS entity_count FROM entity GROUP BY scope_name"
)
def q_entity_counts(spark, sf_dir):
    return S.entity_counts(B.entity(spark, sf_dir))


@query(
    f"WITH {B.ENTITY} SELECT scope_name, count(*) AS row_count, "
    f"count(DISTINCT entity_code) AS entity_count, {_TOTALS} FROM entity GROUP BY scope_name"
)
def q_dataset_summary(spark, sf_dir):
    return S.dataset_summary(B.entity(spark, sf_dir))


_KPI_SHARES = ", ".join(
    f"{B.kpi_pct(f'sum({c})', 'sum(total)')} AS {c}_share_pct" for c in SPEC.categories
)
_AVERAGE = B.exact_round("CAST(sum(total) AS DOUBLE) / CAST(count(*) AS DOUBLE)", 2)
_EXTREMES = ", ".join(
    f"first({col} ORDER BY {order}) AS {side}_{col}"
    for side, order in (
        ("highest", "total DESC, entity_name, entity_code"),
        ("lowest", "total, entity_name, entity_code"),
    )
    for col in ("entity_name", "entity_code", "total")
)


_DEFINITIONS = "\n".join(f"{name}: {text}" for name, text in sorted(S.kpi_definitions().items()))


@query(f"WITH {B.ENTITY} SELECT scope_name, {_KPI_SHARES} FROM entity GROUP BY scope_name")
def q_kpi_shares(spark, sf_dir):
    return S.kpi_shares(B.entity(spark, sf_dir))


@query(
    f"WITH {B.ENTITY} SELECT scope_name, {_AVERAGE} AS average_per_entity FROM entity GROUP BY scope_name"
)
def q_kpi_average(spark, sf_dir):
    return S.kpi_averages(B.entity(spark, sf_dir))


@query(f"WITH {B.ENTITY} SELECT scope_name, {_EXTREMES} FROM entity GROUP BY scope_name")
def q_kpi_extremes(spark, sf_dir):
    return S.kpi_extremes(B.entity(spark, sf_dir))


@query(
    f"WITH {B.ENTITY} SELECT scope_name, count(*) AS entity_count, {_TOTALS}, {_KPI_SHARES}, "
    f"{_AVERAGE} AS average_per_entity, {_EXTREMES}, '{_DEFINITIONS}' AS definitions, "
    f"'{S.INTERPRETATION_WARNING}' AS interpretation_warning FROM entity GROUP BY scope_name"
)
def q_executive_summary(spark, sf_dir):
    """All KPIs with their definitions, these as one line each."""
    found = S.documented_summary(B.entity(spark, sf_dir))
    entries = F.array_sort(F.map_entries("definitions"))
    lines = F.transform(entries, lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return found.withColumn("definitions", F.array_join(lines, "\n"))


@query(
    f"WITH {B.ENTITY_SINCE}, {B.METRICS} SELECT scope_name, "
    + B.exact_round("avg(micro_share_pct + small_share_pct + medium_share_pct)", 4)
    + " AS mean_share_sum FROM metrics GROUP BY scope_name"
)
def q_mean_share_sum(spark, sf_dir):
    return S.mean_share_sum(M.category_shares(B.entity_since(spark, sf_dir)))


@query(
    f"WITH {B.ENTITY} SELECT scope_name, format('{{:,}}', sum(total)::BIGINT) AS total_text, "
    "format('{:,}', sum(micro)::BIGINT) AS micro_text FROM entity GROUP BY scope_name"
)
def q_format_totals(spark, sf_dir):
    totals = S.scope_totals(B.entity(spark, sf_dir))
    return totals.select(
        "scope_name",
        thousands(F.col("total_total")).alias("total_text"),
        thousands(F.col("micro_total")).alias("micro_text"),
    )


@query(
    f"WITH {B.LINES} SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, "
    "count(*) AS copies FROM line GROUP BY ALL"
)
def q_exact_dedupe(spark, sf_dir):
    return exact_dedupe(B.line_key(spark, sf_dir))
