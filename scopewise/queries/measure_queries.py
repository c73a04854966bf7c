"""Measures, page queries and filter contexts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scopewise.operators import contexts as C
from scopewise.operators import measures as E
from scopewise.operators import pages as P
from scopewise.operators.metrics import category_shares, entity_metrics
from scopewise.functions.numeric import dominant_category
from scopewise.queries import bindings as B
from scopewise.queries.registry import query
from scopewise.spec import DEFAULT_SPEC as SPEC

_MEASURES = ", ".join(
    [
        "CAST(sum(total) AS BIGINT) AS total_registered",
        *[f"CAST(sum({c}) AS BIGINT) AS {c}_registered" for c in SPEC.categories],
        "count(DISTINCT entity_code) AS entity_count",
        f"{B.ratio('sum(total)', 'count(DISTINCT entity_code)')} AS average_per_entity",
        *[f"{B.ratio(f'sum({c})', 'sum(total)')} AS {c}_share" for c in SPEC.categories],
    ]
)
_METRICS = f"WITH {B.ENTITY}, {B.METRICS}"
_SINCE = f"WITH {B.ENTITY_SINCE}, {B.METRICS}"


@query(f"WITH {B.ENTITY} SELECT scope_name, {_MEASURES} FROM entity GROUP BY scope_name")
def q_measures(spark, sf_dir):
    return E.measures(B.entity(spark, sf_dir), ["scope_name"])


@query(
    f"{_METRICS}, s AS (SELECT scope_name, sum(total) FILTER (WHERE rank_total <= 10) AS picked, "
    "sum(total) AS whole FROM metrics GROUP BY scope_name) SELECT scope_name, "
    "CAST(picked AS BIGINT) AS selected_total, CAST(whole AS BIGINT) AS whole_total, "
    f"{B.ratio('picked', 'whole')} AS selected_contribution FROM s"
)
def q_selected_contribution(spark, sf_dir):
    context = E.FilterContext(entity_pick=F.col("rank_total") <= 10)
    return E.selected_contribution(
        entity_metrics(B.entity(spark, sf_dir)), ["scope_name"], context
    )


@query(
    f"WITH {B.ENTITY} SELECT scope_name, first(entity_name ORDER BY total DESC, entity_name) "
    "AS highest_entity, first(entity_name ORDER BY total, entity_name) AS lowest_entity "
    "FROM entity GROUP BY scope_name"
)
def q_measure_extremes(spark, sf_dir):
    return E.measure_extremes(B.entity(spark, sf_dir), ["scope_name"])


@query(
    f"{_SINCE} SELECT scope_name, dominant_category, "
    "CAST(min(rank_total) <= 10 AS INTEGER) AS top_10, "
    "CAST(min(rank_total_ascending) <= 10 AS INTEGER) AS bottom_10 "
    "FROM metrics GROUP BY scope_name, dominant_category"
)
def q_measure_flags(spark, sf_dir):
    metrics = entity_metrics(B.entity_since(spark, sf_dir))
    return E.measure_flags(metrics, ["scope_name", "dominant_category"])


@query(
    f"{_METRICS} SELECT scope_name, entity_name, total, rank_total FROM metrics "
    "WHERE top_10_flag ORDER BY scope_name, rank_total"
)
def q_page_top10(spark, sf_dir):
    return P.top10_bar(entity_metrics(B.entity(spark, sf_dir)))


_LONG = " UNION ALL ".join(
    f"SELECT scope_name, '{c}' AS category, CAST(sum({c}) AS BIGINT) AS registered "
    "FROM entity GROUP BY scope_name"
    for c in SPEC.categories
)


@query(f"WITH {B.ENTITY} {_LONG}")
def q_page_category_long(spark, sf_dir):
    return P.category_totals_long(B.entity(spark, sf_dir))


@query(f"WITH {B.ENTITY} SELECT DISTINCT entity_name FROM entity")
def q_slicer_values(spark, sf_dir):
    return P.slicer_values(B.entity(spark, sf_dir), "entity_name")


@query(
    f"{_METRICS} SELECT scope_name, entity_name, entity_code, micro, small, medium, total, "
    "rank_total, scope_total_share_pct FROM metrics ORDER BY scope_name, rank_total"
)
def q_page_rank(spark, sf_dir):
    return P.rank_table(entity_metrics(B.entity(spark, sf_dir)))


@query(
    f"{_METRICS} SELECT scope_name, entity_name, scope_total_share_pct FROM metrics "
    "ORDER BY scope_name, scope_total_share_pct DESC, rank_total"
)
def q_page_contribution(spark, sf_dir):
    return P.contribution_bar(entity_metrics(B.entity(spark, sf_dir)))


_STACKED = " UNION ALL ".join(
    f"SELECT scope_name, entity_name, entity_code, '{c}' AS category, {c} AS registered FROM entity"
    for c in SPEC.categories
)


@query(f"WITH {B.ENTITY} {_STACKED}")
def q_page_stacked(spark, sf_dir):
    return P.stacked_composition(B.entity(spark, sf_dir))


def _since_shares(spark, sf_dir):
    """Row-wise columns only: no rank, hence no shuffle beyond the fact's own."""
    shares = category_shares(B.entity_since(spark, sf_dir))
    return shares.withColumn("dominant_category", dominant_category(SPEC.categories))


@query(
    f"{_SINCE} SELECT scope_name, entity_name, micro_share_pct, small_share_pct, "
    "medium_share_pct, dominant_category FROM metrics"
)
def q_page_share_matrix(spark, sf_dir):
    return P.share_matrix(_since_shares(spark, sf_dir))


@query(
    f"{_SINCE} SELECT scope_name, entity_name, medium_share_pct FROM metrics "
    "ORDER BY medium_share_pct DESC, entity_name, entity_code"
)
def q_page_medium_share(spark, sf_dir):
    return P.share_bar(_since_shares(spark, sf_dir), "medium_share_pct")


@query(
    f"{_SINCE} SELECT scope_name, dominant_category, count(*) AS entities FROM metrics "
    "GROUP BY scope_name, dominant_category"
)
def q_dominant_counts(spark, sf_dir):
    return P.category_slicer(_since_shares(spark, sf_dir))


@query(
    f"{_SINCE} SELECT dominant_category, {_MEASURES} FROM metrics "
    "WHERE dominant_category IN ('MICRO', 'SMALL') AND scope_name IN ('ASIA', 'EUROPE') "
    "AND top_10_flag GROUP BY dominant_category"
)
def q_page_filters(spark, sf_dir):
    context = E.FilterContext(
        outer={"scope_name": ["ASIA", "EUROPE"], "top_10_flag": [True]},
        inner={"dominant_category": ["MICRO", "SMALL"]},
    )
    metrics = entity_metrics(B.entity_since(spark, sf_dir))
    return E.measures(metrics, ["dominant_category"], context)


_HIGHLIGHT = ", ".join(
    f"CAST(sum({c}) AS BIGINT) AS {c}_all, "
    f"CAST(coalesce(sum({c}) FILTER (WHERE micro > small), 0) AS BIGINT) AS {c}_highlighted"
    for c in ("total", "micro")
)


@query(f"WITH {B.ENTITY} SELECT scope_name, {_HIGHLIGHT} FROM entity GROUP BY scope_name")
def q_cross_highlight(spark, sf_dir):
    selection = F.col("micro") > F.col("small")
    return E.cross_highlight(
        B.entity(spark, sf_dir), selection, ["scope_name"], ["total", "micro"]
    )


@query(
    f"{_METRICS}, w AS (SELECT *, sum(total) OVER (PARTITION BY scope_name) AS whole FROM metrics) "
    "SELECT scope_name, entity_name, entity_code, rank_total, dominant_category, "
    "total AS total_registered, micro AS micro_registered, small AS small_registered, "
    f"medium AS medium_registered, {B.ratio('total', 'whole')} AS selected_contribution FROM w"
)
def q_tooltip(spark, sf_dir):
    return E.tooltip(entity_metrics(B.entity(spark, sf_dir)))


@query(
    f"{_METRICS} SELECT scope_name, entity_name, entity_code, total AS total_registered, "
    "micro AS micro_registered, small AS small_registered, medium AS medium_registered, "
    "micro_share_pct, small_share_pct, medium_share_pct, scope_total_share_pct FROM metrics "
    "WHERE entity_code IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer "
    "WHERE c_mktsegment = 'BUILDING') AND dominant_category <> 'TIE'"
)
def q_drillthrough(spark, sf_dir):
    """Detail of the customers of one market segment, other filters kept."""
    chosen = (
        B.table(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment") == "BUILDING")
        .select(F.col("c_name").alias("entity_name"), F.col("c_custkey").cast("string").alias("entity_code"))
    )
    labels = [label for label in SPEC.dominant_labels if label != "TIE"]
    context = E.FilterContext(outer={"dominant_category": labels})
    return E.drillthrough(entity_metrics(B.entity(spark, sf_dir)), chosen, context)


def _page(spark, sf_dir):
    """Filters of a page: per region a ranking, a category and an entity visual, and one without filters."""
    places = B.table(spark, sf_dir, "region").select(F.col("r_name").alias("region"), "r_regionkey")
    nations = B.table(spark, sf_dir, "nation").join(places, F.col("n_regionkey") == F.col("r_regionkey"))
    first = B.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.min("c_custkey").alias("code"))
    codes = nations.join(first, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "region", F.col("code").cast("string").alias("code")
    )

    def rows(source, visual: str, part: str, column: str, value):
        name = F.concat(F.lit(f"{visual} "), F.col("region"))
        return source.select(
            name.alias("context"), F.lit(part).alias("part"), F.lit(column).alias("column_name"), value.alias("value")
        )

    labels = F.explode(F.array(F.lit("MICRO"), F.lit("SMALL")))
    return reduce(
        DataFrame.unionByName,
        [
            rows(places, "ranking", "outer", "scope_name", F.col("region")),
            rows(places, "ranking", "inner", "top_10_flag", F.lit("true")),
            rows(places, "category", "outer", "scope_name", F.col("region")),
            rows(places, "category", "inner", "dominant_category", labels),
            rows(places, "entity", "outer", "scope_name", F.col("region")),
            rows(codes, "entity", "inner", "entity_code", F.col("code")),
            spark.createDataFrame([("all", None, None, None)], C.CONTEXT_SCHEMA),
        ],
    )


def _page_sql() -> str:
    """Every context as a row of lists, met with the metrics by plain conditions."""
    sums = [f"CAST(sum({c}) FILTER (WHERE o AND e) AS BIGINT) AS {c}_registered" for c in SPEC.categories]
    shares = [
        f"{B.ratio(f'sum({c}) FILTER (WHERE o AND e)', 'sum(total) FILTER (WHERE o AND e)')} AS {c}_share"
        for c in SPEC.categories
    ]
    entities = "count(DISTINCT entity_code) FILTER (WHERE o AND e)"
    return f"""{_SINCE}, ctx AS (
  SELECT 'ranking ' || r_name AS context, r_name AS scope, NULL AS labels, true AS top, NULL AS codes FROM region
  UNION ALL SELECT 'category ' || r_name, r_name, ['MICRO', 'SMALL'], NULL, NULL FROM region
  UNION ALL SELECT 'entity ' || r_name, r_name, NULL, NULL, list(code) FROM (SELECT r_name, n_nationkey,
    CAST(min(c_custkey) AS VARCHAR) AS code FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_nationkey) GROUP BY r_name
  UNION ALL SELECT 'all', NULL, NULL, NULL, NULL),
met AS (SELECT *, (labels IS NULL OR list_contains(labels, dominant_category)) AND (top IS NULL OR top_10_flag) AS o,
  codes IS NULL OR list_contains(codes, entity_code) AS e FROM metrics, ctx WHERE scope IS NULL OR scope = scope_name)
SELECT context, scope_name, CAST(sum(total) FILTER (WHERE o AND e) AS BIGINT) AS total_registered, {", ".join(sums)},
  {entities} AS entity_count, {B.ratio("sum(total) FILTER (WHERE o AND e)", entities)} AS average_per_entity,
  {", ".join(shares)}, CAST(sum(total) FILTER (WHERE o) AS BIGINT) AS whole_total,
  {B.ratio("sum(total) FILTER (WHERE o AND e)", "sum(total) FILTER (WHERE o)")} AS selected_contribution,
  first(entity_name ORDER BY total DESC, entity_name) AS highest_entity,
  first(entity_name ORDER BY total, entity_name) AS lowest_entity,
  CAST(coalesce(min(rank_total) FILTER (WHERE o AND e), 0) <= 10 AS INTEGER) AS top_10,
  CAST(coalesce(min(rank_total_ascending) FILTER (WHERE o AND e), 0) <= 10 AS INTEGER) AS bottom_10
FROM met GROUP BY context, scope_name"""


@query(_page_sql())
def q_page_contexts(spark, sf_dir):
    """Sixteen filter contexts of one page, read from tables and evaluated over one scan of the metrics."""
    metrics = entity_metrics(B.entity_since(spark, sf_dir))
    return C.context_measures(metrics, _page(spark, sf_dir), ["scope_name"])
