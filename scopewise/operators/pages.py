"""The queries behind the visuals of the report pages.

Each takes a metrics table.  Page and slicer filters are applied first with
``measures.apply_context``; a query only projects, orders or groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scopewise.operators.quality import require_allowed
from scopewise.spec import DEFAULT_SPEC, FactSpec


def fields(metrics: DataFrame, names: Sequence[str], spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """A projection limited to the columns of the fact dataset."""
    require_allowed(
        names, [*spec.snapshot_cols, spec.scope_col, *spec.required, *spec.derived], "fact"
    )
    return metrics.select(*names)


def top10_bar(metrics: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    names = [*spec.scope_keys, spec.entity_name, spec.total, "rank_total"]
    return fields(metrics.where("top_10_flag"), names, spec).orderBy(*spec.scope_keys, "rank_total")


def rank_table(metrics: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    names = [
        *spec.scope_keys,
        spec.entity_name,
        spec.entity_code,
        *spec.categories,
        spec.total,
        "rank_total",
        "scope_total_share_pct",
    ]
    return fields(metrics, names, spec).orderBy(*spec.scope_keys, "rank_total")


def contribution_bar(metrics: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Entities by contribution, ranks breaking ties."""
    names = [*spec.scope_keys, spec.entity_name, "scope_total_share_pct"]
    ordered = metrics.orderBy(
        *spec.scope_keys, F.desc("scope_total_share_pct"), "rank_total"
    )
    return fields(ordered, names, spec)


def category_totals_long(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Category sums of a scope in long form, as a donut or card list reads them."""
    sums = df.groupBy(*spec.scope_keys).agg(*[F.sum(c).alias(c) for c in spec.categories])
    return sums.unpivot(list(spec.scope_keys), list(spec.categories), "category", "registered")


def stacked_composition(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """One row per entity and category."""
    ids = [*spec.scope_keys, spec.entity_name, spec.entity_code]
    return df.unpivot(ids, list(spec.categories), "category", "registered")


def share_matrix(metrics: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    names = [*spec.scope_keys, spec.entity_name, *spec.share_cols, "dominant_category"]
    return fields(metrics, names, spec)


def share_bar(metrics: DataFrame, share: str, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Entities by one category share."""
    ordered = metrics.orderBy(F.desc(share), spec.entity_name, spec.entity_code)
    return fields(ordered, [*spec.scope_keys, spec.entity_name, share], spec)


def slicer_values(df: DataFrame, column: str, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    return fields(df, [column], spec).distinct()


def category_slicer(metrics: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Dominant categories on offer, with their number of entities."""
    return metrics.groupBy(*spec.scope_keys, "dominant_category").agg(
        F.count("*").alias("entities")
    )
