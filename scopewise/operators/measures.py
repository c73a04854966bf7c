"""Dashboard measures under a filter context.

A measure is evaluated over three sets of rows:

* the rows that pass all filters,
* the same without the filters on entity name and code (the denominator of a
  contribution), and
* the rows that pass the outer filters only (extremes over the selection).

Measures are fractions in 0..1, unlike the percentages stored in the metrics.
Sums over no rows are null; ratios with an empty denominator are 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scopewise.functions.numeric import safe_ratio
from scopewise.operators.metrics import scope_totals_per_row
from scopewise.operators.quality import require_allowed
from scopewise.spec import DEFAULT_SPEC, RANK_CUTOFF, FactSpec


@dataclass(frozen=True)
class FilterContext:
    """Filters of a report: allowed values per column, AND across columns.

    ``outer`` comes from pages and slicers, ``inner`` from the visual itself.
    ``entity_pick`` is a condition on entities that does not fit a value list.
    """

    outer: Mapping[str, Sequence] = field(default_factory=dict)
    inner: Mapping[str, Sequence] = field(default_factory=dict)
    entity_pick: Column | None = None

    def with_filter(self, **values: Sequence) -> FilterContext:
        return replace(self, outer={**self.outer, **values})


def matches(filters: Mapping[str, Sequence]) -> Column:
    """True for rows whose columns hold one of the listed values each."""
    conditions = [F.col(c).isin(*values) for c, values in filters.items()]
    return reduce(and_, conditions, F.lit(True))


def _split(context: FilterContext, spec: FactSpec) -> tuple[Column, Column]:
    """Conditions on other columns, and on the entity."""
    entity_cols = {spec.entity_name, spec.entity_code}
    everything = [*context.outer.items(), *context.inner.items()]
    others = [F.col(c).isin(*v) for c, v in everything if c not in entity_cols]
    entity = [F.col(c).isin(*v) for c, v in everything if c in entity_cols]
    if context.entity_pick is not None:
        entity.append(context.entity_pick)
    return reduce(and_, others, F.lit(True)), reduce(and_, entity, F.lit(True))


def apply_context(df: DataFrame, context: FilterContext, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows that pass all filters."""
    others, entity = _allowed_split(df, context, spec)
    return df.where(others).where(entity)


def _allowed_split(df: DataFrame, context: FilterContext, spec: FactSpec) -> tuple[Column, Column]:
    """``_split`` for filters on fields that the table offers."""
    require_allowed([*context.outer, *context.inner], df.columns, "fact")
    return _split(context, spec)


def count_measures(spec: FactSpec = DEFAULT_SPEC) -> list[Column]:
    """Totals, distinct entities, average and category shares, as aggregates."""
    total = F.sum(spec.total)
    # A missing code counts as one more value.
    entities = F.count_distinct(spec.entity_code) + F.max(
        F.col(spec.entity_code).isNull().cast("int")
    )
    entities = F.coalesce(entities, F.lit(0)).cast("bigint")
    return [
        total.alias("total_registered"),
        *[F.sum(c).alias(f"{c}_registered") for c in spec.categories],
        entities.alias("entity_count"),
        safe_ratio(total, entities).alias("average_per_entity"),
        *[safe_ratio(F.sum(c), total).alias(f"{c}_share") for c in spec.categories],
    ]


def measures(
    df: DataFrame,
    by: Sequence[str] = (),
    context: FilterContext = FilterContext(),
    spec: FactSpec = DEFAULT_SPEC,
) -> DataFrame:
    """The additive measures and their ratios, grouped by ``by``."""
    return apply_context(df, context, spec).groupBy(*by).agg(*count_measures(spec))


def selected_contribution(
    df: DataFrame,
    by: Sequence[str] = (),
    context: FilterContext = FilterContext(),
    spec: FactSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Selected total over the total with entity filters removed.

    Both sums come from one pass: the entity filter moves into the aggregate.
    ``tooltip`` serves the grouping by entity itself.
    """
    if {spec.entity_name, spec.entity_code} & set(by):
        raise ValueError("Group by other columns than the entity; see tooltip.")
    others, entity = _allowed_split(df, context, spec)
    selected = F.sum(F.when(entity, F.col(spec.total)))
    whole = F.sum(spec.total)
    return df.where(others).groupBy(*by).agg(
        selected.alias("selected_total"),
        whole.alias("whole_total"),
        safe_ratio(selected, whole).alias("selected_contribution"),
    )


def measure_extremes(
    df: DataFrame,
    by: Sequence[str] = (),
    context: FilterContext = FilterContext(),
    spec: FactSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Names of the highest and lowest entity over the outer filters."""
    require_allowed([*context.outer, *context.inner], df.columns, "fact")
    rows = df.where(matches(context.outer))
    name, total = F.col(spec.entity_name), F.col(spec.total)
    return rows.groupBy(*by).agg(
        F.min_by(name, F.struct(-total, name)).alias("highest_entity"),
        F.min_by(name, F.struct(total, name)).alias("lowest_entity"),
    )


def measure_flags(
    df: DataFrame,
    by: Sequence[str] = (),
    context: FilterContext = FilterContext(),
    spec: FactSpec = DEFAULT_SPEC,
) -> DataFrame:
    """1 or 0 for a smallest rank within the cut-off; no rows count as within."""

    def flag(rank: str) -> Column:
        return (F.coalesce(F.min(rank), F.lit(0)) <= RANK_CUTOFF).cast("int")

    return apply_context(df, context, spec).groupBy(*by).agg(
        flag("rank_total").alias("top_10"), flag("rank_total_ascending").alias("bottom_10")
    )


def cross_highlight(
    df: DataFrame,
    selection: Column,
    by: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """Full and highlighted sums side by side: a highlight keeps all rows."""
    picked = F.coalesce(selection, F.lit(False))
    return df.groupBy(*by).agg(
        *[F.sum(c).alias(f"{c}_all") for c in columns],
        *[
            F.coalesce(F.sum(F.when(picked, F.col(c))), F.lit(0)).cast("bigint").alias(f"{c}_highlighted")
            for c in columns
        ],
    )


def tooltip(
    metrics: DataFrame,
    context: FilterContext = FilterContext(),
    spec: FactSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Hover record per entity: rank, category, totals and contribution.

    The contribution divides by the scope total over all entities that pass
    the other filters.
    """
    others, entity = _allowed_split(metrics, context, spec)
    kept = scope_totals_per_row(metrics.where(others), spec)
    return kept.where(entity).select(
        *spec.scope_keys,
        spec.entity_name,
        spec.entity_code,
        "rank_total",
        "dominant_category",
        F.col(spec.total).alias("total_registered"),
        *[F.col(c).alias(f"{c}_registered") for c in spec.categories],
        safe_ratio(F.col(spec.total), F.col("scope_total")).alias("selected_contribution"),
    )


def drillthrough(
    metrics: DataFrame,
    entities: DataFrame,
    context: FilterContext = FilterContext(),
    spec: FactSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Detail of chosen entities (name and code), all other filters kept."""
    keys = [spec.entity_name, spec.entity_code]
    chosen = entities.select(*keys).distinct()
    return apply_context(metrics, context, spec).join(chosen, keys, "left_semi").select(
        *spec.scope_keys,
        *keys,
        F.col(spec.total).alias("total_registered"),
        *[F.col(c).alias(f"{c}_registered") for c in spec.categories],
        *spec.pct_cols,
    )
