"""Totals, KPIs and profiles; every scope in one grouped pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scopewise.functions.numeric import percentage, round_value, row_sum
from scopewise.spec import AVERAGE_DECIMALS, DEFAULT_SPEC, SHARE_DECIMALS, FactSpec


def scope_totals(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    sums = [F.sum(c).alias(f"{c}_total") for c in (*spec.categories, spec.total)]
    return df.groupBy(*spec.scope_keys).agg(*sums)


def entity_counts(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    return df.groupBy(*spec.scope_keys).agg(
        F.count("*").alias("row_count"),
        F.count_distinct(spec.entity_code).alias("entity_count"),
    )


def dataset_summary(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows, distinct entities and totals per scope.

    Entities are collapsed first, so a large scope spreads over its entities.
    """
    counted = (*spec.categories, spec.total)
    entities = df.groupBy(*spec.scope_keys, spec.entity_code).agg(
        F.count("*").alias("_rows"), *[F.sum(c).alias(c) for c in counted]
    )
    return entities.groupBy(*spec.scope_keys).agg(
        F.sum("_rows").cast("bigint").alias("row_count"),
        F.count(spec.entity_code).alias("entity_count"),
        *[F.sum(c).alias(f"{c}_total") for c in counted],
    )


def kpi_share(category_total: Column, scope_total: Column) -> Column:
    return round_value(percentage(category_total, scope_total), SHARE_DECIMALS)


def kpi_average(scope_total: Column, rows: Column) -> Column:
    return round_value(scope_total.cast("double") / rows.cast("double"), AVERAGE_DECIMALS)


def first_entity(spec: FactSpec, highest: bool) -> Column:
    """The entity that ranks first from above or below, as one struct."""
    total = F.col(spec.total)
    order = F.struct(-total if highest else total, F.col(spec.entity_name), F.col(spec.entity_code))
    entity = F.struct(
        F.col(spec.entity_name).alias("entity_name"),
        F.col(spec.entity_code).alias("entity_code"),
        total.alias("total"),
    )
    return F.min_by(entity, order)


def kpi_shares(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Share of every category in the total of its scope."""
    total = F.sum(spec.total)
    return df.groupBy(*spec.scope_keys).agg(
        *[kpi_share(F.sum(c), total).alias(s) for c, s in zip(spec.categories, spec.share_cols)]
    )


def kpi_averages(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    return df.groupBy(*spec.scope_keys).agg(
        kpi_average(F.sum(spec.total), F.count("*")).alias("average_per_entity")
    )


def kpi_extremes(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Highest and lowest entity of every scope."""
    found = df.groupBy(*spec.scope_keys).agg(
        first_entity(spec, highest=True).alias("highest"),
        first_entity(spec, highest=False).alias("lowest"),
    )
    return found.select(*spec.scope_keys, *_flat("highest"), *_flat("lowest"))


def _flat(side: str) -> list[Column]:
    return [
        F.col(f"{side}.{part}").alias(f"{side}_{part}")
        for part in ("entity_name", "entity_code", "total")
    ]


def executive_summary(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """All KPIs of a scope in one row."""
    total = F.sum(spec.total)
    found = df.groupBy(*spec.scope_keys).agg(
        F.count("*").alias("entity_count"),
        *[F.sum(c).alias(f"{c}_total") for c in (*spec.categories, spec.total)],
        *[kpi_share(F.sum(c), total).alias(s) for c, s in zip(spec.categories, spec.share_cols)],
        kpi_average(total, F.count("*")).alias("average_per_entity"),
        first_entity(spec, highest=True).alias("highest"),
        first_entity(spec, highest=False).alias("lowest"),
    )
    plain = [c for c in found.columns if c not in ("highest", "lowest")]
    return found.select(*plain, *_flat("highest"), *_flat("lowest"))


def kpi_definitions(spec: FactSpec = DEFAULT_SPEC) -> dict[str, str]:
    """What each KPI of the executive summary means."""
    shares = {s: f"{c} total / {spec.total} total * 100" for c, s in zip(spec.categories, spec.share_cols)}
    return {
        "entity_count": "entities with a row in the scope",
        **{f"{c}_total": f"sum of {c} over the entities of the scope" for c in (*spec.categories, spec.total)},
        **shares,
        "average_per_entity": f"{spec.total} total / entity_count",
        "highest": f"entity with the largest {spec.total}; ties by name, then code",
        "lowest": f"entity with the smallest {spec.total}; ties by name, then code",
    }


INTERPRETATION_WARNING = "Counts are registrations. They say nothing about activity, size or success."


def documented_summary(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """The executive summary with the definitions of its figures and a warning."""
    entries = [F.lit(text) for pair in sorted(kpi_definitions(spec).items()) for text in pair]
    return executive_summary(df, spec).select(
        "*",
        F.create_map(*entries).alias("definitions"),
        F.lit(INTERPRETATION_WARNING).alias("interpretation_warning"),
    )


def mean_share_sum(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Mean over entities of the sum of their category shares."""
    mean = F.avg(row_sum(spec.share_cols))
    return df.groupBy(*spec.scope_keys).agg(
        round_value(mean, SHARE_DECIMALS).alias("mean_share_sum")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; null is a value too."""
    return df.groupBy(column).agg(F.count("*").alias("rows"))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns that hold nulls, with their number."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns]
    )
    return counts.select(F.inline(pairs)).where("nulls > 0")


def blank_profile(df: DataFrame, blanks: Mapping[str, Column]) -> DataFrame:
    """Blank values per named condition, zero counts included."""
    counts = df.agg(*[F.count_if(condition).alias(name) for name, condition in blanks.items()])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("blanks")) for c in blanks]
    )
    return counts.select(F.inline(pairs))


def source_profile(df: DataFrame, scope: str, code: str) -> DataFrame:
    """Rows, distinct scopes and distinct codes of a whole table.

    One grouped pass per column, so that neither count expands the rows.
    """
    scopes = df.groupBy(scope).agg(F.count("*").alias("rows"))
    codes = df.groupBy(code).agg(F.count("*").alias("rows"))
    counted = scopes.agg(
        F.sum("rows").cast("bigint").alias("row_count"), F.count(scope).alias("scope_count")
    )
    return counted.withColumn("code_count", codes.agg(F.count(code)).scalar())
