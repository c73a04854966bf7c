"""Derived columns of a fact: ranks, shares, dominant category and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scopewise.functions.numeric import dominant_category, safe_pct
from scopewise.operators.ranking import add_ranks
from scopewise.session import materialize
from scopewise.spec import DEFAULT_SPEC, RANK_CUTOFF, FactSpec


def category_shares(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Add the share of each category in the row's own total."""
    return df.withColumns(
        {
            share: safe_pct(F.col(name), F.col(spec.total))
            for name, share in zip(spec.categories, spec.share_cols)
        }
    )


def scope_totals_per_row(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Add ``scope_total`` by joining a pre-aggregated, stored table.

    No scope is gathered in one task: the sums combine before the shuffle, and
    the stored table (one row per scope) is small enough to be sent to the
    rows whenever its measured size allows it.
    """
    totals = df.groupBy(*spec.scope_keys).agg(F.sum(spec.total).alias("scope_total"))
    return df.join(materialize(totals, "totals"), list(spec.scope_keys))


def add_scope_share(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Add the share of each entity in the total of its scope."""
    share = safe_pct(F.col(spec.total), F.col("scope_total"))
    return scope_totals_per_row(df, spec).withColumn("scope_total_share_pct", share)


def entity_metrics(
    df: DataFrame,
    spec: FactSpec = DEFAULT_SPEC,
    strategy: str = "range",
) -> DataFrame:
    """All derived columns for every scope at once: base columns plus nine."""
    base = df.select(*spec.snapshot_cols, *spec.required, *spec.extra_cols)
    ranked = add_ranks(base, spec, strategy)
    shared = category_shares(ranked, spec)
    return shared.select(
        *spec.snapshot_cols,
        *spec.required,
        "rank_total",
        "rank_total_ascending",
        *spec.share_cols,
        safe_pct(F.col(spec.total), F.col("scope_total")).alias("scope_total_share_pct"),
        dominant_category(spec.categories).alias("dominant_category"),
        (F.col("rank_total") <= F.least(F.lit(RANK_CUTOFF), "scope_rows")).alias("top_10_flag"),
        (F.col("rank_total_ascending") <= F.least(F.lit(RANK_CUTOFF), "scope_rows")).alias(
            "bottom_10_flag"
        ),
        *spec.extra_cols,
    )
