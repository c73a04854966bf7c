"""Ranks inside scopes, and positions over a whole table.

Ranks are unique: entities are ordered by total, then name, then code.  The
ascending rank is a second order (total up, name and code still up), so it is
not the mirrored descending rank where totals tie.

No scope has to fit a task.  Rows are range-partitioned by (scope, total, name,
code), stored in that order, and numbered where they lie; the numbers are
shifted by the row counts of the slices before them.  Both ranks come from the
one order: inside a run of equal totals they agree, so the ascending rank
follows from the end of the run.  A run is measured inside its slice; the few
runs that cross a slice border are measured over all slices.

``strategy="window"`` sorts every scope in one task instead.  It gives the same
numbers with fewer jobs, for callers who know that all scopes are small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scopewise.session import materialize
from scopewise.spec import DEFAULT_SPEC, RANKING_LIMIT_TEXT, FactSpec

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row below


def descending_order(spec: FactSpec = DEFAULT_SPEC) -> list[Column]:
    return [F.col(spec.total).desc(), F.col(spec.entity_name), F.col(spec.entity_code)]


def ascending_order(spec: FactSpec = DEFAULT_SPEC) -> list[Column]:
    return [F.col(spec.total), F.col(spec.entity_name), F.col(spec.entity_code)]


def add_ranks(
    df: DataFrame, spec: FactSpec = DEFAULT_SPEC, strategy: str = "range"
) -> DataFrame:
    """Add both ranks and ``scope_rows``, ``scope_total`` of the row's scope."""
    ways = {"range": _ranks_by_range, "window": _ranks_by_window}
    if strategy not in ways:
        raise ValueError(f"Unknown ranking strategy: {strategy!r}")
    return ways[strategy](df, spec)


def _ranks_by_window(df: DataFrame, spec: FactSpec) -> DataFrame:
    scope = W.partitionBy(*spec.scope_keys)
    by_total = scope.orderBy(F.col(spec.total).desc())
    ranked = df.select(
        "*",
        F.row_number().over(scope.orderBy(*descending_order(spec))).cast("bigint").alias("rank_total"),
        F.rank().over(by_total).cast("bigint").alias("_run_start"),
        F.count("*").over(by_total).alias("_at_least"),
        F.count("*").over(scope).alias("scope_rows"),
        F.sum(spec.total).over(scope).alias("scope_total"),
    )
    place_in_run = F.col("rank_total") - F.col("_run_start") + 1
    return ranked.withColumn(
        "rank_total_ascending", F.col("scope_rows") - F.col("_at_least") + place_in_run
    ).drop("_run_start", "_at_least")


def _ranks_by_range(df: DataFrame, spec: FactSpec) -> DataFrame:
    scope, total = list(spec.scope_keys), spec.total
    placed = _place_rows(df, [*map(F.col, scope), *descending_order(spec)])

    # One row per scope and slice, so this table is small whatever the rows are.
    by_scope = W.partitionBy(*scope)
    in_order = by_scope.orderBy("_slice")
    before = in_order.rowsBetween(W.unboundedPreceding, -1)
    slices = materialize(
        placed.groupBy(*scope, "_slice")
        .agg(
            F.min("_place").alias("_first"),
            F.count("*").alias("_rows"),
            F.sum(total).alias("_total"),
            F.max(total).alias("_top"),
            F.min(total).alias("_low"),
        )
        .select(
            *scope,
            "_slice",
            (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
            F.sum("_rows").over(by_scope).alias("scope_rows"),
            F.sum("_total").over(by_scope).alias("scope_total"),
            F.when(F.lag("_low").over(in_order) == F.col("_top"), F.col("_top")).alias("_crossing"),
        ),
        "slices",
    )
    ranked = placed.join(slices.drop("_crossing"), [*scope, "_slice"]).withColumn(
        "rank_total", F.col("_place") + F.col("_shift")
    )
    # Runs that cross a slice border: at most one per row of the table above.
    crossing = slices.where(F.col("_crossing").isNotNull()).select(*scope, F.col("_crossing").alias(total))
    long_runs = materialize(
        ranked.join(crossing.distinct(), [*scope, total])
        .groupBy(*scope, total)
        .agg(F.min("rank_total").alias("_start"), F.count("*").alias("_length")),
        "long-runs",
    )
    in_slice = W.partitionBy("_slice", *scope, total)
    start = F.coalesce("_start", F.min("rank_total").over(in_slice))
    length = F.coalesce("_length", F.count("*").over(in_slice))
    # Counted from below: rows after the run, then the place inside it.
    ascending = F.col("scope_rows") - length + F.col("rank_total") - 2 * start + 2
    return ranked.join(long_runs, [*scope, total], "left").select(
        *df.columns, "rank_total", "scope_rows", "scope_total", ascending.alias("rank_total_ascending")
    )


def _place_rows(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Store ``df`` in ``order``, with the slice and the place inside it."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    position = F.monotonically_increasing_id()
    return materialize(
        ordered.withColumn("_position", position).select(
            *df.columns,
            F.shiftright("_position", _POSITION_BITS).alias("_slice"),
            F.col("_position").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_place"),
        ),
        "ordered",
    )


def add_position(
    df: DataFrame,
    order: Sequence[str],
    name: str = "position",
) -> DataFrame:
    """Number all rows 1..n in ``order`` without a single-task sort."""
    placed = _place_rows(df, [F.col(c) for c in order])
    counts = placed.groupBy("_slice").agg(F.count("*").alias("_rows"))
    # One row per slice: the table is as small as the number of tasks.
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = materialize(
        counts.select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")),
        "offsets",
    )
    return placed.join(offsets, "_slice").select(
        *df.columns, (F.col("_offset") + F.col("_place") + 1).alias(name)
    )


def add_top_n(
    df: DataFrame,
    limit: int,
    order: Sequence[Column],
    spec: FactSpec = DEFAULT_SPEC,
    name: str = "ranking_position",
) -> DataFrame:
    """The first ``limit`` rows of every scope, numbered.

    The filter on the row number lets Spark cut each scope to ``limit`` rows in
    every task before the shuffle.
    """
    require_limit(limit)
    window = W.partitionBy(*spec.scope_keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= limit)


def top_n(df: DataFrame, limit: int, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    return add_top_n(df, limit, descending_order(spec), spec)


def bottom_n(df: DataFrame, limit: int, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    return add_top_n(df, limit, ascending_order(spec), spec)


def require_limit(limit: int) -> None:
    if limit < 1:
        raise ValueError(f"The number of ranked entities {RANKING_LIMIT_TEXT}.")


def canonical_sort(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Order by name and code; the other columns make the order total."""
    lead = (spec.entity_name, spec.entity_code)
    return df.orderBy(*lead, *[c for c in df.columns if c not in lead])
