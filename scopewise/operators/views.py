"""Top and bottom views over a metrics table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scopewise.operators.ranking import require_limit
from scopewise.spec import DEFAULT_SPEC, FactSpec


def ranking_view(metrics: DataFrame, limit: int = 10, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Labelled TOP and BOTTOM rows of every scope.

    The position in a group is the rank itself, so the view is one filter over
    the metrics; an entity that belongs to both groups appears twice.
    """
    require_limit(limit)
    groups = F.array_compact(
        F.array(
            F.when(F.col("rank_total") <= limit, _entry("TOP", "rank_total")),
            F.when(
                F.col("rank_total_ascending") <= limit, _entry("BOTTOM", "rank_total_ascending")
            ),
        )
    )
    near_an_end = (F.col("rank_total") <= limit) | (F.col("rank_total_ascending") <= limit)
    return metrics.where(near_an_end).select(F.inline(groups), *metrics.columns)


def _entry(group: str, rank: str):
    return F.struct(
        F.lit(group).alias("ranking_group"), F.col(rank).cast("int").alias("ranking_position")
    )


def top_view(metrics: DataFrame, limit: int = 10, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    return ranking_view(metrics, limit, spec).where("ranking_group = 'TOP'")


def bottom_view(metrics: DataFrame, limit: int = 10, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    return ranking_view(metrics, limit, spec).where("ranking_group = 'BOTTOM'")
