"""Many filter contexts over one fact, evaluated together.

A page of a dashboard has many visuals, each with filters of its own. Here the
filters are a table, one row per allowed value:

    context      name of the visual
    part         ``outer`` (pages, slicers) or ``inner`` (the visual itself)
    column_name  the filtered column; null declares a context without filters
    value        an allowed value, as text

Values of a column are alternatives; columns, and the two parts, must all
hold. A value that is null, or no value of its column's type, matches no row.
The fact is read once for all contexts, and all measures of ``measures`` come
from one grouping by context.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scopewise.functions.numeric import safe_ratio
from scopewise.operators.measures import FilterContext
from scopewise.operators.quality import require_allowed
from scopewise.session import materialize
from scopewise.spec import DEFAULT_SPEC, RANK_CUTOFF, DataQualityError, FactSpec

CONTEXT_SCHEMA = "context string, part string, column_name string, value string"
PARTS = ("outer", "inner")


def _text(value) -> str | None:
    if isinstance(value, bool):
        return str(value).lower()
    return None if value is None else str(value)


def context_rows(spark: SparkSession, contexts: Mapping[str, FilterContext]) -> DataFrame:
    """The table of named contexts; conditions that are no value list do not fit in."""
    rows = []
    for name, context in contexts.items():
        if context.entity_pick is not None:
            raise ValueError(f"The context {name} has a condition that is no list of values.")
        rows.append((name, None, None, None))
        for part, filters in zip(PARTS, (context.outer, context.inner)):
            for column, values in filters.items():
                rows += [(name, part, column, _text(v)) for v in (*values, None)]
    return spark.createDataFrame(rows, CONTEXT_SCHEMA)


@dataclass(frozen=True)
class _Filter:
    """One filtered column of one part; its allowed values are the array ``name``."""

    part: str
    column: str
    name: str
    kind: str

    @property
    def chosen(self) -> Column:
        return (F.col("part") == self.part) & (F.col("column_name") == self.column)

    def allowed(self) -> Column:
        """The values of a context, or null where it does not filter the column."""
        value = F.when(self.chosen, F.col("value").try_cast(self.kind))
        return F.when(F.count_if(self.chosen) > 0, F.collect_set(value)).alias(self.name)

    def holds(self) -> Column:
        return F.col(self.name).isNull() | F.coalesce(F.array_contains(self.name, F.col(self.column)), F.lit(False))


def _filters(df: DataFrame, contexts: DataFrame) -> list[_Filter]:
    """The pairs of part and column in use: at most two per column of the fact."""
    named = contexts.where(F.col("column_name").isNotNull()).select("part", "column_name")
    strange = named.where(~F.col("column_name").isin(df.columns) | ~F.coalesce(F.col("part").isin(*PARTS), F.lit(False)))
    wrong = strange.first()
    if wrong is not None:
        require_allowed([wrong["column_name"]], df.columns, "fact")
        raise DataQualityError(f"A filter on {wrong['column_name']} is neither outer nor inner.")
    kinds = dict(df.dtypes)
    used = sorted(tuple(row) for row in named.distinct().collect())
    return [_Filter(part, column, f"_f{i}", kinds[column]) for i, (part, column) in enumerate(used)]


def _all(filters: Sequence[_Filter]) -> Column:
    return reduce(and_, [f.holds() for f in filters], F.lit(True))


def _lead(filters: Sequence[_Filter]) -> Column:
    """Where a context meets the fact: its first filter as (number, value), or (-1, "")."""
    leads = F.array(_offer(-1, F.lit("")))
    for number, f in reversed(list(enumerate(filters))):
        values = F.transform(f.name, _offers(number))
        leads = F.when(F.col(f.name).isNotNull(), values).otherwise(leads)
    return leads


def _offers(number: int) -> Callable[[Column], Column]:
    return lambda value: _offer(number, value)


def _offer(number: int, value: Column) -> Column:
    return F.struct(F.lit(number).alias("_lead"), value.cast("string").alias("_value"))


def _meet(df: DataFrame, wide: DataFrame, leads: Sequence[_Filter]) -> DataFrame:
    """Rows beside the contexts whose lead they match.

    The contexts are a stored table, so Spark knows its size: it is broadcast
    below the threshold; beyond it the join is on (lead, value), where adaptive
    execution splits a value that holds a large part of the fact.
    """
    numbers = {row[0] for row in wide.select("_lead").distinct().collect()}
    offers = [_offer(i, F.col(f.column)) for i, f in enumerate(leads) if i in numbers]
    if -1 in numbers or not offers:
        offers.append(_offer(-1, F.lit("")))
    return df.select("*", F.inline(F.array(*offers))).join(wide, ["_lead", "_value"])


def context_measures(
    df: DataFrame,
    contexts: DataFrame,
    by: Sequence[str] = (),
    spec: FactSpec = DEFAULT_SPEC,
) -> DataFrame:
    """All measures of every context, grouped by ``by``.

    Equal to ``measures``, ``selected_contribution``, ``measure_extremes`` and,
    where the table has ranks, ``measure_flags`` of each context. A group is
    listed if any of them has rows in it; without ``by`` every context has one
    row. Sums over no rows are null, ratios 0.
    """
    if "context" in by:
        raise ValueError("Results are grouped by context already.")
    entity_cols = {spec.entity_name, spec.entity_code}
    if entity_cols & set(by):
        raise ValueError("Group by other columns than the entity; see tooltip.")
    require_allowed(by, df.columns, "fact")
    filters = _filters(df, contexts)
    others = [f for f in filters if f.column not in entity_cols]
    # Filters that all measures share; floating values have no one text.
    leads = [f for f in others if f.part == "outer" and f.kind not in ("float", "double")]
    ranks = [c for c in ("rank_total", "rank_total_ascending") if c in df.columns]

    named = contexts.groupBy(F.col("context").alias("_context"))
    wide = named.agg(F.count("*").alias("_rows"), *[f.allowed() for f in filters]).drop("_rows")
    wide = materialize(wide.select("*", F.inline(_lead(leads))), "contexts")
    needed = {*by, *(f.column for f in filters), *entity_cols, spec.total, *spec.categories, *ranks}
    met = _meet(df.select(*[c for c in df.columns if c in needed]), wide, leads).withColumns(
        {
            "_others": _all(others),
            "_entity": _all([f for f in filters if f.column in entity_cols]),
            "_outer": _all([f for f in filters if f.part == "outer"]),
        }
    )
    kept = met.where(F.col("_others") | F.col("_outer"))
    result = kept.groupBy(F.col("_context").alias("context"), *by).agg(*_measures(spec, len(ranks) == 2))
    if by:
        return result
    names = contexts.select("context").distinct()
    return names.join(result, F.equal_null(names["context"], result["context"]), "left").select(
        names["context"], *[_over_no_rows(name, kind) for name, kind in result.dtypes if name != "context"]
    )


def _measures(spec: FactSpec, with_flags: bool) -> list[Column]:
    selected = F.col("_others") & F.col("_entity")
    total, name, code = F.col(spec.total), F.col(spec.entity_name), F.col(spec.entity_code)

    def picked(column: str) -> Column:
        return F.sum(F.when(selected, F.col(column)))

    # A missing code counts as one more value.
    entities = F.count_distinct(F.when(selected, code)) + F.coalesce(
        F.max(F.when(selected, code.isNull().cast("int"))), F.lit(0)
    )
    entities = entities.cast("bigint")
    whole = F.sum(F.when(F.col("_others"), total))
    outer = F.col("_outer")
    columns = [
        picked(spec.total).alias("total_registered"),
        *[picked(c).alias(f"{c}_registered") for c in spec.categories],
        entities.alias("entity_count"),
        safe_ratio(picked(spec.total), entities).alias("average_per_entity"),
        *[safe_ratio(picked(c), picked(spec.total)).alias(f"{c}_share") for c in spec.categories],
        whole.alias("whole_total"),
        safe_ratio(picked(spec.total), whole).alias("selected_contribution"),
        F.min_by(name, F.when(outer, F.struct(-total, name))).alias("highest_entity"),
        F.min_by(name, F.when(outer, F.struct(total, name))).alias("lowest_entity"),
    ]
    if with_flags:
        for flag, rank in (("top_10", "rank_total"), ("bottom_10", "rank_total_ascending")):
            least = F.coalesce(F.min(F.when(selected, F.col(rank))), F.lit(0))
            columns.append((least <= RANK_CUTOFF).cast("int").alias(flag))
    return columns


def _over_no_rows(name: str, kind: str) -> Column:
    """What a measure is for a context that no row passes."""
    if kind == "double" or name == "entity_count":
        return F.coalesce(F.col(name), F.lit(0)).cast(kind).alias(name)
    if name in ("top_10", "bottom_10"):
        return F.coalesce(F.col(name), F.lit(1)).alias(name)
    return F.col(name)
