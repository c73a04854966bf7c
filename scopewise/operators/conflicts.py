"""Duplicate keys, their conflicts, and which scopes they touch.

A key that occurs more than once is *conflicting* when its rows differ in any
column, and an *exact duplicate* otherwise.  Finding the duplicate keys moves
only keys and counters; everything else then runs on the members of those
keys, which are a small part of a sound source.  Nulls are equal to each other,
in keys as in values.

The values of a key are rows, not lists, so a key of any size is reported in
full: copies collapse first, then every distinct value is one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scopewise.functions.text import LIST_SEPARATOR
from scopewise.session import materialize
from scopewise.spec import DEFAULT_SPEC, FactSpec


def join_on_key(
    left: DataFrame, right: DataFrame, key: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on a key whose nulls are equal; the key columns of ``left`` stay."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in key})
    same = [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in key]
    return left.join(renamed, reduce(and_, same), how).drop(*[f"_right_{k}" for k in key])


#: A key with more rows than this, and more than this share of all, is heavy: at most 1 / share keys are.
HEAVY_ROWS, HEAVY_SHARE = 100_000, 1e-4


def heavy_keys(
    weights: DataFrame, key: Sequence[str], weight: str = "row_count", heavy_rows: int = HEAVY_ROWS
) -> list[int]:
    """Hashes of the keys whose ``weight`` makes them heavy; a list of bounded length."""
    total = weights.agg(F.sum(weight)).first()[0] or 0
    least = max(heavy_rows, HEAVY_SHARE * total)
    found = weights.where(F.col(weight) > least).select(F.xxhash64(*key).alias("key")).distinct().collect()
    return [r["key"] for r in found]


def join_on_heavy_key(
    left: DataFrame, right: DataFrame, key: Sequence[str], heavy: Sequence[int], how: str = "inner"
) -> DataFrame:
    """``join_on_key`` that deals the rows of heavy keys to many tasks.

    ``right`` has few rows per key.  Rows of ``left`` under a heavy key get one of as many parts as there are
    shuffle partitions, and the rows of ``right`` a copy per part.  Without heavy keys the join is plain.
    """
    if not heavy:
        return join_on_key(left, right, key, how)
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_heavy = F.xxhash64(*key).isin(list(heavy))
    # The place in the scan: equal rows must not go to one part.
    part = F.pmod(F.monotonically_increasing_id(), F.lit(parts))
    dealt = left.withColumn("_part", F.when(is_heavy, part).otherwise(0))
    last = F.when(is_heavy, F.lit(parts - 1)).otherwise(0).cast("bigint")
    copied = right.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    return join_on_key(dealt, copied, [*key, "_part"], how).drop("_part")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys with more than one row, with their row count."""
    return df.groupBy(*key).agg(F.count("*").alias("row_count")).where("row_count > 1")


def duplicate_members(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows of all duplicate keys, each with the row count of its key."""
    return _members(df, key)[0]


def _members(
    df: DataFrame, key: Sequence[str], heavy_rows: int = HEAVY_ROWS
) -> tuple[DataFrame, list[int]]:
    """The rows of all duplicate keys, and the heavy keys.

    The duplicate keys are stored first: their size is then known when the
    join is planned, and as long as they are few the source is not shuffled.
    Their counts tell which of them are heavy.
    """
    keys = materialize(duplicate_keys(df, key), "keys")
    heavy = heavy_keys(keys, key, heavy_rows=heavy_rows)
    return join_on_heavy_key(df, keys, key, heavy).select(*df.columns, "row_count"), heavy


def stored_members(
    df: DataFrame, key: Sequence[str], heavy_rows: int = HEAVY_ROWS
) -> tuple[DataFrame, list[int]]:
    """The members as a stored table, read by all later steps; and the heavy keys."""
    members, heavy = _members(df, key, heavy_rows)
    return materialize(members, "members"), heavy


def exact_dedupe(df: DataFrame) -> DataFrame:
    """One row per distinct full row, with its number of copies."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("copies"))


def conflict_values(members: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The distinct text values of duplicate keys: key, column, value, rows."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    long_form = members.select(*key, F.inline(pairs))
    return long_form.groupBy(*key, "column", "value").agg(F.count("*").alias("rows"))


def conflict_verdicts(
    members: DataFrame, key: Sequence[str], columns: Sequence[str], in_scope: Column
) -> DataFrame:
    """One row per duplicate key.

    Columns: the key, ``row_count``, ``distinct_full_row_count``, ``conflicting``,
    ``contains_scope`` and ``changing``, the ``columns`` that differ.  Copies
    collapse before a key is gathered, and a key keeps counters and two values
    per column only.
    """
    row = [c for c in members.columns if c != "row_count"]
    rows = members.groupBy(*row).agg(
        F.count("*").alias("_copies"),
        F.bool_or(F.coalesce(in_scope, F.lit(False))).alias("_in_scope"),
    )
    # Structs order null before all values, so null is one more value.
    ends = [f(F.struct(c)).alias(f"_{side}_{c}") for c in columns for f, side in ((F.min, "low"), (F.max, "high"))]
    groups = rows.groupBy(*key).agg(
        F.sum("_copies").cast("bigint").alias("row_count"),
        F.count("*").alias("distinct_full_row_count"),
        F.bool_or("_in_scope").alias("contains_scope"),
        *ends,
    )
    differs = [F.when(~F.col(f"_low_{c}").eqNullSafe(F.col(f"_high_{c}")), F.lit(c)) for c in columns]
    return groups.select(
        *key,
        "row_count",
        "distinct_full_row_count",
        (F.col("distinct_full_row_count") > 1).alias("conflicting"),
        "contains_scope",
        F.array_compact(F.array(*differs)).alias("changing"),
    )


def key_conflicts(
    df: DataFrame,
    key: Sequence[str],
    in_scope: Column,
    spec: FactSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Every duplicate key with its verdict, and each scope and entity name it has.

    One row per key, column and distinct name; ``rows`` have the name.
    """
    names = (spec.scope_name, spec.entity_name)
    members, heavy = stored_members(df, key)
    verdicts = conflict_verdicts(members, key, names, in_scope)
    found = join_on_heavy_key(conflict_values(members, key, names), verdicts, key, heavy)
    return found.select(*key, "row_count", "conflicting", "contains_scope", "column", "value", "rows")


def conflict_detail(
    df: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    in_scope: Column,
) -> DataFrame:
    """Verdict per duplicate key, the columns that differ, and every value of ``columns``.

    One row per key, column and distinct value.
    """
    members, heavy = stored_members(df, key)
    verdicts = conflict_verdicts(members, key, columns, in_scope)
    found = join_on_heavy_key(conflict_values(members, key, columns), verdicts, key, heavy)
    return found.select(
        *key,
        "row_count",
        "distinct_full_row_count",
        (~F.col("conflicting")).alias("exact_duplicate_group"),
        F.col("conflicting").alias("conflicting_group"),
        F.array_join("changing", LIST_SEPARATOR).alias("changing_columns"),
        "contains_scope",
        "column",
        "value",
        "rows",
    )


def conflicting_keys(members: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys whose rows differ: their smallest and largest row are not the same.

    Two rows per key are all that is kept and shuffled, however many it has.
    """
    row = F.struct(*members.columns)
    ends = members.groupBy(*key).agg(F.min(row).alias("_low"), F.max(row).alias("_high"))
    return ends.where(~F.col("_low").eqNullSafe(F.col("_high"))).select(*key)


def conflict_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows of conflicting keys."""
    members, heavy = stored_members(df, key)
    members = members.select(*df.columns)
    keys = conflicting_keys(members, key)
    return join_on_heavy_key(members, keys, key, heavy, "left_semi").select(*df.columns)


def dedupe_analysis(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """What an exact dedupe would and would not solve; one row.

    Rows outside duplicate keys only enter the row count, which reads no column.
    """
    by_key = (
        exact_dedupe(duplicate_members(df, key).drop("row_count"))
        .groupBy(*key)
        .agg(F.sum("copies").alias("rows"), F.count("*").alias("distinct_rows"))
    )
    conflicting = F.col("distinct_rows") > 1

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")

    found = by_key.agg(
        F.count("*").alias("duplicate_groups"),
        total(F.col("rows")).alias("duplicate_rows"),
        F.count_if(conflicting).alias("conflicting_groups"),
        total(F.when(conflicting, F.col("rows"))).alias("conflicting_rows"),
        F.count_if(~conflicting).alias("exact_groups"),
        total(F.when(~conflicting, F.col("rows"))).alias("exact_rows"),
        total(F.col("rows") - F.col("distinct_rows")).alias("_dropped"),
        total(F.when(conflicting, F.col("distinct_rows"))).alias("remaining_duplicate_rows"),
    ).withColumn("source_rows", df.agg(F.count("*")).scalar())
    return found.select(
        "source_rows",
        "duplicate_groups",
        "duplicate_rows",
        "conflicting_groups",
        "conflicting_rows",
        "exact_groups",
        "exact_rows",
        (F.col("source_rows") - F.col("_dropped")).alias("rows_after_dedupe"),
        "remaining_duplicate_rows",
        (F.col("remaining_duplicate_rows") == 0).alias("dedupe_resolves_all"),
    )


def _duplicate_counts(df: DataFrame, key: Sequence[str], per_key: Sequence[str]) -> DataFrame:
    """Rows of duplicate keys per key and scope, with the verdict on the key.

    The window only meets one row per key and scope.
    """
    row = F.struct(*df.columns)
    parts = duplicate_members(df, key).groupBy(*per_key).agg(
        F.count("*").alias("rows"), F.min(row).alias("low"), F.max(row).alias("high")
    )
    of_key = W.partitionBy(*key)
    exact = F.min("low").over(of_key).eqNullSafe(F.max("high").over(of_key))
    return parts.select(*per_key, "rows", (~exact).alias("conflicting"))


def scope_qualification(
    df: DataFrame,
    key: Sequence[str],
    scope: str,
    entity_code: str,
    total: str,
    snapshot_cols: Sequence[str] = (),
) -> DataFrame:
    """Which scopes are free of conflicting keys; one row per scope.

    ``qualified`` is the verdict on conflicts alone; ``unique_in_scope`` adds
    that no key repeats inside the scope, not even as an exact copy.  A scope
    passes the release gate with both.  Snapshots are judged one by one.
    """
    scopes = [*snapshot_cols, scope]
    per_snapshot_key = list(dict.fromkeys([*snapshot_cols, *key]))
    per_key = list(dict.fromkeys([*key, *scopes]))

    # Only duplicate keys can conflict or repeat in a scope.
    parts = materialize(_duplicate_counts(df, key, per_key), "duplicates")
    repeated = F.when(F.col("rows") > 1, F.col("rows"))
    by_scope = parts.groupBy(*scopes).agg(
        F.count_if("conflicting").alias("scope_conflicting_groups"),
        F.sum(repeated).alias("scope_duplicate_rows"),
    )
    # Entities are summed first, so a large scope is spread over its entities
    # before its own row is built.
    entities = df.groupBy(*scopes, entity_code).agg(
        F.count("*").alias("rows"), F.sum(total).alias("total")
    )
    sizes = materialize(
        entities.groupBy(*scopes).agg(
            F.sum("rows").cast("bigint").alias("scope_rows"),
            F.count(entity_code).alias("scope_entities"),
            F.sum("total").alias("scope_total"),
        ),
        "scope-sizes",
    )
    found = join_on_key(sizes, by_scope, scopes, "left")

    bad_keys = parts.where("conflicting").groupBy(*per_snapshot_key).agg(F.sum("rows").alias("rows"))
    conflicts = bad_keys.groupBy(*snapshot_cols).agg(
        F.count("*").alias("national_conflicting_groups"),
        F.sum("rows").alias("national_conflicting_rows"),
    )
    rows = sizes.groupBy(*snapshot_cols).agg(F.sum("scope_rows").alias("national_rows"))
    if snapshot_cols:
        found = join_on_key(found, rows, snapshot_cols)
        found = join_on_key(found, conflicts, snapshot_cols, "left")
    else:
        found = found.withColumns(
            {
                name: table.select(name).scalar()
                for table in (rows, conflicts)
                for name in table.columns
            }
        )
    counts = (
        "national_conflicting_groups",
        "national_conflicting_rows",
        "scope_conflicting_groups",
        "scope_duplicate_rows",
    )
    whole = found.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in counts})
    return whole.select(
        *scopes,
        "national_rows",
        *counts[:2],
        "scope_rows",
        "scope_entities",
        *counts[2:],
        "scope_total",
        (F.col("scope_conflicting_groups") == 0).alias("qualified"),
        (F.col("scope_duplicate_rows") == 0).alias("unique_in_scope"),
    )
