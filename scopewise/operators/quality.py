"""Data-quality rules.

A row rule is a boolean column that is true on a violation.  A report counts all
rules of a suite in one scan; a suite with unique keys counts them per key
first, for all its keys at once, so that uniqueness needs no scan of its own.  A report lists one line per
check in the order in which the checks apply; ``enforce`` raises for the first
broken one.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scopewise.functions.numeric import (
    count_of,
    is_fractional,
    number_of,
    parse_number,
    percentage,
    row_sum,
)
from scopewise.functions.text import is_blank, scope_key, strip_text
from scopewise.operators.metrics import scope_totals_per_row
from scopewise.spec import (
    ABOVE_100_TEXT,
    CONTRIBUTION_TOLERANCE,
    DEFAULT_SPEC,
    DUPLICATE_ROWS_TEXT,
    MISSING_COLUMNS_TEXT,
    MUST_EQUAL_TEXT,
    NEGATIVE_TEXT,
    ONLY_SCOPE_TEXT,
    RANK_CUTOFF,
    ROW_SHARE_TOLERANCE,
    SHARE_VALUE_TOLERANCE,
    TOP_FLAGS_TEXT,
    DataQualityError,
    FactSpec,
)


@dataclass(frozen=True)
class Check:
    """One line of a rule report.

    ``broken`` is true for a row that breaks the rule; ``key`` instead names the
    columns of a uniqueness check.  A check with neither asks for rows at all.
    ``message`` may use ``{n}``.
    """

    rule: str
    subject: str
    message: str
    broken: Column | None = None
    key: tuple[str, ...] = ()


@dataclass(frozen=True)
class Suite:
    """Checks and the helper columns they read, computed once per row.

    Each step of ``helpers`` may use the columns of the steps before it.
    """

    checks: tuple[Check, ...]
    helpers: tuple[dict[str, Column], ...] = ()

    def prepare(self, df: DataFrame) -> DataFrame:
        for step in self.helpers:
            df = df.withColumns(step)
        return df


def as_suite(checks: Suite | Sequence[Check]) -> Suite:
    return checks if isinstance(checks, Suite) else Suite(tuple(checks))


def violations(condition: Column) -> Column:
    """Rows where the condition holds; an unknown condition is no violation."""
    return F.count_if(condition)


# --- schema rules: decided on the driver, no job ------------------------------


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise DataQualityError(f"{MISSING_COLUMNS_TEXT}: " + ", ".join(missing))


def prohibited_columns(df: DataFrame, prohibited: Iterable[str]) -> list[str]:
    """Columns that must not leave the house, compared case-insensitively."""
    banned = {name.casefold() for name in prohibited}
    return sorted(name for name in df.columns if name.strip().casefold() in banned)


def require_no_prohibited(df: DataFrame, prohibited: Iterable[str]) -> None:
    found = prohibited_columns(df, prohibited)
    if found:
        raise DataQualityError("These columns must not be published: " + ", ".join(found))


def not_allowed(requested: Iterable[str], allowed: Iterable[str]) -> list[str]:
    return sorted(set(requested) - set(allowed))


def require_allowed(requested: Iterable[str], allowed: Iterable[str], dataset: str) -> None:
    unknown = not_allowed(requested, allowed)
    if unknown:
        raise DataQualityError(f"{dataset} does not offer: " + ", ".join(unknown))


# --- building blocks -----------------------------------------------------------


def non_empty() -> Check:
    return Check(
        "non_empty",
        "*",
        "There are no rows to work on.",
    )


def no_nulls(column: str) -> Check:
    return Check(
        "no_nulls",
        column,
        f"{column!r} is missing in {{n}} rows.",
        F.col(column).isNull(),
    )


def not_blank(column: str) -> Check:
    return Check(
        "not_blank",
        column,
        f"{column!r} is blank in {{n}} rows.",
        is_blank(F.col(column)),
    )


def numeric(column: str) -> Check:
    """Text that is no number; a null is not a violation of this rule."""
    text = F.col(column).cast("string")
    return Check(
        "numeric",
        column,
        f"{column!r} is no number in {{n}} rows.",
        text.isNotNull() & parse_number(text).isNull(),
    )


def numeric_helpers(columns: Sequence[str]) -> tuple[dict[str, Column], ...]:
    """Trimmed text of each column, then its number and its whole value."""
    text = {f"_text_{c}": strip_text(F.col(c).cast("string")) for c in columns}
    numbers = {f"_number_{c}": number_of(F.col(f"_text_{c}")) for c in columns}
    counts = {
        f"_count_{c}": count_of(F.col(f"_text_{c}"), F.col(f"_number_{c}")) for c in columns
    }
    return text, numbers, counts


def nonnegative(column: str) -> Check:
    return Check(
        "nonnegative",
        column,
        f"{column!r} has {{n}} {NEGATIVE_TEXT}.",
        F.col(column).try_cast("double") < 0,
    )


def unique(key: Sequence[str]) -> Check:
    name = ", ".join(key)
    return Check("unique", name, f"{DUPLICATE_ROWS_TEXT}: {{n}} rows share ({name}).", key=tuple(key))


def sum_identity(spec: FactSpec) -> Check:
    parts = " + ".join(spec.categories)
    return Check(
        "sum_identity",
        spec.total,
        f"{spec.total!r} differs from {parts} in {{n}} rows.",
        F.col(spec.total) != row_sum(spec.categories),
    )


# --- suites -------------------------------------------------------------------


def basic_checks(
    non_null: Sequence[str] = (),
    key: Sequence[str] = (),
    nonnegative_cols: Sequence[str] = (),
    further_keys: Sequence[Sequence[str]] = (),
) -> list[Check]:
    """Rows present, no nulls, unique keys, numeric and not negative."""
    checks = [non_empty(), *map(no_nulls, non_null)]
    checks += [unique(columns) for columns in (key, *further_keys) if columns]
    for name in nonnegative_cols:
        checks += [numeric(name), nonnegative(name)]
    return checks


def strict_checks(spec: FactSpec = DEFAULT_SPEC, with_key: bool = True) -> list[Check]:
    """The full suite for a typed fact, in the order of its errors."""
    checks = [non_empty(), *map(not_blank, spec.text_cols)]
    for name in spec.count_cols:
        checks += [_missing_count(name), nonnegative(name)]
    if with_key:
        checks.append(unique(spec.key))
    return [*checks, sum_identity(spec)]


def _missing_count(column: str) -> Check:
    return Check(
        "numeric",
        column,
        f"{column!r} is no number in {{n}} rows.",
        F.col(column).isNull(),
    )


def lenient_row_checks(spec: FactSpec = DEFAULT_SPEC) -> Suite:
    """Row rules on text or numbers, without key uniqueness.

    Checks per column, in this order: null and blank text; then nonnumeric,
    negative and fractional counts; then the total.
    """
    checks = [non_empty()]
    for name in spec.text_cols:
        col = F.col(name)
        checks += [
            Check("null_text", name, f"{name!r} is missing in {{n}} rows.", col.isNull()),
            Check("blank_text", name, f"{name!r} is blank in {{n}} rows.", col.isNotNull() & is_blank(col)),
        ]
    for name in spec.count_cols:
        checks += numeric_class_checks(name, F.col(f"_number_{name}"))
    expected = row_sum([f"_count_{name}" for name in spec.categories])
    checks.append(
        Check(
            "sum_identity",
            spec.total,
            f"{spec.total!r} {MUST_EQUAL_TEXT} " + " + ".join(spec.categories) + "; {n} rows differ.",
            F.col(f"_count_{spec.total}") != expected,
        )
    )
    return Suite(tuple(checks), numeric_helpers(spec.count_cols))


def parse_checks(spec: FactSpec = DEFAULT_SPEC) -> Suite:
    """Rules on the text of the counts, before it is parsed."""
    checks = []
    for name in spec.count_cols:
        number = F.col(f"_number_{name}")
        checks += [
            Check(
                "numeric",
                name,
                f"{name!r} is no number in {{n}} rows.",
                number.isNull(),
            ),
            Check(
                "whole",
                name,
                f"{name!r} has a fraction in {{n}} rows.",
                is_fractional(number),
            ),
        ]
    return Suite(tuple(checks), numeric_helpers(spec.count_cols))


def numeric_class_checks(name: str, number: Column) -> list[Check]:
    """Nonnumeric, negative and fractional values of one parsed column."""
    return [
        Check("nonnumeric", name, f"{name!r} is no number in {{n}} rows.", number.isNull()),
        Check("negative", name, f"{name!r} has {{n}} {NEGATIVE_TEXT}.", number < 0),
        Check("fractional", name, f"{name!r} has a fraction in {{n}} rows.", is_fractional(number)),
    ]


# --- running a suite ----------------------------------------------------------


def count_duplicate_rows(df: DataFrame, key: Sequence[str], name: str = "duplicate_rows") -> DataFrame:
    """Rows that share their key with another row; every member counts."""
    groups = df.groupBy(*key).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias(name))


def rule_report(df: DataFrame, suite: Suite | Sequence[Check]) -> DataFrame:
    """One row per check: ordinal, rule, subject, violations.

    One scan and one shuffle of counters for all rules: rows are grouped by
    every unique key of the suite at once, as grouping sets.
    """
    suite = as_suite(suite)
    numbered = list(enumerate(suite.checks, 1))
    row_rules = [(i, c) for i, c in numbered if c.broken is not None]
    keys = list(dict.fromkeys(tuple(sorted(set(c.key))) for c in suite.checks if c.key)) or [()]
    prepared = suite.prepare(df)
    if len(keys) == 1:
        groups, key_number = prepared.groupBy(*keys[0]), F.lit(0)
    else:
        columns = sorted(set().union(*keys))
        groups = prepared.groupingSets([list(map(F.col, key)) for key in keys], *map(F.col, columns))
        ids = [sum(1 << i for i, c in enumerate(reversed(columns)) if c not in key) for key in keys]
        key_number = reduce(
            lambda rest, n: F.when(F.grouping_id() == ids[n], n).otherwise(rest), range(1, len(keys)), F.lit(0)
        )
    counted = groups.agg(
        key_number.alias("_key"),
        F.count("*").alias("rows"),
        *[violations(c.broken).alias(f"c{i}") for i, c in row_rules],
    )

    def summed(value: Column, key: int, name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_key") == key, value)), F.lit(0)).alias(name)

    rows = F.col("rows")
    totals = counted.agg(
        summed(rows, 0, "rows"),
        *[summed(F.when(rows > 1, rows), n, f"shared{n}") for n in range(len(keys))],
        *[summed(F.col(f"c{i}"), 0, f"c{i}") for i, _ in row_rules],
    )

    def count(i: int, check: Check) -> Column:
        if check.broken is not None:
            return F.col(f"c{i}")
        if check.key:
            return F.col(f"shared{keys.index(tuple(sorted(set(check.key))))}")
        return (rows == 0).cast("bigint")

    return totals.select(F.inline(F.array(*[_line(i, c, count(i, c)) for i, c in numbered])))


def _line(ordinal: int, check: Check, count: Column) -> Column:
    return F.struct(
        F.lit(ordinal).alias("ordinal"),
        F.lit(check.rule).alias("rule"),
        F.lit(check.subject).alias("subject"),
        count.cast("bigint").alias("violations"),
    )


def broken_rules(df: DataFrame, suite: Suite | Sequence[Check]) -> list[str]:
    """Messages of all broken checks in order; the report has one row per check."""
    checks = as_suite(suite).checks
    rows = rule_report(df, suite).where("violations > 0").orderBy("ordinal").collect()
    return [checks[r["ordinal"] - 1].message.format(n=r["violations"]) for r in rows]


def enforce(df: DataFrame, suite: Suite | Sequence[Check]) -> None:
    """Raise for the first broken check."""
    messages = broken_rules(df, suite)
    if messages:
        raise DataQualityError(messages[0])


# --- scope rules on metrics ---------------------------------------------------


def single_scope(df: DataFrame, target: str, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Whether the table holds rows of the target scope and of no other."""
    wanted = scope_key(F.lit(target))
    return df.agg(
        F.count("*").alias("rows"),
        violations(scope_key(F.col(spec.scope_name)) != wanted).alias("other_scope_rows"),
    ).withColumn("single_scope", (F.col("rows") > 0) & (F.col("other_scope_rows") == 0))


def require_single_scope(df: DataFrame, target: str, spec: FactSpec = DEFAULT_SPEC) -> None:
    if not single_scope(df, target, spec).first()["single_scope"]:
        raise DataQualityError(f"These metrics need {target}{ONLY_SCOPE_TEXT} rows.")


def rank_domain(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Both rank columns per scope: ``complete`` if they cover 1..n once each.

    The columns become rows, so that both are judged in one grouping.
    """
    ranks = F.array(
        *[
            F.struct(F.lit(name).alias("rank_column"), F.col(name).alias("rank"))
            for name in ("rank_total", "rank_total_ascending")
        ]
    )
    keys = [*spec.scope_keys, "rank_column"]
    per_value = (
        df.select(*spec.scope_keys, F.inline(ranks)).groupBy(*keys, "rank").agg(F.count("*").alias("_copies"))
    )
    shape = per_value.groupBy(*keys).agg(
        F.sum("_copies").cast("bigint").alias("rows"),
        F.count("rank").alias("_distinct"),
        F.min("rank").alias("_low"),
        F.max("rank").alias("_high"),
    )
    whole = (F.col("_low") == 1) & (F.col("_high") == F.col("rows")) & (F.col("_distinct") == F.col("rows"))
    return shape.select(*keys, "rows", F.coalesce(whole, F.lit(False)).alias("complete"))


def contribution_tolerance(rows: Column, total: Column) -> Column:
    """Every row adds up to half a unit of the last digit, so large scopes need more room.

    Shares of an empty scope are exactly zero, so it needs none.
    """
    room = F.greatest(F.lit(CONTRIBUTION_TOLERANCE), rows * F.lit(5e-5))
    return F.when(total == 0, F.lit(ROW_SHARE_TOLERANCE)).otherwise(room)


def contribution_off(spec: FactSpec = DEFAULT_SPEC) -> Column:
    """Whether the contributions of a group miss 100, or 0 for an empty scope."""
    total = F.sum(spec.total)
    expected = F.when(total == 0, F.lit(0.0)).otherwise(F.lit(100.0))
    return F.abs(F.sum("scope_total_share_pct") - expected) > contribution_tolerance(F.count("*"), total)


def metric_checks_per_scope(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Counts of broken metric rules, one row per scope, in one pass."""
    share_sum = row_sum(spec.share_cols)
    aggs = [
        violations((F.col(p) < 0) | F.col(p).isNull()).alias(f"negative_{p}") for p in spec.pct_cols
    ]
    aggs += [violations(F.col(p) > 100).alias(f"above_100_{p}") for p in spec.pct_cols]
    return df.groupBy(*spec.scope_keys).agg(
        F.count("*").alias("rows"),
        *aggs,
        violations(
            (F.col(spec.total) > 0) & (F.abs(share_sum - 100) > ROW_SHARE_TOLERANCE)
        ).alias("share_sum_off"),
        violations(
            (F.col(spec.total) == 0) & (F.abs(share_sum) > ROW_SHARE_TOLERANCE)
        ).alias("zero_row_shares"),
        F.coalesce(contribution_off(spec), F.lit(False)).cast("bigint").alias("contribution_off"),
        violations(
            ~F.coalesce(F.col("dominant_category").isin(*spec.dominant_labels), F.lit(False))
        ).alias("bad_category"),
        violations(
            ~F.col("top_10_flag").eqNullSafe(F.col("rank_total") <= RANK_CUTOFF)
        ).alias("bad_top_flag"),
        violations(
            ~F.col("bottom_10_flag").eqNullSafe(F.col("rank_total_ascending") <= RANK_CUTOFF)
        ).alias("bad_bottom_flag"),
    )


def contribution_values(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows per scope whose contribution is not the rounded true value.

    The sum alone says little about a scope of many rows.
    """
    exact = percentage(F.col(spec.total), F.col("scope_total"))
    off = F.abs(F.col("scope_total_share_pct") - exact) > SHARE_VALUE_TOLERANCE
    return (
        scope_totals_per_row(df, spec)
        .groupBy(*spec.scope_keys)
        .agg(F.count("*").alias("rows"), violations(off).alias("share_value_off"))
    )


def _metric_messages(spec: FactSpec) -> list[tuple[str, str]]:
    return [
        *((f"negative_{p}", f"{p!r} is missing or below 0.") for p in spec.pct_cols),
        ("bad_rank_total", "rank_total does not count the entities from 1."),
        ("bad_rank_total_ascending", "rank_total_ascending does not count the entities from 1."),
        *((f"above_100_{p}", f"{p!r} is {ABOVE_100_TEXT}.") for p in spec.pct_cols),
        ("share_sum_off", "The category shares of an entity do not add up to 100."),
        ("zero_row_shares", "An entity without registrations has category shares."),
        ("contribution_off", "The contributions of a scope do not add up."),
        ("share_value_off", "A contribution differs from total / scope total."),
        ("bad_category", "The dominant category has an unknown label."),
        ("bad_top_flag", f"{TOP_FLAGS_TEXT} contradict the ranks."),
        ("bad_bottom_flag", "Bottom-10 flags contradict the ranks."),
    ]


def metric_report(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Scopes that break each metric rule: ordinal, rule, scopes."""
    messages = _metric_messages(spec)
    per_scope = metric_checks_per_scope(df, spec)
    sums = per_scope.agg(
        *[
            violations(F.col(rule) > 0).alias(rule)
            for rule, _ in messages
            if rule in per_scope.columns
        ]
    )
    ranks = rank_domain(df, spec).agg(
        *[
            violations((F.col("rank_column") == r) & ~F.col("complete")).alias(f"bad_{r}")
            for r in ("rank_total", "rank_total_ascending")
        ]
    )
    values = contribution_values(df, spec).agg(
        violations(F.col("share_value_off") > 0).alias("share_value_off")
    )
    order = {rule: i for i, (rule, _) in enumerate(messages, 1)}
    lines = [
        table.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(order[c]).alias("ordinal"),
                            F.lit(c).alias("rule"),
                            F.col(c).alias("scopes"),
                        )
                        for c in table.columns
                    ]
                )
            )
        )
        for table in (sums, ranks, values)
    ]
    return reduce(DataFrame.unionByName, lines)


def enforce_metrics(df: DataFrame, spec: FactSpec = DEFAULT_SPEC, with_base: bool = True) -> None:
    """The fact suite, then every metric rule; raises for the first broken one.

    ``with_base=False`` serves metrics of a fact that was checked before.
    """
    require_columns(df, [*spec.required, *spec.derived])
    if with_base:
        enforce(df, strict_checks(spec))
    messages = dict(_metric_messages(spec))
    broken = metric_report(df, spec).where("scopes > 0").orderBy("ordinal").first()
    if broken:
        raise DataQualityError(f"{messages[broken['rule']]} ({broken['scopes']} scopes)")
