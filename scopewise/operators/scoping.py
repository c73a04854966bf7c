"""From raw rows to one typed, scoped fact: the two validation policies.

*Validate then filter* applies the full suite, key uniqueness included, to all
rows; a conflict anywhere rejects the input.  *Filter then validate* applies
row rules to all rows and uniqueness inside the scope only.  The policies
accept different inputs, so the filter is never moved across the check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scopewise.functions.text import scope_key, scope_label, strip_text
from scopewise.operators.quality import (
    Suite,
    broken_rules,
    enforce,
    lenient_row_checks,
    numeric_helpers,
    parse_checks,
    require_columns,
    rule_report,
    strict_checks,
)
from scopewise.session import materialize
from scopewise.spec import DEFAULT_SPEC, DataQualityError, FactSpec


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def project_required(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Required columns in their fixed order; other columns are dropped."""
    trimmed = trim_headers(df)
    wanted = [*spec.snapshot_cols, *spec.required]
    require_columns(trimmed, wanted)
    return trimmed.select(*wanted)


def typed_fact(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Trim text and parse counts; a count that does not parse becomes null.

    A spec grouped by scope key gets that key as an extra column.
    """
    parsed = project_required(df, spec)
    for step in numeric_helpers(spec.count_cols):
        parsed = parsed.withColumns(step)
    return parsed.select(
        *spec.snapshot_cols,
        *[strip_text(F.col(c).cast("string")).alias(c) for c in spec.text_cols],
        *[F.col(f"_count_{c}").alias(c) for c in spec.count_cols],
        *[scope_key(F.col(spec.scope_name)).alias(c) for c in spec.extra_cols],
    )


def _load(raw: DataFrame, spec: FactSpec, with_key: bool, precise: Suite) -> DataFrame:
    """Parse the source once, store it, and check what was stored.

    Only a broken source is parsed again: the ``precise`` rules read its text
    and tell why a value did not parse.
    """
    required = project_required(raw, spec)
    fact = materialize(typed_fact(required, spec), "fact")
    messages = broken_rules(fact, strict_checks(spec, with_key))
    if messages:
        enforce(required, precise)
        raise DataQualityError(messages[0])
    return fact


def load_fact(raw: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Strict load: parse rules first, then all others, key uniqueness included."""
    return _load(raw, spec, True, parse_checks(spec))


def load_lenient_fact(raw: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Lenient load: row rules only, keys may repeat."""
    return _load(raw, spec, False, lenient_row_checks(spec))


def in_scope(target: str, spec: FactSpec = DEFAULT_SPEC) -> Column:
    return scope_key(F.col(spec.scope_name)) == scope_key(F.lit(target))


def canonical_scope(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    return df.withColumn(spec.scope_name, scope_label(F.col(spec.scope_name)))


def filter_scope(df: DataFrame, target: str, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows of one scope under its canonical label."""
    return canonical_scope(df.where(in_scope(target, spec)), spec)


def stored_scope(df: DataFrame, target: str, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """One scope of a stored fact with canonical labels.

    Compares the plain column, so only the folder of the scope is read.
    """
    return df.where(F.col(spec.scope_name) == target.strip().upper())


def validate_then_filter(df: DataFrame, target: str, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    enforce(df, strict_checks(spec))
    scoped = filter_scope(df, target, spec)
    if scoped.isEmpty():
        raise DataQualityError(f"No {target} records were found.")
    return scoped


def filter_then_validate(raw: DataFrame, target: str, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    scoped = load_lenient_fact(raw, spec).where(in_scope(target, spec))
    if scoped.isEmpty():
        raise DataQualityError(f"The source contains no {target} records.")
    enforce(scoped, strict_checks(spec))
    return scoped


# --- the same verdicts for all scopes at once -----------------------------------


def scopes_after_full_check(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Validate-then-filter for every scope: any violation rejects them all."""
    report = rule_report(df, strict_checks(spec))
    broken = report.agg(F.coalesce(F.sum("violations"), F.lit(0)).alias("n"))
    scopes = df.groupBy(*spec.scope_keys).agg(F.count("*").alias("scope_rows"))
    return scopes.withColumn("violations", broken.scalar().cast("bigint")).withColumn(
        "accepted", F.col("violations") == 0
    )


def scopes_after_scoped_check(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Filter-then-validate for every scope: only its own repeats reject it.

    Row rules still apply to all rows.  They are counted per scope and key, so
    one scan serves them, the sizes and the repeats; the sum over all scopes
    meets one row per scope.
    """
    rules = [c.broken for c in strict_checks(spec, with_key=False) if c.broken is not None]
    broken = sum((F.count_if(rule) for rule in rules[1:]), F.count_if(rules[0]))
    keys = list(dict.fromkeys([*spec.scope_keys, *spec.key]))
    copies = df.groupBy(*keys).agg(F.count("*").alias("n"), broken.alias("broken"))
    scopes = copies.groupBy(*spec.scope_keys).agg(
        F.sum("n").cast("bigint").alias("scope_rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
        .cast("bigint")
        .alias("duplicate_rows"),
        F.sum("broken").cast("bigint").alias("_broken"),
    )
    stored = materialize(scopes, "scopes")
    everywhere = stored.agg(F.coalesce(F.sum("_broken"), F.lit(0))).scalar().cast("bigint")
    return stored.drop("_broken").withColumn("row_violations", everywhere).withColumn(
        "accepted", (F.col("row_violations") == 0) & (F.col("duplicate_rows") == 0)
    )
