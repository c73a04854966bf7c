"""Rules for a source registry, reported as violation rows.

Every rule contributes rows (rule, row_no, key, detail), so the report of a
registry of any size stays a table.  ``row_no`` is 0 for rules about a value
rather than a row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scopewise.functions.text import is_blank, strip_text
from scopewise.operators.quality import require_columns

# The allowed states of a source and the fields an approval needs.
PRIORITIES = ("primary", "secondary", "optional")
STATUSES = ("pending_validation", "approved", "rejected", "superseded")
APPROVAL_FIELDS = (
    "publisher",
    "dataset_name",
    "source_url",
    "access_date",
    "source_as_of_date",
    "licence",
    "fields_used",
)


@dataclass(frozen=True)
class RegistrySpec:
    """Which columns and values play which part in a registry."""

    source_id: str = "source_id"
    priority: str = "priority"
    status: str = "status"
    row_no: str = "row_no"
    priorities: tuple[str, ...] = PRIORITIES
    statuses: tuple[str, ...] = STATUSES
    primary: str = "primary"
    approved: str = "approved"
    approval_fields: tuple[str, ...] = APPROVAL_FIELDS


def approved_sources(df: DataFrame, spec: RegistrySpec = RegistrySpec()) -> DataFrame:
    return df.where(F.col(spec.status) == spec.approved)


def unapproved_primaries(df: DataFrame, spec: RegistrySpec = RegistrySpec()) -> DataFrame:
    primary = F.col(spec.priority) == spec.primary
    return df.where(primary & ~F.col(spec.status).eqNullSafe(F.lit(spec.approved)))


def registry_violations(
    df: DataFrame, spec: RegistrySpec = RegistrySpec(), strict: bool = False
) -> DataFrame:
    """All violations of all rules."""
    require_columns(
        df, [spec.source_id, spec.priority, spec.status, spec.row_no, *spec.approval_fields]
    )
    key = F.col(spec.source_id)
    parts = [
        _row_rule(df.where(is_blank(key)), "blank_id", spec, F.lit("")),
        df.groupBy(spec.source_id)
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select(*_line("duplicate_id", F.lit(0), key, F.lit(""))),
        _value_rule(df, "invalid_priority", spec.priority, spec.priorities),
        _value_rule(df, "invalid_status", spec.status, spec.statuses),
        _incomplete_approvals(df, spec),
    ]
    if strict:
        parts.append(
            _row_rule(unapproved_primaries(df, spec), "unapproved_primary", spec, F.col(spec.status))
        )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def _line(rule: str, row_no: Column, key: Column, detail: Column) -> list[Column]:
    return [
        F.lit(rule).alias("rule"),
        row_no.cast("bigint").alias("row_no"),
        F.coalesce(key.cast("string"), F.lit("")).alias("key"),
        detail.alias("detail"),
    ]


def _row_rule(rows: DataFrame, rule: str, spec: RegistrySpec, detail: Column) -> DataFrame:
    return rows.select(*_line(rule, F.col(spec.row_no), F.col(spec.source_id), detail))


def _value_rule(df: DataFrame, rule: str, column: str, allowed: Sequence[str]) -> DataFrame:
    values = df.select(F.coalesce(strip_text(F.col(column)), F.lit("")).alias("value"))
    outside = values.where(~F.col("value").isin(*allowed)).distinct()
    return outside.select(*_line(rule, F.lit(0), F.col("value"), F.lit("")))


def _incomplete_approvals(df: DataFrame, spec: RegistrySpec) -> DataFrame:
    missing = F.array_compact(
        F.array(*[F.when(is_blank(F.col(c)), F.lit(c)) for c in spec.approval_fields])
    )
    rows = approved_sources(df, spec).withColumn("_missing", missing).where(F.size("_missing") > 0)
    return _row_rule(rows, "incomplete_approval", spec, F.array_join("_missing", ", "))


def registry_messages(violations: DataFrame) -> DataFrame:
    """The violations with a readable ``message`` each."""
    row_no, key, detail = F.col("row_no"), F.col("key"), F.col("detail")
    texts = {
        "blank_id": F.concat(F.lit("Row "), row_no, F.lit(" names no source.")),
        "duplicate_id": F.concat(F.lit("Several rows are called "), key, F.lit(".")),
        "invalid_priority": F.concat(F.lit("Unknown priority: "), key),
        "invalid_status": F.concat(F.lit("Unknown status: "), key),
        "incomplete_approval": F.concat(key, F.lit(" (row "), row_no, F.lit(") was approved without "), detail),
        "unapproved_primary": F.concat(key, F.lit(" is primary but its status is "), detail),
    }
    message = F.lit(None).cast("string")
    for rule, text in texts.items():
        message = F.when(F.col("rule") == rule, text).otherwise(message)
    return violations.withColumn("message", message)
