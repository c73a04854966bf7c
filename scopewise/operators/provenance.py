"""Records of where a result comes from and what was checked."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scopewise.operators.summaries import (
    dataset_summary,
    documented_summary,
    kpi_extremes,
    mean_share_sum,
)
from scopewise.spec import DEFAULT_SPEC, FactSpec

SCHEMA_VERSION = "1.0"

@dataclass(frozen=True)
class Source:
    """Identity of a source.

    The as-of date may be unknown; the retrieval date never stands in for it.
    """

    source_id: str
    file_name: str
    sha256: str | None = None
    as_of_date: str | None = None
    retrieval_date: str | None = None
    qualification_status: str | None = None
    source_url: str | None = None
    licence: str | None = None


def generated_at() -> Column:
    """Start of the query in UTC, to the second, with offset."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _source_cols(source: Source) -> list[Column]:
    return [
        F.lit(source.source_id).cast("string").alias("source_id"),
        F.lit(source.file_name).cast("string").alias("source_file_name"),
        F.lit(source.sha256).cast("string").alias("source_sha256"),
        F.lit(source.as_of_date).cast("string").alias("source_as_of_date"),
    ]


def _qualification_cols(source: Source) -> list[Column]:
    names = ("retrieval_date", "qualification_status", "source_url", "licence")
    return [F.lit(getattr(source, n)).cast("string").alias(n) for n in names]


def provenance(
    df: DataFrame,
    source: Source,
    output_name: str,
    spec: FactSpec = DEFAULT_SPEC,
    steps: Sequence[str] = (),
    limitations: Sequence[str] = (),
) -> DataFrame:
    """Provenance record of every scope of a dataset.

    ``steps`` are those that the caller ran, ``limitations`` those that the
    owner of the source states.
    """
    derived = [c for c in spec.derived if c in df.columns]
    return dataset_summary(df, spec).select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        *_source_cols(source),
        generated_at().alias("generated_at_utc"),
        F.lit(output_name).alias("output_name"),
        _texts(df.columns).alias("columns"),
        _texts(derived).alias("derived_columns"),
        *spec.scope_keys,
        "row_count",
        "entity_count",
        *[f"{c}_total" for c in (*spec.categories, spec.total)],
        _texts(steps).alias("transformations"),
        _texts(limitations).alias("limitations"),
    )


def qualified_provenance(
    df: DataFrame,
    source: Source,
    output_name: str,
    spec: FactSpec = DEFAULT_SPEC,
    steps: Sequence[str] = (),
    limitations: Sequence[str] = (),
) -> DataFrame:
    """Provenance plus the qualification of the source."""
    record = provenance(df, source, output_name, spec, steps, limitations)
    return record.select("*", *_qualification_cols(source))


def qualified_summary(df: DataFrame, source: Source, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """KPIs of every scope plus source and qualification."""
    return documented_summary(df, spec).select(
        "*",
        *_source_cols(source),
        *_qualification_cols(source),
        generated_at().alias("generated_at_utc"),
    )


def release_validation(
    metrics: DataFrame, qualification: DataFrame, spec: FactSpec = DEFAULT_SPEC
) -> DataFrame:
    """Gate results, conflict counts, totals and extremes of every scope.

    ``qualification`` holds one row per scope; all parts join on the scope.
    """
    keys = list(spec.scope_keys)
    joined = dataset_summary(metrics, spec)
    for part in (kpi_extremes(metrics, spec), mean_share_sum(metrics, spec)):
        joined = joined.join(part, keys)
    gates = qualification.select(
        *keys,
        "national_conflicting_groups",
        "national_conflicting_rows",
        "scope_conflicting_groups",
        "qualified",
    )
    return joined.join(gates, keys, "left").withColumn("publication_allowed", F.lit(False))


def release_totals(df: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Row count and totals over all scopes; one row per snapshot."""
    return df.groupBy(*spec.snapshot_cols).agg(
        F.count("*").alias("row_count"),
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(f"{c}_total")
            for c in (*spec.categories, spec.total)
        ],
    )
