"""Write a data package: fact, views, KPIs, provenance and a manifest.

Layout below the output folder::

    data/fact        metrics, Parquet split by scope (or CSV)
    data/rankings    TOP and BOTTOM rows, CSV
    data/summary     KPIs, one JSON line per scope
    data/metadata    provenance, one JSON line per scope
    data/dictionary  field descriptions, CSV
    manifest/files   path, size and SHA-256 of every file below data, CSV
    manifest/header  row counts, totals and source, one JSON line

The package is written aside and moved to its place when it is whole, the
manifest last; a folder without one holds no package.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scopewise.operators.metrics import entity_metrics
from scopewise.operators.provenance import (
    SCHEMA_VERSION,
    Source,
    generated_at,
    qualified_provenance,
    qualified_summary,
    release_totals,
)
from scopewise.operators.quality import enforce_metrics
from scopewise.operators.ranking import require_limit
from scopewise.operators.scoping import canonical_scope, load_fact, validate_then_filter
from scopewise.operators.views import ranking_view
from scopewise.plans.publish import staged
from scopewise.session import materialize, scratch_tables, together
from scopewise.sources.files import inventory
from scopewise.sources.sinks import write_csv, write_inventory, write_json_rows, write_parquet
from scopewise.sources.tables import read_metrics
from scopewise.spec import DEFAULT_SPEC, FactSpec


class WrittenFigures:
    """Row counts and totals, counted by the jobs that write the rows.

    They are observed in the last stage of a write, so the manifest needs no
    second read. An observation has no groups: totals per snapshot are read
    back from what was written.
    """

    def __init__(self, spec: FactSpec = DEFAULT_SPEC):
        self.spec = spec
        self.fact, self.rankings = Observation(), Observation()

    def of_fact(self, df: DataFrame) -> DataFrame:
        sums = [
            F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(f"{c}_total")
            for c in (*self.spec.categories, self.spec.total)
        ]
        return df.observe(self.fact, F.count(F.lit(1)).alias("row_count"), *sums)

    def of_rankings(self, df: DataFrame) -> DataFrame:
        return df.observe(self.rankings, F.count(F.lit(1)).alias("n"))

    def totals(self, stored: DataFrame) -> DataFrame:
        """Like ``release_totals`` of the written fact."""
        if self.spec.snapshot_cols:
            return release_totals(stored, self.spec)
        figures = [F.lit(v).cast("bigint").alias(k) for k, v in self.fact.get.items()]
        return stored.sparkSession.range(1, numPartitions=1).select(*figures)

    def ranking_rows(self) -> Column:
        return F.lit(self.rankings.get["n"]).cast("bigint")


METRIC_STEPS = ("derived ranks, shares, dominant categories and flags", "checked the derived columns")


def data_dictionary(spark: SparkSession, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Field names, types, origin and calculation, in table order."""
    calculations = {
        spec.total: " + ".join(spec.categories),
        "rank_total": "descending rank of the total inside the scope",
        "rank_total_ascending": "ascending rank of the total inside the scope",
        **{s: f"{c} / {spec.total} * 100" for c, s in zip(spec.categories, spec.share_cols)},
        "scope_total_share_pct": f"{spec.total} / scope total * 100",
        "dominant_category": "largest category, TIE or NO_REGISTRATIONS",
        "top_10_flag": "rank_total <= 10",
        "bottom_10_flag": "rank_total_ascending <= 10",
    }
    calculations |= dict.fromkeys(spec.extra_cols, "scope name in one spelling")
    derived = {*spec.derived, *spec.extra_cols}
    kinds = {"bigint": "whole_number", "double": "decimal_number", "string": "text"}
    rows = [
        F.struct(
            F.lit(f.name).alias("field_name"),
            F.lit(kinds.get(f.dataType.simpleString(), f.dataType.simpleString())).alias("data_type"),
            F.lit("derived" if f.name in derived else "source").alias("field_origin"),
            F.lit(calculations.get(f.name, "")).alias("calculation"),
        )
        for f in spec.metrics_schema()
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def write_metrics(
    metrics: DataFrame,
    path: str,
    spec: FactSpec = DEFAULT_SPEC,
    fmt: str = "parquet",
    written: WrittenFigures | None = None,
) -> DataFrame:
    """Write metrics in rank order, and read them back.

    Rows are range-partitioned by scope and rank, and files are numbered by
    partition: in a scope's folder, files in the order of their names hold the
    ranks in order, however many tasks a large scope takes.
    """
    order = [*spec.scope_keys, "rank_total"]
    ranged = metrics.select(*spec.output_cols).repartitionByRange(*order)
    if written:
        ranged = written.of_fact(ranged)  # below the sort, which the writer relies on
    ordered = ranged.sortWithinPartitions(*order)
    if fmt == "csv":
        write_csv(ordered, path)
    else:
        write_parquet(ordered, path, spec.scope_keys)
    return read_metrics(metrics.sparkSession, path, spec, fmt)


def write_fact(
    fact: DataFrame, path: str, spec: FactSpec = DEFAULT_SPEC, fmt: str = "parquet"
) -> DataFrame:
    """Compute the metrics of a fact, write them, and read them back."""
    return write_metrics(entity_metrics(fact, spec), path, spec, fmt)


def checked_metrics(fact: DataFrame, spec: FactSpec = DEFAULT_SPEC) -> DataFrame:
    """Metrics of a checked fact, stored aside and proved before anything is published."""
    metrics = materialize(entity_metrics(fact, spec), "metrics")
    enforce_metrics(metrics, spec, with_base=False)
    return metrics


def write_data_package(
    metrics: DataFrame,
    out: str,
    source: Source,
    spec: FactSpec = DEFAULT_SPEC,
    limit: int = 10,
    fact_format: str = "parquet",
    steps: Sequence[str] = (),
    limitations: Sequence[str] = (),
    written: WrittenFigures | None = None,
) -> DataFrame:
    """Write everything below ``out/data``; returns the stored metrics.

    Expects checked metrics.  Views and KPIs read what was written, at the same
    time; ``written`` takes the figures of the manifest.
    """
    require_limit(limit)
    spark = metrics.sparkSession
    steps = (*steps, *METRIC_STEPS)
    stored = write_metrics(metrics, f"{out}/data/fact", spec, fact_format, written)
    rankings = ranking_view(stored, limit, spec)
    if written:
        rankings = written.of_rankings(rankings)
    summary = qualified_summary(stored, source, spec)
    record = qualified_provenance(stored, source, "fact", spec, steps, limitations)
    together(
        spark,
        lambda: write_csv(rankings, f"{out}/data/rankings"),
        lambda: write_json_rows(summary, f"{out}/data/summary"),
        lambda: write_json_rows(record, f"{out}/data/metadata"),
        lambda: write_csv(data_dictionary(spark, spec), f"{out}/data/dictionary"),
    )
    return stored


def _names(columns) -> Column:
    return F.array(*[F.lit(c) for c in columns]).cast("array<string>")


def write_manifest(
    stored: DataFrame,
    out: str,
    name: str,
    source: Source,
    spec: FactSpec = DEFAULT_SPEC,
    fact_format: str = "parquet",
    limitations: Sequence[str] = (),
    figures: DataFrame | None = None,
    written: WrittenFigures | None = None,
    **extra: Column,
) -> DataFrame:
    """Hash what was written, then publish files and header of the manifest.

    The header has one row per snapshot; ``figures`` adds columns to it.
    Without the figures of the writing jobs, all are read back.
    """
    spark = stored.sparkSession
    if written:
        totals, ranking_rows = written.totals(stored), written.ranking_rows()
    else:
        rankings = spark.read.option("header", True).csv(f"{out}/data/rankings")
        totals, ranking_rows = release_totals(stored, spec), rankings.agg(F.count("*")).scalar()
    files = materialize(inventory(spark, out), "inventory")
    write_inventory(files, f"{out}/manifest/files")
    size = files.agg(F.count("*"))
    added = []
    if figures is not None:
        added = [c for c in figures.columns if c not in spec.snapshot_cols]
        if spec.snapshot_cols:
            totals = totals.join(figures, list(spec.snapshot_cols), "left")
        else:
            totals = totals.withColumns({c: figures.select(c).scalar() for c in added})
    header = totals.select(
        *spec.snapshot_cols,
        *added,
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(name).alias("name"),
        generated_at().alias("generated_at_utc"),
        F.lit(fact_format).alias("fact_format"),
        F.lit(spec.scope_col).alias("scope_column"),
        F.lit(source.source_id).cast("string").alias("source_id"),
        F.lit(source.file_name).cast("string").alias("source_file_name"),
        F.lit(source.sha256).cast("string").alias("source_sha256"),
        F.lit(source.as_of_date).cast("string").alias("source_as_of_date"),
        F.lit(source.retrieval_date).cast("string").alias("retrieval_date"),
        "row_count",
        *[f"{c}_total" for c in (*spec.categories, spec.total)],
        ranking_rows.alias("ranking_row_count"),
        F.lit(len(spec.output_cols)).alias("dictionary_row_count"),
        size.scalar().alias("file_count"),
        _names(spec.required).alias("base_columns"),
        _names(spec.derived).alias("derived_columns"),
        _names(limitations).alias("limitations"),
        *[column.alias(field) for field, column in extra.items()],
    )
    write_json_rows(header, f"{out}/manifest/header")
    return read_header(spark, out)


def read_header(spark: SparkSession, out: str) -> DataFrame:
    """The manifest header of a package, one row per snapshot."""
    return spark.read.json(f"{out}/manifest/header")


def strict_scopes(raw: DataFrame, target: str | None, spec: FactSpec) -> DataFrame:
    """All rows checked; then one scope, or all, under canonical labels."""
    fact = load_fact(raw, spec)
    if target is None:
        return canonical_scope(fact, spec)
    return validate_then_filter(fact, target, spec)


def strict_steps(target: str | None) -> tuple[str, ...]:
    """What ``strict_scopes`` does, for the record."""
    kept = (f"kept the rows of {target}",) if target else ("brought scope names to one spelling",)
    return ("parsed text and counts", "checked all rows and keys", *kept)


def write_bundle(
    raw: DataFrame,
    out: str,
    source: Source,
    target: str | None = None,
    spec: FactSpec = DEFAULT_SPEC,
    limit: int = 10,
    fact_format: str = "parquet",
    limitations: Sequence[str] = (),
) -> DataFrame:
    """Strict bundle: all rows are validated before any scope is taken.

    Without a ``target`` every scope is published.  Returns the header.
    """
    require_limit(limit)
    spark = raw.sparkSession
    with scratch_tables(), staged(spark, out, ("data",)) as stage:
        metrics = checked_metrics(strict_scopes(raw, target, spec), spec)
        written = WrittenFigures(spec)
        stored = write_data_package(
            metrics, stage, source, spec, limit, fact_format, strict_steps(target), limitations, written
        )
        write_manifest(stored, stage, "Data package", source, spec, fact_format, limitations, written=written)
    return read_header(spark, out)


def write_processed(
    raw: DataFrame,
    fact_path: str,
    metadata_path: str,
    source: Source,
    target: str | None = None,
    spec: FactSpec = DEFAULT_SPEC,
    fact_format: str = "csv",
    limitations: Sequence[str] = (),
) -> DataFrame:
    """The processed pair: metrics and their provenance."""
    with scratch_tables():
        metrics = checked_metrics(strict_scopes(raw, target, spec), spec)
        stored = write_metrics(metrics, fact_path, spec, fact_format)
        steps = (*strict_steps(target), *METRIC_STEPS)
        record = qualified_provenance(stored, source, fact_path, spec, steps, limitations)
        write_json_rows(record, metadata_path)
    return raw.sparkSession.read.json(metadata_path)
