"""One table of many snapshots, each replaced as a whole.

A snapshot is told apart by the columns in ``FactSpec.snapshot_cols``; each has
a folder of its own in the table. Writing metrics of some snapshots replaces
those and leaves all others as they are: Spark stages the new files and swaps
the folders that it wrote (dynamic partition overwrite). Scopes are no folders
here, so a scope that a later version of a snapshot lacks goes with the old one.

The metrics and their provenance lie side by side::

    table/metrics      Parquet by snapshot, in order of scope and rank
    table/provenance   Parquet by snapshot, one row per scope

The provenance of a snapshot is swapped after its metrics, and carries their
row count; ``torn_snapshots`` finds those where a run ended between the two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scopewise.operators.provenance import Source, qualified_provenance
from scopewise.operators.quality import enforce, non_empty, not_blank, require_columns
from scopewise.plans.bundle import METRIC_STEPS, checked_metrics
from scopewise.session import scratch_tables
from scopewise.sources.sinks import MAX_ROWS_PER_FILE
from scopewise.spec import FactSpec


def _swap(df: DataFrame, path: str, spec: FactSpec) -> None:
    """Replace the folders of the snapshots in ``df``, and no others."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", MAX_ROWS_PER_FILE).partitionBy(*spec.snapshot_cols).parquet(path)


def write_snapshots(
    fact: DataFrame,
    table: str,
    source: Source,
    spec: FactSpec,
    steps: Sequence[str] = (),
    limitations: Sequence[str] = (),
) -> DataFrame:
    """Compute, check and write the snapshots in ``fact``; returns all that are stored.

    Every rule is judged before anything is replaced. A fact without rows, or
    with a snapshot column that is null or blank, is refused.
    """
    if not spec.snapshot_cols:
        raise ValueError("Name the columns that tell snapshots apart in snapshot_cols.")
    require_columns(fact, spec.snapshot_cols)
    enforce(fact, [non_empty(), *map(not_blank, spec.snapshot_cols)])
    spark = fact.sparkSession
    with scratch_tables():
        metrics = checked_metrics(fact, spec)
        order = [*spec.scope_keys, "rank_total"]
        ordered = metrics.select(*spec.output_cols).repartitionByRange(*order).sortWithinPartitions(*order)
        _swap(ordered, f"{table}/metrics", spec)
        record = qualified_provenance(metrics, source, "metrics", spec, (*steps, *METRIC_STEPS), limitations)
        _swap(record, f"{table}/provenance", spec)
    return read_snapshots(spark, table, spec)


def _chosen(spec: FactSpec, snapshot: dict[str, str]) -> list[Column]:
    unknown = sorted(set(snapshot) - set(spec.snapshot_cols))
    if unknown:
        raise ValueError("These columns tell no snapshots apart: " + ", ".join(unknown))
    return [F.col(name) == F.lit(value) for name, value in snapshot.items()]


def read_snapshots(spark: SparkSession, table: str, spec: FactSpec, **snapshot: str) -> DataFrame:
    """Stored metrics of all snapshots, or of those with the given values: other folders are not read."""
    stored = spark.read.schema(spec.metrics_schema()).parquet(f"{table}/metrics").select(*spec.output_cols)
    for condition in _chosen(spec, snapshot):
        stored = stored.where(condition)
    return stored


def read_provenance(spark: SparkSession, table: str, spec: FactSpec, **snapshot: str) -> DataFrame:
    """Provenance of all scopes of all snapshots, or of those with the given values."""
    none = spark.createDataFrame([], spec.metrics_schema()).select(*spec.output_cols)
    shape = qualified_provenance(none, Source("", ""), "metrics", spec).schema
    record = spark.read.schema(shape).parquet(f"{table}/provenance").select(*shape.names)
    for condition in _chosen(spec, snapshot):
        record = record.where(condition)
    return record


def torn_snapshots(spark: SparkSession, table: str, spec: FactSpec) -> DataFrame:
    """Scopes whose metrics and provenance differ in rows or total, with both figures.

    Writing such a snapshot again mends it.
    """
    keys, total = list(spec.scope_keys), f"{spec.total}_total"
    actual = read_snapshots(spark, table, spec).groupBy(*keys).agg(
        F.count("*").alias("actual_rows"), F.sum(spec.total).alias("actual_total")
    )
    told = read_provenance(spark, table, spec).select(
        *keys, F.col("row_count").alias("recorded_rows"), F.col(total).alias("recorded_total")
    )
    same = F.equal_null("actual_rows", "recorded_rows") & F.equal_null("actual_total", "recorded_total")
    return actual.join(told, keys, "full_outer").where(~same)
