"""Lookups and reconciliation between tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scopewise.spec import DataQualityError


def keyed_reorder(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows whose key is listed, in the order of the list; a key without rows is an error.

    The list is an argument, so its size is that of the call, not of the data.
    Sorting by the other columns too lets a frequent key spread over tasks.
    """
    missing = missing_order_keys(df, key, order)
    if missing:
        raise DataQualityError(f"No rows for these values of {key!r}: " + ", ".join(map(str, missing)))
    place = F.array_position(F.array(*[F.lit(k) for k in order]), F.col(key))
    listed = df.where(F.col(key).isin(*order)).withColumn("ordinal", place)
    return listed.orderBy("ordinal", *df.columns)


def missing_order_keys(df: DataFrame, key: str, order: Sequence[str]) -> list[str]:
    """Listed keys that the table lacks; at most as many as listed."""
    found = {r[0] for r in df.where(F.col(key).isin(*order)).select(key).distinct().collect()}
    return [k for k in order if k not in found]


def reconcile_keys(expected: DataFrame, actual: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every key of either side: ok, missing (not in actual) or unexpected."""
    left = expected.select(*key).distinct().withColumn("_expected", F.lit(True))
    right = actual.select(*key).distinct().withColumn("_actual", F.lit(True))
    status = (
        F.when(F.col("_actual").isNull(), F.lit("missing"))
        .when(F.col("_expected").isNull(), F.lit("unexpected"))
        .otherwise(F.lit("ok"))
    )
    return left.join(right, list(key), "full_outer").select(*key, status.alias("status"))


def unknown_references(df: DataFrame, ref: str, known: DataFrame, key: str) -> DataFrame:
    """Rows whose reference is no known key."""
    return df.join(known.select(F.col(key).alias(ref)), ref, "left_anti")


def shared_keys(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    return left.select(*key).intersect(right.select(*key))


def values_outside(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Distinct values that are not allowed; null is allowed only if listed."""
    inside = F.lit(False)
    for value in allowed:
        inside = inside | F.col(column).eqNullSafe(F.lit(value))
    return df.where(~inside).select(column).distinct()


def verify_manifest(expected: DataFrame, actual: DataFrame, key: str = "relative_path") -> DataFrame:
    """Status of every file of either side: unlisted, missing, then size, then checksum.

    Both sides carry ``size_bytes`` and ``sha256``; a null expected size is
    not compared.
    """
    listed = expected.select(key, "size_bytes", "sha256", F.lit(True).alias("_listed"))
    found = actual.select(
        key, F.col("size_bytes").alias("_size"), F.col("sha256").alias("_sha256")
    )
    status = (
        F.when(F.col("_listed").isNull(), F.lit("unlisted"))
        .when(F.col("_sha256").isNull(), F.lit("missing"))
        .when(F.col("size_bytes") != F.col("_size"), F.lit("size_mismatch"))
        .when(F.col("sha256") != F.col("_sha256"), F.lit("checksum_mismatch"))
        .otherwise(F.lit("ok"))
    )
    return listed.join(found, key, "full_outer").select(key, status.alias("status"))


def qualification_decision(
    sources: DataFrame,
    qualifications: DataFrame,
    key: str,
    status_ok,
    privacy_ok,
) -> DataFrame:
    """Gate decision per source from its qualification record."""
    marked = qualifications.select(
        key,
        F.coalesce(status_ok, F.lit(False)).alias("_status_ok"),
        F.coalesce(privacy_ok, F.lit(False)).alias("_privacy_ok"),
    )
    decision = (
        F.when(F.col("_status_ok").isNull(), F.lit("missing_qualification"))
        .when(~F.col("_status_ok"), F.lit("status"))
        .when(~F.col("_privacy_ok"), F.lit("privacy"))
        .otherwise(F.lit("approved"))
    )
    return sources.select(key).join(marked, key, "left").select(key, decision.alias("decision"))
