"""Check a source registry file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scopewise.operators.quality import require_columns
from scopewise.operators.registry import registry_messages, registry_violations
from scopewise.sources.tables import REGISTRY_COLUMNS, read_registry
from scopewise.spec import DataQualityError

EMPTY = "The registry lists no source."


def _whole_file(spark: SparkSession, rule: str, message: str) -> DataFrame:
    """One violation of the file itself."""
    return spark.range(1).select(
        F.lit(rule).alias("rule"),
        F.lit(0).cast("bigint").alias("row_no"),
        F.lit("").alias("key"),
        F.lit("").alias("detail"),
        F.lit(message).alias("message"),
    )


def check_registry(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """All violations with their messages, one row each; no rows for a sound registry."""
    registry = read_registry(spark, path)
    try:
        require_columns(registry, REGISTRY_COLUMNS)
    except DataQualityError as error:
        return _whole_file(spark, "missing_columns", str(error))
    if registry.isEmpty():
        return _whole_file(spark, "empty", EMPTY)
    return registry_messages(registry_violations(registry, strict=strict))
