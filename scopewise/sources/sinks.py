"""Writers.  Output is one folder per dataset, as Spark writes it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS_PER_FILE = 5_000_000

# Spark's writer trims cells unless told otherwise.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(
    df: DataFrame, path: str, single_file: bool = False, **options: str
) -> None:
    """Header CSV in UTF-8 with line feeds.

    ``single_file`` serves hand-offs to desktop tools; it writes in one task
    and fits small outputs only.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("error").options(**CSV_OPTIONS, **options).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Parquet, split by the given columns; files are bounded in rows."""
    writer = df.write.mode("error").option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_json_rows(df: DataFrame, path: str) -> None:
    """One JSON object per line, keys sorted, nulls kept."""
    ordered = df.select(*[sorted_fields(df, c) for c in sorted(df.columns)])
    ordered.write.mode("error").option("ignoreNullFields", False).json(path)


def write_json_document(df: DataFrame, path: str) -> None:
    """The one row of ``df`` as one document: keys sorted, indented, a line end behind it.

    For hand-offs of a summary or a manifest header.
    """
    rows = df.select(F.struct(*[sorted_fields(df, c) for c in sorted(df.columns)]).alias("value"))
    text = F.to_json("value", {"pretty": "true", "ignoreNullFields": "false"})
    rows.select(text.alias("value")).coalesce(1).write.mode("error").text(path)


def sorted_fields(df: DataFrame, name: str) -> Column:
    """A column with the fields of a struct in sorted order."""
    kind = df.schema[name].dataType
    if kind.typeName() != "struct":
        return F.col(name)
    return F.struct(*[F.col(f"{name}.{f}").alias(f) for f in sorted(kind.names)]).alias(name)


def write_inventory(records: DataFrame, path: str) -> None:
    """Inventory records as CSV."""
    write_csv(records.select("relative_path", "size_bytes", "sha256"), path)
