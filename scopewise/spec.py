"""The shape of a fact table: column names, schemas and fixed values."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T


class DataQualityError(ValueError):
    """A dataset breaks one of its quality rules."""


# Outcome labels, rank cut-off and check tolerances.
NO_REGISTRATIONS = "NO_REGISTRATIONS"
TIE = "TIE"
RANK_CUTOFF = 10
SHARE_DECIMALS = 4
AVERAGE_DECIMALS = 2
ROW_SHARE_TOLERANCE = 0.01
CONTRIBUTION_TOLERANCE = 0.05
SHARE_VALUE_TOLERANCE = 1e-4

# Fragments of messages that callers look for.
MISSING_COLUMNS_TEXT = "Missing required columns"
DUPLICATE_ROWS_TEXT = "Duplicate rows"
NEGATIVE_TEXT = "negative values"
MUST_EQUAL_TEXT = "must equal"
ABOVE_100_TEXT = "above 100"
TOP_FLAGS_TEXT = "Top-10 flags"
ONLY_SCOPE_TEXT = "-only"
RANKING_LIMIT_TEXT = "must be at least 1"


@dataclass(frozen=True)
class FactSpec:
    """Names the columns of a fact table.

    ``snapshot_cols`` lists columns that tell snapshots apart (source, as-of
    date).  They join every key and every grouping, so two snapshots kept in
    one table are never combined.  ``scope_col`` is the column that groups a
    scope; it differs from ``scope_name`` only for facts that keep the source
    spelling and carry a separate ``scope_key``.
    """

    scope_name: str = "scope_name"
    scope_id: str = "scope_id"
    entity_name: str = "entity_name"
    entity_code: str = "entity_code"
    categories: tuple[str, ...] = ("micro", "small", "medium")
    #: Fixed value: the categories in the order of a table's columns.
    count_order: tuple[str, ...] = ("medium", "micro", "small")
    total: str = "total"
    snapshot_cols: tuple[str, ...] = field(default=())
    scope_col: str = "scope_name"

    @property
    def text_cols(self) -> tuple[str, ...]:
        return (self.scope_name, self.scope_id, self.entity_name, self.entity_code)

    @property
    def count_cols(self) -> tuple[str, ...]:
        return (*self.count_order, self.total)

    @property
    def required(self) -> tuple[str, ...]:
        return (*self.text_cols, *self.count_cols)

    @property
    def key(self) -> tuple[str, ...]:
        return (*self.snapshot_cols, self.scope_id, self.entity_code)

    @property
    def scope_keys(self) -> tuple[str, ...]:
        return (*self.snapshot_cols, self.scope_col)

    @property
    def share_cols(self) -> tuple[str, ...]:
        return tuple(f"{name}_share_pct" for name in self.categories)

    @property
    def pct_cols(self) -> tuple[str, ...]:
        return (*self.share_cols, "scope_total_share_pct")

    @property
    def derived(self) -> tuple[str, ...]:
        return (
            "rank_total",
            "rank_total_ascending",
            *self.pct_cols,
            "dominant_category",
            "top_10_flag",
            "bottom_10_flag",
        )

    @property
    def extra_cols(self) -> tuple[str, ...]:
        """The scope column, where it is none of the required ones."""
        return () if self.scope_col in self.required else (self.scope_col,)

    @property
    def output_cols(self) -> tuple[str, ...]:
        return (*self.snapshot_cols, *self.required, *self.derived, *self.extra_cols)

    def keyed(self) -> FactSpec:
        """The same fact, grouped by a spelling-independent scope key."""
        return replace(self, scope_col="scope_key")

    @property
    def dominant_labels(self) -> tuple[str, ...]:
        return (*(name.upper() for name in self.categories), TIE, NO_REGISTRATIONS)

    def raw_schema(self) -> T.StructType:
        return text_schema(self.required)

    def fact_schema(self) -> T.StructType:
        counts = set(self.count_cols)
        return T.StructType(
            [
                T.StructField(name, T.LongType() if name in counts else T.StringType())
                for name in (*self.snapshot_cols, *self.required)
            ]
        )

    def metrics_schema(self) -> T.StructType:
        kinds = {
            "rank_total": T.LongType(),
            "rank_total_ascending": T.LongType(),
            "dominant_category": T.StringType(),
            "top_10_flag": T.BooleanType(),
            "bottom_10_flag": T.BooleanType(),
        }
        return T.StructType(
            [
                *self.fact_schema().fields,
                *(T.StructField(n, kinds.get(n, T.DoubleType())) for n in self.derived),
                *(T.StructField(n, T.StringType()) for n in self.extra_cols),
            ]
        )


def text_schema(columns) -> T.StructType:
    """An all-string schema, so that identifiers keep their leading zeros."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


DEFAULT_SPEC = FactSpec()
