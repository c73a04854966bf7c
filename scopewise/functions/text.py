"""Text expressions: trimming, blanks, scope keys and list flattening."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Python's str.strip removes; Spark's trim alone takes
# only the blank.
WHITE_SPACE = "".join(filter(str.isspace, map(chr, range(0x3001))))

# Most text starts and ends with printable ASCII and needs no trimming.
_UNSURE_EDGE = r"^[^!-~]|[^!-~]$"

LIST_SEPARATOR = " | "


def strip_text(col: Column) -> Column:
    """Trim every kind of Unicode white space."""
    return F.when(col.rlike(_UNSURE_EDGE), F.btrim(col, F.lit(WHITE_SPACE))).otherwise(col)


def is_blank(col: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return F.coalesce(F.ltrim(col, F.lit(WHITE_SPACE)), F.lit("")) == ""


def fold_case(col: Column) -> Column:
    """Case-insensitive form; the detour over upper case also folds sharp s.

    The optimizer would take a plain lower(upper(x)) for lower(x), hence the
    neutral step between the two.
    """
    return F.lower(F.concat(F.upper(col), F.lit("")))


def scope_key(col: Column) -> Column:
    """The spelling-independent form of a scope name."""
    return fold_case(strip_text(col))


def scope_label(col: Column) -> Column:
    """The canonical upper-case label of a scope name."""
    return F.upper(strip_text(col))


def flatten_list(col: Column) -> Column:
    """A list of strings as one delimited string, in sorted order."""
    return F.array_join(F.sort_array(col), LIST_SEPARATOR)


def thousands(col: Column) -> Column:
    """An integer with thousands separators."""
    return F.format_number(col, 0)


def mentions_name(json_text: Column, name: str) -> Column:
    """Whether serialised JSON holds a quoted name, in any case."""
    return F.contains(fold_case(json_text), fold_case(F.lit(f'"{name}"')))
