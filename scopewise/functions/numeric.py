"""Number expressions: strict parsing, shares, rounding and categories."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from scopewise.functions.text import strip_text
from scopewise.spec import NO_REGISTRATIONS, SHARE_DECIMALS, TIE

# Spark's own cast also takes "5d", "0x1p3", "inf" and "NaN", which are no
# counts; all of those hold a character that a plain number lacks.
_NOT_IN_NUMBER = r"[^0-9+\-.eE]"


def parse_number(col: Column) -> Column:
    """Text to double; null where the text is no plain decimal number."""
    return number_of(strip_text(col))


def number_of(text: Column) -> Column:
    """``parse_number`` for text that is already trimmed."""
    return F.when(~text.rlike(_NOT_IN_NUMBER), text.try_cast("double"))


def is_fractional(number: Column) -> Column:
    """True where a number has digits after the point; null stays null."""
    return number != F.floor(number)


def parse_count(col: Column) -> Column:
    """Text to bigint; null where the text is no whole number."""
    text = strip_text(col)
    return count_of(text, number_of(text))


def count_of(text: Column, number: Column) -> Column:
    """The whole value of trimmed text, given its number.

    Plain digits are cast directly, which keeps values above 2**53 exact;
    other spellings ("7.0", "1e3") go through double.  The test before the
    cast spares Spark the failed attempt, which is far slower than a test.
    """
    other_spelling = text.rlike("[.eE]")
    whole = F.when(other_spelling, number.try_cast("bigint")).otherwise(text.try_cast("bigint"))
    return F.when(number == F.floor(number), whole)


def round_column(col: Column, decimals: int) -> Column:
    """Half-even rounding of the scaled double, the way array libraries do."""
    scale = float(10**decimals)
    return F.rint(col * F.lit(scale)) / F.lit(scale)


def round_value(col: Column, decimals: int) -> Column:
    """Half-even rounding of the exact binary value, the way Python does.

    Formats the number, so it is meant for one value per scope, not per row.
    """
    return F.replace(F.format_number(col, decimals), F.lit(","), F.lit("")).cast("double")


def percentage(numerator: Column, denominator: Column) -> Column:
    """Unrounded percentage, 0 for a zero denominator; divides first."""
    ratio = numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")
    return F.coalesce(ratio * F.lit(100.0), F.lit(0.0))


def safe_pct(numerator: Column, denominator: Column, decimals: int = SHARE_DECIMALS) -> Column:
    """Rounded percentage of one column in another, 0 for a zero denominator."""
    return round_column(percentage(numerator, denominator), decimals)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Fraction that is 0 when the denominator is zero or missing."""
    ratio = numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")
    return F.when(F.coalesce(denominator, F.lit(0)) == 0, F.lit(0.0)).otherwise(ratio)


def row_sum(names: Sequence[str]) -> Column:
    return reduce(add, [F.col(name) for name in names])


def dominant_category(names: Sequence[str]) -> Column:
    """The label of the largest category, or why there is none."""
    cols = [F.col(name) for name in names]
    peak = F.greatest(*cols)
    at_peak = reduce(add, [(col == peak).cast("int") for col in cols])
    label = F.when(peak == 0, F.lit(NO_REGISTRATIONS)).when(at_peak > 1, F.lit(TIE))
    for name, col in zip(names, cols):
        label = label.when(col == peak, F.lit(name.upper()))
    return label
