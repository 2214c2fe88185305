"""Numeric columns: lenient parsing, the rounding rules, ratios and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER_IN_TEXT = r"[-+]?\d+(?:\.\d+)?"
_WHOLE_TEXT_IS_NUMBER = r"^\s*[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?\s*$"


def null_if_nan(value: Column) -> Column:
    """NaN would poison sums and sort above every number, so it enters as NULL."""
    return F.when(F.isnan(value), F.lit(None)).otherwise(value)


def parse_number(text: Column) -> Column:
    """First signed number of a cell, comma or dot as decimal mark, else null."""
    dotted = F.replace(text.cast("string"), F.lit(","), F.lit("."))
    return F.nullif(F.regexp_extract(dotted, _NUMBER_IN_TEXT, 0), F.lit("")).cast("double")


def to_double(text: Column) -> Column:
    """The cell as double if all of it is a finite number, else null."""
    plain = text.cast("string")
    return F.when(plain.rlike(_WHOLE_TEXT_IS_NUMBER), plain).try_cast("double")


def whole_number(value: Column, kind: str = "bigint") -> Column:
    """Truncate toward zero to an integer type."""
    return null_if_nan(value.cast("double")).cast(kind)


def scaled_int(value: Column, factor: int) -> Column:
    """``value * factor`` to the nearest integer, ties to even."""
    return F.rint(null_if_nan(value.cast("double")) * F.lit(float(factor))).cast("bigint")


def round_scaled(value: Column, digits: int) -> Column:
    """Array-style rounding: scale, nearest even integer, scale back."""
    scale = float(10**digits)
    return F.rint(null_if_nan(value) * scale) / scale


def round_exact(value: Column, digits: int) -> Column:
    """Round a double on its exact binary value, ties to even (2.675 -> 2.67).

    The scaled product is itself rounded, so 2.675 * 100 looks like a tie. Where it does,
    the product's rounding error, recovered exactly by splitting the factor into a high and
    a low half, says on which side of the tie the true value lies.
    """
    scale = float(10**digits)
    x = null_if_nan(value)
    product = x * scale
    nearest = F.rint(product)
    shifted = x * F.lit(134217729.0)  # 2**27 + 1: the high half keeps 26 bits
    high = shifted - (shifted - x)
    error = (high * scale - product) + (x - high) * scale
    looks_tied = F.abs(product - nearest) == 0.5
    nearest = (
        F.when(looks_tied & (error > 0), product + 0.5)
        .when(looks_tied & (error < 0), product - 0.5)
        .otherwise(nearest)
    )
    return nearest / scale


def ratio(top: Column, bottom: Column, factor: int = 1, digits: int | None = None) -> Column:
    """``factor * top / bottom`` in decimals, null where the divisor is zero or null.

    ``digits`` rounds half away from zero, as SQL does for exact numerics.
    """
    quotient = top * F.lit(factor) / F.nullif(bottom, F.lit(0))
    return quotient if digits is None else F.round(quotient, digits)


def share_text(part: Column, whole: Column, digits: int = 1) -> Column:
    """Share of a total as text, such as ``48.8%``."""
    return F.concat(ratio(part, whole, 100, digits).cast("string"), F.lit("%"))
