"""Wide to long and long to wide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_columns(
    df: DataFrame,
    ids: Sequence[str],
    columns: Sequence[str],
    variable: str,
    value: str,
    drop_nulls: bool = False,
) -> DataFrame:
    """One row per (row, column); a narrow expansion without a shuffle."""
    long = df.unpivot(
        [F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in columns], variable, value
    )
    return long.where(F.col(f"`{value}`").isNotNull()) if drop_nulls else long


def pivot_first(
    df: DataFrame,
    index: Sequence[str],
    column: str,
    categories: Mapping[str, str] | Sequence[str],
    value: str,
    order: Sequence[Column | str],
) -> DataFrame:
    """Long to wide over named categories: first non-null value per cell in the given order.

    ``categories`` lists the wanted values of ``column``, or maps them to output names.
    Rows with a null index key go, and so do index rows with no value at all. One
    aggregate with a conditional per category, so one shuffle on the index.
    """
    names = categories if isinstance(categories, Mapping) else {c: c for c in categories}
    v = F.col(f"`{value}`")
    position = F.struct(*[F.col(f"`{c}`") if isinstance(c, str) else c for c in order], v)
    kept = df.dropna(how="any", subset=[*index, value]).where(F.col(f"`{column}`").isin(*names))
    cells = [
        F.min_by(v, F.when(F.col(f"`{column}`") == category, position)).alias(name)
        for category, name in names.items()
    ]
    return kept.groupBy(*[f"`{i}`" for i in index]).agg(*cells)
