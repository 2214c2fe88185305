"""Reading the panel's tables by name, from the DataFrame API or from SQL text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def pick(panel: Mapping[str, DataFrame], table: str, *columns: str) -> DataFrame:
    """All rows of a table, only the named columns."""
    return panel[table].select(*[f"`{c}`" for c in columns])


def as_views(panel: Mapping[str, DataFrame]) -> None:
    """Register each table as a temporary view, so SQL text can name it in backticks."""
    for name, df in panel.items():
        df.createOrReplaceTempView(f"`{name}`")
