"""Order-dependent operators: top row per group, first row per key, sorted top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def _as_columns(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(f"`{c}`") if isinstance(c, str) else c for c in order]


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each group in the given order, whole row kept.

    Planned as a window with a group limit: each task keeps its own best row per group
    before the shuffle, so a group holding a third of all rows still sends one row per task.
    The order must be total for the result to be repeatable.
    """
    window = Window.partitionBy(*[f"`{g}`" for g in group]).orderBy(*_as_columns(order))
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Deduplicate on ``key``, keeping the first row in the given order.

    Every other column is added as a tie-break, so equal ``order`` values cannot make the
    outcome depend on how the data happened to be split.
    """
    named = {c for c in order if isinstance(c, str)}
    rest = [c for c in df.columns if c not in {*key, *named}]
    return top_per_group(df, key, [*order, *rest] or key)


def sort_desc(df: DataFrame, *columns: Column | str, ties: Sequence[Column | str] = ()) -> DataFrame:
    """Sort by the columns descending with NULLs first, then by ``ties`` ascending."""
    return df.orderBy(*[c.desc_nulls_first() for c in _as_columns(columns)], *_as_columns(ties))


def top_k(df: DataFrame, k: int, *columns: Column | str, ties: Sequence[Column | str] = ()) -> DataFrame:
    """Sort and limit; planned as one heap of ``k`` rows per task, never a full sort."""
    return sort_desc(df, *columns, ties=ties).limit(k)
