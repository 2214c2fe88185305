"""Sums, conditional sums, leaders and totals that are taken before a join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_sums(value: Column, cases: Mapping[str, Column]) -> list[Column]:
    """One ``SUM(CASE WHEN condition THEN value ELSE 0 END)`` per named condition.

    A null condition counts as false and so adds 0; a null value under a true condition
    stays null and is skipped.
    """
    return [F.sum(F.when(cond, value).otherwise(F.lit(0))).alias(name) for name, cond in cases.items()]


def leader(
    value: Column,
    by: Column,
    ties: Sequence[Column] = (),
    nulls: str = "first",
    where: Column | None = None,
) -> Column:
    """Aggregate: ``value`` of the row with the largest ``by``; least ``ties`` break draws.

    With ``nulls="first"`` a null ``by`` outranks every number, as it does under a
    descending sort in databases that treat null as largest; ``"last"`` lets it lose.
    ``where`` limits the candidates. Being an aggregate, it combines inside each task and
    shares its shuffle with the sums of the same group.
    """
    late = by.isNotNull() if nulls == "first" else by.isNull()
    rank = F.struct(late, -by, *ties)
    return F.min_by(value, rank if where is None else F.when(where, rank))


def sum_by_dimension(
    fact: DataFrame,
    foreign_key: str,
    dimension: DataFrame,
    dimension_key: str,
    attributes: Sequence[str],
    keys: Sequence[str],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Sum a fact by attributes of a dimension, collapsing the fact on its key first.

    The join then meets one row per (foreign key, keys) rather than the fact itself, so
    neither a hot dimension row nor a dimension too large to broadcast makes it heavy.
    Rows whose key is not in the dimension drop out, as in an inner join.
    """
    small = fact.groupBy(f"`{foreign_key}`", *keys).agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    named = small.join(
        dimension.withColumnRenamed(dimension_key, foreign_key), on=foreign_key, how="inner"
    )
    return named.groupBy(*attributes, *keys).agg(*[F.sum(n).alias(n) for n in sums])


def side_totals(side: DataFrame, keys: Sequence[str], sums: Mapping[str, Column], rows: str) -> DataFrame:
    """Per key: the named sums and the number of rows.

    Two such sides joined on the key give the sums of their many-to-many join without
    forming it: each side's sum is multiplied by the other side's row count.
    """
    return side.groupBy(*keys).agg(
        *[F.sum(e).alias(n) for n, e in sums.items()], F.count(F.lit(1)).alias(rows)
    )


def fan_out_sums(
    sides: Sequence[tuple[DataFrame, Mapping[str, Column]]], keys: Sequence[str], rows: str | None = None
) -> DataFrame:
    """Sums over the inner join of any number of many-to-many sides, which is never formed.

    Each side comes with its named measures and the shared key columns. A row of one side stands in the
    join once for every way to pick a row with its key from each other side, so a side's sum is multiplied
    by the row counts of all others. Every side collapses to one row a key inside its tasks first; what is
    joined has one row a key, however hot the key. ``rows`` names the number of joined rows. A key that
    some side lacks, or with a null in it, drops out; a sum without any value stays null. Sums stay
    decimals where their measures are.
    """
    count = [f"_rows_{i}" for i in range(len(sides))]
    small = [side_totals(df.dropna(subset=list(keys)), [f"`{k}`" for k in keys], sums, n) for (df, sums), n in zip(sides, count)]
    joined = reduce(lambda a, b: a.join(b, on=list(keys)), small)

    def times(c: Column, others: Sequence[str]) -> Column:
        return reduce(lambda x, n: x * F.col(n), others, c)

    products = [
        times(F.col(f"`{name}`"), [n for n in count if n != own]).alias(name) for (_, sums), own in zip(sides, count) for name in sums
    ]
    whole = [times(F.col(count[0]), count[1:]).alias(rows)] if rows else []
    return joined.select(*[f"`{k}`" for k in keys], *products, *whole)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """UNION: duplicates go inside each task first, then in one shuffle over all inputs."""
    return reduce(DataFrame.union, frames).distinct()
