"""Write semantics as plans: replace, keep-old-if-new-is-null, ignore.

Each takes the present rows and the incoming rows and returns rows to write; the store
decides which partitions that touches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.operators.ranking import first_per_key

_ARRIVED = "_arrived"


def merge_rows(
    present: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    mode: str = "keep_old",
    keep: Sequence[str | None] = (),
) -> DataFrame:
    """Upsert. Both inputs hold one row per key.

    ``"replace"``: incoming values win, null included. ``"keep_old"``: a null incoming value
    leaves the present one. Columns that ``incoming`` lacks keep their present value, and so
    do those in ``keep`` (surrogate keys) unless the row is new.
    Rows with a null in the key match nothing and are inserted.
    """
    if mode not in ("replace", "keep_old"):
        raise ValueError(f"unknown merge mode {mode!r}")
    values = [c for c in present.columns if c not in key]
    arriving = [c for c in values if c in incoming.columns]
    new = incoming.select(
        *[f"`{k}`" for k in key],
        *[F.col(f"`{c}`").alias(f"_new_{c}") for c in arriving],
        F.lit(True).alias(_ARRIVED),
    )
    joined = present.join(new, on=list(key), how="full_outer")

    def merged(c: str) -> Column:
        old = F.col(f"`{c}`")
        if c in key or c not in arriving:
            return old
        fresh = F.col(f"`_new_{c}`")
        if c in keep:
            return F.coalesce(old, fresh).alias(c)
        if mode == "replace":
            return F.when(F.col(_ARRIVED), fresh).otherwise(old).alias(c)
        return F.coalesce(fresh, old).alias(c)

    return joined.select(*[merged(c) for c in present.columns])


def insert_ignore(
    present: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[Column | str] = ()
) -> DataFrame:
    """The incoming rows to append: first per key, where the key is not there yet.

    Keys compare null-safe, so a repeated load of a null name adds it once.
    """
    fresh = first_per_key(incoming, key, order)
    known = present.select(*[F.col(f"`{k}`").alias(f"_known_{i}") for i, k in enumerate(key)])
    same = [fresh[f"`{k}`"].eqNullSafe(known[f"_known_{i}"]) for i, k in enumerate(key)]
    return fresh.join(known, same, "left_anti")


def last_known(
    df: DataFrame, key: Sequence[str], values: Mapping[str, Column], order: Sequence[str]
) -> DataFrame:
    """Per key and value: the last non-null in the given order.

    This is where a series of keep-old upserts ends up, in one aggregate.
    """
    position = F.struct(*[F.col(f"`{c}`") for c in order])
    return df.groupBy(*[f"`{k}`" for k in key]).agg(
        *[F.max_by(v, F.when(v.isNotNull(), F.struct(position, v))).alias(n) for n, v in values.items()]
    )
