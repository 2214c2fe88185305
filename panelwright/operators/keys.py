"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET, _WITHIN, _BEFORE = "_bucket", "_within", "_before"


def dense_keys(
    df: DataFrame,
    natural_key: Sequence[str],
    id: str,
    start: Column | int = 1,
    hex_digits: int = 3,
) -> DataFrame:
    """Number rows ``start``, ``start + 1``, ... by a rule that depends on the data alone.

    Rows are spread over ``16 ** hex_digits`` buckets by a digest of the natural key and
    numbered inside their bucket; a bucket starts where the counts of the buckets before it
    end. No task sees more than one bucket, the only unpartitioned step runs over the
    bucket counts (4,096 rows at most by default), and a lost task renumbers its rows the
    same way. The natural key must be unique.
    """
    text = F.concat_ws(
        "\x1f", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in natural_key]
    )
    spread = df.withColumn(_BUCKET, F.substring(F.md5(text), 1, hex_digits))
    inside = Window.partitionBy(_BUCKET).orderBy(*[F.col(f"`{c}`") for c in natural_key])
    earlier = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        spread.groupBy(_BUCKET)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(_BUCKET, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(_BEFORE))
    )
    first = F.lit(start) if isinstance(start, int) else start
    return (
        spread.withColumn(_WITHIN, F.row_number().over(inside))
        .join(offsets, on=_BUCKET)
        .withColumn(id, (F.col(_BEFORE) + F.col(_WITHIN) + first - 1).cast("int"))
        .select(id, *[f"`{c}`" for c in df.columns])
    )
