from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from panelwright.session import remove_folder, shared_folder

_NUMBER = "_number"


def write_result_csv(df: DataFrame, path: str) -> None:
    """Write a result as CSV with a header. A sorted result stays sorted across part files."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_ordered_csv(
    df: DataFrame, path: str, order: Sequence[Column | str], index: bool = True, header: bool = True, files: int | None = None
) -> None:
    """Write CSV whose files, put together in the order of their names, are the sorted result.

    With ``index`` each row starts with its number from 0, under a nameless label, as array libraries write
    it; only the first file has the header line. Rows are dealt to ``files`` ranges of the order, each task
    sorts and numbers its own, and the ranges' sizes, one number each, say where the numbers of a range
    begin. Rows that the order leaves equal keep one of their orders. Null is an empty cell.
    """
    spark = df.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = shared_folder(spark)
    dealt = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    dealt.withColumn(_NUMBER, F.monotonically_increasing_id()).write.parquet(staged)
    try:
        rows = spark.read.schema(StructType([*df.schema.fields, StructField(_NUMBER, LongType())])).parquet(staged)
        part = F.shiftright(_NUMBER, 33)
        sizes = {p: n for p, n in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
        starts, so_far = [], 0
        for p in range(max(sizes, default=0) + 1):
            starts.append(so_far)
            so_far += sizes.get(p, 0)
        inside = F.col(_NUMBER) - F.shiftleft(part, 33)
        place = inside + F.element_at(F.array(*[F.lit(n).cast("bigint") for n in starts]), part.cast("int") + 1)
        cells = [place.alias("_place")] if index else []
        line = F.to_csv(F.struct(*cells, *[f"`{c}`" for c in df.columns]), {"escape": '"'})
        lines = rows.select(place.alias("place"), line.alias("value"))
        if header:
            labels = ["" if index else None, *df.columns][not index :]
            first = ",".join(_quoted(c) for c in labels)
            lines = spark.range(1).select(F.lit(-1).cast("bigint").alias("place"), F.lit(first).alias("value")).unionAll(lines)
        lines.repartitionByRange(files, "place").sortWithinPartitions("place").select("value").write.mode("overwrite").text(path)
    finally:
        remove_folder(spark, staged)


def _quoted(label: str) -> str:
    return '"' + label.replace('"', '""') + '"' if set(label) & set(',"\n\r') else label
