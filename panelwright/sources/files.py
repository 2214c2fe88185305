"""Delimited files: plain headers, report layouts with a preamble, exported sheets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Column that carries a row's position in its file. "Keep the first" needs an order, and a
# distributed read has none of its own: blocks are handed to tasks by size. Path and block
# start place the block; the running id places the row inside it.
FILE_ORDER = "_file_order"


def _with_file_order(df: DataFrame) -> DataFrame:
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select("*", position.alias(FILE_ORDER))


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str,
    rename: Mapping[str, str] | None = None,
    file_order: bool = False,
) -> DataFrame:
    """CSV with a header line, read with a declared schema so no pass infers types."""
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(path)
    )
    if file_order:
        df = _with_file_order(df)
    return df.withColumnsRenamed(dict(rename)) if rename else df


def read_with_preamble(
    spark: SparkSession,
    path: str | Sequence[str],
    width: int,
    columns: Mapping[str, int],
    required: str,
    file_order: bool = False,
) -> DataFrame:
    """CSV report whose real header sits below title lines, with blank or repeated labels.

    Columns are taken by position (``columns`` maps a name to its index out of ``width``),
    all as text. Title, header and footnote lines come through as rows, as they do for any
    reader that cannot seek by line in a split file; those without a ``required`` value are
    dropped here, and a rule on the content (a year in the survey column) drops the rest.
    """
    schema = StructType([StructField(f"_c{i}", StringType()) for i in range(width)])
    raw = spark.read.schema(schema).option("header", False).option("escape", '"').csv(path)
    if file_order:
        raw = _with_file_order(raw)
    wanted = [F.col(f"_c{i}").alias(name) for name, i in columns.items()]
    extra = [FILE_ORDER] if file_order else []
    return raw.select(*wanted, *extra).where(F.col(required).isNotNull())


def clean_headers(df: DataFrame) -> DataFrame:
    """Strip header labels; a label that is a whole float (``2004.0``) becomes ``2004``."""
    return df.toDF(*[_clean_header(c) for c in df.columns])


def _clean_header(label: str) -> str:
    label = label.strip()
    try:
        number = float(label)
    except ValueError:
        return label
    return str(int(number)) if number.is_integer() else label


def year_columns(df: DataFrame, first: int = 2000, last: int = 2023) -> list[str]:
    """Headers that read as a year within the range. Looks at metadata only."""
    return [label for label in df.columns if _is_year(label, first, last)]


def _is_year(label: str, first: int, last: int) -> bool:
    try:
        return first <= int(float(label)) <= last
    except (ValueError, OverflowError):
        return False


def read_sheet_export(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    """One sheet of a workbook, exported to CSV (header line) or Parquet, headers cleaned."""
    reader = spark.read.option("header", True).option("escape", '"')
    return clean_headers(reader.format(format).load(path))


#: Cells of a line: after its start or a comma, in quotes or bare.
_CELLS = r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'


def _cells(line: Column) -> Column:
    """The cells of a delimited line as an array, quotes taken off."""
    bare = lambda c: F.when(c.startswith('"'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)
    return F.transform(F.regexp_extract_all(line, F.lit(_CELLS), F.lit(1)), bare)


def melt_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    ids: Sequence[str],
    first: int = 2000,
    last: int = 2023,
    names_to: str = "Year",
    values_to: str = "value",
    header: str | None = None,
) -> DataFrame:
    """A wide delimited file made long in one scan, by its header line alone.

    A line stays an array of cells, paired with the header and exploded, so that thousands of year
    columns need no schema and no column each. All files carry the same header, which is read once and left
    out wherever it stands, or ``header`` is the path of a file that has it in their place; headers are
    cleaned. Year columns between ``first`` and ``last`` become
    rows, in text as the ids; empty cells are dropped, cells that a line lacks too. A cell holds no line break.
    """
    lines = spark.read.text(path)
    top = (lines if header is None else spark.read.text(header)).first()
    if top is None:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in (*ids, names_to, values_to)]))
    labels = [_clean_header(c) for c in spark.range(1).select(_cells(F.lit(top.value)).alias("c")).first().c]
    missing = [c for c in ids if c not in labels]
    if missing:
        raise ValueError(f"no column {missing} in {path}")
    wanted = [i for i, label in enumerate(labels) if _is_year(label, first, last)]
    rows = lines.where((F.col("value") != top.value) & (F.trim("value") != "")).select(_cells(F.col("value")).alias("cells"))
    if not wanted:
        return rows.where("false").select(*[F.lit("").alias(c) for c in (*ids, names_to, values_to)])
    pairs = F.arrays_zip(F.lit([labels[i] for i in wanted]).alias("n"), F.lit([i + 1 for i in wanted]).alias("i"))
    held = F.transform(pairs, lambda p: F.struct(p["n"].alias("n"), F.nullif(F.try_element_at("cells", p["i"]), F.lit("")).alias("v")))
    own = [F.nullif(F.try_element_at("cells", F.lit(labels.index(c) + 1)), F.lit("")).alias(c) for c in ids]
    long = rows.select(*own, F.explode(F.filter(held, lambda x: x["v"].isNotNull())).alias("x"))
    return long.select(*[f"`{c}`" for c in ids], F.col("x.n").alias(names_to), F.col("x.v").alias(values_to))


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in df.columns])
