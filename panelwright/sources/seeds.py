"""Fixed rows of the power-source dimension and the labels energy files use for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Source name and whether it counts as renewable.
POWER_SOURCES = [
    ("Other renewables excluding bioenergy", True),
    ("Bioenergy", True),
    ("Solar", True),
    ("Wind", True),
    ("Hydro", True),
    ("Nuclear", False),
    ("Oil", False),
    ("Gas", False),
    ("Coal", False),
]

# Label in the energy file, name in the dimension.
SOURCE_LABELS = [
    ("Bioenergy", "Bioenergy"),
    ("Coal", "Coal"),
    ("Gas", "Gas"),
    ("Hydro", "Hydro"),
    ("Nuclear", "Nuclear"),
    ("Other Fossil", "Oil"),
    ("Other Renewables", "Other renewables excluding bioenergy"),
    ("Solar", "Solar"),
    ("Wind", "Wind"),
]


def literal_rows(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """Fixed rows as a VALUES relation: its size is known, so joins can rely on it."""

    def cell(value: object) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(value).upper()

    cells = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {cells} AS t({columns})")


def power_source_seed(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, POWER_SOURCES, "Name, Renewable")


def source_labels(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, SOURCE_LABELS, "label, name")
