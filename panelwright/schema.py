"""Declared tables of the panel: column types, real keys, foreign keys, partitioning.

Table and column names are part of the data contract (existing queries use them), so
they are kept verbatim, including the spelling of ``CO2_Emision`` and ``Ano``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

NAME_LENGTH = 100


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: StructType
    key: tuple[str, ...]
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    surrogate: str | None = None
    partition: str | None = None
    wider: dict[str, DataType] = field(default_factory=dict)

    @property
    def kept(self) -> StructType:
        """Columns as the store keeps them. ``columns`` has the declared types, which an audit checks; figures that
        grow with what is counted or summed outgrow some of these, and are kept whole in a ``wider`` type."""
        return StructType([StructField(c.name, self.wider.get(c.name, c.dataType), c.nullable) for c in self.columns])

    @property
    def folder(self) -> str:
        """Folder name under the table root: lower case, no spaces."""
        return self.name.lower().replace(" ", "_")

    @property
    def measures(self) -> list[str]:
        fixed = {*self.key, self.surrogate}
        return [c for c in self.columns.fieldNames() if c not in fixed]


def _struct(*cols: tuple) -> StructType:
    return StructType([StructField(c[0], c[1], c[2] if len(c) > 2 else True) for c in cols])


_INT, _LONG, _TEXT, _BOOL = IntegerType(), LongType(), StringType(), BooleanType()
_TO_COUNTRY = ("Country", "ID_Country")

COUNTRY = TableSpec(
    "Country",
    _struct(("ID_Country", _INT, False), ("Name", _TEXT)),
    key=("Name",),
    surrogate="ID_Country",
)
SECTOR = TableSpec(
    "Sector",
    _struct(("ID_Sector", _INT, False), ("Name", _TEXT)),
    key=("Name",),
    surrogate="ID_Sector",
)
POWER_SOURCE = TableSpec(
    "Power Source",
    _struct(("ID_Power", _INT, False), ("Name", _TEXT), ("Renewable", _BOOL)),
    key=("Name",),
    surrogate="ID_Power",
)
SECTOR_COUNTRY = TableSpec(
    "Sector_Country",
    _struct(
        ("Sector_ID_Sector", _INT, False),
        ("Country_ID_Country", _INT, False),
        ("CO2_Emission", DecimalType(12, 4)),
        ("Year", _INT),
    ),
    key=("Sector_ID_Sector", "Country_ID_Country", "Year"),
    foreign_keys={"Sector_ID_Sector": ("Sector", "ID_Sector"), "Country_ID_Country": _TO_COUNTRY},
    partition="Year",
)
POWER_SOURCE_COUNTRY = TableSpec(
    "Power Source_Country",
    _struct(
        ("Power Source_ID_Power", _INT, False),
        ("Country_ID_Country", _INT, False),
        ("Year", _INT),
        ("CO2_Emission", DecimalType(12, 4)),
        ("Power_Generation", DecimalType(12, 4)),
    ),
    key=("Country_ID_Country", "Power Source_ID_Power", "Year"),
    foreign_keys={
        "Power Source_ID_Power": ("Power Source", "ID_Power"),
        "Country_ID_Country": _TO_COUNTRY,
    },
    partition="Year",
)
ENVIRONMENTAL = TableSpec(
    "Environmental Indicator",
    _struct(
        ("ID_Environmental", _INT, False),
        ("CO2_Emision", DecimalType(15, 10)),
        ("Year", _INT),
        ("Country_ID", _INT, False),
    ),
    key=("Country_ID", "Year"),
    foreign_keys={"Country_ID": _TO_COUNTRY},
    surrogate="ID_Environmental",
    partition="Year",
    wider={"CO2_Emision": DecimalType(28, 10)},
)
INVESTMENT = TableSpec(
    "Investment",
    _struct(
        ("ID_Investment", _INT, False),
        ("GDP", DecimalType(12, 2)),
        ("Investment_Energy", DecimalType(15, 2)),
        ("Health_Expenditure", DecimalType(15, 2)),
        ("Year", _INT),
        ("Country_ID", _INT, False),
    ),
    key=("Country_ID", "Year"),
    foreign_keys={"Country_ID": _TO_COUNTRY},
    surrogate="ID_Investment",
    partition="Year",
)
DEVELOPMENT = TableSpec(
    "Development",
    _struct(
        ("ID_Development", _INT, False),
        ("IDH", DecimalType(6, 2)),
        ("Electricity", DecimalType(6, 2)),
        ("Sanitation", DecimalType(6, 2)),
        ("Health", DecimalType(6, 2)),
        ("Standard_Living", DecimalType(6, 2)),
        ("Ano", _INT),
        ("Country_ID", _INT, False),
    ),
    key=("Country_ID", "Ano"),
    foreign_keys={"Country_ID": _TO_COUNTRY},
    surrogate="ID_Development",
    partition="Ano",
    wider=dict.fromkeys(("IDH", "Electricity", "Sanitation", "Health", "Standard_Living"), DecimalType(18, 2)),
)
POWER_CONSUMED = TableSpec(
    "Power Consumed",
    _struct(
        ("ID_Consumed", _INT, False),
        ("GWH", DecimalType(12, 2)),
        ("PowerImport", DecimalType(12, 2)),
        ("Renewable_Energy", DecimalType(7, 4)),
        ("Year", _INT),
        ("Country_ID", _INT, False),
    ),
    key=("Country_ID", "Year"),
    foreign_keys={"Country_ID": _TO_COUNTRY},
    surrogate="ID_Consumed",
    partition="Year",
)
DEMOGRAPHY = TableSpec(
    "Demography",
    _struct(
        ("ID", _INT, False),
        ("Year", _INT),
        ("Population", _LONG),
        ("Country_ID", _INT, False),
    ),
    key=("Country_ID", "Year"),
    foreign_keys={"Country_ID": _TO_COUNTRY},
    surrogate="ID",
    partition="Year",
)

TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in (
        COUNTRY,
        ENVIRONMENTAL,
        INVESTMENT,
        DEVELOPMENT,
        POWER_CONSUMED,
        POWER_SOURCE,
        SECTOR,
        SECTOR_COUNTRY,
        POWER_SOURCE_COUNTRY,
        DEMOGRAPHY,
    )
}
