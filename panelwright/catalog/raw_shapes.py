"""Raw-looking inputs for the loads, derived by Spark from the star tables.

They imitate the layouts the loads expect: wide sheets, long releases, numbers as text
with comma decimals, messy names, repeated rows. ``seq`` is the row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from panelwright.operators.reshape import unpivot_columns
from panelwright.plans.star_panel import StarPanel
from panelwright.plans.tidy import EMISSIONS, GENERATION
from panelwright.sources.files import clean_headers
from panelwright.sources.seeds import literal_rows

SEQ = ("seq",)

# The label an energy file gives each segment; others keep their own name.
SEGMENT_LABELS = [
    ("AUTOMOBILE", "Coal"),
    ("BUILDING", "Solar"),
    ("FURNITURE", "Wind"),
    ("HOUSEHOLD", "Other Fossil"),
    ("MACHINERY", "Bioenergy"),
]
CAPACITY = "Capacity"


class ScaledPanel(StarPanel):
    """The star panel with every amount divided by a stated factor, so that it fits the declared types.

    Two decimals are kept, so that sheet values stay exact in binary and both engines round alike."""

    factor = 100_000

    def __getitem__(self, name: str) -> DataFrame:
        df = super().__getitem__(name)
        sums = [f.name for f in df.schema if isinstance(f.dataType, DecimalType) and f.name != "Renewable_Energy"]
        return df.withColumns({c: (F.col(c) / self.factor).cast("decimal(20,2)") for c in sums})


def known_countries(panel: StarPanel) -> DataFrame:
    """Country dimension; the raw inputs misspell the nations of region 0, so they stay unmatched."""
    return panel.star("nation").select(F.col("n_nationkey").alias("ID_Country"), _plain("n_name").alias("Name"))


def _plain(name: str) -> Column:
    return F.replace(F.col(name), F.lit("_"), F.lit(" "))


def _names(panel: StarPanel, key: str) -> DataFrame:
    misspelt = F.when(F.col("n_regionkey") == 0, F.concat(F.lit("OLD "), _plain("n_name"))).otherwise(_plain("n_name"))
    return panel.star("nation").select(F.col("n_nationkey").alias(key), misspelt.alias("plain"))


def _messy(plain: Column) -> Column:
    """``NATION 3`` with mixed case, outer blanks, a tab and a no-break space."""
    return F.concat(F.lit("  "), F.initcap(F.replace(plain, F.lit(" "), F.lit(" \u00a0\t"))), F.lit(" "))


def _comma(value: Column) -> Column:
    return F.coalesce(F.replace(value.cast("string"), F.lit("."), F.lit(",")), F.lit(".."))


def _twice(df: DataFrame) -> DataFrame:
    """Every row two times, told apart by ``seq``."""
    return df.withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2))))


def sector_sheet(panel: StarPanel) -> DataFrame:
    """(Sector, EDGAR Country Code, Country) rows with a column per year, five years on."""
    accents = ("AEIOU", "ÀÉÎÕÜ")
    cells = {
        f" {y + 5}.0": F.max(F.when(F.col("Year") == y, (F.col("CO2_Emission") * 100).cast("double") / 1024))
        for y in panel.order_years
    }
    wide = (
        panel["Sector_Country"]
        .groupBy("Sector_ID_Sector", "Country_ID_Country")
        .agg(*[c.alias(n) for n, c in cells.items()])
        .join(panel["Sector"].withColumnRenamed("ID_Sector", "Sector_ID_Sector"), "Sector_ID_Sector")
        .join(_names(panel, "Country_ID_Country"), "Country_ID_Country")
    )
    # a total's code with blanks around it is no total
    code = (
        F.when(F.col("Country_ID_Country") == 7, F.lit("eu27"))
        .when(F.col("Country_ID_Country") == 8, F.lit(" eu27 "))
        .when(F.col("Country_ID_Country") != 2, F.lit("XYZ"))
    )
    return clean_headers(
        wide.select(
            F.translate("Name", *accents).alias("Sector "),
            code.alias(" EDGAR Country Code"),
            F.concat(F.lit(" "), F.translate("plain", *accents)).alias("Country"),
            *[f"`{n}`" for n in cells],
        )
    )


def energy_release(panel: StarPanel) -> DataFrame:
    """Long rows (Area, Year, Category, Subcategory, Variable, Unit, Value as text, seq).

    The second copy of a row repeats the emission, changed, and has no usable generation.
    """
    labels = literal_rows(panel.spark, SEGMENT_LABELS, "Name, Variable")
    named = (
        panel["Power Source_Country"]
        .join(panel["Power Source"].withColumnRenamed("ID_Power", "Power Source_ID_Power"), "Power Source_ID_Power")
        .join(labels, "Name", "left")
        .withColumn("Variable", F.coalesce("Variable", "Name"))
        .join(_names(panel, "Country_ID_Country"), "Country_ID_Country")
    )
    generation = F.col("Power_Generation").cast("double") / 8
    emission = F.col("CO2_Emission").cast("double") / 8
    rows = _twice(named).select(
        F.col("plain").alias("Area"),
        (F.col("Year") + 5).alias("Year"),
        "Variable",
        "seq",
        F.when(F.col("seq") == 1, generation.cast("string")).otherwise(F.lit("n/a")).alias(GENERATION),
        F.when(F.col("seq") == 1, emission).otherwise(emission / 2).cast("string").alias(EMISSIONS),
        F.lit("1").alias(CAPACITY),
    )
    long = unpivot_columns(
        rows, ["Area", "Year", "Variable", "seq"], [GENERATION, EMISSIONS, CAPACITY], "Category", "Value"
    )
    unit = (
        F.when(F.col("Category") == GENERATION, F.lit("TWh"))
        .when(F.col("Category") == EMISSIONS, F.lit("mtCO2"))
        .otherwise(F.lit("GW"))
    )
    return long.select(
        "Area", "Year", "Category", F.lit("Fuel").alias("Subcategory"), "Variable", unit.alias("Unit"), "Value", "seq"
    )


def emission_rows(panel: StarPanel) -> DataFrame:
    named = panel["Environmental Indicator"].join(_names(panel, "Country_ID"), "Country_ID")
    return _twice(named).select(
        _messy(F.col("plain")).alias("Country"),
        (F.col("Year") + 2).alias("Year"),
        F.when(F.col("seq") == 1, _comma(F.col("CO2_Emision"))).otherwise("1,5").alias("CO2 Emission"),
        "seq",
    )


def development_index(panel: StarPanel) -> DataFrame:
    people = panel["Demography"].withColumnRenamed("Year", "Ano")
    named = (
        panel["Development"].join(people, ["Country_ID", "Ano"]).join(_names(panel, "Country_ID"), "Country_ID")
    )
    return _twice(named).select(
        _messy(F.col("plain")).alias("Entity"),
        (F.col("Ano") + 2).alias("Year"),
        (F.col("IDH") / F.lit(1024.0) / F.col("seq")).alias("Human Development Index"),
        (F.col("Population") + F.lit(0.9) / F.col("seq")).alias("Population (historical)"),
        "seq",
    )


def _tenths(count: str) -> Column:
    return _comma((F.col(count).cast("decimal(12,1)") / 10).cast("decimal(12,1)"))


def _survey(panel: StarPanel) -> DataFrame:
    named = panel["Development"].join(_names(panel, "Country_ID"), "Country_ID")
    first = F.col("Ano") + 2
    return named.select(
        _messy(F.col("plain")).alias("Country"),
        F.concat(first.cast("string"), F.lit("/"), (first + 1).cast("string"), F.lit(" M")).alias("Year and survey"),
        "IDH",
        "Electricity",
        "Health",
        "Ano",
        F.lit(1).alias("seq"),
    )


def poverty_1(panel: StarPanel) -> DataFrame:
    return _survey(panel).select(
        "Country",
        "Year and survey",
        _tenths("Health").alias("Health"),
        _tenths("IDH").alias("Standard of living"),
        "seq",
    )


def poverty_2(panel: StarPanel) -> DataFrame:
    """Most rows of the second report are without a year."""
    dated = F.when((F.col("Ano") > 1998) & (F.col("Ano") < 2001), F.col("Year and survey")).otherwise(F.lit("—"))
    return _survey(panel).select(
        "Country",
        dated.alias("Year and survey"),
        _tenths("Electricity").alias("Electricity"),
        _tenths("IDH").alias("Sanitation"),
        "seq",
    )


def investment_rows(panel: StarPanel) -> DataFrame:
    named = panel["Investment"].join(_names(panel, "Country_ID"), "Country_ID")
    gdp = F.when(F.col("Country_ID") == 3, F.lit("n/a")).otherwise(F.col("GDP").cast("string"))
    return _twice(named).select(
        _messy(F.col("plain")).alias("country_name"),
        F.col("Year").alias("year"),
        F.when(F.col("seq") == 1, gdp).otherwise(F.lit("1")).alias("gdp"),
        F.col("Investment_Energy").cast("string").alias("investment_energy"),
        F.col("Health_Expenditure").cast("double").cast("string").alias("health_expenditure"),
        "seq",
    )


def consumption_rows(panel: StarPanel) -> DataFrame:
    named = panel["Power Consumed"].join(_names(panel, "Country_ID"), "Country_ID")
    return _twice(named).select(
        _messy(F.col("plain")).alias("Country"),
        (F.col("Year") + 2).alias("Year"),
        _comma(F.col("PowerImport")).alias("Energy imports, net (% of energy use)"),
        _comma(F.col("Renewable_Energy")).alias(
            "Renewable energy consumption (% of total final energy consumption)"
        ),
        F.when(F.col("seq") == 1, F.concat(F.lit("ca. "), _comma(F.col("GWH")))).otherwise("7").alias("GWH"),
        "seq",
    )


def fossil_sheet(panel: StarPanel) -> DataFrame:
    """(Country, one column per year) of the total emission."""
    cells = [
        F.max(F.when(F.col("Year") == y, F.col("CO2_Emision").cast("double"))).alias(str(y + 5))
        for y in panel.order_years
    ]
    return (
        panel["Environmental Indicator"]
        .join(panel["Country"].withColumnRenamed("ID_Country", "Country_ID"), "Country_ID")
        .groupBy(F.col("Name").alias("Country"))
        .agg(*cells)
    )


def land_use_sheet(panel: StarPanel) -> DataFrame:
    """(Year, one column per nation) of returned amounts, three years on."""
    nations = panel.star("nation").select("n_nationkey", "n_name").collect()  # the columns of the sheet
    cells = [
        F.sum(F.when(F.col("Country_ID_Country") == n, F.col("CO2_Emission"))).cast("double").alias(name)
        for n, name in nations
    ]
    return panel["Power Source_Country"].groupBy((F.col("Year") + 3).alias("Year")).agg(*cells)
