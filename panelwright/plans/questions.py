"""The six analytical questions over the panel.

``panel`` maps table names to DataFrames with the columns of ``schema``. Facts are
collapsed to the grain of the answer before they meet anything else, so each question
shuffles a fact once, partly combined, and every later join works on small rows.
Descending sorts put NULLs first throughout, and every limit has a total order.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.numeric import ratio, share_text
from panelwright.operators.aggregates import (
    conditional_sums,
    leader,
    side_totals,
    sum_by_dimension,
    union_distinct,
)
from panelwright.operators.ranking import sort_desc, top_k
from panelwright.sources.views import pick

Panel = Mapping[str, DataFrame]
_COUNTRY_YEAR = ["country_id", "Year"]


def _countries(panel: Panel, name: str = "Country") -> DataFrame:
    return panel["Country"].select(F.col("ID_Country").alias("country_id"), F.col("Name").alias(name))


def _by_country_year(panel: Panel, table: str, *columns: str) -> DataFrame:
    """A table keyed (country_id, Year), whatever it calls the two, plus the named columns."""
    df = panel[table]
    country = "Country_ID" if "Country_ID" in df.columns else "Country_ID_Country"
    year = "Ano" if "Ano" in df.columns else "Year"
    return df.select(F.col(country).alias("country_id"), F.col(year).alias("Year"), *columns)


def top_sector_share(panel: Panel, year: int = 2023) -> DataFrame:
    """Per country: total emission of the year, its top sector, and that sector's share."""
    rows = panel["Sector_Country"].where(F.col("Year") == year)
    emission, sector = F.col("CO2_Emission"), F.col("Sector_ID_Sector")
    per_country = rows.groupBy(F.col("Country_ID_Country").alias("country_id")).agg(
        F.sum(emission).alias("total"),
        leader(F.struct(sector, emission), emission, ties=[sector]).alias("top"),
    )
    named = per_country.select(
        "country_id", "total", F.col("top.Sector_ID_Sector").alias("sector_id"), "top.CO2_Emission"
    ).join(_countries(panel), "country_id")
    sectors = panel["Sector"].select(
        F.col("ID_Sector").alias("sector_id"), F.col("Name").alias(f"Top Sector {year}")
    )
    answer = named.join(sectors, "sector_id").select(
        "Country",
        F.col("total").alias(f"Total CO₂ {year} (Mt)"),
        f"Top Sector {year}",
        F.col("CO2_Emission").alias(f"Sector CO₂ {year} (Mt)"),
        share_text(F.col("CO2_Emission"), F.col("total")).alias("Share"),
    )
    return sort_desc(answer, f"Total CO₂ {year} (Mt)", ties=["Country"])


def emission_intensity(panel: Panel, k: int = 100) -> DataFrame:
    """Grams of CO2 per kWh for each country, source and year; the top ``k`` emitters first."""
    sources = panel["Power Source"].select(
        F.col("ID_Power").alias("Power Source_ID_Power"),
        F.col("Name").alias("Energy Source"),
        "Renewable",
    )
    rows = (
        panel["Power Source_Country"]
        .withColumnRenamed("Country_ID_Country", "country_id")
        .join(_countries(panel), "country_id")
        .join(sources, "Power Source_ID_Power")
        .select(
            "Country",
            "Year",
            "Energy Source",
            "Renewable",
            F.col("Power_Generation").alias("Generation_TWh"),
            F.col("CO2_Emission").alias("Emissions_Mt"),
        )
    )
    top = top_k(rows, k, "Year", "Emissions_Mt", "Generation_TWh", ties=["Country", "Energy Source"])
    return top.withColumn(
        "gCO2_per_kWh", ratio(F.col("Emissions_Mt"), F.col("Generation_TWh"), 1000, digits=1)
    )


def _power_and_sector(panel: Panel) -> DataFrame:
    """Per (country, year) with rows on both sides: sums and row counts of the two bridges."""
    power = side_totals(
        _by_country_year(panel, "Power Source_Country", "CO2_Emission", "Power_Generation"),
        _COUNTRY_YEAR,
        {"power_emission": F.col("CO2_Emission"), "generation": F.col("Power_Generation")},
        rows="power_rows",
    )
    sector = side_totals(
        _by_country_year(panel, "Sector_Country", "CO2_Emission"),
        _COUNTRY_YEAR,
        {"sector_emission": F.col("CO2_Emission")},
        rows="sector_rows",
    )
    return power.join(sector, _COUNTRY_YEAR)


def _fan_out(panel: Panel, fan_out: bool) -> tuple[Column, Column]:
    """Multipliers for (power, sector) sums: the other side's rows, or 1 for plain sums."""
    if not fan_out:
        return F.lit(1), F.lit(1)
    return F.col("sector_rows"), F.col("power_rows")


def emission_breakdown(panel: Panel, k: int = 100, fan_out: bool = True) -> DataFrame:
    """Total, power and sector emission per country and year, the latest and largest first.

    ``fan_out=True`` gives the sums of the many-to-many join of both bridges, where every
    power row counts once per sector and the reverse; ``False`` counts each row once.
    """
    per_power, per_sector = _fan_out(panel, fan_out)
    total = _by_country_year(
        panel, "Environmental Indicator", F.col("CO2_Emision").alias("Total Emission")
    )
    rows = _power_and_sector(panel).join(total, _COUNTRY_YEAR).join(_countries(panel), "country_id")
    answer = rows.groupBy("Country", "Year", "Total Emission").agg(
        F.sum(F.col("power_emission") * per_power).alias("Emission Power"),
        F.sum(F.col("sector_emission") * per_sector).alias("Emission Sector"),
    )
    return top_k(
        answer, k, "Year", "Total Emission", "Emission Power", "Emission Sector", ties=["Country"]
    )


def yearly_leaders(panel: Panel, k: int = 30, nulls: str = "first") -> DataFrame:
    """Per year: total emission by sector, by source and by country with the largest of each,
    and the sums of the development index and of GDP.

    ``nulls="first"`` lets a country without a figure lead its year, as the original
    ordering does; ``"last"`` names the largest known emitter.

    The five inputs, cut down to rows of (year, name, amount), are stacked and grouped by
    year once.
    """
    sector = sum_by_dimension(
        panel["Sector_Country"],
        "Sector_ID_Sector",
        panel["Sector"].select("ID_Sector", F.col("Name").alias("sector")),
        "ID_Sector",
        ["sector"],
        ["Year"],
        {"co2_sector": F.col("CO2_Emission")},
    )
    energy = sum_by_dimension(
        panel["Power Source_Country"],
        "Power Source_ID_Power",
        panel["Power Source"].select("ID_Power", F.col("Name").alias("energy"), "Renewable"),
        "ID_Power",
        ["energy", "Renewable"],
        ["Year"],
        {"co2_energy": F.col("CO2_Emission")},
    ).drop("Renewable")
    country = (
        _by_country_year(panel, "Environmental Indicator", F.col("CO2_Emision").alias("co2_country"))
        .join(_countries(panel, "country"), "country_id")
        .drop("country_id")
    )
    idh = _by_country_year(panel, "Development", "IDH").groupBy("Year").agg(F.sum("IDH").alias("idh"))
    gdp = _by_country_year(panel, "Investment", "GDP").groupBy("Year").agg(F.sum("GDP").alias("gdp"))
    kinds = {"sector": sector, "energy": energy, "country": country, "idh": idh, "gdp": gdp}
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [df.withColumn("kind", F.lit(kind)) for kind, df in kinds.items()],
    )

    def top(kind: str) -> Column:
        name = F.col(kind)
        return leader(name, F.col(f"co2_{kind}"), [name], nulls, where=F.col("kind") == kind)

    answer = stacked.groupBy("Year").agg(
        F.sum("co2_sector").alias("co2_total_sector"),
        top("sector").alias("sector_maior_emissao"),
        F.sum("co2_energy").alias("co2_total_energia"),
        top("energy").alias("energia_maior_emissao"),
        F.sum("co2_country").alias("co2_total_country"),
        top("country").alias("country_maior_emissao"),
        F.sum("idh").alias("total_idh"),
        F.sum("gdp").alias("total_gdp"),
    )
    known = ["co2_total_sector", "co2_total_energia", "co2_total_country", "total_idh", "total_gdp"]
    return top_k(
        answer.dropna(how="any", subset=known).where(F.col("Year").isNotNull()),
        k,
        "Year",
        "co2_total_country",
        "co2_total_energia",
        "co2_total_sector",
    )


def covered_years(panel: Panel) -> DataFrame:
    """UNION of the years found in the two bridges, Development and Investment."""
    return union_distinct(
        pick(panel, "Sector_Country", "Year"),
        pick(panel, "Power Source_Country", "Year"),
        panel["Development"].select(F.col("Ano").alias("Year")),
        pick(panel, "Investment", "Year"),
    )


def development_panel(panel: Panel, k: int = 50, fan_out: bool = True) -> DataFrame:
    """Development index against investment, energy and emissions per country and year."""
    per_power, per_sector = _fan_out(panel, fan_out)
    invested = _by_country_year(
        panel,
        "Investment",
        "GDP",
        F.col("Investment_Energy").alias("eletricity investiment"),
        F.col("Health_Expenditure").alias("helth investiment"),
    ).where(F.col("GDP").isNotNull())
    developed = _by_country_year(
        panel,
        "Development",
        "IDH",
        F.col("Electricity").alias("electricity index"),
        F.col("Health").alias("health index"),
    ).dropna(how="any", subset=["IDH", "electricity index", "health index"])
    total = _by_country_year(
        panel, "Environmental Indicator", F.col("CO2_Emision").alias("total_emission")
    )
    consumed = _by_country_year(
        panel,
        "Power Consumed",
        F.col("Renewable_Energy").alias("renewable share pct"),
        F.col("PowerImport").alias("import_gwh"),
    )
    rows = (
        invested.join(developed, _COUNTRY_YEAR)
        .join(total, _COUNTRY_YEAR)
        .join(consumed, _COUNTRY_YEAR)
        .join(_power_and_sector(panel), _COUNTRY_YEAR)
        .join(_countries(panel, "country"), "country_id")
    )
    carried = [
        "country",
        "Year",
        "IDH",
        "GDP",
        "electricity index",
        "eletricity investiment",
        "health index",
        "helth investiment",
        "renewable share pct",
        "import_gwh",
        "total_emission",
    ]
    answer = rows.groupBy(*carried).agg(
        F.sum(F.col("generation") * per_power).alias("total_power_generation"),
        F.sum(F.col("sector_emission") * per_sector).alias("sector emission"),
        F.sum(F.col("power_emission") * per_power).alias("emission energy"),
    )
    top = top_k(answer, k, "IDH", "GDP", "total_emission", "Year", ties=carried)
    return top.select(
        *carried[:8],
        "total_power_generation",
        *carried[8:],
        "sector emission",
        "emission energy",
    )


def renewable_split(panel: Panel, after: int = 2010, investment_key: str = "Country_ID") -> DataFrame:
    """Renewable and other generation against consumption and access, per country and year.

    ``investment_key="ID_Investment"`` matches countries with Investment's own row id, which
    is how the question was first written; the default matches its country.
    """
    recent = F.col("Year") > after
    generation = (
        panel["Power Source_Country"]
        .where(recent)
        .groupBy(F.col("Country_ID_Country").alias("country_id"), "Power Source_ID_Power", "Year")
        .agg(F.sum("Power_Generation").alias("generation"))
    )
    sources = panel["Power Source"].select(
        F.col("ID_Power").alias("Power Source_ID_Power"), "Renewable"
    )
    split = (
        generation.join(sources, "Power Source_ID_Power")
        .groupBy(*_COUNTRY_YEAR)
        .agg(
            *conditional_sums(
                F.col("generation"),
                {
                    "renewable_power": F.col("Renewable") == F.lit(True),
                    "non_renewable_power": F.col("Renewable") == F.lit(False),
                },
            )
        )
    )
    developed = _by_country_year(panel, "Development", F.col("Electricity").alias("access_to_energy"))
    invested = panel["Investment"].select(
        F.col(investment_key).alias("country_id"), "Year", "Investment_Energy"
    )
    consumed = _by_country_year(
        panel,
        "Power Consumed",
        F.col("GWH").alias("power_consumed"),
        F.col("Renewable_Energy").alias("renewable_share_pct"),
        F.col("PowerImport").alias("power_import_consumed"),
    )
    rows = (
        split.join(developed.where(recent), _COUNTRY_YEAR)
        .join(invested.where(recent), _COUNTRY_YEAR)
        .join(consumed.where(recent), _COUNTRY_YEAR)
        .join(_countries(panel, "country"), "country_id")
    )
    carried = [
        "country",
        "Year",
        "Investment_Energy",
        "power_consumed",
        "renewable_share_pct",
        "power_import_consumed",
        "access_to_energy",
    ]
    answer = rows.groupBy(*carried).agg(
        F.sum("renewable_power").alias("renewable_power"),
        F.sum("non_renewable_power").alias("non_renewable_power"),
    )
    return sort_desc(
        answer.select(*carried[:3], "renewable_power", "non_renewable_power", *carried[3:]),
        "Investment_Energy",
        "renewable_power",
        "access_to_energy",
        ties=carried,
    )
