"""Loads: raw rows to rows of the declared tables, and the ordered load of them all.

Each load is a function from raw DataFrames and dimensions to the rows to write. Where the
outcome depends on row order ("keep the first"), the caller names the order; files read
with ``file_order=True`` carry one.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.numeric import (
    parse_number,
    round_exact,
    round_scaled,
    scaled_int,
    to_double,
    whole_number,
)
from panelwright.functions.text import casefold_key, extract_year, first_chars
from panelwright.operators.joins import Match, Matched, lookup, match_and_report, outer_merge, unmatched_names
from panelwright.operators.merge import last_known
from panelwright.operators.ranking import first_per_key
from panelwright.operators.reshape import unpivot_columns
from panelwright.plans.tidy import EMISSIONS, GENERATION
from panelwright.sinks.store import PanelStore
from panelwright.sources.files import FILE_ORDER, year_columns
from panelwright.sources.seeds import power_source_seed, source_labels

# Country codes of the sheet's global totals.
SHEET_TOTALS = ["GLOBAL TOTAL", "OECD TOTAL", "NON-OECD TOTAL", "EU27"]

IN_FILE_ORDER = (FILE_ORDER,)

Window = tuple[int, int]

# First and last year each table takes from its release. A load takes another
# window as ``years``, the full load through ``RawInputs.years``.
WINDOWS: dict[str, Window] = {
    "Sector_Country": (2000, 2023),
    "Power Source_Country": (2000, 2024),
    "Environmental Indicator": (2000, 2025),
    "Development": (2000, 2025),
    "Investment": (1960, 2025),
    "Power Consumed": (2000, 2025),
    "Demography": (2000, 2025),
}


# ---------------------------------------------------------------- dimensions


def countries(raw: DataFrame, name: str = "Table Name") -> DataFrame:
    """Country names but for the world total; a missing name is kept."""
    kept = raw.where(~F.col(f"`{name}`").eqNullSafe("World"))
    return kept.select(first_chars(F.col(f"`{name}`")).alias("Name"))


def sectors(raw: DataFrame, name: str = "Sector") -> DataFrame:
    names = raw.select(F.col(f"`{name}`").alias("Name")).dropna().distinct()
    return names.select(first_chars(F.col("Name")).alias("Name"))


# -------------------------------------------------------------------- bridges


def _without_totals(sheet: DataFrame) -> DataFrame:
    is_total = F.upper("EDGAR Country Code").isin(SHEET_TOTALS)  # blanks around a code count
    return sheet.where(~F.coalesce(is_total, F.lit(False)))


def sector_emissions(
    sheet: DataFrame, country: DataFrame, sector: DataFrame, years: Window = WINDOWS["Sector_Country"]
) -> DataFrame:
    """Sheet of (sector, country) rows with a column per year -> Sector_Country rows.

    Names are matched on the wide rows, before they multiply by the number of years.
    """
    rows = _sheet_rows(sheet, years)
    for m in sheet_matches(country, sector):
        rows = lookup(rows, m.name, m.dimension, m.dimension_name, m.dimension_id, m.out, m.rule, "inner")
    return _melted(rows, years)


def sheet_matches(country: DataFrame, sector: DataFrame) -> list[Match]:
    """The two columns of names of the sector sheet, the sector first."""
    return [
        Match("Sector", sector, "ID_Sector", "Sector_ID_Sector", kind="sector"),
        Match("Country", country, "ID_Country", "Country_ID_Country", kind="country"),
    ]


@contextmanager
def sector_emissions_and_gaps(
    sheet: DataFrame, country: DataFrame, sector: DataFrame, years: Window = WINDOWS["Sector_Country"]
) -> Iterator[Matched]:
    """``sector_emissions`` together with the names it could not match, from one pass over the sheet."""
    with match_and_report(_sheet_rows(sheet, years), sheet_matches(country, sector)) as found:
        yield Matched(_melted(found.rows, years), found.unmatched)


def _sheet_rows(sheet: DataFrame, years: Window) -> DataFrame:
    return _without_totals(sheet).select("Sector", "Country", *[f"`{y}`" for y in year_columns(sheet, *years)])


def _melted(matched: DataFrame, years: Window) -> DataFrame:
    columns = year_columns(matched, *years)
    typed = matched.select(
        "Sector_ID_Sector", "Country_ID_Country", *[F.col(f"`{y}`").cast("double").alias(y) for y in columns]
    )
    long = unpivot_columns(
        typed, ["Sector_ID_Sector", "Country_ID_Country"], columns, "Year", "CO2_Emission", drop_nulls=True
    )
    return long.where(~F.isnan("CO2_Emission")).select(
        "Sector_ID_Sector",
        "Country_ID_Country",
        F.col("Year").cast("double").cast("int").alias("Year"),
        round_exact(F.col("CO2_Emission"), 2).alias("CO2_Emission"),
    )


def sector_emission_gaps(sheet: DataFrame, country: DataFrame, sector: DataFrame) -> DataFrame:
    """Names the sheet uses and the dimensions lack: (kind, name), sorted.

    Countries are listed only for rows whose sector is known.
    """
    rows = _without_totals(sheet)
    no_sector = unmatched_names(rows, "Sector", sector)
    known = lookup(rows, "Sector", sector, "Name", "ID_Sector", "_sector", "accent_fold", "inner")
    no_country = unmatched_names(known, "Country", country)
    return (
        no_sector.select(F.lit("sector").alias("kind"), F.col("Sector").alias("name"))
        .union(no_country.select(F.lit("country").alias("kind"), F.col("Country").alias("name")))
        .orderBy("kind", "name")
    )


def source_emissions(
    raw: DataFrame,
    country: DataFrame,
    source: DataFrame,
    labels: DataFrame,
    order: Sequence[str] = IN_FILE_ORDER,
    years: Window = WINDOWS["Power Source_Country"],
) -> DataFrame:
    """Long energy rows -> Power Source_Country rows, generation and emission side by side.

    The two categories are brought together per key by one aggregate that keeps the last
    known value of each. That is where joining them and upserting the pairs row by row
    ends, repeated keys included, without ever forming the pairs.
    """
    named = source.join(labels, source["Name"] == labels["name"]).select("label", "ID_Power")
    rows = raw.where(F.col("Year").between(*years) & F.col("Category").isin(GENERATION, EMISSIONS))
    rows = lookup(rows, "Area", country, "Name", "ID_Country", "Country_ID_Country", "exact", "inner")
    rows = lookup(rows, "Variable", named, "label", "ID_Power", "Power Source_ID_Power", "exact", "inner")
    amount = round_scaled(to_double(F.col("Value")), 2)
    result = last_known(
        rows.withColumn("Year", F.col("Year").cast("int")),
        ["Power Source_ID_Power", "Country_ID_Country", "Year"],
        {
            "CO2_Emission": F.when(F.col("Category") == EMISSIONS, amount),
            "Power_Generation": F.when(F.col("Category") == GENERATION, amount),
        },
        order,
    )
    return result.dropna(how="all", subset=["CO2_Emission", "Power_Generation"])


# ----------------------------------------------------------------- indicators


def _in_years(raw: DataFrame, first: int, last: int, year: str = "Year") -> DataFrame:
    return raw.where(F.col(f"`{year}`").between(first, last))


def _country_ids(df: DataFrame, name: str, country: DataFrame) -> DataFrame:
    """Inner match on the case-folded name; a name fitting two countries goes to both."""
    return lookup(df, name, country, "Name", "ID_Country", "Country_ID", "casefold", "inner", unique=False)


def environmental(
    raw: DataFrame,
    country: DataFrame,
    order: Sequence[str] = IN_FILE_ORDER,
    years: Window = WINDOWS["Environmental Indicator"],
) -> DataFrame:
    """CO2 per country and year. A missing figure still makes a row, with a null."""
    rows = _country_ids(_in_years(raw, *years), "Country", country)
    typed = rows.select(
        "Country_ID",
        F.col("Year").cast("int").alias("Year"),
        parse_number(F.col("CO2 Emission")).alias("CO2_Emision"),
        *order,
    )
    return first_per_key(typed, ["Country_ID", "Year"], order).drop(*order)


def _poverty(report: DataFrame, measures: dict[str, str], order: Sequence[str]) -> DataFrame:
    """Poverty report rows -> (key, Ano, measures x10), the first per key and year."""
    rows = report.dropna(subset=["Country"]).select(
        casefold_key(F.col("Country")).alias("key"),
        extract_year(F.col("Year and survey")).alias("Ano"),
        *[scaled_int(parse_number(F.col(f"`{c}`")), 10).alias(n) for n, c in measures.items()],
        *order,
    )
    return first_per_key(rows.dropna(subset=["Ano"]), ["key", "Ano"], order).drop(*order)


def development(
    index: DataFrame,
    poverty_1: DataFrame,
    poverty_2: DataFrame,
    country: DataFrame,
    order: Sequence[str] = IN_FILE_ORDER,
    years: Window = WINDOWS["Development"],
) -> DataFrame:
    """Development index x1000 with the poverty measures of the same country and year.

    Every input is cut to one row per key and year first, so no join can multiply rows.
    """
    measures = outer_merge(
        _poverty(poverty_1, {"Health": "Health", "Standard_Living": "Standard of living"}, order),
        _poverty(poverty_2, {"Electricity": "Electricity", "Sanitation": "Sanitation"}, order),
        ["key", "Ano"],
    )
    typed = _in_years(index, *years).select(
        casefold_key(F.col("Entity")).alias("key"),
        F.col("Year").cast("int").alias("Ano"),
        scaled_int(F.col("Human Development Index"), 1000).alias("IDH"),
        *order,
    )
    first = first_per_key(typed.dropna(subset=["IDH"]), ["key", "Ano"], order).drop(*order)
    keys = country.select(casefold_key(F.col("Name")).alias("key"), F.col("ID_Country").alias("Country_ID"))
    return (
        first.join(measures, ["key", "Ano"], "left")
        .join(keys, "key")
        .select("Country_ID", "Ano", "IDH", "Electricity", "Sanitation", "Health", "Standard_Living")
    )


def investment(
    raw: DataFrame,
    country: DataFrame,
    order: Sequence[str] = IN_FILE_ORDER,
    years: Window = WINDOWS["Investment"],
) -> DataFrame:
    rows = _country_ids(_in_years(raw, *years, "year"), "country_name", country)
    typed = rows.select(
        "Country_ID",
        F.col("year").cast("int").alias("Year"),
        to_double(F.col("gdp")).alias("GDP"),
        to_double(F.col("investment_energy")).alias("Investment_Energy"),
        to_double(F.col("health_expenditure")).alias("Health_Expenditure"),
        *order,
    )
    return first_per_key(typed.dropna(subset=["GDP"]), ["Country_ID", "Year"], order).drop(*order)


def power_consumed(
    raw: DataFrame,
    country: DataFrame,
    order: Sequence[str] = IN_FILE_ORDER,
    years: Window = WINDOWS["Power Consumed"],
) -> DataFrame:
    """Consumption, imports and renewable share; a row without any figure is kept too."""
    rows = _country_ids(_in_years(raw, *years), "Country", country)
    renewable = "Renewable energy consumption (% of total final energy consumption)"
    typed = rows.select(
        "Country_ID",
        F.col("Year").cast("int").alias("Year"),
        parse_number(F.col("GWH")).alias("GWH"),
        parse_number(F.col("`Energy imports, net (% of energy use)`")).alias("PowerImport"),
        parse_number(F.col(f"`{renewable}`")).alias("Renewable_Energy"),
        *order,
    )
    return first_per_key(typed, ["Country_ID", "Year"], order).drop(*order)


def demography(
    raw: DataFrame,
    country: DataFrame,
    order: Sequence[str] = IN_FILE_ORDER,
    years: Window = WINDOWS["Demography"],
) -> DataFrame:
    rows = _country_ids(_in_years(raw, *years), "Entity", country)
    typed = rows.select(
        "Country_ID",
        F.col("Year").cast("int").alias("Year"),
        whole_number(F.col("Population (historical)")).alias("Population"),
        *order,
    )
    return first_per_key(typed.dropna(subset=["Population"]), ["Country_ID", "Year"], order).drop(*order)


# ------------------------------------------------------------------ all of it


@dataclass(frozen=True)
class RawInputs:
    """The raw tables a full load reads."""

    country_list: DataFrame
    sector_sheet: DataFrame
    energy: DataFrame
    emissions: DataFrame
    development_index: DataFrame
    poverty_1: DataFrame
    poverty_2: DataFrame
    investment: DataFrame
    consumption: DataFrame
    order: Sequence[str] = IN_FILE_ORDER
    years: Mapping[str, Window] = field(default_factory=dict)  # per table, in place of WINDOWS


def cut_names(names: DataFrame, name: str) -> DataFrame:
    """Names that only differ beyond the declared length, by what is left of them."""
    full = names.select(F.col(f"`{name}`").alias("full")).dropna().distinct()
    cut = full.groupBy(first_chars(F.col("full")).alias("Name")).agg(F.count(F.lit(1)).alias("n_names"))
    return cut.where("n_names > 1")


def _refuse_cut_names(names: DataFrame, name: str) -> None:
    lost = cut_names(names, name).first()
    if lost:
        raise ValueError(f"{lost.n_names} names would become one, {lost.Name!r}")


def load_all(spark: SparkSession, raw: RawInputs, store: PanelStore) -> None:
    """Dimensions, then bridges, then indicators; safe to repeat.

    Names of the sheet that no dimension knows are kept as the report of Sector_Country.

    A sheet in which two rows fold to one sector and country has a repeated key, and so do
    names that agree in their first characters: both raise.

    Every stage reads what earlier stages wrote, so a stage that has been committed is not
    computed again when a later one is.
    """
    window = {**WINDOWS, **raw.years}
    store.create()
    _refuse_cut_names(raw.country_list, "Table Name")
    _refuse_cut_names(raw.sector_sheet, "Sector")
    store.insert_ignore("Country", countries(raw.country_list))
    store.insert_ignore("Sector", sectors(raw.sector_sheet))
    store.insert_ignore("Power Source", power_source_seed(spark))
    country, order = store.read("Country"), raw.order
    with sector_emissions_and_gaps(raw.sector_sheet, country, store.read("Sector"), window["Sector_Country"]) as found:
        store.upsert("Sector_Country", found.rows)
        store.write_report("Sector_Country", found.unmatched)
    store.upsert(
        "Power Source_Country",
        source_emissions(raw.energy, country, store.read("Power Source"), source_labels(spark), order, window["Power Source_Country"]),
    )
    store.upsert("Environmental Indicator", environmental(raw.emissions, country, order, window["Environmental Indicator"]))
    store.upsert(
        "Development",
        development(raw.development_index, raw.poverty_1, raw.poverty_2, country, order, window["Development"]),
    )
    store.upsert("Investment", investment(raw.investment, country, order, window["Investment"]))
    store.upsert("Power Consumed", power_consumed(raw.consumption, country, order, window["Power Consumed"]))
    store.upsert("Demography", demography(raw.development_index, country, order, window["Demography"]), mode="replace")
