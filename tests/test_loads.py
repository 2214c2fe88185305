"""A full load from small hand-written files, read the way real releases are laid out."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelwright import sources
from panelwright.plans import loads, questions, tidy
from panelwright.sinks import PanelStore

FILES = {
    "countries.csv": "Table Name,Region\nWorld,\nAfghanistan,SA\nTürkiye,ECA\nSão Tomé and Príncipe,AF\nChad,AF\n,\n",
    "sheet.csv": (
        "Sector,EDGAR Country Code,Country,1999,2000.0,2001.0\n"
        "Power Industry,AFG,Afghanistan,9,2.675,\n"
        "Power Industry,TUR,Turkiye,9,1.005,3\n"
        "Transport,AFG, AFGHANISTAN,9,0.5,0.25\n"
        "Transport,eu27,Afghanistan,9,100,100\n"
        "Transport,,Chad,9,4,\n"
        "Transport,XXX,Atlantis,9,4,4\n"
        ",YYY,Lemuria,9,4,4\n"
    ),
    "energy.csv": (
        "Area,Year,Category,Subcategory,Variable,Unit,Value\n"
        "Chad,2000,Electricity generation,Fuel,Coal,TWh,1.125\n"
        "Chad,2000,Power sector emissions,Fuel,Coal,mtCO2,2\n"
        "Chad,2000,Power sector emissions,Fuel,Coal,mtCO2,bad\n"
        "Chad,2000,Electricity generation,Fuel,Other Fossil,TWh,7\n"
        "Chad,2001,Electricity generation,Fuel,Wind,TWh,\n"
        "Chad,1999,Electricity generation,Fuel,Coal,TWh,5\n"
        "Chad,2000,Electricity generation,Total,Coal,TWh,99\n"
        "Chad,2000,Capacity,Fuel,Coal,GW,99\n"
        "chad,2000,Electricity generation,Fuel,Gas,TWh,99\n"
    ),
    "emissions.csv": (
        'Country,Year,CO2 Emission\n chad ,2000,"1,25"\nCHAD,2000,9\nTürkiye,2000,..\nAtlantis,2000,1\nChad,1999,1\n'
    ),
    "index.csv": (
        "Entity,Year,Human Development Index,Population (historical)\n"
        "Chad,2000,0.2985,8000000\nchad,2000,0.9,1\nTÜRKIYE,2017,0.8145,80000000\nAfghanistan,2000,,20000000\n"
    ),
    "poverty1.csv": 'T,,,,\n,,,,\nCountry,Year and survey,b,Health,Living\nTürkiye,2017/2018 D,,"28,35","55,1"\nChad,—,,"1,0","2,0"\n',
    "poverty2.csv": 'T,,,\nCountry,Year and survey,Electricity ,Sanitation \nturkiye,2017 D,1,1\nTürkiye,2017 D,"0,5",..\n',
    "investment.csv": (
        "country_name,country_code,year,gdp,investment_energy,health_expenditure\n"
        "Chad,TCD,2000,100.005,,3.5\nChad,TCD,2000,7,7,7\nTürkiye,TUR,1965,x,1,1\nTürkiye,TUR,1966,5,1,\n"
    ),
    "consumption.csv": (
        "Country,Year,"
        '"Energy imports, net (% of energy use)",Renewable energy consumption (% of total final energy consumption),GWH\n'
        'Chad,2000,-75.46,"1,5",1.25\nTürkiye,2000,..,..,..\n'
    ),
}


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for name, text in FILES.items():
        (folder / name).write_text(text, encoding="utf-8")

    def read(name, schema):
        return sources.read_delimited(spark, str(folder / name), schema, file_order=True)

    renewable = "Renewable energy consumption (% of total final energy consumption)"
    return loads.RawInputs(
        country_list=read("countries.csv", "`Table Name` string, Region string"),
        sector_sheet=sources.read_sheet_export(spark, str(folder / "sheet.csv")),
        energy=read(
            "energy.csv",
            "Area string, Year int, Category string, Subcategory string, Variable string, Unit string, Value string",
        ).where(F.col("Subcategory") == "Fuel"),
        emissions=read("emissions.csv", "Country string, Year int, `CO2 Emission` string"),
        development_index=read(
            "index.csv",
            "Entity string, Year int, `Human Development Index` double, `Population (historical)` double",
        ),
        poverty_1=sources.read_with_preamble(
            spark, str(folder / "poverty1.csv"), 5,
            {"Country": 0, "Year and survey": 1, "Health": 3, "Standard of living": 4}, "Country", True,
        ),
        poverty_2=sources.read_with_preamble(
            spark, str(folder / "poverty2.csv"), 4,
            {"Country": 0, "Year and survey": 1, "Electricity": 2, "Sanitation": 3}, "Country", True,
        ),
        investment=read(
            "investment.csv",
            "country_name string, country_code string, year int, gdp string, investment_energy string,"
            " health_expenditure string",
        ),
        consumption=read(
            "consumption.csv",
            f"Country string, Year int, `Energy imports, net (% of energy use)` string, `{renewable}` string, GWH string",
        ),
    )


@pytest.fixture(scope="module")
def store(spark, raw, tmp_path_factory):
    store = PanelStore(spark, str(tmp_path_factory.mktemp("panel")))
    loads.load_all(spark, raw, store)
    return store


def named(store, table, key="Country_ID"):
    names = store.read("Country").select(F.col("ID_Country").alias(key), F.col("Name").alias("country"))
    df = store.read(table).join(names, key).drop(key)
    surrogates = [c for c in df.columns if c in ("ID", "ID_Environmental", "ID_Investment", "ID_Development", "ID_Consumed")]
    return [tuple(float(v) if hasattr(v, "as_tuple") else v for v in r) for r in rows(df.drop(*surrogates))]


def test_dimensions(store):
    assert {r.Name for r in store.read("Country").collect()} == {
        None, "Afghanistan", "Türkiye", "São Tomé and Príncipe", "Chad",
    }
    assert {r.Name for r in store.read("Sector").collect()} == {"Power Industry", "Transport"}
    assert store.read("Power Source").count() == 9


def test_sector_country(store):
    sectors = store.read("Sector").select(F.col("ID_Sector").alias("Sector_ID_Sector"), F.col("Name").alias("sector"))
    got = [
        (r.country, r.sector, r.Year, float(r.CO2_Emission))
        for r in store.read("Sector_Country")
        .join(sectors, "Sector_ID_Sector")
        .join(store.read("Country").select(F.col("ID_Country").alias("Country_ID_Country"), F.col("Name").alias("country")), "Country_ID_Country")
        .collect()
    ]
    assert sorted(got) == [
        ("Afghanistan", "Power Industry", 2000, 2.67),
        ("Afghanistan", "Transport", 2000, 0.5),
        ("Afghanistan", "Transport", 2001, 0.25),
        ("Chad", "Transport", 2000, 4.0),
        ("Türkiye", "Power Industry", 2000, 1.0),
        ("Türkiye", "Power Industry", 2001, 3.0),
    ]


def test_sector_gaps(store, raw):
    gaps = loads.sector_emission_gaps(raw.sector_sheet, store.read("Country"), store.read("Sector"))
    assert [tuple(r) for r in gaps.collect()] == [("country", "Atlantis"), ("sector", None)]


def test_power_source_country(store):
    power = store.read("Power Source").select(F.col("ID_Power").alias("Power Source_ID_Power"), F.col("Name").alias("source"))
    got = [
        (r.source, r.Year, r.Power_Generation and float(r.Power_Generation), r.CO2_Emission and float(r.CO2_Emission))
        for r in store.read("Power Source_Country").join(power, "Power Source_ID_Power").collect()
    ]
    assert sorted(got) == [("Coal", 2000, 1.12, 2.0), ("Oil", 2000, 7.0, None)]


def test_indicators(store):
    assert named(store, "Environmental Indicator") == [(1.25, 2000, "Chad"), (None, 2000, "Türkiye")]
    assert named(store, "Development") == [
        (298.0, None, None, None, None, 2000, "Chad"),
        (814.0, 5.0, None, 284.0, 551.0, 2017, "Türkiye"),
    ]
    assert named(store, "Investment") == [(5.0, 1.0, None, 1966, "Türkiye"), (100.01, None, 3.5, 2000, "Chad")]
    assert named(store, "Power Consumed") == [(1.25, -75.46, 1.5, 2000, "Chad"), (None, None, None, 2000, "Türkiye")]
    assert named(store, "Demography") == [
        (2000, 8000000, "Chad"), (2000, 20000000, "Afghanistan"), (2017, 80000000, "Türkiye"),
    ]


def test_a_second_load_changes_nothing(spark, raw, store):
    before = {t: rows(df) for t, df in store.panel().items()}
    loads.load_all(spark, raw, store)
    assert {t: rows(df) for t, df in store.panel().items()} == before


def test_questions_run_on_the_stored_panel(store):
    panel = store.panel()
    top = [tuple(r)[:4:2] for r in questions.top_sector_share(panel, 2000).collect()]
    assert top == [("Chad", "Transport"), ("Afghanistan", "Power Industry"), ("Türkiye", "Power Industry")]
    for ask in (
        questions.emission_intensity,
        questions.emission_breakdown,
        questions.yearly_leaders,
        questions.development_panel,
        questions.renewable_split,
    ):
        ask(panel).collect()


def test_year_filter_prunes_partitions(store):
    plan = questions.top_sector_share(store.panel(), 2000)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan


def test_tidy_emissions(spark):
    fossil = spark.createDataFrame([("Chad", 1.0, None, "x")], "Country string, `2000` double, `2001` double, note string")
    land = spark.createDataFrame([(2001, 5.0, 6.0)], "Year int, Chad double, Mali double")
    assert rows(tidy.emissions_and_land_use(fossil, land)) == [
        (2000, "Chad", 1.0, None), (2001, "Chad", None, 5.0), (2001, "Mali", None, 6.0),
    ]


def test_tidy_energy_wide(spark):
    release = spark.createDataFrame(
        [
            ("Chad", 2000, "Electricity generation", "Coal", "TWh", 1.0, 1),
            ("Chad", 2000, "Electricity generation", "Coal", "TWh", 2.0, 2),
            ("Chad", 2000, "Power sector emissions", "Coal", "mtCO2", 3.0, 3),
            ("Chad", 2000, "Power sector emissions", "Other Fossil", "mtCO2", 4.0, 4),
            ("Chad", 2000, "Electricity generation", "Wind", "%", 5.0, 5),
        ],
        "Country string, Year int, Category string, Variable string, Unit string, Value double, o int",
    )
    assert rows(tidy.energy_wide(release, ["o"])) == [("Chad", 2000, "Coal", 1.0, 3.0)]


def _sheet(spark, *rows):
    return spark.createDataFrame(rows, "Sector string, `EDGAR Country Code` string, Country string, `2000` double")


def test_names_that_fold_to_one_are_refused_however_often(spark, raw, tmp_path):
    from dataclasses import replace

    from panelwright.sinks.store import RepeatedKey

    store = PanelStore(spark, str(tmp_path / "panel"))
    twice = replace(raw, sector_sheet=_sheet(spark, ("Power", "TCD", "Chad", 1.0), ("Power", "TCD", "Ch\u00e1d", 2.0)))
    for _ in range(3):
        with pytest.raises(RepeatedKey, match="2 rows for Sector_Country"):
            loads.load_all(spark, twice, store)
        assert store.read("Sector_Country").count() == 0 and store.read("Sector").count() == 1


def test_names_cut_to_one_are_refused(spark, raw, tmp_path):
    from dataclasses import replace

    store = PanelStore(spark, str(tmp_path / "panel"))
    long = "x" * 100
    cut = replace(raw, sector_sheet=_sheet(spark, (long + "a", "TCD", "Chad", 1.0), (long + "b", "TCD", "Chad", 2.0)))
    with pytest.raises(ValueError, match="2 names would become one"):
        loads.load_all(spark, cut, store)


def test_a_total_with_blanks_around_its_code_is_no_total(spark):
    sheet = _sheet(spark, ("Power", "eu27", "Chad", 1.0), ("Power", " EU27 ", "Chad", 2.0), ("Power", None, "Chad", 3.0))
    country = spark.createDataFrame([(1, "Chad")], "ID_Country int, Name string")
    sector = spark.createDataFrame([(1, "Power")], "ID_Sector int, Name string")
    found = loads.sector_emissions(sheet, country, sector).collect()
    assert sorted(r.CO2_Emission for r in found) == [2.0, 3.0]


def test_year_windows_are_parameters(spark):
    rows = spark.createDataFrame([("Chad", 2025, "1"), ("Chad", 2026, "2")], "Country string, Year int, `CO2 Emission` string")
    country = spark.createDataFrame([(1, "Chad")], "ID_Country int, Name string")
    ordered = rows.withColumn("n", F.lit(1))
    assert loads.environmental(ordered, country, ["n"]).count() == 1
    assert loads.environmental(ordered, country, ["n"], years=(2000, 2026)).count() == 2
