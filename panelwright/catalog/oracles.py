"""DuckDB SQL for the named queries, over the same Parquet tables as views.

The SQL states each result the plain way (fan-out joins, row numbers, correlated
choices), independent of how the Spark side computes it. The questions are stated over
tables of one name each, so the same text serves the star panel and the loaded one.
"""

from __future__ import annotations

from collections.abc import Callable

from panelwright.catalog.raw_shapes import SEGMENT_LABELS, ScaledPanel
from panelwright.plans.star_panel import (
    NO_ELECTRICITY,
    NO_ENERGY_INVESTMENT,
    NO_HEALTH,
    NO_IMPORTS,
    NO_TOTAL,
    RENEWABLE,
)
from panelwright.sources.seeds import POWER_SOURCES, SOURCE_LABELS


def _in(values: list) -> str:
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def _values(rows: list[tuple]) -> str:
    def cell(v: object) -> str:
        return f"'{v}'" if isinstance(v, str) else str(v).lower()

    return "(VALUES " + ", ".join("(" + ", ".join(cell(v) for v in r) + ")" for r in rows) + ")"


def _name_id(name: str) -> str:
    return f"CAST('0x' || substr(md5({name}), 1, 15) AS BIGINT)"


def _half_up(top: str, bottom: str, factor: int) -> str:
    """``factor * top / bottom`` to the nearest integer, halves up, in whole cents."""
    a, b = f"CAST(({top}) * 100 AS HUGEINT)", f"CAST(({bottom}) * 100 AS HUGEINT)"
    return f"((2 * {factor} * {a} + {b}) // nullif(2 * {b}, 0))"


_MONEY = "CAST({} AS DECIMAL(12, 2))"
_PRICE, _QUANTITY = _MONEY.format("l_extendedprice"), _MONEY.format("l_quantity")

def _scaled(amount: str) -> str:
    """Divided by the panel's factor, two decimals, halves up."""
    step = ScaledPanel.factor
    return f"(((2 * CAST(({amount}) * 100 AS HUGEINT) + {step}) // (2 * {step})) / 100.0)::DECIMAL(20, 2)"


def _panel(amount: Callable[[str], str] = str) -> str:
    return f"""
dated AS (
  SELECT *, CAST(year(o_orderdate) AS INTEGER) AS yr, {_MONEY.format("o_totalprice")} AS total FROM orders
),
country AS (SELECT n_nationkey AS "ID_Country", n_name AS "Name" FROM nation),
sector AS (SELECT DISTINCT {_name_id("p_type")} AS "ID_Sector", p_type AS "Name" FROM part),
power_source AS (
  SELECT DISTINCT {_name_id("c_mktsegment")} AS "ID_Power", c_mktsegment AS "Name",
         c_mktsegment IN {_in(RENEWABLE)} AS "Renewable"
  FROM customer
),
sector_base AS (
  SELECT p_type, s_nationkey, yr, sum({_PRICE}) AS total
  FROM lineitem JOIN dated ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY ALL
),
sector_country AS (
  SELECT {_name_id("p_type")} AS "Sector_ID_Sector", p_type, s_nationkey AS "Country_ID_Country", yr AS "Year",
         {amount("total")} AS "CO2_Emission"
  FROM sector_base
),
sold AS (
  SELECT c_nationkey, c_mktsegment, yr, {_QUANTITY} AS quantity, {_PRICE} AS amount, l_returnflag, l_linestatus
  FROM lineitem JOIN dated ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
),
power_source_country AS (
  SELECT {_name_id("c_mktsegment")} AS "Power Source_ID_Power", c_mktsegment, c_nationkey AS "Country_ID_Country",
         yr AS "Year", {amount("sum(amount) FILTER (WHERE l_returnflag = 'R')")} AS "CO2_Emission",
         {amount("sum(quantity)")} AS "Power_Generation"
  FROM sold GROUP BY ALL
),
environmental AS (
  SELECT s_nationkey AS "Country_ID", yr AS "Year",
         CASE WHEN s_nationkey NOT IN {_in(NO_TOTAL)} THEN {amount("sum(total)")} END AS "CO2_Emision"
  FROM sector_base GROUP BY s_nationkey, yr
),
bought AS (
  SELECT c_nationkey AS "Country_ID", yr AS "Year", sum(total) AS total,
         sum(total) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent,
         sum(total) FILTER (WHERE o_orderpriority = '2-HIGH') AS high,
         count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
         count(*) FILTER (WHERE o_orderstatus = 'O') AS open_orders, count(DISTINCT o_custkey) AS customers
  FROM dated JOIN customer ON o_custkey = c_custkey GROUP BY ALL
),
investment_base AS (
  SELECT {amount("total")} AS "GDP",
         CASE WHEN "Country_ID" NOT IN {_in(NO_ENERGY_INVESTMENT)} THEN {amount("urgent")} END AS "Investment_Energy",
         {amount("high")} AS "Health_Expenditure", "Year", "Country_ID"
  FROM bought
),
investment AS (
  SELECT row_number() OVER (
           ORDER BY substr(md5("Country_ID" || chr(31) || "Year"), 1, 3), "Country_ID", "Year"
         ) AS "ID_Investment", *
  FROM investment_base
),
development AS (
  SELECT n AS "IDH", CASE WHEN "Country_ID" NOT IN {_in(NO_ELECTRICITY)} THEN finished END AS "Electricity",
         CASE WHEN "Country_ID" NOT IN {_in(NO_HEALTH)} THEN open_orders END AS "Health",
         "Year" AS "Ano", "Country_ID"
  FROM bought
),
consumed_base AS (
  SELECT c_nationkey AS "Country_ID", yr AS "Year", sum(quantity) AS quantity,
         sum(quantity) FILTER (WHERE l_linestatus = 'O') AS imports,
         sum(quantity) FILTER (WHERE c_mktsegment IN {_in(RENEWABLE)}) AS renewable
  FROM sold GROUP BY ALL
),
power_consumed AS (
  SELECT {amount("quantity")} AS "GWH",
         CASE WHEN "Country_ID" NOT IN {_in(NO_IMPORTS)} THEN {amount("imports")} END AS "PowerImport",
         {_half_up("renewable", "quantity", 1000000)} / 10000.0 AS "Renewable_Energy", "Year", "Country_ID"
  FROM consumed_base
),
demography AS (SELECT "Year", customers AS "Population", "Country_ID" FROM bought),
known AS (
  SELECT n_nationkey AS "ID_Country", replace(n_name, '_', ' ') AS "Name", n_regionkey = 0 AS misspelt,
         CASE WHEN n_regionkey = 0 THEN 'OLD ' ELSE '' END || replace(n_name, '_', ' ') AS plain
  FROM nation
),
matched AS (SELECT * FROM known WHERE NOT misspelt),
labels_of AS (SELECT * FROM {_values(SEGMENT_LABELS)} AS v(segment, label)),
source_of AS (SELECT * FROM {_values(SOURCE_LABELS)} AS v(label, source)),
seeds AS (SELECT * FROM {_values(POWER_SOURCES)} AS v(source, renewable))
"""


With = Callable[[str], str]


def _with_panel(body: str) -> str:
    return f"WITH {_panel().strip()}{body}"


def _with_scaled(body: str) -> str:
    return f"WITH {_panel(_scaled).strip()}{body}"


# What a question needs of each fact, one row per country and year (and source, or sector).
_FACTS = """,
nations AS (SELECT "ID_Country" AS id, "Name" AS country FROM country),
by_source AS (
  SELECT f."Country_ID_Country" AS id, f."Year" AS yr, p."Name" AS source, p."Renewable" AS green,
         f."CO2_Emission" AS co2, f."Power_Generation" AS made
  FROM power_source_country f, power_source p WHERE p."ID_Power" = f."Power Source_ID_Power"
),
by_sector AS (
  SELECT f."Country_ID_Country" AS id, f."Year" AS yr, s."Name" AS sector, f."CO2_Emission" AS co2
  FROM sector_country f, sector s WHERE s."ID_Sector" = f."Sector_ID_Sector"
),
totals AS (SELECT "Country_ID" AS id, "Year" AS yr, "CO2_Emision" AS co2 FROM environmental),
spent AS (
  SELECT "Country_ID" AS id, "Year" AS yr, "GDP" AS gdp, "Investment_Energy" AS energy, "Health_Expenditure" AS health
  FROM investment
),
lived AS (
  SELECT "Country_ID" AS id, "Ano" AS yr, "IDH" AS idh, "Electricity" AS power, "Health" AS health FROM development
),
used AS (
  SELECT "Country_ID" AS id, "Year" AS yr, "GWH" AS gwh, "PowerImport" AS bought, "Renewable_Energy" AS share
  FROM power_consumed
)"""

# Sums of both bridges. Fanned out, every source row meets every sector row of its country
# and year, so a side's sum counts once for each row of the other side.
_PAIRED = {
    True: """,
both_sides AS (
  SELECT id, yr, sum(a.co2) AS source_co2, sum(a.made) AS made, sum(b.co2) AS sector_co2
  FROM by_source a JOIN by_sector b USING (id, yr) GROUP BY id, yr
)""",
    False: """,
both_sides AS (
  SELECT * FROM (SELECT id, yr, sum(co2) AS source_co2, sum(made) AS made FROM by_source GROUP BY id, yr)
  JOIN (SELECT id, yr, sum(co2) AS sector_co2 FROM by_sector GROUP BY id, yr) USING (id, yr)
)""",
}


def _best(order: str, k: int, source: str) -> str:
    """The first k rows of a source by an order, as rows with their rank."""
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM {source} QUALIFY place <= {k}"


def _q1(with_tables: With, year: int) -> str:
    return with_tables(f"""{_FACTS},
ranked AS (
  SELECT id, sector, co2, sum(co2) OVER (PARTITION BY id) AS total,
         row_number() OVER (PARTITION BY id ORDER BY co2 DESC NULLS FIRST, {_name_id("sector")}) AS place
  FROM by_sector WHERE yr = {year}
),
tenths AS (SELECT *, {_half_up("co2", "total", 1000)} AS share FROM ranked WHERE place = 1)
SELECT country AS "Country", total::DOUBLE AS "Total CO₂ {year} (Mt)", sector AS "Top Sector {year}",
       co2::DOUBLE AS "Sector CO₂ {year} (Mt)", (share // 10) || '.' || (share % 10) || '%' AS "Share"
FROM tenths JOIN nations USING (id)
ORDER BY total DESC NULLS FIRST, country""")


def _q2(with_tables: With) -> str:
    top = _best("yr DESC, co2 DESC NULLS FIRST, made DESC NULLS FIRST, country, source", 100, "by_source JOIN nations USING (id)")
    return with_tables(f"""{_FACTS},
top AS ({top})
SELECT country AS "Country", yr AS "Year", source AS "Energy Source", green AS "Renewable", made::DOUBLE AS "Generation_TWh",
       co2::DOUBLE AS "Emissions_Mt", {_half_up("co2", "made", 10000)} / 10.0 AS "gCO2_per_kWh"
FROM top ORDER BY place""")


def _q3(with_tables: With, fan_out: bool) -> str:
    top = _best(
        "yr DESC, co2 DESC NULLS FIRST, source_co2 DESC NULLS FIRST, sector_co2 DESC NULLS FIRST, country",
        100,
        "both_sides JOIN totals USING (id, yr) JOIN nations USING (id)",
    )
    return with_tables(f"""{_FACTS}{_PAIRED[fan_out]},
top AS ({top})
SELECT country AS "Country", yr AS "Year", co2::DOUBLE AS "Total Emission", source_co2::DOUBLE AS "Emission Power",
       sector_co2::DOUBLE AS "Emission Sector"
FROM top ORDER BY place""")


def _q4(with_tables: With, nulls: str) -> str:
    def leader(name: str, source: str) -> str:
        return f"""
  SELECT yr, max(name) FILTER (WHERE place = 1) AS leader, sum(amount) AS total
  FROM (SELECT *, row_number() OVER (PARTITION BY yr ORDER BY amount DESC NULLS {nulls}, name) AS place
        FROM (SELECT yr, {name} AS name, sum(co2) AS amount FROM {source} GROUP BY ALL))
  GROUP BY yr"""

    return with_tables(f"""{_FACTS},
sectors AS ({leader("sector", "by_sector")}),
sources AS ({leader("source", "by_source")}),
places AS ({leader("country", "totals JOIN nations USING (id)")}),
people AS (SELECT yr, sum(idh) AS idh FROM lived GROUP BY yr),
money AS (SELECT yr, sum(gdp) AS gdp FROM spent GROUP BY yr),
top AS ({_best("yr DESC", 30, "sectors a JOIN sources b USING (yr) JOIN places c USING (yr) JOIN people USING (yr) JOIN money USING (yr) "
               "WHERE a.total IS NOT NULL AND b.total IS NOT NULL AND c.total IS NOT NULL AND idh IS NOT NULL AND gdp IS NOT NULL")
        .replace("SELECT *,", "SELECT yr, a.total AS s, a.leader AS sector, b.total AS e, b.leader AS source, c.total AS n, "
                 "c.leader AS nation, idh, gdp,")})
SELECT yr AS "Year", s::DOUBLE AS co2_total_sector, sector AS sector_maior_emissao, e::DOUBLE AS co2_total_energia,
       source AS energia_maior_emissao, n::DOUBLE AS co2_total_country, nation AS country_maior_emissao,
       idh::{{idh}} AS total_idh, gdp::DOUBLE AS total_gdp
FROM top ORDER BY place""").replace("{idh}", "BIGINT" if with_tables is _with_panel else "DOUBLE")


def _q5(with_tables: With, fan_out: bool) -> str:
    top = _best(
        "idh DESC NULLS FIRST, gdp DESC NULLS FIRST, co2 DESC NULLS FIRST, yr DESC, country",
        50,
        "lived JOIN spent USING (id, yr) JOIN used USING (id, yr) JOIN totals USING (id, yr) JOIN both_sides USING (id, yr) "
        "JOIN nations USING (id) WHERE idh IS NOT NULL AND gdp IS NOT NULL AND power IS NOT NULL AND lived.health IS NOT NULL",
    )
    return with_tables(f"""{_FACTS}{_PAIRED[fan_out]},
top AS ({top})
SELECT country, yr AS "Year", idh{{number}} AS "IDH", gdp::DOUBLE AS "GDP", power{{number}} AS "electricity index",
       energy::DOUBLE AS "eletricity investiment", health{{number}} AS "health index", health_1::DOUBLE AS "helth investiment",
       made::DOUBLE AS total_power_generation, share{{number}} AS "renewable share pct", bought::DOUBLE AS import_gwh,
       co2::DOUBLE AS total_emission, sector_co2::DOUBLE AS "sector emission", source_co2::DOUBLE AS "emission energy"
FROM top ORDER BY place""").replace("{number}", "" if with_tables is _with_panel else "::DOUBLE")


def _q6(with_tables: With, after: int, key: str = "Country_ID") -> str:
    return with_tables(f"""{_FACTS},
split AS (
  SELECT id, yr, coalesce(sum(made) FILTER (WHERE green), 0) AS green, coalesce(sum(made) FILTER (WHERE NOT green), 0) AS other
  FROM by_source WHERE yr > {after} GROUP BY id, yr
),
funded AS (SELECT "{key}" AS id, "Year" AS yr, "Investment_Energy" AS energy FROM investment)
SELECT country, yr AS "Year", energy::DOUBLE AS "Investment_Energy", green::DOUBLE AS renewable_power,
       other::DOUBLE AS non_renewable_power, gwh::DOUBLE AS power_consumed, share{{number}} AS renewable_share_pct,
       bought::DOUBLE AS power_import_consumed, power{{number}} AS access_to_energy
FROM split JOIN funded USING (id, yr) JOIN used USING (id, yr) JOIN lived USING (id, yr) JOIN nations USING (id)
ORDER BY energy DESC NULLS FIRST, green DESC, access_to_energy DESC NULLS FIRST, country, yr, gwh
""").replace("{number}", "" if with_tables is _with_panel else "::DOUBLE")


_QUESTIONS = {
    "q1_top_sector_share": _q1(_with_panel, 1998),
    "q2_intensity_topk": _q2(_with_panel),
    "q3_emission_breakdown": _q3(_with_panel, True),
    "q3_safe": _q3(_with_panel, False),
    "q4_yearly_leaders": _q4(_with_panel, "FIRST"),
    "q4_nulls_last": _q4(_with_panel, "LAST"),
    "q5_development_panel": _q5(_with_panel, True),
    "q5_safe": _q5(_with_panel, False),
    "q6_renewable_split": _q6(_with_panel, 1997),
    "q6_as_written": _q6(_with_panel, 1997, "ID_Investment"),
}


def _dense(columns: str, key: str, source: str) -> str:
    """Row numbers in the order (digest prefix of the key, key)."""
    return f"""SELECT CAST(row_number() OVER (ORDER BY substr(md5({key}), 1, 3), {columns}) AS INTEGER) AS {{id}}, {columns}
FROM {source}"""


_SHEET = """,
sheet AS (
  SELECT p_type AS sector, "Sector_ID_Sector", "Country_ID_Country", k.misspelt, k.plain,
         "Year" + 5 AS yr, ("CO2_Emission" * 100)::DOUBLE / 1024 AS emission
  FROM sector_country JOIN known k ON k."ID_Country" = "Country_ID_Country"
  WHERE "Country_ID_Country" <> 7
)"""
_ACCENTED = "translate({}, 'AEIOU', 'ÀÉÎÕÜ')"

_ENERGY = """,
energy AS (
  SELECT k.plain AS area, misspelt, "Country_ID_Country", "Year" + 5 AS yr, coalesce(label, c_mktsegment) AS label, seq,
         CASE WHEN seq = 1 THEN "Power_Generation"::DOUBLE / 8 END AS generation,
         CASE WHEN seq = 1 THEN "CO2_Emission"::DOUBLE / 8 ELSE "CO2_Emission"::DOUBLE / 8 / 2 END AS emission
  FROM power_source_country JOIN known k ON k."ID_Country" = "Country_ID_Country"
  LEFT JOIN labels_of ON segment = c_mktsegment, (VALUES (1), (2)) AS v(seq)
)"""

def _loads(with_tables: With) -> dict[str, str]:
    return {
    "load_country": _dense(
        '"Name" NULLS FIRST',
        "coalesce(\"Name\", '')",
        """(SELECT DISTINCT CASE WHEN c_acctbal >= 0 THEN c_name END AS "Name"
      FROM customer WHERE c_mktsegment <> 'MACHINERY')""",
    )
    .format(id='"ID_Country"')
    .replace('INTEGER) AS "ID_Country", "Name" NULLS FIRST', 'INTEGER) AS "ID_Country", "Name"'),
    "load_sector": _dense(
        '"Name"',
        '"Name"',
        """(SELECT DISTINCT substr(repeat(p_type || ' ' || p_brand || ' ' || p_name, 5), 1, 100) AS "Name"
      FROM part WHERE p_size > 1)""",
    ).format(id='"ID_Sector"'),
    "load_power_source": with_tables(""",
present AS (SELECT DISTINCT coalesce(label, c_mktsegment) AS label FROM customer LEFT JOIN labels_of ON segment = c_mktsegment)
SELECT label AS "Name", NULL::BOOLEAN AS "Renewable", FALSE AS added FROM present
UNION ALL
SELECT source, renewable, TRUE FROM seeds WHERE source NOT IN (SELECT label FROM present)"""),
    "load_sector_country": with_tables(f"""{_SHEET}
SELECT "Sector_ID_Sector", "Country_ID_Country", CAST(yr AS INTEGER) AS "Year",
       round_even(emission * 100, 0) / 100 AS "CO2_Emission"
FROM sheet WHERE NOT misspelt AND emission IS NOT NULL AND yr BETWEEN 2000 AND 2023"""),
    "load_sector_country_gaps": with_tables(f"""{_SHEET}
SELECT 'sector' AS kind, 'Tiny' AS name FROM sheet WHERE sector = 'SMALL'
UNION
SELECT 'country', ' ' || {_ACCENTED.format('plain')} FROM sheet WHERE sector <> 'SMALL' AND misspelt
ORDER BY kind, name"""),
    "load_power_source_country": with_tables(f"""{_ENERGY}
SELECT {_name_id('source')} AS "ID_Power", "Country_ID_Country", CAST(yr AS INTEGER) AS "Year",
       round_even(arg_max(emission, seq) * 100, 0) / 100 AS "CO2_Emission",
       round_even(arg_max(generation, seq) * 100, 0) / 100 AS "Power_Generation"
FROM energy JOIN source_of USING (label) WHERE NOT misspelt AND yr BETWEEN 2000 AND 2024
GROUP BY source, "Country_ID_Country", yr"""),
    "load_environmental": with_tables("""
SELECT "Country_ID", CAST("Year" + 2 AS INTEGER) AS "Year", "CO2_Emision"::DOUBLE AS "CO2_Emision"
FROM environmental JOIN matched ON "ID_Country" = "Country_ID" WHERE "Year" + 2 >= 2000"""),
    "load_development": with_tables("""
SELECT d."Country_ID", CAST(d."Ano" + 2 AS INTEGER) AS "Ano",
       CAST(round_even(d."IDH" / 1024.0::DOUBLE * 1000, 0) AS BIGINT) AS "IDH",
       CASE WHEN "Ano" > 1998 AND "Ano" < 2001 THEN d."Electricity" END AS "Electricity",
       CASE WHEN "Ano" > 1998 AND "Ano" < 2001 THEN d."IDH" END AS "Sanitation",
       d."Health", d."IDH" AS "Standard_Living"
FROM development d JOIN matched ON "ID_Country" = d."Country_ID" WHERE "Ano" + 2 >= 2000"""),
    "load_investment": with_tables("""
SELECT "Country_ID", "Year",
       CASE WHEN "Country_ID" = 3 THEN 1 ELSE "GDP" END::DOUBLE AS "GDP",
       "Investment_Energy"::DOUBLE AS "Investment_Energy", "Health_Expenditure"::DOUBLE AS "Health_Expenditure"
FROM investment_base JOIN matched ON "ID_Country" = "Country_ID\""""),
    "load_power_consumed": with_tables("""
SELECT "Country_ID", CAST("Year" + 2 AS INTEGER) AS "Year", "GWH"::DOUBLE AS "GWH",
       "PowerImport"::DOUBLE AS "PowerImport", "Renewable_Energy"
FROM power_consumed JOIN matched ON "ID_Country" = "Country_ID" WHERE "Year" + 2 >= 2000"""),
    "load_demography": with_tables("""
SELECT "Country_ID", CAST("Year" + 2 AS INTEGER) AS "Year", "Population"
FROM demography JOIN matched ON "ID_Country" = "Country_ID" WHERE "Year" + 2 >= 2000"""),
    "tidy_energy_long": with_tables(f"""{_ENERGY}
SELECT area AS "Area", yr AS "Year", 'Electricity generation' AS "Category", label AS "Variable", generation AS "Value"
FROM energy WHERE label IN {_in([a for a, _ in SOURCE_LABELS])}
UNION ALL
SELECT area, yr, 'Power sector emissions', label, emission FROM energy WHERE label IN {_in([a for a, _ in SOURCE_LABELS])}"""),
    "tidy_energy_wide": with_tables(f"""{_ENERGY}
SELECT area AS "Country", yr AS "Year", label AS "Variable", max(generation) AS "Electricity generation",
       arg_min(emission, seq) AS "Power sector emissions"
FROM energy WHERE label IN {_in([a for a, _ in POWER_SOURCES])} GROUP BY ALL"""),
    "tidy_emissions": with_tables(f""",
span AS (
  SELECT yr FROM (SELECT unnest(range(min(yr) + 5, max(yr) + 6)) AS yr FROM dated) WHERE yr BETWEEN 2000 AND 2024
),
fossil AS (
  SELECT yr, n_name AS country, "CO2_Emision"::DOUBLE AS co2
  FROM (SELECT DISTINCT "Country_ID" FROM environmental) JOIN nation ON n_nationkey = "Country_ID"
  JOIN span ON TRUE
  LEFT JOIN environmental e ON e."Country_ID" = n_nationkey AND e."Year" + 5 = yr
),
land AS (
  SELECT yr, n_name AS country, sum("CO2_Emission")::DOUBLE AS eluc
  FROM (SELECT DISTINCT "Year" + 3 AS yr FROM power_source_country) JOIN nation ON TRUE
  LEFT JOIN power_source_country p ON p."Country_ID_Country" = n_nationkey AND p."Year" + 3 = yr
  GROUP BY ALL
)
SELECT CAST(yr AS INTEGER) AS "Year", country AS "Country", co2 AS "CO2 Emission", eluc AS "ELUC"
FROM fossil FULL JOIN land USING (yr, country)"""),
}


_REPORT = _with_scaled(f"""{_SHEET}
SELECT 'sector' AS kind, 'Tiny' AS name, count(DISTINCT "Country_ID_Country") AS n_rows, NULL::DOUBLE AS total
FROM sheet WHERE sector = 'SMALL' HAVING count(*) > 0
UNION ALL
SELECT 'country', ' ' || {_ACCENTED.format('plain')} AS n, count(DISTINCT sector), NULL FROM sheet WHERE sector <> 'SMALL' AND misspelt GROUP BY n
UNION ALL
SELECT 'loaded', yr::VARCHAR AS n, count(*), sum((round_even(emission * 100, 0) / 100)::DECIMAL(12, 4))::DOUBLE FROM sheet
WHERE sector <> 'SMALL' AND NOT misspelt AND emission IS NOT NULL AND yr BETWEEN 2000 AND 2023 GROUP BY n""")

_LOADS = _loads(_with_panel)
_SCALED = _loads(_with_scaled)

# Per loaded table: the load, its country column, whether rows are numbered, the measures with their declared types.
_LOADED = {
    "Sector_Country": ("load_sector_country", "Country_ID_Country", False, {"CO2_Emission": (12, 4)}),
    "Power Source_Country": (
        "load_power_source_country",
        "Country_ID_Country",
        False,
        {"CO2_Emission": (12, 4), "Power_Generation": (12, 4)},
    ),
    "Environmental Indicator": ("load_environmental", "Country_ID", True, {"CO2_Emision": (15, 10)}),
    "Investment": (
        "load_investment",
        "Country_ID",
        True,
        {"GDP": (12, 2), "Investment_Energy": (15, 2), "Health_Expenditure": (15, 2)},
    ),
    "Development": (
        "load_development",
        "Country_ID",
        True,
        dict.fromkeys(["IDH", "Electricity", "Sanitation", "Health", "Standard_Living"], (6, 2)),
    ),
    "Power Consumed": ("load_power_consumed", "Country_ID", True, {"GWH": (12, 2), "PowerImport": (12, 2), "Renewable_Energy": (7, 4)}),
    "Demography": ("load_demography", "Country_ID", True, {"Population": (18, 0)}),
}


def _loaded_rows(table: str) -> str:
    load, _, _, measures = _LOADED[table]
    typed = ", ".join(f'CAST("{m}" AS DECIMAL({p}, {q})) AS "{m}"' for m, (p, q) in measures.items())
    return f"(SELECT * REPLACE ({typed}) FROM ({_SCALED[load]}))"


def _load_sums() -> str:
    dimensions = """SELECT 'Country' AS table_name, 'names' AS measure, count(*) AS n_rows, count(*) AS n_countries, count(*) AS n_keys,
       count(*)::DOUBLE AS total FROM nation
UNION ALL SELECT 'Sector', 'names', count(DISTINCT p_type), 0, count(DISTINCT p_type), count(DISTINCT p_type) FROM part
"""
    dimensions += f"UNION ALL SELECT 'Power Source', 'names', {len(POWER_SOURCES)}, 0, {len(POWER_SOURCES)}, {len(POWER_SOURCES)}\n"
    facts = [
        f"""UNION ALL SELECT '{table}', '{m}', count(*), count(DISTINCT "{country}"), {"count(*)" if numbered else "0"}, sum("{m}")::DOUBLE
FROM {_loaded_rows(table)}\n"""
        for table, (_, country, numbered, measures) in _LOADED.items()
        for m in measures
    ]
    return dimensions + "".join(facts)


def _with_loaded(body: str) -> str:
    """The question tables as the full load leaves them."""
    return f"""WITH country AS (SELECT n_nationkey AS "ID_Country", replace(n_name, '_', ' ') AS "Name" FROM nation),
sector AS (SELECT DISTINCT {_name_id("p_type")} AS "ID_Sector", {_ACCENTED.format("p_type")} AS "Name" FROM part),
power_source AS (
  SELECT {_name_id("source")} AS "ID_Power", source AS "Name", renewable AS "Renewable"
  FROM {_values(POWER_SOURCES)} AS v(source, renewable)
),
sector_country AS {_loaded_rows("Sector_Country")},
power_source_country AS (SELECT "ID_Power" AS "Power Source_ID_Power", * EXCLUDE ("ID_Power") FROM {_loaded_rows("Power Source_Country")}),
environmental AS {_loaded_rows("Environmental Indicator")},
investment AS {_loaded_rows("Investment")},
development AS {_loaded_rows("Development")},
power_consumed AS {_loaded_rows("Power Consumed")}{body}"""


_STORED = {
    "load_everything": _load_sums(),
    "stored_q1": _q1(_with_loaded, 2003),
    "stored_q2": _q2(_with_loaded),
    "stored_q3": _q3(_with_loaded, True),
    "stored_q4": _q4(_with_loaded, "FIRST"),
    "stored_q5": _q5(_with_loaded, True),
    "stored_q6": _q6(_with_loaded, 2000),
}

_FOLD = "upper(regexp_replace(strip_accents({}), '[^\\x00-\\x7F]', '', 'g'))"
_WORDS = r"""WITH doc_words AS (
  SELECT unnest(string_split_regex(text, '[ \n\t\r]+')) AS word FROM documents
),
dim AS (SELECT DISTINCT unnest(string_split_regex(text, '[ \n\t\r]+')) AS word FROM benchmark)"""
_FIGURES = """WITH figures AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS "Year", o_orderstatus = 'O' AS incoming,
         sum(CAST(o_totalprice AS DECIMAL(12, 2))) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent,
         sum(CAST(o_totalprice AS DECIMAL(12, 2))) FILTER (WHERE o_orderpriority = '2-HIGH') AS high
  FROM orders GROUP BY ALL
),
old AS (SELECT * FROM figures WHERE NOT incoming),
new AS (SELECT *, TRUE AS arrived FROM figures WHERE incoming)"""


def _upsert(column: str) -> str:
    return f"CASE WHEN new.arrived THEN new.{column} ELSE old.{column} END::DOUBLE AS {column}"


_JUDGED = "documents LEFT JOIN labels USING (doc_id)"

_OPERATORS = {
    "unpivot_years": """SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS "Year",
       sum(CAST(l_quantity AS DECIMAL(12, 2)))::DOUBLE AS quantity
FROM lineitem GROUP BY ALL""",
    "pivot_categories": """WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_linestatus, l_returnflag
    ORDER BY l_shipdate, l_orderkey, l_partkey, l_linenumber, l_quantity) AS rn
  FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R') AND l_quantity IS NOT NULL
    AND l_suppkey IS NOT NULL AND l_linestatus IS NOT NULL
)
SELECT l_suppkey, l_linestatus, max(l_quantity) FILTER (WHERE l_returnflag = 'A') AS accepted,
       max(l_quantity) FILTER (WHERE l_returnflag = 'N') AS "none",
       max(l_quantity) FILTER (WHERE l_returnflag = 'R') AS returned
FROM ranked WHERE rn = 1 GROUP BY ALL""",
    "outer_merge_measures": _with_panel(""",
l AS (SELECT "Country_ID_Country", "Year", sum("CO2_Emission")::DOUBLE AS emission_sector
      FROM sector_country GROUP BY ALL),
r AS (SELECT "Country_ID_Country", "Year" + 2 AS "Year", sum("CO2_Emission")::DOUBLE AS emission_source
      FROM power_source_country GROUP BY ALL)
SELECT * FROM l FULL JOIN r USING ("Country_ID_Country", "Year")"""),
    "fan_out_three_sides": """
SELECT (s_suppkey % 17)::INTEGER AS number, sum((s_acctbal * 100)::DECIMAL(14, 0)::BIGINT)::BIGINT AS supplier_cents,
       sum((c_acctbal * 100)::DECIMAL(14, 0)::BIGINT)::BIGINT AS customer_cents,
       sum((p_retailprice * 100)::DECIMAL(14, 0)::BIGINT)::BIGINT AS part_cents, count(*) AS n_rows
FROM supplier JOIN customer ON s_suppkey % 17 = c_custkey % 17 JOIN part ON s_suppkey % 17 = p_partkey % 17
WHERE p_size > 10 GROUP BY s_suppkey % 17""",
    "outer_merge_hot_key": """
WITH l AS (
  SELECT CASE WHEN l_tax = 0 THEN NULL WHEN l_returnflag = 'R' THEN 7 ELSE l_suppkey END AS key, l_orderkey, l_linenumber,
         l_quantity AS amount_line
  FROM lineitem
), r AS (SELECT s_suppkey + 3 AS key, s_acctbal AS amount_supplier, s_nationkey FROM supplier WHERE (s_suppkey + 3) % 3 <> 0)
SELECT * FROM l FULL JOIN r USING (key)""",
    "dense_keys": _dense(
        "p_brand, p_name", "p_brand || chr(31) || p_name", "(SELECT DISTINCT p_brand, p_name FROM part)"
    ).format(id="id"),
    "dedup_keep_first": """SELECT * EXCLUDE rn FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus) AS rn
  FROM lineitem) WHERE rn = 1""",
    "dedup_rows": "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem",
    "seed_recode": _with_panel("""
SELECT c_mktsegment, count(*) AS customers, source, renewable AS "Renewable"
FROM customer LEFT JOIN labels_of ON segment = c_mktsegment LEFT JOIN source_of USING (label) LEFT JOIN seeds USING (source)
GROUP BY ALL"""),
    "top_row_per_group": """SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""",
    "union_years": _with_panel("""
SELECT "Year" FROM sector_country UNION SELECT "Year" FROM power_source_country
UNION SELECT "Ano" FROM development UNION SELECT "Year" FROM investment_base"""),
    "semi_join_rows": """SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "not_equal_keep_null": f"SELECT doc_id, quality FROM {_JUDGED} WHERE quality IS DISTINCT FROM 1",
    "not_in_keep_null": f"""SELECT * FROM (
  SELECT doc_id, CASE WHEN toxic = 1 THEN ' ' || upper(lang) || ' ' WHEN toxic = 0 THEN upper(lang) END AS code FROM {_JUDGED}
) WHERE coalesce(code NOT IN ('EN', 'FR'), TRUE)""",
    "dropna_any_all": _with_panel("""
SELECT 'development' AS table_name, 'any' AS how, count(*) AS n_rows FROM development
WHERE "Electricity" IS NOT NULL AND "Health" IS NOT NULL
UNION ALL SELECT 'development', 'all', count(*) FROM development
WHERE "Electricity" IS NOT NULL OR "Health" IS NOT NULL
UNION ALL SELECT 'consumed', 'any', count(*) FROM power_consumed
WHERE "PowerImport" IS NOT NULL AND "GWH" IS NOT NULL
UNION ALL SELECT 'consumed', 'all', count(*) FROM power_consumed
WHERE "PowerImport" IS NOT NULL OR "GWH" IS NOT NULL"""),
    "parse_number_text": r"""SELECT event_id,
       CAST(nullif(regexp_extract(props, '[-+]?\d+(\.\d+)?'), '') AS DOUBLE) AS from_props,
       -- the text "ca. -" is followed by the value, so its own sign is only read when it follows no other
       CAST(nullif(regexp_extract('ca. -' || CAST(value AS DECIMAL(12, 2)), '[-+]?\d+(\.\d+)?'), '') AS DOUBLE)
         AS from_comma,
       TRY_CAST(props AS DOUBLE) AS whole_text, CAST(CAST(value AS DECIMAL(12, 2)) AS DOUBLE) AS whole_number
FROM events""",
    "extract_year_text": """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS "Year" FROM orders""",
    "rounding_rules": """SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(round_even(l_quantity / 8 * 10, 0) AS BIGINT) AS tenfold,
       round_even(l_quantity / 8 * 100, 0) / 100 AS half_even,
       floor(l_quantity / 8 * 100 + 0.5) / 100 AS half_away,
       CAST(trunc(l_quantity / 8) AS BIGINT) AS truncated
FROM lineitem""",
    "nan_as_null": """SELECT l_orderkey, sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) AS quantity
FROM lineitem GROUP BY ALL""",
    "safe_ratio_lines": """WITH sums AS (
  SELECT l_orderkey,
         sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END)::BIGINT AS returned,
         sum(CASE WHEN l_tax > 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END)::BIGINT AS taxed
  FROM lineitem GROUP BY ALL)
SELECT *, returned * 8 / nullif(taxed, 0) AS per_taxed FROM sums""",
    "casefold_text": r"""SELECT doc_id, CAST(length(k) AS INTEGER) AS key_length, md5(k) AS key_digest FROM (
  SELECT doc_id, replace(lower(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))), 'ß', 'ss') AS k
  FROM documents)""",
    "accent_fold_lookup": f"""{_WORDS},
ids AS (SELECT {_FOLD.format('word')} AS key, max(md5(word)) AS id FROM dim GROUP BY ALL)
SELECT id, count(*) AS hits FROM doc_words JOIN ids ON key = {_FOLD.format('doc_words.word')} GROUP BY ALL""",
    "unmatched_names": f"""{_WORDS}
SELECT DISTINCT word FROM doc_words WHERE {_FOLD.format('word')} NOT IN (SELECT {_FOLD.format('word')} FROM dim)
ORDER BY word""",
    "upsert_replace": f"""{_FIGURES}
SELECT o_custkey, "Year", {_upsert('urgent')}, {_upsert('high')} FROM old FULL JOIN new USING (o_custkey, "Year")""",
    "upsert_keep_old": f"""{_FIGURES}
SELECT o_custkey, "Year", coalesce(new.urgent, old.urgent)::DOUBLE AS urgent,
       coalesce(new.high, old.high)::DOUBLE AS high
FROM old FULL JOIN new USING (o_custkey, "Year")""",
    "insert_ignore": f"""{_FIGURES}
SELECT o_custkey, "Year", urgent::DOUBLE AS urgent, high::DOUBLE AS high
FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.o_custkey = new.o_custkey AND old."Year" = new."Year")""",
    "last_known_values": """WITH placed AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders)
SELECT o_custkey, max(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT' AND rn = 1) AS urgent,
       max(o_totalprice) FILTER (WHERE o_orderpriority = '2-HIGH' AND rn = 1) AS high
FROM placed GROUP BY ALL""",
    "store_upsert": _with_scaled("""
SELECT count(*) AS n_rows, count(*) AS n_keys, sum("GWH"::DECIMAL(12, 2))::DOUBLE AS gwh,
       sum("PowerImport"::DECIMAL(12, 2) * CASE WHEN "Year" > 1996 THEN 2 ELSE 1 END)::DOUBLE AS power_import,
       sum(CASE WHEN "Year" > 1996 AND "Country_ID" > 9 THEN (round("Renewable_Energy" * 10000)::BIGINT + 1) // 2
                WHEN "Year" < 1999 THEN round("Renewable_Energy" * 10000)::BIGINT END) / 10000.0 AS renewable
FROM (SELECT * REPLACE (CASE WHEN "Year" < 1999 THEN "GWH" END AS "GWH") FROM power_consumed)"""),
    "append_bridge": _with_scaled("""
SELECT "Country_ID_Country" AS country, "Year", count(*) AS n_rows, sum("CO2_Emission")::DOUBLE AS emission
FROM sector_country GROUP BY ALL"""),
    "exact_lookup_left": """SELECT c_custkey, CASE WHEN c_nationkey % 5 <> 0 THEN n_nationkey END AS id
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "csv_round_trip": _with_panel("""
SELECT "GWH"::DOUBLE AS gwh, "PowerImport"::DOUBLE AS power_import, "Renewable_Energy", "Year", "Country_ID"
FROM power_consumed"""),
    "sheet_round_trip": _with_panel(f"""
SELECT {_ACCENTED.format('p_type')} AS "Sector", {_ACCENTED.format("plain")} AS "Country",
       CAST("Year" + 5 AS VARCHAR) AS "Year", ("CO2_Emission" * 100)::DOUBLE / 1024 AS emission
FROM sector_country JOIN known ON "ID_Country" = "Country_ID_Country" WHERE "Year" + 5 BETWEEN 2001 AND 2005"""),
    "ordered_export": """SELECT row_number() OVER (ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey) - 1 AS place,
       o_orderkey, o_totalprice, o_orderpriority FROM orders""",
    "melt_by_header": f"""SELECT l_suppkey, (l_partkey % 997 + 1000)::INTEGER AS "Year", (sum({_QUANTITY}) * 100)::BIGINT AS quantity
FROM lineitem WHERE l_partkey % 997 <= 990 GROUP BY ALL""",
    "upsert_changed_years": _with_scaled("""
SELECT "Year", count(*) AS n_rows, (sum("GWH") + CASE WHEN "Year" = 1998 THEN count(*) ELSE 0 END)::DOUBLE AS gwh,
       FALSE AS again, "Year" = 1998 AS written
FROM power_consumed GROUP BY 1"""),
    "workbook_round_trip": "SELECT * FROM orders",
    "workbook_sectors": _LOADS["load_sector_country"],
    "report_with_preamble": _with_panel(r"""
SELECT replace(CASE WHEN misspelt THEN 'Old nation ' ELSE 'Nation ' END, ' ', ' ' || chr(160) || chr(9)) || "ID_Country" AS "Country",
       CAST("Ano" + 2 AS INTEGER) AS "Year", "Health"
FROM development JOIN known ON ("Country_ID" = "ID_Country")"""),
    "key_duplicates": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY ALL HAVING count(*) > 1""",
    "fk_orphans": """SELECT -l_orderkey - 1 AS l_orderkey, count(*) AS n_rows FROM lineitem
WHERE l_returnflag = 'R' GROUP BY ALL""",
    "null_violations": f"""SELECT * FROM (
  SELECT 'doc_id' AS column_name, count(*) FILTER (WHERE doc_id IS NULL) AS n_rows FROM {_JUDGED}
  UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL) FROM {_JUDGED}
  UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL) FROM {_JUDGED}) WHERE n_rows > 0""",
    "precision_violations": """SELECT * FROM (
  SELECT 'o_totalprice' AS column_name,
         count(*) FILTER (WHERE o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(7, 2)) IS NULL) AS n_rows
  FROM orders
  UNION ALL
  SELECT 'o_wide',
         count(*) FILTER (WHERE o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(12, 2)) IS NULL)
  FROM orders) WHERE n_rows > 0""",
    "audit_panel": _with_panel("""
SELECT 'Sector_Country' AS table_name, 'Country_ID_Country in Country' AS rule,
       ("Country_ID_Country" + 1000)::VARCHAR AS detail, count(*) AS n_rows
FROM sector_country WHERE "Country_ID_Country" < 5 GROUP BY ALL
UNION ALL
SELECT 'Sector_Country', 'precision', 'CO2_Emission', count(*) FROM sector_country
WHERE TRY_CAST("CO2_Emission" AS DECIMAL(12, 4)) IS NULL HAVING count(*) > 0"""),
    "audit_star": """
WITH line AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN -l_orderkey - 1 ELSE l_orderkey END AS o, l_linenumber AS n, l_partkey AS p,
         CASE WHEN l_returnflag = 'A' THEN -7 ELSE l_suppkey END AS s,
         CASE WHEN l_quantity <> 13 THEN l_shipdate END AS d, l_extendedprice AS price
  FROM lineitem
), found AS (
  SELECT 'region' AS t, 'unique key' AS r, r_regionkey::VARCHAR AS v, count(*) AS c, 2 AS least FROM region WHERE v IS NOT NULL GROUP BY v
  UNION ALL SELECT 'region', 'not null', 'r_regionkey', count(*), 1 FROM region WHERE r_regionkey IS NULL
  UNION ALL SELECT 'region', 'precision', 'r_name', count(*), 1 FROM region WHERE length(r_name) > 100
  UNION ALL SELECT 'nation', 'unique key', n_name AS v, count(*), 2 FROM nation WHERE v IS NOT NULL GROUP BY v
  UNION ALL SELECT 'nation', 'not null', 'n_nationkey', count(*), 1 FROM nation WHERE n_nationkey IS NULL
  UNION ALL SELECT 'nation', 'precision', 'n_name', count(*), 1 FROM nation WHERE length(n_name) > 100
  UNION ALL SELECT 'nation', 'n_regionkey in region', n_regionkey::VARCHAR AS v, count(*), 1
    FROM nation ANTI JOIN region ON n_regionkey = r_regionkey WHERE v IS NOT NULL GROUP BY v
  UNION ALL SELECT 'supplier', 'unique key', s_suppkey::VARCHAR AS v, count(*), 2 FROM supplier WHERE v IS NOT NULL GROUP BY v
  UNION ALL SELECT 'supplier', 'precision', 's_acctbal', count(*), 1 FROM supplier
    WHERE s_acctbal IS NOT NULL AND TRY_CAST(s_acctbal AS DECIMAL(5, 2)) IS NULL
  UNION ALL SELECT 'supplier', 's_nationkey in nation', s_nationkey::VARCHAR AS v, count(*), 1
    FROM supplier ANTI JOIN nation ON s_nationkey = n_nationkey WHERE v IS NOT NULL GROUP BY v
  UNION ALL SELECT 'customer', 'unique key', c_custkey::VARCHAR AS v, count(*), 2 FROM customer WHERE v IS NOT NULL GROUP BY v
  UNION ALL SELECT 'customer', 'not null', 'c_nationkey', count(*), 1 FROM customer WHERE c_nationkey IS NULL
  UNION ALL SELECT 'customer', 'precision', 'c_mktsegment', count(*), 1 FROM customer WHERE length(c_mktsegment) > 100
  UNION ALL SELECT 'customer', 'c_nationkey in nation', c_nationkey::VARCHAR AS v, count(*), 1
    FROM customer ANTI JOIN nation ON c_nationkey = n_nationkey WHERE v IS NOT NULL GROUP BY v
  UNION ALL SELECT 'part', 'unique key', p_brand || ', ' || p_size AS v, count(*), 2 FROM part WHERE v IS NOT NULL GROUP BY v
  UNION ALL SELECT 'part', 'not null', 'p_size', count(*), 1 FROM part WHERE p_size IS NULL
  UNION ALL SELECT 'part', 'precision', 'p_name', count(*), 1 FROM part WHERE length(p_name) > 100
  UNION ALL SELECT 'orders', 'unique key', o_orderkey::VARCHAR AS v, count(*), 2 FROM orders WHERE v IS NOT NULL GROUP BY v
  UNION ALL SELECT 'orders', 'not null', 'o_orderdate', count(*), 1 FROM orders WHERE o_orderdate IS NULL
  UNION ALL SELECT 'orders', 'precision', 'o_totalprice', count(*), 1 FROM orders
    WHERE o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(7, 2)) IS NULL
  UNION ALL SELECT 'orders', 'o_custkey in customer', o_custkey::VARCHAR AS v, count(*), 1
    FROM orders ANTI JOIN customer ON o_custkey = c_custkey WHERE v IS NOT NULL GROUP BY v
  UNION ALL SELECT 'lineitem', 'unique key', o || ', ' || n AS v, count(*), 2 FROM line WHERE v IS NOT NULL GROUP BY v
  UNION ALL SELECT 'lineitem', 'not null', 'l_shipdate', count(*), 1 FROM line WHERE d IS NULL
  UNION ALL SELECT 'lineitem', 'precision', 'l_extendedprice', count(*), 1 FROM line
    WHERE price IS NOT NULL AND TRY_CAST(price AS DECIMAL(8, 2)) IS NULL
  UNION ALL SELECT 'lineitem', 'l_orderkey in orders', o::VARCHAR AS v, count(*), 1
    FROM line ANTI JOIN orders ON o = o_orderkey WHERE v IS NOT NULL GROUP BY v
  UNION ALL SELECT 'lineitem', 'l_partkey in part', p::VARCHAR AS v, count(*), 1
    FROM line ANTI JOIN part ON p = p_partkey WHERE v IS NOT NULL GROUP BY v
  UNION ALL SELECT 'lineitem', 'l_suppkey in supplier', s::VARCHAR AS v, count(*), 1
    FROM line ANTI JOIN supplier ON s = s_suppkey WHERE v IS NOT NULL GROUP BY v
)
SELECT t AS table_name, r AS rule, v AS detail, c AS n_rows FROM found WHERE c >= least""",
}


def all_oracles() -> dict[str, str]:
    return {**_QUESTIONS, **_LOADS, "load_sector_country_report": _REPORT, **_STORED, **_OPERATORS}
