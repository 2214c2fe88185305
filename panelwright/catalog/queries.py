"""Every named query: a function of (session, folder of the test tables)."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from panelwright import operators as ops
from panelwright.catalog import raw_shapes as raw
from panelwright.functions import (
    casefold_key,
    extract_year,
    null_if_nan,
    parse_number,
    ratio,
    round_scaled,
    scaled_int,
    to_double,
    whole_number,
)
from panelwright.plans import loads, questions, tidy
from panelwright.plans.star_panel import StarPanel, cents, from_cents, name_id
from panelwright.session import files_under, shared_folder
from panelwright.schema import TABLES, TableSpec
from panelwright.sinks import PanelStore, write_ordered_csv, write_result_csv
from panelwright.sinks.store import RepeatedKey
from panelwright.sources import (
    literal_rows,
    melt_delimited,
    power_source_seed,
    read_delimited,
    read_sheet_export,
    read_with_preamble,
    read_workbook,
    source_labels,
    write_workbooks,
    year_columns,
)

Query = Callable[[SparkSession, str], DataFrame]

QUESTION_YEAR = 1998  # the star's orders end in 2001
AFTER_YEAR = 1997
LAST_YEAR = 9000

_REGISTRY: dict[str, Query] = {}


def _register(build: Callable[[StarPanel], DataFrame], **how: object) -> Callable[[StarPanel], DataFrame]:
    _REGISTRY[build.__name__] = lambda spark, folder: _plain_numbers(build(StarPanel(spark, folder, **how)))
    return build


def _register_shared(build: Callable[[StarPanel], DataFrame]) -> Callable[[StarPanel], DataFrame]:
    """For queries that take several tables: what these have in common is computed once."""
    return _register(build, share=True)


def _plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles: sums are exact decimals, their width differs between engines."""
    decimals = {f.name: F.col(f"`{f.name}`").cast("double") for f in df.schema if isinstance(f.dataType, DecimalType)}
    return df.withColumns(decimals) if decimals else df


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# ---------------------------------------------------------- the six questions


@partial(_register, years=(QUESTION_YEAR, QUESTION_YEAR))
def q1_top_sector_share(panel: StarPanel) -> DataFrame:
    return questions.top_sector_share(panel, QUESTION_YEAR)


@_register
def q2_intensity_topk(panel: StarPanel) -> DataFrame:
    return questions.emission_intensity(panel)


@_register
def q3_emission_breakdown(panel: StarPanel) -> DataFrame:
    return questions.emission_breakdown(panel)


@_register
def q3_safe(panel: StarPanel) -> DataFrame:
    return questions.emission_breakdown(panel, fan_out=False)


@_register_shared
def q4_yearly_leaders(panel: StarPanel) -> DataFrame:
    return questions.yearly_leaders(panel)


@_register_shared
def q4_nulls_last(panel: StarPanel) -> DataFrame:
    return questions.yearly_leaders(panel, nulls="last")


@_register_shared
def q5_development_panel(panel: StarPanel) -> DataFrame:
    return questions.development_panel(panel)


@_register_shared
def q5_safe(panel: StarPanel) -> DataFrame:
    return questions.development_panel(panel, fan_out=False)


@partial(_register, years=(AFTER_YEAR + 1, LAST_YEAR), share=True)
def q6_renewable_split(panel: StarPanel) -> DataFrame:
    return questions.renewable_split(panel, AFTER_YEAR)


@_register_shared
def q6_as_written(panel: StarPanel) -> DataFrame:
    return questions.renewable_split(panel.with_investment_ids(), AFTER_YEAR, "ID_Investment")


# ---------------------------------------------------------------------- loads


@_register
def load_country(panel: StarPanel) -> DataFrame:
    """Customer names as the country list; some are the world total, some missing."""
    listed = panel.star("customer").select(
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("World"))
        .when(F.col("c_acctbal") >= 0, F.col("c_name"))
        .alias("Table Name")
    )
    return ops.dense_keys(loads.countries(listed).distinct(), ["Name"], "ID_Country")


@_register
def load_sector(panel: StarPanel) -> DataFrame:
    """Long part descriptions as sector names, cut at the declared length."""
    words = F.concat_ws(" ", "p_type", "p_brand", "p_name")
    listed = panel.star("part").select(
        F.when(F.col("p_size") > 1, F.repeat(words, F.lit(5))).alias("Sector")
    )
    return ops.dense_keys(loads.sectors(listed).distinct(), ["Name"], "ID_Sector")


@_register
def load_power_source(panel: StarPanel) -> DataFrame:
    """Seed rows ignored where a segment already carries the name."""
    labels = literal_rows(panel.spark, raw.SEGMENT_LABELS, "c_mktsegment, Name")
    present = panel.star("customer").select("c_mktsegment").distinct().join(labels, "c_mktsegment", "left")
    present = present.select(F.coalesce("Name", "c_mktsegment").alias("Name"), F.lit(None).cast("boolean").alias("Renewable"))
    added = ops.insert_ignore(present, power_source_seed(panel.spark), ["Name"])
    return present.withColumn("added", F.lit(False)).unionByName(added.withColumn("added", F.lit(True)))


@_register_shared
def load_sector_country(panel: StarPanel) -> DataFrame:
    return loads.sector_emissions(raw.sector_sheet(panel), raw.known_countries(panel), panel["Sector"])


@_register_shared
def load_sector_country_gaps(panel: StarPanel) -> DataFrame:
    """One sector goes by another name in the sheet."""
    sector = F.col("Sector")
    sheet = raw.sector_sheet(panel).withColumn("Sector", F.when(sector == "SMÀLL", F.lit("Tiny")).otherwise(sector))
    return loads.sector_emission_gaps(sheet, raw.known_countries(panel), panel["Sector"])


@_register
def load_sector_country_report(panel: StarPanel) -> DataFrame:
    """The sheet loaded and its unmatched names reported from one pass: rows by year, names with their rows."""
    scaled = raw.ScaledPanel(panel.spark, panel.folder, share=True)
    sector = F.col("Sector")
    sheet = raw.sector_sheet(scaled).withColumn("Sector", F.when(sector == "SMÀLL", F.lit("Tiny")).otherwise(sector))
    store = PanelStore(panel.spark, shared_folder(panel.spark))
    store.create("Sector_Country")
    sectors = ops.dense_keys(panel["Sector"].select("Name"), ["Name"], "ID_Sector")
    with loads.sector_emissions_and_gaps(sheet, raw.known_countries(panel), sectors) as found:
        store.upsert("Sector_Country", found.rows)
        store.write_report("Sector_Country", found.unmatched)
    by_year = store.read("Sector_Country").groupBy("Year").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("CO2_Emission").alias("total"))
    loaded = by_year.select(F.lit("loaded").alias("kind"), F.col("Year").cast("string").alias("name"), "n_rows", "total")
    return loaded.unionByName(store.report("Sector_Country").withColumn("total", F.lit(None).cast("decimal(22,4)")))


@_register
def load_power_source_country(panel: StarPanel) -> DataFrame:
    sources = power_source_seed(panel.spark).withColumn("ID_Power", name_id(F.col("Name")))
    rows = loads.source_emissions(
        raw.energy_release(panel), raw.known_countries(panel), sources, source_labels(panel.spark), raw.SEQ
    )
    return rows.withColumnRenamed("Power Source_ID_Power", "ID_Power")


@_register
def load_environmental(panel: StarPanel) -> DataFrame:
    return loads.environmental(raw.emission_rows(panel), raw.known_countries(panel), raw.SEQ)


@_register
def load_development(panel: StarPanel) -> DataFrame:
    return loads.development(
        raw.development_index(panel),
        raw.poverty_1(panel),
        raw.poverty_2(panel),
        raw.known_countries(panel),
        raw.SEQ,
    )


@_register
def load_investment(panel: StarPanel) -> DataFrame:
    return loads.investment(raw.investment_rows(panel), raw.known_countries(panel), raw.SEQ)


@_register
def load_power_consumed(panel: StarPanel) -> DataFrame:
    return loads.power_consumed(raw.consumption_rows(panel), raw.known_countries(panel), raw.SEQ)


@_register
def load_demography(panel: StarPanel) -> DataFrame:
    return loads.demography(raw.development_index(panel), raw.known_countries(panel), raw.SEQ)


def _load(panel: StarPanel) -> PanelStore:
    """The whole ordered load into fresh tables."""
    scaled = raw.ScaledPanel(panel.spark, panel.folder, share=True)
    store = PanelStore(panel.spark, shared_folder(panel.spark))
    inputs = loads.RawInputs(
        country_list=raw.known_countries(panel).withColumnRenamed("Name", "Table Name"),
        sector_sheet=raw.sector_sheet(scaled),
        energy=raw.energy_release(scaled),
        emissions=raw.emission_rows(scaled),
        development_index=raw.development_index(scaled),
        poverty_1=raw.poverty_1(scaled),
        poverty_2=raw.poverty_2(scaled),
        investment=raw.investment_rows(scaled),
        consumption=raw.consumption_rows(scaled),
        order=raw.SEQ,
    )
    loads.load_all(panel.spark, inputs, store)
    return store


_LOADED: dict[tuple[object, ...], tuple[PanelStore, list[tuple[str, int, int]]]] = {}


def _loaded(panel: StarPanel) -> PanelStore:
    """Loaded tables that the stored questions share, as long as the files behind them and all files of the store are the same."""
    state = (panel.spark.sparkContext.applicationId, panel.folder, *panel.files())
    store, files = _LOADED.get(state, (None, []))
    if store is None or files_under(panel.spark, store.root) != files:
        store = _load(panel)
        _LOADED[state] = store, files_under(panel.spark, store.root)
    return store


@_register
def load_everything(panel: StarPanel) -> DataFrame:
    """The whole load: per table and measure rows, countries, surrogate keys and the sum."""
    return reduce(DataFrame.unionAll, [s for t, df in _load(panel).panel().items() for s in _table_sums(t, df)])


def _table_sums(table: str, df: DataFrame) -> list[DataFrame]:
    spec = TABLES[table]
    country = next((c for c in ("Country_ID", "Country_ID_Country", "ID_Country") if c in df.columns), None)
    countries = F.count_distinct(F.col(country)) if country else F.lit(0).cast("bigint")
    keys = F.count_distinct(F.col(spec.surrogate)) if spec.surrogate else F.lit(0).cast("bigint")
    ids = {spec.surrogate, spec.partition, *spec.foreign_keys, "Name", "Renewable"}
    measures = {m: F.sum(F.col(f"`{m}`")).cast("double") for m in df.columns if m not in ids}
    if not measures:
        measures = {"names": F.count_distinct("Name").cast("double")}
    return [
        df.agg(F.count(F.lit(1)).alias("n_rows"), countries.alias("n_countries"), keys.alias("n_keys"), total.alias("total")).select(
            F.lit(table).alias("table_name"), F.lit(m).alias("measure"), "n_rows", "n_countries", "n_keys", "total"
        )
        for m, total in measures.items()
    ]


# ------------------------------------------- the questions over stored tables


@_register
def stored_q1(panel: StarPanel) -> DataFrame:
    return questions.top_sector_share(_loaded(panel).panel(), 2003)


@_register
def stored_q2(panel: StarPanel) -> DataFrame:
    return questions.emission_intensity(_loaded(panel).panel())


@_register
def stored_q3(panel: StarPanel) -> DataFrame:
    return questions.emission_breakdown(_loaded(panel).panel())


@_register
def stored_q4(panel: StarPanel) -> DataFrame:
    return questions.yearly_leaders(_loaded(panel).panel())


@_register
def stored_q5(panel: StarPanel) -> DataFrame:
    return questions.development_panel(_loaded(panel).panel())


@_register
def stored_q6(panel: StarPanel) -> DataFrame:
    return questions.renewable_split(_loaded(panel).panel(), 2000)


# --------------------------------------------------------------- tidy releases


@_register
def tidy_energy_long(panel: StarPanel) -> DataFrame:
    rows = tidy.energy_long(raw.energy_release(panel))
    return rows.withColumn("Value", to_double(F.col("Value")))


@_register
def tidy_energy_wide(panel: StarPanel) -> DataFrame:
    release = raw.energy_release(panel).withColumnRenamed("Area", "Country")
    rows = tidy.energy_wide(release, raw.SEQ)
    return rows.withColumns({c: to_double(F.col(f"`{c}`")) for c in tidy.CATEGORIES})


@_register
def tidy_emissions(panel: StarPanel) -> DataFrame:
    return tidy.emissions_and_land_use(raw.fossil_sheet(panel), raw.land_use_sheet(panel))


# ------------------------------------------------------------ reshape and keys


@_register
def unpivot_years(panel: StarPanel) -> DataFrame:
    """Quantities shipped per supplier, a column per year, made long with nulls dropped."""
    shipped = panel.star("lineitem").select("l_suppkey", F.year("l_shipdate").alias("y"), cents("l_quantity").alias("q"))
    first, last = shipped.agg(F.min("y"), F.max("y")).first()
    years = [str(y) for y in range(first, last + 1)] if first is not None else []
    if not years:
        return panel.spark.createDataFrame([], "l_suppkey long, Year int, quantity decimal(20,2)")
    wide = shipped.groupBy("l_suppkey").agg(*[from_cents(F.sum(F.when(F.col("y") == int(y), F.col("q")))).alias(y) for y in years])
    long = ops.unpivot_columns(wide, ["l_suppkey"], years, "Year", "quantity", drop_nulls=True)
    return long.withColumn("Year", F.col("Year").cast("int"))


@_register
def pivot_categories(panel: StarPanel) -> DataFrame:
    """First quantity by ship date for each return flag, per supplier and line status."""
    return ops.pivot_first(
        panel.star("lineitem"),
        ["l_suppkey", "l_linestatus"],
        "l_returnflag",
        {"A": "accepted", "N": "none", "R": "returned"},
        "l_quantity",
        ["l_shipdate", "l_orderkey", "l_partkey", "l_linenumber"],
    )


@_register
def outer_merge_measures(panel: StarPanel) -> DataFrame:
    """Emission by sector beside emission by source two years on, so each side lacks some years."""
    sector = panel["Sector_Country"].groupBy("Country_ID_Country", "Year").agg(F.sum("CO2_Emission").alias("emission"))
    source = (
        panel["Power Source_Country"]
        .groupBy("Country_ID_Country", (F.col("Year") + 2).alias("Year"))
        .agg(F.sum("CO2_Emission").alias("emission"))
    )
    return ops.outer_merge(sector, source, ["Country_ID_Country", "Year"], ("_sector", "_source"))


@_register
def fan_out_three_sides(panel: StarPanel) -> DataFrame:
    """Balances and list prices over the join of suppliers, customers and parts that share a number, never formed."""
    number = lambda c: F.pmod(F.col(c), F.lit(17)).cast("int")
    sides = [
        (panel.star("supplier").withColumn("number", number("s_suppkey")), {"supplier_cents": cents("s_acctbal")}),
        (panel.star("customer").withColumn("number", number("c_custkey")), {"customer_cents": cents("c_acctbal")}),
        (panel.star("part").where("p_size > 10").withColumn("number", number("p_partkey")), {"part_cents": cents("p_retailprice")}),
    ]
    return ops.fan_out_sums(sides, ["number"], "n_rows")


@_register
def outer_merge_hot_key(panel: StarPanel) -> DataFrame:
    """Every line beside its supplier, three suppliers on: returned lines, a third of all, name one supplier, lines
    without tax none, and another third of the suppliers' numbers is not there."""
    key = F.when(F.col("l_tax") == 0, F.lit(None)).when(F.col("l_returnflag") == "R", F.lit(7)).otherwise(F.col("l_suppkey"))
    lines = panel.star("lineitem").select(key.cast("bigint").alias("key"), "l_orderkey", "l_linenumber", F.col("l_quantity").alias("amount"))
    suppliers = panel.star("supplier").select((F.col("s_suppkey") + 3).alias("key"), F.col("s_acctbal").alias("amount"), "s_nationkey")
    return ops.outer_merge_skewed(lines, suppliers.where("key % 3 <> 0"), ["key"], ("_line", "_supplier"))


@_register
def dense_keys(panel: StarPanel) -> DataFrame:
    names = panel.star("part").select("p_brand", "p_name").distinct()
    return ops.dense_keys(names, ["p_brand", "p_name"], "id")


@_register
def dedup_keep_first(panel: StarPanel) -> DataFrame:
    lines = panel.star("lineitem")
    return ops.first_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@_register
def dedup_rows(panel: StarPanel) -> DataFrame:
    return panel.star("lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@_register
def seed_recode(panel: StarPanel) -> DataFrame:
    """Customers per source name: segments recoded to labels, labels to dimension names."""
    labels = literal_rows(panel.spark, raw.SEGMENT_LABELS, "segment, label")
    names = labels.join(source_labels(panel.spark).withColumnRenamed("name", "source"), "label", "left")
    seeds = names.join(power_source_seed(panel.spark).withColumnRenamed("Name", "source"), "source", "left")
    counted = panel.star("customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))
    return counted.join(seeds.withColumnRenamed("segment", "c_mktsegment"), "c_mktsegment", "left").drop("label")


# ------------------------------------------------------------ ranking and sets


@_register
def top_row_per_group(panel: StarPanel) -> DataFrame:
    orders = panel.star("orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")
    return ops.top_per_group(orders, ["o_custkey"], [F.col("o_totalprice").desc_nulls_first(), "o_orderkey"])


@_register_shared
def union_years(panel: StarPanel) -> DataFrame:
    return questions.covered_years(panel)


@_register
def semi_join_rows(panel: StarPanel) -> DataFrame:
    builders = panel.star("customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return ops.semi(panel.star("orders").select("o_orderkey", "o_custkey"), "o_custkey", builders)


# ------------------------------------------------------------ filters and nulls


def _judged(panel: StarPanel) -> DataFrame:
    """Every document with its labels, null where it has none."""
    documents = panel.star("documents").select("doc_id", "lang", "source")
    return documents.join(panel.star("labels"), "doc_id", "left")


@_register
def not_equal_keep_null(panel: StarPanel) -> DataFrame:
    return _judged(panel).where(~F.col("quality").eqNullSafe(1)).select("doc_id", "quality")


@_register
def not_in_keep_null(panel: StarPanel) -> DataFrame:
    """Codes are only upper-cased: one with blanks around it is not in the list, and stays."""
    padded = F.concat(F.lit(" "), F.col("lang"), F.lit(" "))
    code = F.upper(F.when(F.col("toxic") == 1, padded).when(F.col("toxic") == 0, F.col("lang")))
    coded = _judged(panel).select("doc_id", code.alias("code"))
    return coded.where(~F.coalesce(F.col("code").isin("EN", "FR"), F.lit(False)))


@_register
def dropna_any_all(panel: StarPanel) -> DataFrame:
    """Rows left by each rule, over the measures of three tables with gaps."""
    development = panel["Development"].select("Electricity", "Health")
    consumed = panel["Power Consumed"].select("PowerImport", "GWH")
    counts = []
    for name, df in {"development": development, "consumed": consumed}.items():
        for how in ("any", "all"):
            kept = df.dropna(how=how).agg(F.count(F.lit(1)).alias("n_rows"))
            counts.append(kept.select(F.lit(name).alias("table_name"), F.lit(how).alias("how"), "n_rows"))
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


# ------------------------------------------------------------------ functions


@_register
def parse_number_text(panel: StarPanel) -> DataFrame:
    return panel.star("events").select(
        "event_id",
        parse_number(F.col("props")).alias("from_props"),
        parse_number(F.concat(F.lit("ca. -"), F.replace(F.col("value").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")))).alias(
            "from_comma"
        ),
        to_double(F.col("props")).alias("whole_text"),
        to_double(F.concat(F.lit(" "), F.col("value").cast("decimal(12,2)").cast("string"))).alias("whole_number"),
    )


@_register
def extract_year_text(panel: StarPanel) -> DataFrame:
    survey = F.concat(F.lit("survey "), F.col("o_orderdate").cast("string"), F.lit(" M"))
    return panel.star("orders").select("o_orderkey", extract_year(survey).alias("Year"))


@_register
def rounding_rules(panel: StarPanel) -> DataFrame:
    eighth = F.col("l_quantity") / 8
    return panel.star("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        scaled_int(eighth, 10).alias("tenfold"),
        round_scaled(eighth, 2).alias("half_even"),
        F.round(eighth.cast("decimal(12,4)"), 2).alias("half_away"),
        whole_number(eighth).alias("truncated"),
    )


@_register
def nan_as_null(panel: StarPanel) -> DataFrame:
    """Quantities of returned lines arrive as NaN; sums skip them."""
    arrived = F.when(F.col("l_returnflag") == "R", F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    return panel.star("lineitem").groupBy("l_orderkey").agg(F.sum(null_if_nan(arrived)).alias("quantity"))


@_register
def safe_ratio_lines(panel: StarPanel) -> DataFrame:
    """Returned share of each order's quantity; null where nothing was charged for tax."""
    lines = panel.star("lineitem")
    quantity = F.col("l_quantity").cast("bigint")
    sums = lines.groupBy("l_orderkey").agg(
        *ops.conditional_sums(
            quantity, {"returned": F.col("l_returnflag") == "R", "taxed": F.col("l_tax") > 0}
        )
    )
    return sums.withColumn("per_taxed", ratio(F.col("returned"), F.col("taxed"), 8))


@_register
def casefold_text(panel: StarPanel) -> DataFrame:
    """Whole document texts folded, given by length and digest."""
    key = casefold_key(F.col("text"))
    return panel.star("documents").select(
        "doc_id", F.char_length(key).alias("key_length"), F.md5(key).alias("key_digest")
    )


def _words(df: DataFrame) -> DataFrame:
    return df.select(F.explode(F.split("text", r"[ \n\t\r]+")).alias("word"))


def _benchmark_words(panel: StarPanel) -> DataFrame:
    words = _words(panel.star("benchmark")).distinct()
    return words.select(F.col("word").alias("Name"), F.md5("word").alias("id"))


@_register
def accent_fold_lookup(panel: StarPanel) -> DataFrame:
    """Every word of every document matched to the benchmark's words; hits per id.

    Words are counted first, so a word that fills a third of all text is one row to match.
    """
    counted = _words(panel.star("documents")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = _benchmark_words(panel)
    hits = ops.lookup(counted, "word", words, rule="accent_fold", how="inner")
    return hits.groupBy("id").agg(F.sum("n").alias("hits"))


@_register
def unmatched_names(panel: StarPanel) -> DataFrame:
    return ops.unmatched_names(_words(panel.star("documents")), "word", _benchmark_words(panel))


# --------------------------------------------------------------- write modes


def _customer_figures(panel: StarPanel, *statuses: str) -> DataFrame:
    """Per customer and year: totals over orders of a status; gaps where a priority is absent."""
    priority, total = F.col("o_orderpriority"), cents("o_totalprice")
    return (
        panel.star("orders")
        .where(F.col("o_orderstatus").isin(*statuses))
        .groupBy("o_custkey", F.year("o_orderdate").alias("Year"))
        .agg(
            from_cents(F.sum(F.when(priority == "1-URGENT", total))).alias("urgent"),
            from_cents(F.sum(F.when(priority == "2-HIGH", total))).alias("high"),
        )
    )


_FIGURE_KEY = ["o_custkey", "Year"]


@_register
def upsert_replace(panel: StarPanel) -> DataFrame:
    return ops.merge_rows(
        _customer_figures(panel, "F", "P"), _customer_figures(panel, "O"), _FIGURE_KEY, mode="replace"
    )


@_register
def upsert_keep_old(panel: StarPanel) -> DataFrame:
    return ops.merge_rows(_customer_figures(panel, "F", "P"), _customer_figures(panel, "O"), _FIGURE_KEY)


@_register
def insert_ignore(panel: StarPanel) -> DataFrame:
    """Rows that an insert-ignore of open orders' figures would append."""
    return ops.insert_ignore(_customer_figures(panel, "F", "P"), _customer_figures(panel, "O"), _FIGURE_KEY)


@_register
def last_known_values(panel: StarPanel) -> DataFrame:
    """Where keep-old upserts of every order in date order would leave each customer."""
    priority = F.col("o_orderpriority")
    return ops.last_known(
        panel.star("orders"),
        ["o_custkey"],
        {
            "urgent": F.when(priority == "1-URGENT", F.col("o_totalprice")),
            "high": F.when(priority == "2-HIGH", F.col("o_totalprice")),
        },
        ["o_orderdate", "o_orderkey"],
    )


@_register
def store_upsert(panel: StarPanel) -> DataFrame:
    """Tables written and upserted in the shared folder, then read back: sums of every measure."""
    store = PanelStore(panel.spark, shared_folder(panel.spark))
    store.create("Power Consumed")
    rows = raw.ScaledPanel(panel.spark, panel.folder, share=True)["Power Consumed"]
    store.append("Power Consumed", rows.where(F.col("Year") < 1999))
    single = F.col("PowerImport").cast("decimal(12,2)")
    later = rows.where(F.col("Year") > 1996).select(
        "Country_ID",
        "Year",
        (single * 2).alias("PowerImport"),
        F.when(F.col("Country_ID") > 9, F.col("Renewable_Energy") / 2).alias("Renewable_Energy"),
    )
    store.upsert("Power Consumed", later)
    return store.read("Power Consumed").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("ID_Consumed").alias("n_keys"),
        F.sum("GWH").alias("gwh"),
        F.sum("PowerImport").alias("power_import"),
        F.sum("Renewable_Energy").alias("renewable"),
    )


@_register
def upsert_changed_years(panel: StarPanel) -> DataFrame:
    """The same rows upserted again and then with one year changed: what is stored, and the years written last."""
    store = PanelStore(panel.spark, shared_folder(panel.spark))
    store.create("Power Consumed")
    rows = raw.ScaledPanel(panel.spark, panel.folder, share=True)["Power Consumed"]
    store.append("Power Consumed", rows)
    again = store.upsert("Power Consumed", rows)
    more = F.when(F.col("Year") == 1998, F.col("GWH") + 1).otherwise(F.col("GWH")).cast("decimal(12,2)")
    written = store.upsert("Power Consumed", rows.withColumn("GWH", more))
    by_year = store.read("Power Consumed").groupBy("Year").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("GWH").alias("gwh"))
    return by_year.withColumns({"again": F.col("Year").isin(again), "written": F.col("Year").isin(written)})


@_register
def append_bridge(panel: StarPanel) -> DataFrame:
    """A bridge filled by appends; a batch that repeats stored keys is refused and changes nothing."""
    store = PanelStore(panel.spark, shared_folder(panel.spark))
    store.create("Sector", "Sector_Country")
    store.insert_ignore("Sector", panel["Sector"].select("Name"))
    scaled = raw.ScaledPanel(panel.spark, panel.folder, share=True)
    named = scaled["Sector_Country"].join(panel["Sector"].withColumnRenamed("ID_Sector", "Sector_ID_Sector"), "Sector_ID_Sector")
    rows = named.drop("Sector_ID_Sector").join(store.read("Sector").withColumnRenamed("ID_Sector", "Sector_ID_Sector"), "Name")
    for half in (F.col("Year") % 2 == 0, F.col("Year") % 2 == 1):
        store.append("Sector_Country", rows.where(half))
    try:
        store.append("Sector_Country", rows.where("Year % 2 = 0"))
    except RepeatedKey:
        pass
    kept = store.read("Sector_Country").groupBy(F.col("Country_ID_Country").alias("country"), "Year")
    return kept.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("CO2_Emission").alias("emission"))


@_register
def exact_lookup_left(panel: StarPanel) -> DataFrame:
    """Customers by nation name, matched exactly; a fifth of the names is misspelt and gets null."""
    nation = panel.star("nation")
    named = panel.star("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    written = F.when(F.col("c_nationkey") % 5 == 0, F.lower("n_name")).otherwise(F.col("n_name"))
    customers = named.select("c_custkey", written.alias("name"))
    return ops.lookup(customers, "name", nation, "n_name", "n_nationkey", "id", "exact", "left").select("c_custkey", "id")


# --------------------------------------------------------------------- files


@_register
def csv_round_trip(panel: StarPanel) -> DataFrame:
    """A result written as CSV with a header, read back with a declared schema and renames."""
    path = shared_folder(panel.spark)
    write_result_csv(panel["Power Consumed"], path)
    schema = "GWH decimal(20,2), PowerImport decimal(20,2), Renewable_Energy decimal(20,4), Year int, Country_ID int"
    rows = read_delimited(panel.spark, path, schema, rename={"GWH": "gwh", "PowerImport": "power_import"})
    return rows.dropna(how="all")


@_register
def sheet_round_trip(panel: StarPanel) -> DataFrame:
    """A wide sheet exported to CSV, its headers cleaned and its year columns found on reading."""
    path = shared_folder(panel.spark)
    write_result_csv(raw.sector_sheet(panel).withColumnsRenamed({"Sector": " Sector ", "2003": "2003.0"}), path)
    sheet = read_sheet_export(panel.spark, path)
    years = year_columns(sheet, 2001, 2005)
    return ops.unpivot_columns(sheet, ["Sector", "Country"], years, "Year", "emission", drop_nulls=True).select(
        F.trim("Sector").alias("Sector"), F.trim("Country").alias("Country"), "Year", to_double(F.col("emission")).alias("emission")
    )


@_register
def ordered_export(panel: StarPanel) -> DataFrame:
    """Every order exported in the order of its price with a row index, read back."""
    path, orders = shared_folder(panel.spark), panel.star("orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    write_ordered_csv(orders, path, [F.col("o_totalprice").desc_nulls_first(), F.col("o_orderkey")])
    read = panel.spark.read.schema("place long, o_orderkey long, o_totalprice double, o_orderpriority string")
    return read.option("escape", '"').csv(path).where(F.col("place").isNotNull())


@_register
def melt_by_header(panel: StarPanel) -> DataFrame:
    """Quantities of each order line, a column for every part number, written wide and melted by the header alone."""
    path = shared_folder(panel.spark)
    lines = panel.star("lineitem").select("l_suppkey", (F.col("l_partkey") % 997 + 1000).alias("column"), cents("l_quantity").alias("q"))
    summed = lines.groupBy("l_suppkey", "column").agg(F.sum("q").alias("q"))
    columns = F.sequence(F.lit(1000), F.lit(1996))
    header = F.concat(F.lit("l_suppkey,note,"), F.array_join(F.transform(columns, lambda c: c.cast("string")), ","))
    _wide_lines(summed, 1000, 1996).write.text(f"{path}/rows")
    panel.spark.range(1).select(header.alias("value")).write.text(f"{path}/header")
    long = melt_delimited(panel.spark, f"{path}/rows", ["l_suppkey"], 1000, 1990, "Year", "quantity", header=f"{path}/header")
    return long.select(F.col("l_suppkey").cast("bigint").alias("l_suppkey"), F.col("Year").cast("int").alias("Year"), F.col("quantity").cast("bigint").alias("quantity"))


def _wide_lines(summed: DataFrame, first: int, last: int) -> DataFrame:
    """A line of text for each supplier with a cell for every column: what it holds in their order, each after the commas
    of the columns since the one before, so that a line costs its cells and no column is looked up."""
    column = F.col("column")
    held = F.array_sort(F.collect_list(F.when(column.between(first, last), F.struct("column", F.col("q").cast("string").alias("q")))))
    wide = summed.groupBy("l_suppkey").agg(held.alias("held"))
    at = F.concat(F.array(F.lit(first).cast("bigint")), F.transform("held", lambda x: x["column"]))
    commas = lambda n: F.repeat(F.lit(","), n.cast("int"))
    cell = lambda x, before: F.concat(commas(x["column"] - before), F.coalesce(x["q"], F.lit("")))
    cells = F.array_join(F.zip_with("held", F.slice(at, 1, F.size("held")), cell), "")
    body = F.concat(cells, commas(F.lit(last) - F.element_at(at, -1)))
    return wide.select(F.concat(F.col("l_suppkey").cast("string"), F.lit(',"a ""b"", c",'), body).alias("value"))


@_register
def workbook_round_trip(panel: StarPanel) -> DataFrame:
    """Every order through workbooks, one a partition, read in ranges of rows with a declared schema."""
    path, orders = shared_folder(panel.spark), panel.star("orders")
    write_workbooks(orders, path, "orders")
    return read_workbook(panel.spark, path, "orders", schema=orders.schema)


@_register
def workbook_sectors(panel: StarPanel) -> DataFrame:
    """The wide sheet of sectors written as workbooks, read as text, matched and melted by the load."""
    path = shared_folder(panel.spark)
    sheet = raw.sector_sheet(StarPanel(panel.spark, panel.folder, share=True))
    write_workbooks(sheet.withColumnsRenamed({"Sector": " Sector ", "2003": "2003.0"}), path, "totals")
    read = read_workbook(panel.spark, path, "totals")
    return loads.sector_emissions(read, raw.known_countries(panel), panel["Sector"])


@_register
def report_with_preamble(panel: StarPanel) -> DataFrame:
    """A report with title lines, blank headers and footnotes, parsed by position."""
    path = shared_folder(panel.spark)
    _write_report(panel, path)
    rows = read_with_preamble(
        panel.spark, path, width=5, columns={"Country": 0, "Year and survey": 1, "Health": 3}, required="Country"
    )
    return rows.select(
        "Country",
        extract_year(F.col("Year and survey")).alias("Year"),
        scaled_int(parse_number(F.col("Health")), 10).alias("Health"),
    ).dropna(subset=["Year"])


def _write_report(panel: StarPanel, path: str) -> None:
    lines = ["Table 1: an index,,,,", ",,,,", "Country,Year and survey,b,Health,", ",1995-2001,,(%),"]
    notes = ["Footnotes,,,,", '"a. Not all indicators, in all places.",,,,', ",,,,"]

    def text(values: list[str]) -> DataFrame:
        return literal_rows(panel.spark, [(v,) for v in values], "value")

    def quoted(c: Column) -> Column:
        return F.concat(F.lit('"'), c, F.lit('"'))

    survey = raw.poverty_1(panel)
    body = survey.select(
        F.concat_ws(",", quoted(F.trim("Country")), "Year and survey", F.lit("c"), quoted(F.col("Health")), F.lit("")).alias(
            "value"
        )
    )
    text(lines).union(body).union(text(notes)).write.text(path)


# ------------------------------------------------------------------- quality


@_register
def key_duplicates(panel: StarPanel) -> DataFrame:
    return ops.key_duplicates(panel.star("lineitem"), ["l_orderkey", "l_linenumber"])


@_register
def fk_orphans(panel: StarPanel) -> DataFrame:
    """Returned lines name an order that does not exist."""
    key = F.when(F.col("l_returnflag") == "R", -F.col("l_orderkey") - 1).otherwise(F.col("l_orderkey"))
    return ops.foreign_key_orphans(panel.star("lineitem").select(key.alias("l_orderkey")), "l_orderkey", panel.star("orders"), "o_orderkey")


@_register
def null_violations(panel: StarPanel) -> DataFrame:
    return ops.null_violations(_judged(panel), ["doc_id", "quality", "toxic"])


@_register
def precision_violations(panel: StarPanel) -> DataFrame:
    rows = panel.star("orders").select("o_totalprice", F.col("o_totalprice").alias("o_wide"))
    return ops.precision_violations(rows, {"o_totalprice": DecimalType(7, 2), "o_wide": DecimalType(12, 2)})


@_register_shared
def audit_panel(panel: StarPanel) -> DataFrame:
    """Declared rules over dimensions and bridges; some rows name a country that does not exist."""
    country = F.col("Country_ID_Country")
    wrong = F.when(country < 5, country + 1000).otherwise(country)
    tables = {
        "Country": raw.known_countries(panel),
        "Sector": panel["Sector"],
        "Sector_Country": panel["Sector_Country"].withColumn("Country_ID_Country", wrong),
    }
    return ops.audit(tables)


def _star_spec(name: str, columns: str, *key: str, **references: tuple[str, str]) -> TableSpec:
    return TableSpec(name, StructType.fromDDL(columns), key, references)


def star_specs() -> dict[str, TableSpec]:
    """Rules that the star declares, some tighter than its values."""
    specs = (
        _star_spec("region", "r_regionkey int not null, r_name string", "r_regionkey"),
        _star_spec("nation", "n_nationkey int not null, n_name string", "n_name", n_regionkey=("region", "r_regionkey")),
        _star_spec("supplier", "s_acctbal decimal(5,2)", "s_suppkey", s_nationkey=("nation", "n_nationkey")),
        _star_spec("customer", "c_nationkey int not null, c_mktsegment string", "c_custkey", c_nationkey=("nation", "n_nationkey")),
        _star_spec("part", "p_name string, p_size int not null", "p_brand", "p_size"),
        _star_spec("orders", "o_totalprice decimal(7,2), o_orderdate timestamp not null", "o_orderkey", o_custkey=("customer", "c_custkey")),
        _star_spec(
            "lineitem",
            "l_shipdate timestamp not null, l_extendedprice decimal(8,2)",
            "l_orderkey",
            "l_linenumber",
            l_orderkey=("orders", "o_orderkey"),
            l_partkey=("part", "p_partkey"),
            l_suppkey=("supplier", "s_suppkey"),
        ),
    )
    return {s.name: s for s in specs}


@_register
def audit_star(panel: StarPanel) -> DataFrame:
    """Every rule over seven tables: returned lines name an order that does not exist, a third of all lines one
    supplier that is gone, and some dates are missing."""
    specs = star_specs()
    tables = {name: panel.star(name) for name in specs}
    returned = F.col("l_returnflag") == "R"
    tables["lineitem"] = tables["lineitem"].withColumns(
        {
            "l_orderkey": F.when(returned, -F.col("l_orderkey") - 1).otherwise(F.col("l_orderkey")),
            "l_suppkey": F.when(F.col("l_returnflag") == "A", F.lit(-7).cast("bigint")).otherwise(F.col("l_suppkey")),
            "l_shipdate": F.when(F.col("l_quantity") != 13, F.col("l_shipdate")),
        }
    )
    return ops.audit(tables, specs)
