"""The panel computed from an order star (nation customer supplier part orders lineitem).

A stand-in with the panel's tables, keys and null patterns that grows with the star.
Nations are countries, part types are sectors, market segments are power sources.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.numeric import ratio
from panelwright.operators.keys import dense_keys
from panelwright.session import files_under, shared_folder

# Nations that do not report a figure, and the renewable segments.
NO_TOTAL = [3]
NO_ENERGY_INVESTMENT = [0, 4, 8, 12, 16, 20, 24]
NO_ELECTRICITY = [0, 3, 6, 9, 12, 15, 18, 21, 24]
NO_HEALTH = [1, 7, 13, 19]
NO_IMPORTS = [2, 9, 16, 23]
RENEWABLE = ["BUILDING", "FURNITURE"]

# Declared schemas of the star, so that no read starts a job to infer one.
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def cents(column: str) -> Column:
    """An amount with two decimals in whole cents: exact to sum, and cheap, as long integers."""
    return F.rint(F.col(column) * 100).cast("bigint")


def from_cents(amount: Column) -> Column:
    return (amount.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(20,2)")


def name_id(name: Column) -> Column:
    """Stable id of a name: 60 bits of its digest. Facts get it without a join.

    Meant for the few names of a dimension; an unbounded set of words needs the whole digest."""
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint")


class StarPanel(Mapping[str, DataFrame]):
    """Lazy tables by name; only what a question touches is planned.

    ``years`` (first, last) cuts the orders to whole years by their dates, a filter that
    skips row groups. ``share`` writes what several tables are computed from to the
    shared folder on first use: the lines are then read once for the sales by segment and
    once for those by part type, however many tables a question takes.
    """

    def __init__(self, spark: SparkSession, folder: str, years: tuple[int, int] | None = None, share: bool = False):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.years = years
        self.share = share
        self._cache: dict[str, DataFrame] = {}
        self._builders: dict[str, Callable[[], DataFrame]] = {
            "Country": self._country,
            "Sector": self._sector,
            "Power Source": self._power_source,
            "Sector_Country": self._sector_country,
            "Power Source_Country": self._power_source_country,
            "Environmental Indicator": self._environmental,
            "Investment": self._investment,
            "Development": self._development,
            "Power Consumed": self._power_consumed,
            "Demography": self._demography,
        }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._builders[name]()
        return self._cache[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def star(self, table: str) -> DataFrame:
        return self.spark.read.schema(STAR_SCHEMAS[table]).parquet(f"{self.folder}/{table}.parquet")

    def files(self) -> list[tuple[str, int, int]]:
        """Path, length and time of every file behind the star tables: changes when their rows do."""
        return sorted(f for table in STAR_SCHEMAS for f in files_under(self.spark, f"{self.folder}/{table}.parquet"))

    # ------------------------------------------------------------ shared steps

    @cached_property
    def order_years(self) -> list[int]:
        """Every year from the first order to the last, by one aggregate."""
        first, last = self.star("orders").agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
        return list(range(first, last + 1)) if first is not None else []

    def _shared(self, df: DataFrame) -> DataFrame:
        if not self.share:
            return df
        path = shared_folder(self.spark)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def _orders(self) -> DataFrame:
        orders = self.star("orders")
        if self.years:
            first, last = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (self.years[0], self.years[1] + 1))
            orders = orders.where((F.col("o_orderdate") >= first) & (F.col("o_orderdate") < last))
        return orders.withColumn("Year", F.year("o_orderdate"))

    @cached_property
    def _order_lines(self) -> DataFrame:
        """(o_custkey, Year) sums of line figures.

        Lines collapse to one row per order, already partitioned for the join with orders,
        and those to one row per customer and year before they meet the customers.
        """
        quantity, amount = cents("l_quantity"), cents("l_extendedprice")
        per_order = (
            self.star("lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.sum(quantity).alias("quantity"),
                F.sum(F.when(F.col("l_returnflag") == "R", amount)).alias("returned"),
                F.sum(F.when(F.col("l_linestatus") == "O", quantity)).alias("open_quantity"),
            )
        )
        dated = self._orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "Year")
        return (
            per_order.join(dated, "l_orderkey")
            .groupBy("o_custkey", "Year")
            .agg(*[F.sum(c).alias(c) for c in ("quantity", "returned", "open_quantity")])
        )

    @cached_property
    def _sold(self) -> DataFrame:
        """(nation, segment, Year) sums of line figures."""
        return self._shared(
            self._order_lines.join(self._customers("c_nationkey", "c_mktsegment"), "o_custkey")
            .groupBy("c_nationkey", "c_mktsegment", "Year")
            .agg(*[F.sum(c).alias(c) for c in ("quantity", "returned", "open_quantity")])
        )

    @cached_property
    def _customer_years(self) -> DataFrame:
        """(nation, Year) sums over orders, cut to one row per customer and year first."""
        total, priority, status = cents("o_totalprice"), F.col("o_orderpriority"), F.col("o_orderstatus")
        per_customer = self._orders.groupBy("o_custkey", "Year").agg(
            F.sum(total).alias("total"),
            F.sum(F.when(priority == "1-URGENT", total)).alias("urgent"),
            F.sum(F.when(priority == "2-HIGH", total)).alias("high"),
            F.count(F.lit(1)).alias("orders"),
            F.count_if(status == "F").alias("finished"),
            F.count_if(status == "O").alias("open"),
        )
        sums = ["total", "urgent", "high", "orders", "finished", "open"]
        return self._shared(
            per_customer.join(self._customers("c_nationkey"), "o_custkey")
            .groupBy(F.col("c_nationkey").alias("Country_ID"), "Year")
            .agg(*[F.sum(c).alias(c) for c in sums], F.count(F.lit(1)).alias("customers"))
        )

    def _customers(self, *columns: str) -> DataFrame:
        return self.star("customer").select(F.col("c_custkey").alias("o_custkey"), *columns)

    # ------------------------------------------------------------------ tables

    def _country(self) -> DataFrame:
        return self.star("nation").select(
            F.col("n_nationkey").alias("ID_Country"), F.col("n_name").alias("Name")
        )

    def _sector(self) -> DataFrame:
        names = self.star("part").select(F.col("p_type").alias("Name")).distinct()
        return names.select(name_id(F.col("Name")).alias("ID_Sector"), "Name")

    def _power_source(self) -> DataFrame:
        names = self.star("customer").select(F.col("c_mktsegment").alias("Name")).distinct()
        return names.select(
            name_id(F.col("Name")).alias("ID_Power"),
            "Name",
            F.col("Name").isin(RENEWABLE).alias("Renewable"),
        )

    def _sector_country(self) -> DataFrame:
        lines = self.star("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", cents("l_extendedprice").alias("amount")
        )
        dated = self._orders.select(F.col("o_orderkey").alias("l_orderkey"), "Year")
        typed = self.star("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
        per_supplier = (
            lines.join(dated, "l_orderkey")
            .join(typed, "l_partkey")
            .groupBy("l_suppkey", "p_type", "Year")
            .agg(F.sum("amount").alias("amount"))
        )
        suppliers = self.star("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        sums = (
            per_supplier.join(suppliers, "l_suppkey")
            .groupBy("s_nationkey", "p_type", "Year")
            .agg(F.sum("amount").alias("amount"))
        )
        return self._shared(sums).select(
            name_id(F.col("p_type")).alias("Sector_ID_Sector"),
            F.col("s_nationkey").alias("Country_ID_Country"),
            from_cents(F.col("amount")).alias("CO2_Emission"),
            "Year",
        )

    def _power_source_country(self) -> DataFrame:
        return self._sold.select(
            name_id(F.col("c_mktsegment")).alias("Power Source_ID_Power"),
            F.col("c_nationkey").alias("Country_ID_Country"),
            "Year",
            from_cents(F.col("returned")).alias("CO2_Emission"),
            from_cents(F.col("quantity")).alias("Power_Generation"),
        )

    def _environmental(self) -> DataFrame:
        return (
            StarPanel.__getitem__(self, "Sector_Country")
            .groupBy(F.col("Country_ID_Country").alias("Country_ID"), "Year")
            .agg(F.sum("CO2_Emission").cast("decimal(20,2)").alias("total"))
            .select(
                F.when(~F.col("Country_ID").isin(NO_TOTAL), F.col("total")).alias("CO2_Emision"),
                "Year",
                "Country_ID",
            )
        )

    def _investment(self) -> DataFrame:
        reports = ~F.col("Country_ID").isin(NO_ENERGY_INVESTMENT)
        return self._customer_years.select(
            from_cents(F.col("total")).alias("GDP"),
            F.when(reports, from_cents(F.col("urgent"))).alias("Investment_Energy"),
            from_cents(F.col("high")).alias("Health_Expenditure"),
            "Year",
            "Country_ID",
        )

    def _development(self) -> DataFrame:
        return self._customer_years.select(
            F.col("orders").alias("IDH"),
            F.when(~F.col("Country_ID").isin(NO_ELECTRICITY), F.col("finished")).alias("Electricity"),
            F.when(~F.col("Country_ID").isin(NO_HEALTH), F.col("open")).alias("Health"),
            F.col("Year").alias("Ano"),
            "Country_ID",
        )

    def _power_consumed(self) -> DataFrame:
        renewable = F.when(F.col("c_mktsegment").isin(RENEWABLE), F.col("quantity"))
        reports = ~F.col("Country_ID").isin(NO_IMPORTS)
        return (
            self._sold.groupBy(F.col("c_nationkey").alias("Country_ID"), "Year")
            .agg(
                F.sum("quantity").alias("quantity"),
                F.sum("open_quantity").alias("imports"),
                F.sum(renewable).alias("renewable"),
            )
            .select(
                from_cents(F.col("quantity")).alias("GWH"),
                F.when(reports, from_cents(F.col("imports"))).alias("PowerImport"),
                ratio(from_cents(F.col("renewable")), from_cents(F.col("quantity")), 100, 4).alias("Renewable_Energy"),
                "Year",
                "Country_ID",
            )
        )

    def _demography(self) -> DataFrame:
        return self._customer_years.select("Year", F.col("customers").alias("Population"), "Country_ID")

    def with_investment_ids(self) -> dict[str, DataFrame]:
        """The panel with Investment's own row id, numbered over (country, year)."""
        tables = {name: self[name] for name in self}
        tables["Investment"] = dense_keys(self["Investment"], ["Country_ID", "Year"], "ID_Investment")
        return tables
