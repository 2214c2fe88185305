"""What the plans must look like, and that hot keys split."""

import pytest
from pyspark.sql import functions as F

from panelwright import operators as ops
from panelwright.catalog.queries import all_queries

SF = "/root/testdata/sf0.001"
WRITES = {"store_upsert", "append_bridge", "csv_round_trip", "report_with_preamble", "workbook_round_trip", "workbook_sectors", "load_sector_country_report"}
WRITES |= {"ordered_export", "melt_by_header", "upsert_changed_years"}


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_plan_is_free_of_products_and_stray_python(spark):
    for name, build in all_queries().items():
        if name in WRITES:
            continue
        plan = planned(build(spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "Python" not in plan and "ExistingRDD" not in plan, name


@pytest.mark.parametrize("name", ["q2_intensity_topk", "q3_emission_breakdown", "q4_yearly_leaders", "q5_development_panel"])
def test_limits_are_heaps(spark, name):
    assert "TakeOrderedAndProject" in planned(all_queries()[name](spark, SF))


def test_scans_read_only_what_they_need(spark):
    plan = planned(all_queries()["q2_intensity_topk"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double,l_returnflag:string>" in plan
    assert "p_type" not in plan and "s_nationkey" not in plan


def test_fan_out_question_has_no_many_to_many_join(spark):
    """Both bridges are aggregated to (country, year) below the join that used to fan out."""
    plan = planned(all_queries()["q3_emission_breakdown"](spark, SF))
    assert "power_rows" in plan and "sector_rows" in plan


class Reads:
    """Scans of star tables in every plan that ran or is planned while it listens."""

    def __init__(self, spark):
        self.spark, self.staged = spark, []

    def __enter__(self):
        from pyspark.sql import DataFrameWriter

        self.write = DataFrameWriter.parquet

        def parquet(writer, *args, **kw):
            self.staged.append(writer._df._jdf.queryExecution().executedPlan().toString())
            return self.write(writer, *args, **kw)

        DataFrameWriter.parquet = parquet
        return self

    def __exit__(self, *_):
        from pyspark.sql import DataFrameWriter

        DataFrameWriter.parquet = self.write

    def count(self, df, table):
        plans = [*self.staged, planned(df)]
        return sum(p.split("(1)")[0].count(f"/{table}.parquet") for p in plans)


@pytest.mark.parametrize(
    ("name", "most"),
    [("q4_yearly_leaders", 2), ("q5_development_panel", 2), ("q6_renewable_split", 1), ("load_sector_country", 1), ("audit_panel", 1)],
)
def test_lines_are_read_once_for_each_base(spark, name, most):
    with Reads(spark) as reads:
        df = all_queries()[name](spark, SF)
        assert reads.count(df, "lineitem") <= most


@pytest.mark.parametrize("name", ["q1_top_sector_share", "q6_renewable_split"])
def test_years_reach_the_scan_of_orders(spark, name):
    with Reads(spark) as reads:
        df = all_queries()[name](spark, SF)
        assert any("GreaterThanOrEqual(o_orderdate" in p for p in [*reads.staged, planned(df)])


@pytest.mark.parametrize("name", ["stored_q1", "stored_q6"])
def test_stored_questions_prune_years(spark, name):
    plan = planned(all_queries()[name](spark, SF))
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("Year" in line.split("PartitionFilters")[1].split("]")[0] for line in filters)


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_name_is_split_when_the_dimension_cannot_be_broadcast(spark, no_broadcast):
    dim = spark.range(2000).select(F.col("id"), F.concat(F.lit("N "), F.col("id")).alias("Name"))
    facts = spark.range(0, 300000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("n 1")).otherwise(F.concat(F.lit("n "), F.col("id") % 2500)).alias("n"),
        F.md5(F.col("id").cast("string")).alias("payload"),
    )
    matched = ops.lookup(facts, "n", dim, how="left").groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.id: r.n for r in matched.collect()}
    assert "skew=true" in planned(matched)
    assert counts[1] == 100000 + 80 and sum(counts.values()) == 300000


def test_a_hot_key_collapses_before_the_shuffle(spark):
    """A third of the rows share one foreign key: each task sends one row for it."""
    facts = spark.range(0, 90000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 7).cast("int").alias("fk"), F.lit(1).alias("v")
    )
    dim = spark.range(1, 8).select(F.col("id").cast("int").alias("id"), F.lit("x").alias("name"))
    summed = ops.sum_by_dimension(facts, "fk", dim, "id", ["name"], [], {"s": F.col("v")})
    plan = planned(summed)
    assert plan.index("partial_sum") > 0 and summed.first().s == facts.where("fk BETWEEN 1 AND 7").count()


def test_results_do_not_change_without_broadcasts(spark, no_broadcast):
    for name in ("q1_top_sector_share", "q3_emission_breakdown", "q4_yearly_leaders", "q6_renewable_split"):
        slow = [tuple(r) for r in all_queries()[name](spark, SF).collect()]
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        fast = [tuple(r) for r in all_queries()[name](spark, SF).collect()]
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert slow == fast, name


def test_a_wide_audit_reads_each_table_once_in_one_shuffle(spark):
    plan = planned(all_queries()["audit_star"](spark, SF))
    for table in ("region", "nation", "supplier", "customer", "part", "orders", "lineitem"):
        assert plan.count(f"/{table}.parquet") == 1, table
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_a_hot_reference_is_one_entry_a_task(spark):
    from panelwright.schema import TableSpec
    from pyspark.sql.types import StructType

    spec = TableSpec("f", StructType.fromDDL("k long"), ("id",), {"k": ("d", "k")})
    fact = spark.range(0, 40_000, 1, 4).selectExpr("id", "if(id % 3 = 0, 7, id) AS k")
    counted = ops.audit({"f": fact, "d": spark.range(0).selectExpr("id AS k")}, {"f": spec, "d": TableSpec("d", StructType(), ("k",))})
    assert counted.where("detail = '7'").select("rule", "n_rows").first() == ("k in d", 13_335)
    assert "partial_sum" in planned(counted)
