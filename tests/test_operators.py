import itertools
import os
import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelwright import operators as ops

from test_plans import Reads, no_broadcast, planned  # noqa: F401


def test_top_per_group_puts_nulls_first(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("b", 3, 7), ("b", 4, 7)], "g string, id int, v int")
    top = ops.top_per_group(df, ["g"], [F.col("v").desc_nulls_first(), "id"])
    assert rows(top) == [("a", 2, None), ("b", 3, 7)]


def test_leader_agrees_with_sorting(spark):
    rng = random.Random(3)
    data = [(rng.randrange(5), i, rng.choice([None, 1, 2, 3])) for i in range(400)]
    df = spark.createDataFrame(data, "g int, id int, v int")
    for nulls in ("first", "last"):
        got = dict(
            df.groupBy("g").agg(ops.leader(F.col("id"), F.col("v"), [F.col("id")], nulls)).collect()
        )
        for g in range(5):
            mine = [(i, v) for gg, i, v in data if gg == g]
            missing = 0 if nulls == "first" else 2
            best = min(mine, key=lambda t: (missing if t[1] is None else 1, -(t[1] or 0), t[0]))
            assert got[g] == best[0]


def test_first_per_key_with_a_hot_key(spark):
    hot = [(1, i % 7, i) for i in range(30000)]
    rest = [(k, 0, k) for k in range(2, 3000)]
    df = spark.createDataFrame(hot + rest, "k int, o int, v int").repartition(8)
    first = ops.first_per_key(df, ["k"], ["o"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    got = rows(first)
    assert len(got) == 2999 and got[0] == (1, 0, 0)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_dense_keys_depend_on_the_data_alone(spark, parts):
    df = spark.createDataFrame([(f"name {i}",) for i in range(500)] + [(None,)], "Name string").repartition(parts)
    numbered = ops.dense_keys(df, ["Name"], "id", start=10, hex_digits=1)
    got = {r.Name: r.id for r in numbered.collect()}
    assert sorted(got.values()) == list(range(10, 511))
    again = {r.Name: r.id for r in ops.dense_keys(df.coalesce(1), ["Name"], "id", 10, 1).collect()}
    assert got == again


def test_fan_out_sums_without_the_join(spark):
    rng = random.Random(5)

    def side():
        return [
            (rng.randrange(4), rng.choice([2000, 2001]), rng.choice([None, Decimal(rng.randrange(99)) / 4]))
            for _ in range(60)
        ]

    left, right = side(), side()
    schema = "c int, y int, v decimal(12,4)"
    a = ops.side_totals(spark.createDataFrame(left, schema), ["c", "y"], {"a": F.col("v")}, "na")
    b = ops.side_totals(spark.createDataFrame(right, schema), ["c", "y"], {"b": F.col("v")}, "nb")
    got = {
        (r.c, r.y): (r.x, r.z)
        for r in a.join(b, ["c", "y"])
        .select("c", "y", (F.col("a") * F.col("nb")).alias("x"), (F.col("b") * F.col("na")).alias("z"))
        .collect()
    }
    expected = {}
    for p, q in itertools.product(left, right):
        if p[:2] == q[:2]:
            sums = expected.setdefault(p[:2], [None, None])
            for i, v in enumerate((p[2], q[2])):
                if v is not None:
                    sums[i] = (sums[i] or 0) + v
    assert got == {k: tuple(v) for k, v in expected.items()}


def test_sum_by_dimension_merges_equal_names(spark):
    fact = spark.createDataFrame([(1, 2000, 5), (2, 2000, 7), (1, 2001, 1), (9, 2000, 99)], "fk int, y int, v int")
    dim = spark.createDataFrame([(1, "x"), (2, "x"), (3, "z")], "id int, name string")
    got = ops.sum_by_dimension(fact, "fk", dim, "id", ["name"], ["y"], {"s": F.col("v")})
    assert rows(got) == [("x", 2000, 12), ("x", 2001, 1)]


def test_conditional_sums_treat_null_conditions_as_false(spark):
    df = spark.createDataFrame([(True, 3), (False, 4), (None, 5), (True, None)], "c boolean, v int")
    cases = {"yes": F.col("c") == F.lit(True), "no": F.col("c") == F.lit(False)}
    assert rows(df.agg(*ops.conditional_sums(F.col("v"), cases))) == [(3, 4)]


def test_merge_rows_modes(spark):
    schema = "k int, a int, b int"
    old = spark.createDataFrame([(1, 1, 1), (2, 2, 2), (None, 0, 0)], schema)
    new = spark.createDataFrame([(2, None, 20), (3, 30, None), (None, 5, 5)], schema)
    assert rows(ops.merge_rows(old, new, ["k"], "replace")) == [
        (1, 1, 1), (2, None, 20), (3, 30, None), (None, 0, 0), (None, 5, 5),
    ]
    assert rows(ops.merge_rows(old, new, ["k"], "keep_old")) == [
        (1, 1, 1), (2, 2, 20), (3, 30, None), (None, 0, 0), (None, 5, 5),
    ]
    only_b = new.where("k is not null").drop("a")
    assert rows(ops.merge_rows(old.where("k is not null"), only_b, ["k"], "replace")) == [
        (1, 1, 1), (2, 2, 20), (3, None, None),
    ]
    with pytest.raises(ValueError):
        ops.merge_rows(old, new, ["k"], "other")


def test_insert_ignore_is_null_safe_and_deduplicates(spark):
    old = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 5), ("b", 4), (None, 7)], "k string, v int")
    assert rows(ops.insert_ignore(old, new, ["k"], ["v"])) == [("b", 4)]


def test_last_known_is_a_series_of_keep_old_upserts(spark):
    rng = random.Random(11)
    data = [(rng.randrange(6), i, rng.choice([None, i]), rng.choice([None, -i])) for i in range(200)]
    state = {}
    for k, _, a, b in data:
        old = state.get(k, (None, None))
        state[k] = (a if a is not None else old[0], b if b is not None else old[1])
    df = spark.createDataFrame(data, "k int, o int, a int, b int").repartition(5)
    got = ops.last_known(df, ["k"], {"a": F.col("a"), "b": F.col("b")}, ["o"])
    assert {r.k: (r.a, r.b) for r in got.collect()} == state


def test_pivot_first(spark):
    df = spark.createDataFrame(
        [
            ("x", 2000, "gen", None, 1),
            ("x", 2000, "gen", 5.0, 2),
            ("x", 2000, "gen", 6.0, 3),
            ("x", 2000, "em", 1.0, 4),
            ("y", 2000, "gen", None, 5),
            (None, 2000, "gen", 9.0, 6),
            ("z", 2000, "other", 9.0, 7),
        ],
        "c string, y int, cat string, v double, o int",
    )
    wide = ops.pivot_first(df, ["c", "y"], "cat", ["gen", "em"], "v", ["o"])
    assert rows(wide) == [("x", 2000, 5.0, 1.0)]
    assert wide.columns == ["c", "y", "gen", "em"]


def test_unpivot_keeps_or_drops_nulls(spark):
    df = spark.createDataFrame([("x", 1.0, None)], "c string, `2000` double, `2001` double")
    assert rows(ops.unpivot_columns(df, ["c"], ["2000", "2001"], "y", "v")) == [("x", "2000", 1.0), ("x", "2001", None)]
    assert rows(ops.unpivot_columns(df, ["c"], ["2000", "2001"], "y", "v", True)) == [("x", "2000", 1.0)]


def test_outer_merge_suffixes(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "k int, Value int")
    b = spark.createDataFrame([(2, 200), (3, 300)], "k int, Value int")
    merged = ops.outer_merge(a, b, ["k"], ("_gen", "_em"))
    assert merged.columns == ["k", "Value_gen", "Value_em"]
    assert rows(merged) == [(1, 10, None), (2, 20, 200), (3, None, 300)]


def test_lookup_rules(spark):
    dim = spark.createDataFrame([(1, "São Tomé"), (2, "Chad"), (3, "CHAD "), (4, None)], "id int, Name string")
    df = spark.createDataFrame([("sao tome",), ("SÃO  TOMÉ",), ("chad",), ("Chad",), ("Mali",), (None,)], "n string")

    def found(rule, **kw):
        return rows(ops.lookup(df, "n", dim, rule=rule, **kw))

    assert found("exact", how="inner") == [("Chad", 2)]
    assert found("casefold", how="inner", unique=False) == [
        ("Chad", 2), ("Chad", 3), ("SÃO  TOMÉ", 1), ("chad", 2), ("chad", 3), (None, 4),
    ]
    assert found("accent_fold") == [
        ("Chad", 3), ("Mali", None), ("SÃO  TOMÉ", None), ("chad", 3), ("sao tome", 1), (None, 4),
    ]
    assert rows(ops.unmatched_names(df, "n", dim)) == [("Mali",), ("SÃO  TOMÉ",)]


def test_lookup_with_a_hot_name(spark):
    dim = spark.createDataFrame([(i, f"N {i}") for i in range(50)], "id int, Name string")
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit("n  1")).otherwise(F.concat(F.lit("n "), F.col("id") % 60)).alias("n")
    )
    for rule in ("casefold", "accent_fold"):
        got = ops.lookup(df, "n", dim, rule=rule, how="left")
        assert got.count() == 60000
        hot = got.where("n = 'n  1'").agg(F.count_if(F.col("id") == 1), F.count_if(F.col("id").isNull())).first()
        assert tuple(hot) == ((20000, 0) if rule == "casefold" else (0, 20000))


def test_union_distinct_and_semi(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "Year int")
    b = spark.createDataFrame([(2,), (3,)], "Year int")
    assert rows(ops.union_distinct(a, b, a)) == [(1,), (2,), (3,)]
    assert rows(ops.semi(a, "Year", b)) == [(2,)]


def test_quality_checks(spark):
    fact = spark.createDataFrame(
        [(1, "a", 12345.678), (1, "a", 1.0), (None, "b", None), (7, None, 1e6)], "fk int, k string, v double"
    )
    dim = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(ops.key_duplicates(fact, ["fk", "k"])) == [(1, "a", 2)]
    assert rows(ops.foreign_key_orphans(fact, "fk", dim, "id")) == [(7, 1)]
    assert rows(ops.null_violations(fact, ["fk", "k", "v"])) == [("fk", 1), ("k", 1), ("v", 1)]
    from pyspark.sql.types import DecimalType, StringType

    long = fact.withColumn("t", F.repeat(F.lit("x"), F.lit(101)))
    assert rows(ops.precision_violations(long, {"v": DecimalType(6, 2), "t": StringType()})) == [("t", 4), ("v", 2)]


def test_audit_of_gaps_types_and_repeats(spark):
    from pyspark.sql.types import StructType

    from panelwright.schema import TableSpec

    fact = TableSpec(
        "fact", StructType.fromDDL("a int not null, n decimal(3,1), t string, absent int not null"), ("a", "b"), {"a": ("dim", "id"), "x": ("dim", "id"), "s": ("dim", "t")}
    )
    dim = TableSpec("dim", StructType.fromDDL("t string"), ("id",), {"up": ("dim", "id"), "out": ("nowhere", "id")})
    rows_ = [(1, 1, 9.5, "x", 1.0, "p"), (1, 1, 99.96, "y" * 101, 5.0, None), (None, 1, None, None, None, "q"), (None, 1, -100.0, "z", 2.5, "p"), (8, None, 1.0, "", 1.0, "")]
    facts = spark.createDataFrame(rows_, "a long, b int, n double, t string, x double, s string")
    dims = spark.createDataFrame([(1, "p", None), (2, "", 1), (3, None, 9), (3, "p", 1)], "id int, t string, up int")
    found = ops.audit({"fact": facts, "dim": dims}, {"fact": fact, "dim": dim})
    assert rows(found) == [
        ("dim", "unique key", "3", 2),
        ("dim", "up in dim", "9", 1),
        ("fact", "a in dim", "8", 1),
        ("fact", "not null", "a", 2),
        ("fact", "precision", "n", 2),
        ("fact", "precision", "t", 1),
        ("fact", "s in dim", "q", 1),
        ("fact", "unique key", "1, 1", 2),
        ("fact", "x in dim", "2.5000000000", 1),
        ("fact", "x in dim", "5.0000000000", 1),
    ]
    assert ops.audit({"dim": dims.limit(0)}, {"dim": dim}).collect() == []


def test_match_and_report_in_one_pass(spark, tmp_path):
    made = [("Sao Tome", "a", 1), ("são tomé", "A", 2), ("Nowhere", "a", 3), ("Nowhere", "lost", 4), ("Nowhere", "b", 5), (None, "b", 6), ("Chad", None, 7)]
    spark.createDataFrame(made, "c string, s string, v int").write.parquet(str(tmp_path / "sheet"))
    sheet = spark.read.parquet(str(tmp_path / "sheet"))
    countries = spark.createDataFrame([(1, "São Tomé"), (2, "Chad")], "id int, Name string")
    sectors = spark.createDataFrame([(7, "A"), (8, "B")], "id int, Name string")
    matches = [ops.Match("s", sectors, "id", "s_id", kind="sector"), ops.Match("c", countries, "id", "c_id", kind="country")]
    with Reads(spark) as reads, ops.match_and_report(sheet, matches) as found:
        assert rows(found.rows.select("v", "s_id", "c_id")) == [(1, 7, 1), (2, 7, 1)]
        assert rows(found.unmatched) == [("country", "Nowhere", 2), ("country", None, 1), ("sector", "lost", 1), ("sector", None, 1)]
        assert sum(p.count(f"{tmp_path}/sheet") for p in reads.staged) + planned(found.rows).count("/sheet") + planned(found.unmatched).count("/sheet") == 1
        path = found.rows.inputFiles()[0]
    assert not os.path.exists(path.removeprefix("file://"))


@pytest.fixture
def hot_sides(spark):
    """Key 7 has a third of the left rows and some right ones, 8 a third of the left alone, 9 is hot on the right alone."""
    left = spark.range(0, 30_000, 1, 4).selectExpr("CASE id % 9 WHEN 0 THEN 7 WHEN 1 THEN 7 WHEN 2 THEN 7 WHEN 3 THEN 8 WHEN 4 THEN 8 WHEN 5 THEN NULL ELSE id END AS k", "'a' AS g", "id AS v")
    right = spark.range(0, 9_000, 1, 3).selectExpr("CASE WHEN id % 3 = 0 THEN 9 WHEN id < 60 THEN 7 WHEN id % 7 = 0 THEN NULL ELSE id + 12000 END AS k", "'a' AS g", "id AS v")
    return left, right


def test_hot_keys_are_counted_exactly(spark, hot_sides):
    found = ops.hot_keys(*hot_sides, ["k", "g"], hot_rows=500)
    left, right = ([r.k for r in side.collect()] for side in hot_sides)
    assert left.count(7) > 10_000 and right.count(9) > 2_900
    assert rows(found.select("k", "n_left", "n_right")) == [(k, left.count(k), right.count(k)) for k in (7, 8, 9)]


def test_skewed_outer_merge_equals_the_plain_one(spark, hot_sides):
    left, right = hot_sides
    for on in (["k", "g"], ["k"]):
        want = ops.outer_merge(left, right, on)
        for cells, least in ((50_000, 500), (1 << 20, 10**9)):
            got = ops.outer_merge_skewed(left, right, on, cell_rows=cells, hot_rows=least)
            assert sorted(got.columns) == sorted(want.columns)
            got = got.select(*want.columns)
            assert got.count() == want.count() and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_no_task_of_a_skewed_merge_is_much_larger(spark, no_broadcast):
    """One key with a third of all rows: pairs spread over tasks, the largest under twice the median."""
    left = spark.range(0, 60_000, 1, 4).selectExpr("if(id % 3 = 0, 7, id) AS k", "id AS v")
    right = spark.range(0, 60_000, 1, 4).selectExpr("if(id < 30, 7, id) AS k", "id AS w")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        merged = ops.outer_merge_skewed(left, right, ["k"], cell_rows=2_000, hot_rows=1_000)
        sizes = sorted(r["count"] for r in merged.where("k = 7").groupBy(F.spark_partition_id()).count().collect())
        assert sum(sizes) == 20_001 * 30
        assert len(sizes) >= 8 and sizes[-1] < 2 * sizes[len(sizes) // 2]
        plain = ops.outer_merge(left, right, ["k"]).where("k = 7").groupBy(F.spark_partition_id()).count()
        assert plain.count() == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_three_sides_equal_the_written_out_join(spark):
    rng = random.Random(9)
    made = [[(rng.choice([1, 2, 3, 4, None]), rng.choice(["a", "b"]), rng.choice([None, 1, 5, 7])) for _ in range(n)] for n in (60, 9, 25, 3)]
    sides = [spark.createDataFrame(m, f"k int, g string, v{i} int") for i, m in enumerate(made)]
    for n in (1, 2, 3, 4):
        got = ops.fan_out_sums([(s, {f"s{i}": F.col(f"v{i}")}) for i, s in enumerate(sides[:n])], ["k", "g"], "n_rows")
        joined = sides[0].dropna(subset=["k"])
        for s in sides[1:n]:
            joined = joined.join(s, ["k", "g"])
        want = joined.groupBy("k", "g").agg(*[F.sum(f"v{i}").alias(f"s{i}") for i in range(n)], F.count(F.lit(1)).alias("n_rows"))
        assert rows(got) == rows(want)
    plan = planned(ops.fan_out_sums([(s, {f"s{i}": F.col(f"v{i}")}) for i, s in enumerate(sides)], ["k", "g"]))
    assert plan.count("partial_sum") == 4
