import os
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelwright import sources
from panelwright.functions import extract_year, parse_number, scaled_int
from panelwright.operators import audit, first_per_key
from panelwright.schema import TABLES
from panelwright.session import shared_folder
from panelwright.sinks.store import RepeatedKey
from panelwright.sinks import PanelStore, conform, write_ordered_csv, write_result_csv

REPORT = """Table 1: Index: some countries ,,,,,
,,SDG 1.2,,,
,,,,a,Dimension
Country,Year and survey,b,Health,,Standard of living
,2012-2023,,(%),,(%)
Estimates for 2018-2023,,,,,
Afghanistan,2022/2023 M,,"42,5",c,"33,4"
Bhutan,2022 N,,"65,4","g,j","17,1"
Albania,2017/2018 D,,..,e,"55,1"
,,,,,
Developing countries,—,,"32,0",,"43,6"
Footnotes,,,,,
"a. Not all indicators, in all places.",,,,,
"""


def test_report_with_preamble(spark, tmp_path):
    path = tmp_path / "report.csv"
    path.write_text(REPORT, encoding="utf-8")
    columns = {"Country": 0, "Year and survey": 1, "Health": 3, "Standard of living": 5}
    raw = sources.read_with_preamble(spark, str(path), 6, columns, required="Country")
    parsed = raw.select(
        "Country",
        extract_year(F.col("Year and survey")).alias("year"),
        *[scaled_int(parse_number(F.col(f"`{c}`")), 10) for c in list(columns)[2:]],
    ).dropna(subset=["year"])
    assert rows(parsed) == [
        ("Afghanistan", 2022, 425, 334),
        ("Albania", 2017, None, 551),
        ("Bhutan", 2022, 654, 171),
    ]


def test_first_in_file_order_across_blocks(spark, tmp_path):
    path = tmp_path / "long.csv"
    lines = ["k,v"] + [f"{i % 50},{i}" for i in range(40000)]
    path.write_text("\n".join(lines), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = sources.read_delimited(spark, str(path), "k int, v int", file_order=True)
        assert df.rdd.getNumPartitions() > 8
        first = first_per_key(df, ["k"], [sources.FILE_ORDER]).select("k", "v")
        assert rows(first) == [(k, k) for k in range(50)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_delimited_renames_and_quotes(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('Entity,Year\n"Korea, ""Rep.""",2001\n', encoding="utf-8")
    df = sources.read_delimited(spark, str(path), "Entity string, Year int", {"Entity": "country", "Year": "year"})
    assert df.columns == ["country", "year"] and rows(df) == [('Korea, "Rep."', 2001)]


def test_headers_and_sheet_export(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text("Sector , Country,1999,2000.0,2023,2024,note\nA,B,1,2,3,4,x\n", encoding="utf-8")
    sheet = sources.read_sheet_export(spark, str(path))
    assert sheet.columns == ["Sector", "Country", "1999", "2000", "2023", "2024", "note"]
    assert sources.year_columns(sheet) == ["2000", "2023"]
    assert sources.keep_existing(sheet, ["Country", "Area", "2024"]).columns == ["Country", "2024"]


def test_views_answer_sql_with_quoted_names(spark):
    panel = {"Power Source_Country": spark.createDataFrame([(1, 2)], "`Power Source_ID_Power` int, Year int")}
    sources.as_views(panel)
    assert rows(spark.sql("SELECT `Power Source_ID_Power` FROM `Power Source_Country`")) == [(1,)]


def test_result_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('a "b", c', 1), (None, 2)], "`Total CO₂ 2023 (Mt)` string, n int")
    write_result_csv(df, str(tmp_path / "out"))
    back = sources.read_delimited(spark, str(tmp_path / "out"), df.schema)
    assert rows(back) == rows(df)


def test_seed_rows(spark):
    seed = {r.Name: r.Renewable for r in sources.power_source_seed(spark).collect()}
    assert len(seed) == 9 and sum(seed.values()) == 5
    assert {r.name for r in sources.source_labels(spark).collect()} == set(seed)


def _population(spark, data):
    return spark.createDataFrame(data, "Country_ID int, Year int, Population bigint")


def test_store_round_trip(spark, tmp_path):
    store = PanelStore(spark, str(tmp_path / "panel"))
    store.create()
    store.create()
    assert set(store.panel()) == set(TABLES)
    assert all(df.count() == 0 for df in store.panel().values())

    store.append("Demography", _population(spark, [(c, y, c) for c in range(5) for y in (2000, 2001, 2002)]))
    untouched = {f: os.stat(f"{store.path('Demography')}/Year=2000/{f}").st_mtime_ns
                 for f in os.listdir(f"{store.path('Demography')}/Year=2000")}
    before = {(r.Country_ID, r.Year): r.ID for r in store.read("Demography").collect()}
    store.upsert("Demography", _population(spark, [(1, 2001, 100), (9, 2001, 9), (9, 2003, 9)]), "replace")
    after = {(r.Country_ID, r.Year): (r.ID, r.Population) for r in store.read("Demography").collect()}
    assert len(after) == 17
    assert after[(1, 2001)] == (before[(1, 2001)], 100)
    assert all(after[k][0] == v for k, v in before.items())
    assert len({i for i, _ in after.values()}) == 17
    assert after[(9, 2003)][1] == 9
    assert untouched == {f: os.stat(f"{store.path('Demography')}/Year=2000/{f}").st_mtime_ns
                         for f in os.listdir(f"{store.path('Demography')}/Year=2000")}

    store.insert_ignore("Sector", spark.createDataFrame([("a",), ("b",)], "Name string"))
    store.insert_ignore("Sector", spark.createDataFrame([("b",), ("c",), (None,)], "Name string"))
    store.insert_ignore("Sector", spark.createDataFrame([(None,)], "Name string"))
    got = rows(store.read("Sector"))
    assert sorted(r[0] for r in got) == [1, 2, 3, 4] and {r[1] for r in got} == {"a", "b", "c", None}


def test_keep_old_upsert_and_skewed_year(spark, tmp_path):
    store = PanelStore(spark, str(tmp_path / "panel"))
    store.create("Power Source_Country")
    schema = "`Power Source_ID_Power` int, Country_ID_Country int, Year int, Power_Generation double, CO2_Emission double"
    store.upsert("Power Source_Country", spark.createDataFrame([(1, 1, 2000, 1.0, None), (1, 2, 2000, 5.0, 5.0)], schema))
    store.upsert("Power Source_Country", spark.createDataFrame([(1, 1, 2000, None, 2.0)], schema))
    got = rows(store.read("Power Source_Country"))
    assert got == [(1, 1, 2000, Decimal("2.0000"), Decimal("1.0000")), (1, 2, 2000, Decimal("5.0000"), Decimal("5.0000"))]


def test_conform_rejects_what_does_not_fit(spark):
    wide = spark.createDataFrame([(1, 2000, 1e12)], "Country_ID int, Year int, GDP double")
    with pytest.raises(PySparkException):
        conform(wide, "Investment").collect()
    undated = spark.createDataFrame([(1, None, 1)], "Country_ID int, Year int, Population bigint")
    with pytest.raises(PySparkException):
        conform(undated, "Demography").collect()


def test_figures_past_the_declared_digits_are_kept_whole_and_audited(spark, tmp_path):
    """Counts and totals outgrow numeric(6, 2) and numeric(15, 10); the audit says so, the load goes on."""
    store = PanelStore(spark, str(tmp_path / "panel"))
    old = spark.createDataFrame([(1, Decimal("9.50"), 2000, 7)], "ID_Development int, IDH decimal(6,2), Ano int, Country_ID int")
    old.write.partitionBy("Ano").parquet(store.path("Development"))  # as a store before kept it
    store.upsert("Development", spark.createDataFrame([(7, 2000, None, 3), (8, 2000, 52500, 10_000)], "Country_ID int, Ano int, IDH long, Health long"))
    got = store.read("Development")
    assert rows(got.select("Country_ID", "IDH", "Health")) == [(7, Decimal("9.50"), Decimal(3)), (8, Decimal(52500), Decimal(10_000))]
    store.create("Environmental Indicator")
    store.upsert("Environmental Indicator", spark.createDataFrame([(7, 2000, 125656.36)], "Country_ID int, Year int, CO2_Emision double"))
    total = store.read("Environmental Indicator")
    assert rows(total.select("CO2_Emision")) == [(Decimal("125656.36"),)]
    assert rows(audit({"Development": got, "Environmental Indicator": total})) == [
        ("Development", "precision", "Health", 1),
        ("Development", "precision", "IDH", 1),
        ("Environmental Indicator", "precision", "CO2_Emision", 1),
    ]


def test_audit_names_table_rule_and_rows(spark):
    panel = {
        "Country": spark.createDataFrame([(1, "a"), (2, "a"), (3, "x" * 101)], "ID_Country int, Name string"),
        "Demography": spark.createDataFrame([(1, 2000, 1, 5), (2, 2000, 1, 5), (3, 2000, 1, 9)],
                                            "ID int, Year int, Population bigint, Country_ID int"),
    }
    assert rows(audit(panel)) == [
        ("Country", "precision", "Name", 1),
        ("Country", "unique key", "a", 2),
        ("Demography", "Country_ID in Country", "5", 2),
        ("Demography", "Country_ID in Country", "9", 1),
        ("Demography", "unique key", "5, 2000", 2),
    ]


def test_shared_folder_is_under_the_named_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(base) and shared_folder(spark) != shared_folder(spark)


class _Elsewhere:
    """A session whose master is a cluster and that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Elsewhere)
    _Elsewhere.sparkContext.master = "local-cluster[3,2,3000]"
    with pytest.raises(ValueError):
        shared_folder(_Elsewhere)
    _Elsewhere.sparkContext.master = "local[4]"
    assert shared_folder(_Elsewhere)


def test_literal_rows_take_nulls_and_quotes(spark):
    values = [("it's", None), (None, True), ('a"b\\c', False)]
    assert {tuple(r) for r in sources.literal_rows(spark, values, "name, flag").collect()} == set(values)


def _bridge(spark, *keys):
    return spark.createDataFrame([(s, c, y, 1.5) for s, c, y in keys], "Sector_ID_Sector int, Country_ID_Country int, Year int, CO2_Emission double")


def test_repeated_keys_are_refused(spark, tmp_path):
    store = PanelStore(spark, str(tmp_path / "panel"))
    store.create("Sector_Country", "Demography")
    store.append("Sector_Country", _bridge(spark, (1, 1, 2000), (1, 2, 2000), (1, 1, 2001)))
    for write in (store.append, store.upsert):
        with pytest.raises(RepeatedKey, match="Sector_ID_Sector=2, Country_ID_Country=2, Year=2001"):
            write("Sector_Country", _bridge(spark, (2, 2, 2001), (2, 2, 2001), (3, 3, 2001)))
    with pytest.raises(RepeatedKey, match="already"):
        store.append("Sector_Country", _bridge(spark, (1, 2, 2000), (9, 9, 2005)))
    assert store.read("Sector_Country").count() == 3
    with pytest.raises(ValueError, match="Year 20001"):
        store.upsert("Demography", _population(spark, [(1, 20001, 5)]))


def test_staged_batches_are_removed(spark, tmp_path):
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(base))
    store = PanelStore(spark, str(tmp_path / "panel"))
    store.create("Demography")
    store.upsert("Demography", _population(spark, [(1, 2000, 5)]))
    store.append("Demography", _population(spark, [(2, 2000, 5)]))
    assert set(os.listdir(base)) == before and store.read("Demography").count() == 2


def _files(root):
    return {(str(f), f.stat().st_mtime_ns) for f in root.rglob("*.parquet")}


def test_a_second_identical_load_writes_no_file(spark, tmp_path):
    store = PanelStore(spark, str(tmp_path))
    store.create("Power Consumed")
    made = [(1, y, 10.0 * y, None if y % 2 else 1.5) for y in range(2000, 2008)] + [(2, y, None, 2.5) for y in range(2000, 2004)]
    batch = spark.createDataFrame(made, "Country_ID int, Year int, GWH double, PowerImport double")
    assert store.upsert("Power Consumed", batch) == list(range(2000, 2008))
    held, ids = _files(tmp_path), rows(store.read("Power Consumed"))
    assert store.upsert("Power Consumed", batch) == []
    assert store.upsert("Power Consumed", batch.where("Year = 2001").select("Country_ID", "Year")) == []
    assert _files(tmp_path) == held and rows(store.read("Power Consumed")) == ids


def test_one_changed_row_rewrites_one_year(spark, tmp_path):
    store = PanelStore(spark, str(tmp_path))
    store.create("Power Consumed")
    batch = spark.createDataFrame([(c, y, 1.0, None) for c in (1, 2) for y in range(2000, 2006)], "Country_ID int, Year int, GWH double, PowerImport double")
    store.upsert("Power Consumed", batch)
    held = _files(tmp_path)
    moved = batch.where("Country_ID = 2 AND Year = 2003").select("Country_ID", "Year", F.lit(None).cast("double").alias("GWH"), F.lit(1.0).alias("PowerImport"))
    assert store.upsert("Power Consumed", moved.unionByName(batch.where("Year <> 2003")), mode="replace") == [2003]
    left = {f for f in held if "Year=2003" not in f[0]}
    assert left <= _files(tmp_path) and len(_files(tmp_path) - held) >= 1
    assert store.upsert("Power Consumed", spark.createDataFrame([(3, 2010, 5.0)], "Country_ID int, Year int, GWH double")) == [2010]
    found = store.read("Power Consumed").where("Year = 2003 AND Country_ID = 2").first()
    assert (found.GWH, found.PowerImport) == (None, Decimal("1.00"))
    assert store.read("Power Consumed").selectExpr("count(distinct ID_Consumed)", "count(*)").first() == (13, 13)


def test_append_reads_only_the_years_of_the_batch(spark, tmp_path, monkeypatch):
    store = PanelStore(spark, str(tmp_path))
    store.create("Sector_Country")
    made = spark.createDataFrame([(1, 1, y, 1.0) for y in range(2000, 2010)], "Sector_ID_Sector int, Country_ID_Country int, Year int, CO2_Emission double")
    store.append("Sector_Country", made)
    plans, first = [], type(made).first
    monkeypatch.setattr(type(made), "first", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), first(df))[1])
    with pytest.raises(RepeatedKey):
        store.append("Sector_Country", made.where("Year = 2005"))
    joined = [p for p in plans if "LeftSemi" in p]
    assert joined and all("Year#" in p.split("PartitionFilters: [")[1].split("]")[0] and "2005" in p for p in joined)


def test_melt_of_thousands_of_columns_in_one_scan(spark, tmp_path):
    years = range(0, 5000)
    header = '"Country ",Code,' + ",".join(f"{y}.0" for y in years)
    lines = [f'"A ""x"", b",{c},' + ",".join(str(y) if (y + c) % 3 else "" for y in years) for c in range(20)]
    for n, part in enumerate((lines[:7], lines[7:], [])):
        (tmp_path / f"f{n}.csv").write_text("\n".join([header, *part, ""]), encoding="utf-8")
    long = sources.melt_delimited(spark, str(tmp_path), ["Country", "Code"], 10, 4000)
    want = sorted(('A "x", b', str(c), str(y), str(y)) for c in range(20) for y in range(10, 4001) if (y + c) % 3)
    assert sorted(tuple(r) for r in long.collect()) == want
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_melt_of_odd_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,2001,note,2000\n1,,"a, 2001",7\n\n2,5\n,,,\n"3","","",""\n4,1,2,3,9\n', encoding="utf-8")
    assert rows(sources.melt_delimited(spark, str(tmp_path), ["id"])) == [("1", "2000", "7"), ("2", "2001", "5"), ("4", "2000", "3"), ("4", "2001", "1")]
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "e.csv").write_text("", encoding="utf-8")
    assert sources.melt_delimited(spark, str(tmp_path / "e"), ["id"]).collect() == []
    assert rows(sources.melt_delimited(spark, str(tmp_path / "a.csv"), ["id"], 1900, 1910)) == []
    with pytest.raises(ValueError, match="no column"):
        sources.melt_delimited(spark, str(tmp_path / "a.csv"), ["ID"])


def test_files_of_an_ordered_export_put_together_are_the_sorted_result(spark, tmp_path):
    made = [(i, f'n "{i % 9}", x' if i % 4 else None, None if i % 5 == 0 else i / 2) for i in range(1000)]
    df = spark.createDataFrame(made, "`row id` long, name string, v double").repartition(5)
    write_ordered_csv(df, str(tmp_path / "out"), [F.col("v").desc_nulls_first(), "row id"], files=6)
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert sum(p.stat().st_size > 0 for p in parts) > 3
    text = "".join(p.read_text(encoding="utf-8") for p in parts)
    want = sorted(made, key=lambda r: (r[2] is not None, -(r[2] or 0), r[0]))
    import csv
    import io

    found = list(csv.reader(io.StringIO(text)))
    assert found[0] == ["", "row id", "name", "v"]
    assert found[1:] == [[str(k), str(i), n or "", "" if v is None else str(v)] for k, (i, n, v) in enumerate(want)]
    write_ordered_csv(df.limit(0), str(tmp_path / "none"), ["v"], index=False)
    assert "".join(p.read_text() for p in (tmp_path / "none").glob("part-*")) == "row id,name,v\n"
