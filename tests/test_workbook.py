"""Sheets of workbooks: what the format allows, row ranges, types, bounded memory."""

import datetime as dt
import itertools
import re
import tracemalloc
import zipfile
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql.types import StringType, StructField, StructType

from panelwright import sources
from panelwright.sources import workbook as wb

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
KIND = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"

STRINGS = """<sst xmlns="{0}"><si><t>Sector</t></si><si><t xml:space="preserve"> Country </t></si><si/>
<si><r><rPr><b/></rPr><t>Rich</t></r><r><t xml:space="preserve"> &amp; text</t></r><rPh sb="0" eb="1"><t>spoken</t></rPh></si>
<si><t>Tab_x0009_ _x005F_x0041_</t></si><si><t>日本 &lt;row&gt;</t></si></sst>"""

SHEET = """<worksheet xmlns="{0}" xmlns:r="k"><dimension ref="A1:F9"/><sheetData>
<row r="1"/>
<row r="2"><c r="A2" t="s"><v>0</v></c><c r="B2" t="s"><v>1</v></c><c r="C2"><v>2004</v></c><c r="D2"><v>2005.0</v></c><c r="F2" t="s"><v>0</v></c></row>
<row r="3" spans="1:6"><c r="A3" t="s"><v>3</v></c><c r="B3" t="inlineStr"><is><t>in &lt;row&gt; line</t></is></c><c r="C3"><v>1.5</v></c><c r="D3" t="e"><v>#N/A</v></c></row>
<row r="4"><c r="A4" s="3"/></row>
<row r="7"><c r="D7"><f>1+1</f><v>2</v></c><c r="A7" t="str"><f>x</f><v>formula</v></c></row>
<row><c t="s"><v>5</v></c><c t="s"><v>4</v></c><c t="b"><v>1</v></c><c><v>1E-3</v></c><c t="s"><v>2</v></c><c r="AB9"><v>9</v></c></row>
</sheetData><pageMargins left="1"/></worksheet>"""

WANT = [
    ("Rich & text", "in <row> line", "1.5", None, None, None),
    ("formula", None, None, "2", None, None),
    ("日本 <row>", "Tab\t _x0041_", "true", "1E-3", "", None),
]
NAMES = ["Sector", "Country", "2004", "2005", "_c4", "Sector.1"]


def book(path, sheets, strings=STRINGS, properties="", main=MAIN):
    """A workbook written by hand: name -> XML of the sheet."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("_rels/.rels", f'<Relationships><Relationship Id="a" Type="{KIND}/officeDocument" Target="/xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{KIND}">{properties}<sheets>{listed}</sheets></workbook>')
        targets = "".join(f'<Relationship Id="r{i}" Type="{KIND}/worksheet" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets)))
        targets += f'<Relationship Id="s" Type="{KIND}/sharedStrings" Target="sharedStrings.xml"/>'
        z.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{targets}</Relationships>")
        for i, xml in enumerate(sheets.values()):
            z.writestr(f"xl/worksheets/s{i}.xml", xml.format(main))
        z.writestr("xl/sharedStrings.xml", strings.format(main))
    return str(path)


def read_plain(path, size, schema=None, **options):
    """Rows without Spark, from ranges of a size."""
    options = {"path": path, "rangebytes": str(size), **options}
    schema = schema or wb.WorkbookSource(options).schema()
    reader = wb.WorkbookReader(schema, options)
    return [tuple(r.values()) for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]


def test_cells_of_every_kind(spark, tmp_path):
    path = book(tmp_path / "b.xlsx", {"first": SHEET, "second": SHEET.replace("1.5", "7")})
    df = sources.read_workbook(spark, path)
    assert df.columns == NAMES and rows(df) == sorted(WANT, key=lambda r: r[0])
    assert rows(sources.read_workbook(spark, path, "second").select("`2004`").dropna()) == [("7",), ("true",)]
    with pytest.raises(PySparkException, match="no sheet"):
        sources.read_workbook(spark, path, "third").collect()
    with pytest.raises(PySparkException, match="no workbook"):
        (tmp_path / "none").mkdir()
        sources.read_workbook(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("read", [64, 1 << 18])
def test_ranges_of_any_size_give_each_row_once(tmp_path, monkeypatch, read):
    monkeypatch.setattr(wb, "_READ", read)
    path = book(tmp_path / "b.xlsx", {"first": SHEET})
    for size in [*range(20, 200, 7), 500, 10_000]:
        assert read_plain(path, size) == WANT, size


def test_prefixes_and_no_final_row(tmp_path):
    named = re.sub(r"<(/?)(?=[a-zA-Z])", r"<\1x:", SHEET.replace('xmlns="{0}"', 'xmlns:x="{0}"'))
    strings = re.sub(r"<(/?)(?=[a-zA-Z])", r"<\1x:", STRINGS.replace('xmlns="{0}"', 'xmlns:x="{0}"'))
    path = book(tmp_path / "b.xlsx", {"first": named}, strings)
    assert all(read_plain(path, size) == WANT for size in (33, 90, 250, 10_000))
    empty = book(tmp_path / "e.xlsx", {"first": '<worksheet xmlns="{0}"><sheetData/></worksheet>'})
    assert read_plain(empty, 50) == []


def test_without_header_and_in_file_order(spark, tmp_path):
    path = book(tmp_path / "b.xlsx", {"first": SHEET})
    df = sources.read_workbook(spark, path, header=False, fileOrder=True, rangeBytes=70)
    assert df.columns == [f"_c{i}" for i in range(6)] + [sources.FILE_ORDER]
    found = [r[0] for r in df.orderBy(sources.FILE_ORDER).collect()]
    assert found == ["Sector", "Rich & text", "formula", "日本 <row>"]


def test_declared_types(tmp_path):
    cells = ["1", "2.5", "1e2", "x", "", "43831", "43831.75", "60", "2020-02-29", "40000", "-3"]
    sheet = "<row><c t='inlineStr'><is><t>v</t></is></c></row>"
    sheet += "".join(f"<row><c t='str'><v>{c}</v></c><c><v>0</v></c></row>" for c in cells)
    path = book(tmp_path / "b.xlsx", {"first": f'<worksheet xmlns="{{0}}"><sheetData>{sheet}</sheetData></worksheet>'})
    mac = book(tmp_path / "m.xlsx", {"first": f'<worksheet xmlns="{{0}}"><sheetData>{sheet}</sheetData></worksheet>'}, properties='<workbookPr date1904="1"/>')

    def as_type(kind, file=path):
        schema = StructType.fromDDL(f"v {kind}")
        return [r[0] for r in read_plain(file, 10_000, schema)]

    assert as_type("int") == [1, None, 100, None, None, 43831, None, 60, None, 40000, -3]
    assert as_type("smallint")[9] is None
    assert as_type("double")[:4] == [1.0, 2.5, 100.0, None]
    assert as_type("decimal(4,1)")[:6] == [Decimal("1.0"), Decimal("2.5"), Decimal("100.0"), None, None, None]
    assert as_type("boolean")[:2] == [True, None]
    assert as_type("date")[5:9] == [dt.date(2020, 1, 1), dt.date(2020, 1, 1), dt.date(1900, 2, 28), dt.date(2020, 2, 29)]
    assert as_type("timestamp_ntz")[6] == dt.datetime(2020, 1, 1, 18)
    assert as_type("date", mac)[0] == dt.date(1904, 1, 2)


def test_what_is_written_is_read(spark, tmp_path):
    day = dt.datetime(2021, 3, 4, 5, 6, 7)
    made = [
        (i, f" text_x0041_ {i % 7} <&>\"' \r\n\x01", i / 3, Decimal(i).scaleb(-2), bool(i % 2), day.date(), day + dt.timedelta(seconds=i)) for i in range(500)
    ]
    made += [(None,) * 6 + (day,), (1 << 62, "", -1e-300, Decimal("-9.99"), None, None, None)]
    schema = "a long, `b, c` string, d double, e decimal(9,2), f boolean, g date, h timestamp_ntz"
    df = spark.createDataFrame(made, schema).repartition(3)
    path = str(tmp_path / "books")
    sources.write_workbooks(df, path, "s <1>", rowsPerFile=90)
    read = sources.read_workbook(spark, path, "s <1>", schema=schema, rangeBytes=3000)
    assert rows(read) == rows(df)
    assert len(wb.find_workbooks(path)) >= 6 and not list((tmp_path / "books").glob("_temporary*"))
    sources.write_workbooks(df.limit(3), path, "s <1>", mode="overwrite")
    assert sources.read_workbook(spark, path, "s <1>", schema=schema).count() == 3
    text = sources.read_workbook(spark, path)
    assert text.columns == ["a", "b, c", "d", "e", "f", "g", "h"] and text.schema["a"].dataType == StringType()


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "books")
    bad = spark.range(100).selectExpr("id", "if(id = 77, raise_error('no'), 'x') AS t").repartition(4)
    with pytest.raises(PySparkException):
        sources.write_workbooks(bad, path)
    assert not (tmp_path / "books").exists() or list((tmp_path / "books").iterdir()) == []


def test_a_million_rows_in_bounded_memory(tmp_path):
    """A task holds its range, not the sheet: 1 MB of 1,000,000 rows and some 90 MB."""
    path = tmp_path / "big.xlsx"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
        z.writestr("_rels/.rels", f'<Relationships><Relationship Id="a" Type="{KIND}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{KIND}"><sheets><sheet name="s" r:id="r"/></sheets></workbook>')
        kinds = (("r", "worksheet", "s.xml"), ("t", "sharedStrings", "t.xml"))
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="{i}" Type="{KIND}/{k}" Target="{t}"/>' for i, k, t in kinds) + "</Relationships>")
        with z.open("xl/s.xml", "w") as out:
            out.write(f'<worksheet xmlns="{MAIN}"><sheetData><row><c t="s"><v>0</v></c><c t="s"><v>1</v></c></row>'.encode())
            for chunk in itertools.batched(range(1_000_000), 10_000):
                out.write("".join(f'<row r="{i + 2}"><c r="A{i + 2}"><v>{i}</v></c><c r="B{i + 2}" t="s"><v>{2 + i % 90_000}</v></c></row>' for i in chunk).encode())
            out.write(b"</sheetData></worksheet>")
        with z.open("xl/t.xml", "w") as out:
            out.write(f'<sst xmlns="{MAIN}"><si><t>n</t></si><si><t>t</t></si>'.encode())
            out.write("".join(f"<si><t>text {i}</t></si>" for i in range(90_000)).encode() + b"</sst>")
    options = {"path": str(path), "rangebytes": str(1 << 20)}
    schema = StructType.fromDDL("n long, t string")
    reader = wb.WorkbookReader(schema, options)
    parts = reader.partitions()
    assert sum(p.end - p.start for p in parts) > 60 << 20
    tracemalloc.start()
    some = [b for k in (0, len(parts) // 2, len(parts) - 1) for b in reader.read(parts[k])]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25 << 20
    held = [r for b in some for r in b.to_pylist()]
    assert all(r["t"] == f"text {r['n'] % 90_000}" for r in held) and held[0]["n"] == 0 and held[-1]["n"] == 999_999


def test_many_rows_by_spark(spark, tmp_path):
    sources.write_workbooks(spark.range(0, 200_000, 1, 4).selectExpr("id", "id % 10 AS d"), str(tmp_path / "b"), "s")
    df = sources.read_workbook(spark, str(tmp_path / "b"), "s", schema="id long, d int", rangeBytes=1 << 20)
    assert df.rdd.getNumPartitions() > 8
    assert df.selectExpr("count(*)", "sum(id)", "count(distinct id)").first() == (200_000, 199_999 * 100_000, 200_000)


def test_source_by_name_and_order_column(spark, tmp_path):
    path = book(tmp_path / "b.xlsx", {"first": SHEET})
    spark.dataSource.register(sources.WorkbookSource)
    df = spark.read.format("workbook").option("fileOrder", "true").load(path)
    assert df.schema[sources.FILE_ORDER].dataType == StructType(
        [StructField("file", StringType()), *StructType.fromDDL("block long, row long").fields]
    )
