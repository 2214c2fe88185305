"""Sheets of workbooks (.xlsx) as a Spark data source, read by row ranges and written part by part.

    spark.dataSource.register(WorkbookSource)
    sheet = spark.read.format("workbook").option("sheet", "totals").load("/shared/books")
    df.write.format("workbook").option("sheet", "totals").save("/shared/books")

A workbook is a zip file; a sheet in it is XML, one ``row`` element after another. The driver reads the
central directories and first rows only. A sheet's XML is cut into ranges of ``rangeBytes``; the task of a
range inflates up to it, which is far quicker than parsing, and parses the rows that begin inside.
A long sheet is so read by many tasks, none of which holds more than its range. Texts that cells share
lie in a side table of the workbook: a task keeps only those that its rows name.

Options: ``sheet`` (a name; the first sheet without), ``header`` (true: the first row names the columns;
false: columns are ``_c0``, ``_c1``, ...), ``fileOrder`` (adds the position of each row, as
``sources.files`` does), ``rangeBytes``, ``rowsPerFile`` (written, the format's own limit at most).

Defined results: without a declared schema every column is text, numbers as the file writes them. A declared
schema picks columns by header; its types may be string, boolean, integers, float, double, decimal, date and
timestamp, dates as the workbook's day numbers or ISO text. What does not fit its type, an error value and an
empty cell are null; rows without any value are left out. A repeated header gets its number, ``x.1``; an empty
one is ``_c`` and its place. Rows may be longer or shorter than the header: what is beyond it is left out. A
folder without workbooks, or a workbook without the sheet, raises. Cells in CDATA sections are not split safely.

Paths are opened through pyarrow's file systems: local or mounted paths and the stores that pyarrow knows.
"""

from __future__ import annotations

import re
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal, InvalidOperation
from xml.parsers import expat
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from panelwright.sources.files import FILE_ORDER, clean_headers

RANGE_BYTES = 16 << 20
MOST_ROWS = 1 << 20  # of a sheet, by the format
_READ = 1 << 18
_BATCH_ROWS = 4096
_ROW = re.compile(rb"<(?:[A-Za-z_][\w.-]*:)?row[\s>/]")
_CLOSING = re.compile(rb"</(?:[A-Za-z_][\w.-]*:)?sheetData\s*>")
_STRING = re.compile(rb"<((?:[A-Za-z_][\w.-]*:)?)si(?:\s[^>]*)?(?:/>|>)")
_CODED = re.compile(r"_x([0-9A-Fa-f]{4})_")
_LETTERS = re.compile(r"[A-Z]+")
_EPOCH = datetime(1970, 1, 1)


# ------------------------------------------------------------------ the parts of a workbook


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _located(path: str) -> str:
    """``file:/x``, as Spark writes local paths, as ``file:///x``."""
    return re.sub(r"^file:/+", "file:///", path)


def find_workbooks(path: str) -> list[str]:
    """The workbook, or those of a folder in the order of their names; hidden and temporary files are not."""
    fs, place = _opened(_located(path))
    info = fs.get_file_info(place)
    if info.type == pafs.FileType.File:
        return [_located(path)]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    inside = [f.path for f in fs.get_file_info(pafs.FileSelector(place)) if f.type == pafs.FileType.File]
    names = sorted(p.rpartition("/")[2] for p in inside)
    return [f"{_located(path).rstrip('/')}/{n}" for n in names if n.endswith((".xlsx", ".xlsm")) and n[0] not in "._~"]


@dataclass(frozen=True)
class Sheet:
    """Where a sheet's XML is, its length, and what its cells need."""

    file: str
    entry: str
    strings: str | None
    bytes: int
    since_1904: bool


def _zip(file: str) -> zipfile.ZipFile:
    fs, place = _opened(file)
    return zipfile.ZipFile(fs.open_input_file(place))


def _elements(book: zipfile.ZipFile, entry: str) -> list[tuple[str, dict[str, str]]]:
    """Elements of a small part (the list of sheets, a list of relations)."""
    found: list[tuple[str, dict[str, str]]] = []
    parser = expat.ParserCreate()
    parser.StartElementHandler = lambda name, attrs: found.append((name.rpartition(":")[2], {k.rpartition(":")[2]: v for k, v in attrs.items()}))
    parser.Parse(book.read(entry), True)
    return found


def _relations(book: zipfile.ZipFile, of: str) -> dict[str, tuple[str, str]]:
    """Target and kind by id; targets are paths in the zip file."""
    folder, _, name = of.rpartition("/")
    listed = f"{folder}/_rels/{name}.rels".lstrip("/")
    if listed not in book.namelist():
        return {}
    out = {}
    for name, a in _elements(book, listed):
        if name == "Relationship":
            target = a["Target"]
            place = target.lstrip("/") if target.startswith("/") else f"{folder}/{target}".lstrip("/")
            out[a["Id"]] = (place, a.get("Type", "").rpartition("/")[2])
    return out


def find_sheet(file: str, sheet: str | None) -> Sheet:
    with _zip(file) as book:
        main = next((t for t, kind in _relations(book, "").values() if kind == "officeDocument"), "xl/workbook.xml")
        parts = _elements(book, main)
        related = _relations(book, main)
        sheets = {a["name"]: related[a["id"]][0] for n, a in parts if n == "sheet" and a.get("id") in related}
        if not sheets or sheet is not None and sheet not in sheets:
            raise ValueError(f"{file} has no sheet {sheet!r}; it has {sorted(sheets)}")
        entry = next(iter(sheets.values())) if sheet is None else sheets[sheet]
        strings = next((t for t, kind in related.values() if kind == "sharedStrings"), None)
        old_mac = any(n == "workbookPr" and a.get("date1904") in ("1", "true") for n, a in parts)
        return Sheet(file, entry, strings, book.getinfo(entry).file_size, old_mac)


# ---------------------------------------------------------------------------- rows and cells


class _Rows:
    """Cells of row elements as they come: column -> (kind, text)."""

    def __init__(self) -> None:
        self.done: list[dict[int, tuple[str, str]]] = []
        self.parser = expat.ParserCreate()
        self.parser.buffer_text = True
        self.parser.StartElementHandler, self.parser.EndElementHandler = self._start, self._end
        self.parser.CharacterDataHandler = self._text
        self.cells: dict[int, tuple[str, str]] = {}
        self.column, self.kind, self.value, self.inside, self.phonetic = -1, "n", [], False, False

    def _start(self, name: str, attrs: dict[str, str]) -> None:
        name = name.rpartition(":")[2]
        if name == "row":
            self.cells, self.column = {}, -1
        elif name == "c":
            at = _LETTERS.match(attrs.get("r", ""))
            self.column = _column(at[0]) if at else self.column + 1
            self.kind, self.value = attrs.get("t", "n"), []
        elif name == "rPh":
            self.phonetic = True
        elif name == "v" or name == "t" and not self.phonetic:
            self.inside = True

    def _text(self, data: str) -> None:
        if self.inside:
            self.value.append(data)

    def _end(self, name: str) -> None:
        name = name.rpartition(":")[2]
        if name in ("v", "t"):
            self.inside = False
        elif name == "rPh":
            self.phonetic = False
        elif name == "c" and self.value:
            self.cells[self.column] = (self.kind, "".join(self.value))
        elif name == "row":
            self.done.append(self.cells)

    def feed(self, data: bytes) -> list[dict[int, tuple[str, str]]]:
        self.parser.Parse(data, False)
        done, self.done = self.done, []
        return done


def _column(letters: str) -> int:
    n = 0
    for c in letters:
        n = 26 * n + ord(c) - 64
    return n - 1


def rows_in(sheet: Sheet, start: int, end: int) -> Iterator[tuple[int, dict[int, tuple[str, str]]]]:
    """Rows whose element begins in [start, end) of the sheet's XML, each with the byte where it begins."""
    with _zip(sheet.file) as book, book.open(sheet.entry) as stream:
        held, at, parser, heads = b"", 0, None, []
        while at < start - 32 and (skipped := stream.read(min(_READ, start - 32 - at))):
            at += len(skipped)  # inflated, not parsed
        while True:
            more = stream.read(_READ)
            held += more
            last = max(0, len(held) - 32) if more else len(held)  # a name cut off at the end is met again
            places = [m.start() for m in _ROW.finditer(held) if m.start() < last]
            closing = _CLOSING.search(held)
            over = bool(closing) and closing.start() < last
            cut = closing.start() if over else last
            for p in places:
                if at + p >= end:
                    cut, over = p, True
                    break
                if at + p >= start:
                    heads.append(at + p)
            if parser is None and heads:
                parser = _Rows()
                names = {n.decode() for n in re.findall(rb"<([A-Za-z_][\w.-]*):row[\s>/]", held)}
                spaces = "".join(f' xmlns:{n}="x"' for n in names)
                parser.feed(f'<sheet xmlns:r="r" xmlns:x14ac="a" xmlns:mc="m" xmlns:xr="r2"{spaces}>'.encode())
                held, at, cut = held[heads[0] - at :], heads[0], cut - (heads[0] - at)
            if parser:
                piece, tail = held[:cut], held[cut:]
                found = parser.feed(piece)
                yield from zip(heads[: len(found)], found)
                heads = heads[len(found) :]
                held, at = tail, at + cut
            else:
                held, at = held[cut:], at + cut
            if over or not more:
                return


def shared_texts(sheet: Sheet, wanted: set[int]) -> dict[int, str]:
    """The wanted entries of the workbook's table of texts; the others are passed over unparsed."""
    if not wanted or sheet.strings is None:
        return {}
    out, number, left, held = {}, 0, len(wanted), b""
    with _zip(sheet.file) as book, book.open(sheet.strings) as stream:
        while left:
            more = stream.read(_READ)
            held += more
            done = 0
            for m in _STRING.finditer(held):
                if m.start() < done:
                    continue
                close = m.end() if m[0].endswith(b"/>") else held.find(b"</" + m[1] + b"si>", m.end())
                if close < 0:
                    break
                if number in wanted:
                    out[number] = _text_of(held[m.end() : close]) if close > m.end() else ""
                    left -= 1
                number += 1
                done = close
            if not more:
                break
            held = held[done:]
    return out


def _text_of(inner: bytes) -> str:
    """Text of an entry, its runs put together, without pronunciation."""
    if b":" in inner and re.search(rb"<[A-Za-z_][\w.-]*:", inner):
        inner = re.sub(rb"(</?)[A-Za-z_][\w.-]*:", rb"\1", inner)
    inner = re.sub(rb"<rPh\b.*?</rPh>", b"", inner, flags=re.S)
    rows = _Rows()
    rows.parser.StartElementHandler = lambda name, attrs: setattr(rows, "inside", name == "t")
    rows.parser.EndElementHandler = lambda name: setattr(rows, "inside", False)
    rows.parser.Parse(b"<si>" + re.sub(rb"\sxml:space=", b" space=", inner) + b"</si>", True)
    return "".join(rows.value)


def _plain(text: str) -> str:
    """Signs that XML cannot hold are written ``_x000D_``."""
    return _CODED.sub(lambda m: chr(int(m[1], 16)), text) if "_x" in text else text


def _headers(cells: dict[int, tuple[str, str]], texts: dict[int, str]) -> list[str]:
    names, seen = [], {}
    for i in range(max(cells, default=-1) + 1):
        name = (_shown(cells[i], texts) if i in cells else None) or f"_c{i}"
        seen[name] = seen.get(name, -1) + 1
        names.append(f"{name}.{seen[name]}" if seen[name] else name)
    return names


def _shown(cell: tuple[str, str], texts: dict[int, str]) -> str | None:
    """A cell as text; error values are none."""
    kind, text = cell
    if kind == "s":
        text = texts.get(int(text))
        return None if text is None else _plain(text)
    if kind == "e":
        return None
    if kind == "b":
        return "true" if text in ("1", "true") else "false"
    return _plain(text) if kind in ("inlineStr", "str") else text


def header_of(sheet: Sheet, named: bool = True) -> tuple[int, list[str]]:
    """Where the first row with values begins, and the names of the columns: its texts, or ``_c0`` and so on,
    when that row is one of data and the first byte is -1."""
    at, first = next(((at, cells) for at, cells in rows_in(sheet, 0, sheet.bytes) if cells), (-1, {}))
    if not named:
        return -1, [f"_c{i}" for i in range(max(first, default=-1) + 1)]
    return at, _headers(first, shared_texts(sheet, {int(t) for k, t in first.values() if k == "s"}))


# ------------------------------------------------------------------------------------ types


def _instant(text: str, since_1904: bool) -> datetime | None:
    try:
        days = float(text)
    except ValueError:
        try:
            return datetime.fromisoformat(text.replace("Z", "+00:00")).replace(tzinfo=None)
        except ValueError:
            return None
    # Day 60 of the older system is a 29 February 1900 that never was.
    start = datetime(1904, 1, 1) if since_1904 else datetime(1899, 12, 30 if days >= 60 else 31)
    try:
        return start + timedelta(microseconds=round(days * 86_400_000) * 1000)
    except OverflowError:
        return None


def _typed(text: str | None, kind: DataType, since_1904: bool) -> object:
    if text is None or isinstance(kind, StringType):
        return text
    if isinstance(kind, BooleanType):
        return {"true": True, "1": True, "false": False, "0": False}.get(text.strip().lower())
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        found = _instant(text.strip(), since_1904)
        return found.date() if found and isinstance(kind, DateType) else found
    try:
        if isinstance(kind, (FloatType, DoubleType)):
            return float(text)
        number = Decimal(text.strip())
        if isinstance(kind, DecimalType):
            exact = round(number, kind.scale)
            return exact if abs(exact) < Decimal(10) ** (kind.precision - kind.scale) else None
        bits = {"byte": 7, "short": 15, "integer": 31, "long": 63}[kind.typeName()]
        return int(number) if number == number.to_integral_value() and -(1 << bits) <= number < 1 << bits else None
    except (ValueError, InvalidOperation, OverflowError):
        return None


def _arrow_type(kind: DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind, timezone="UTC") if isinstance(kind, TimestampType) else to_arrow_type(kind)


_ORDER = StructType([StructField("file", StringType()), StructField("block", LongType()), StructField("row", LongType())])


@dataclass
class RowRange(InputPartition):
    """Rows that begin in [start, end) of a sheet's XML, but for the header, which begins at byte ``first``."""

    sheet: Sheet
    start: int
    end: int
    first: int
    names: list[str]


# ----------------------------------------------------------------------------------- reading


def _true(options: dict[str, str], name: str, default: bool) -> bool:
    return str(options.get(name, default)).lower() == "true"


class WorkbookReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.options = schema, dict(options)

    def partitions(self) -> Sequence[InputPartition]:
        size, named = int(self.options.get("rangebytes", RANGE_BYTES)), _true(self.options, "header", True)
        out = []
        for file in find_workbooks(self.options["path"]):
            sheet = find_sheet(file, self.options.get("sheet"))
            first, names = header_of(sheet, named)
            if not named:  # rows may be wider than the first one
                names = [f.name for f in self.schema if f.name != FILE_ORDER]
                names = [f"_c{i}" for i in range(1 + max((int(n[2:]) for n in names if re.fullmatch(r"_c\d+", n)), default=-1))]
            out += [RowRange(sheet, a, min(a + size, sheet.bytes), first, names) for a in range(0, sheet.bytes, size)]
        return out

    def read(self, partition: RowRange) -> Iterator[pa.RecordBatch]:
        sheet = partition.sheet
        place = {n: i for i, n in enumerate(partition.names)}
        columns = [place.get(f.name) for f in self.schema if f.name != FILE_ORDER]
        wanted = set(columns)
        found = rows_in(sheet, partition.start, partition.end)
        rows = [(at, {c: v for c, v in cells.items() if c in wanted}) for at, cells in found if cells and at != partition.first]
        texts = shared_texts(sheet, {int(t) for _, cells in rows for k, t in cells.values() if k == "s"})
        for i in range(0, len(rows), _BATCH_ROWS):
            yield self._batch(rows[i : i + _BATCH_ROWS], columns, texts, sheet)

    def _batch(self, rows: list, columns: list[int | None], texts: dict[int, str], sheet: Sheet) -> pa.RecordBatch:
        shown = iter(columns)
        arrays = []
        for f in self.schema:
            if f.name == FILE_ORDER:
                values = [{"file": sheet.file, "block": 0, "row": at} for at, _ in rows]
            else:
                c = next(shown)
                values = [_typed(_shown(cells[c], texts), f.dataType, sheet.since_1904) if c in cells else None for _, cells in rows]
            arrays.append(pa.array(values, _arrow_type(f.dataType)))
        return pa.RecordBatch.from_arrays(arrays, [f.name for f in self.schema])


# ----------------------------------------------------------------------------------- writing

_TYPES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
    '<Override PartName="/xl/sharedStrings.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sharedStrings+xml"/></Types>'
)
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'


def _rels(*targets: tuple[str, str]) -> str:
    inside = "".join(f'<Relationship Id="rId{i + 1}" Type="{_OFFICE}/{kind}" Target="{t}"/>' for i, (kind, t) in enumerate(targets))
    return f'{_HEAD}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{inside}</Relationships>'


def _safe(text: str) -> str:
    coded = re.sub(r"_(?=x[0-9A-Fa-f]{4}_)", "_x005F_", text)
    return escape(re.sub(r"[\x00-\x08\x0b-\x1f￾￿]", lambda m: f"_x{ord(m[0]):04X}_", coded))


def _letters(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


class _Book:
    """One workbook, its rows streamed out; repeated short texts go to the side table."""

    def __init__(self, target: object, sheet: str, names: list[str]):
        self.zip = zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED, compresslevel=3)
        self.zip.writestr("[Content_Types].xml", _TYPES)
        self.zip.writestr("_rels/.rels", _rels(("officeDocument", "xl/workbook.xml")))
        self.zip.writestr("xl/_rels/workbook.xml.rels", _rels(("worksheet", "worksheets/sheet1.xml"), ("sharedStrings", "sharedStrings.xml")))
        listed = f'<sheets><sheet name={quoteattr(sheet)} sheetId="1" r:id="rId1"/></sheets>'
        self.zip.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}">{listed}</workbook>')
        self.stream = self.zip.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
        self.stream.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
        self.letters = [_letters(i) for i in range(len(names))]
        self.shared: dict[str, int] = {}
        self.rows = 0
        self.add(names)

    def _cell(self, at: str, v: object) -> str:
        if v is None or isinstance(v, float) and v != v:
            return ""
        if isinstance(v, bool):
            return f'<c r="{at}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, (int, float, Decimal)):
            return f'<c r="{at}"><v>{v!r}</v></c>' if not isinstance(v, Decimal) else f'<c r="{at}"><v>{v}</v></c>'
        if isinstance(v, datetime):
            return f'<c r="{at}" t="d"><v>{v.replace(tzinfo=None).isoformat()}</v></c>'
        if isinstance(v, date):
            return f'<c r="{at}" t="d"><v>{v.isoformat()}</v></c>'
        text = str(v)
        if len(self.shared) < 65_536 or text in self.shared:
            return f'<c r="{at}" t="s"><v>{self.shared.setdefault(text, len(self.shared))}</v></c>'
        return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{_safe(text)}</t></is></c>'

    def add(self, values: Sequence[object]) -> None:
        self.rows += 1
        cells = "".join(self._cell(f"{c}{self.rows}", v) for c, v in zip(self.letters, values))
        self.stream.write(f'<row r="{self.rows}">{cells}</row>'.encode())

    def close(self) -> None:
        self.stream.write(b"</sheetData></worksheet>")
        self.stream.close()
        with self.zip.open("xl/sharedStrings.xml", "w", force_zip64=True) as out:
            out.write(f'{_HEAD}<sst xmlns="{_MAIN}" uniqueCount="{len(self.shared)}">'.encode())
            for text in self.shared:
                out.write(f'<si><t xml:space="preserve">{_safe(text)}</t></si>'.encode())
            out.write(b"</sst>")
        self.zip.close()


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WorkbookWriter(DataSourceWriter):
    """Tasks write into a folder of their own inside the target; the driver moves the files when all is done."""

    def __init__(self, schema: StructType, options: dict[str, str], overwrite: bool):
        self.schema, self.options, self.overwrite = schema, dict(options), overwrite
        self.fs_path = _located(self.options["path"]).rstrip("/")
        self.job = uuid.uuid4().hex
        self.most = min(int(self.options.get("rowsperfile", MOST_ROWS - 1)), MOST_ROWS - 1)

    @property
    def _temporary(self) -> str:
        return f"{_opened(self.fs_path)[1]}/_temporary-{self.job}"

    def write(self, rows: Iterator) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        part = task.partitionId() if task else 0
        attempt = task.taskAttemptId() if task else 0
        fs, _ = _opened(self.fs_path)
        fs.create_dir(self._temporary, recursive=True)
        files, book = [], None
        for row in rows:
            if book is None or book.rows > self.most:
                if book:
                    book.close()
                    out.close()
                name = f"part-{part:05d}-{len(files):03d}-{self.job}.xlsx"
                files.append(f"{attempt}-{name}")
                out = fs.open_output_stream(f"{self._temporary}/{files[-1]}")
                book = _Book(out, self.options.get("sheet", "Sheet1"), self.schema.names)
            book.add(list(row))
        if book:
            book.close()
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, place = _opened(self.fs_path)
        fs.create_dir(place, recursive=True)
        old = [f.path for f in fs.get_file_info(pafs.FileSelector(place)) if f.type == pafs.FileType.File]
        for name in (n for m in messages if m for n in m.files):
            fs.move(f"{self._temporary}/{name}", f"{place}/{name.partition('-')[2]}")
        if self.overwrite:
            for path in old:
                fs.delete_file(path)
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, _ = _opened(self.fs_path)
        if fs.get_file_info(self._temporary).type != pafs.FileType.NotFound:
            fs.delete_dir(self._temporary)


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> StructType:
        files = find_workbooks(self.options["path"])
        if not files:
            raise FileNotFoundError(f"no workbook in {self.options['path']}")
        _, names = header_of(find_sheet(files[0], self.options.get("sheet")), _true(self.options, "header", True))
        order = [StructField(FILE_ORDER, _ORDER)] if _true(self.options, "fileorder", False) else []
        return StructType([StructField(n, StringType()) for n in names] + order)

    def reader(self, schema: StructType) -> WorkbookReader:
        return WorkbookReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WorkbookWriter:
        return WorkbookWriter(schema, self.options, overwrite)


def read_workbook(
    spark: SparkSession, path: str, sheet: str | None = None, schema: StructType | str | None = None, **options: object
) -> DataFrame:
    """One sheet of a workbook, or of each workbook of a folder; without a schema, as text with cleaned headers."""
    spark.dataSource.register(WorkbookSource)
    reader = spark.read.format("workbook").options(**options)
    reader = reader.option("sheet", sheet) if sheet is not None else reader
    return clean_headers(reader.load(path)) if schema is None else reader.schema(schema).load(path)


def write_workbooks(df: DataFrame, path: str, sheet: str = "Sheet1", mode: str = "append", **options: object) -> None:
    """Rows as workbooks, one for each partition at least; a partition beyond the rows of a sheet makes several."""
    df.sparkSession.dataSource.register(WorkbookSource)
    df.write.format("workbook").mode(mode).option("sheet", sheet).options(**options).save(path)
