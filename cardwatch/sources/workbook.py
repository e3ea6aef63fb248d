"""Workbook (.xlsx) feeds read and written on the executors.

Spark's ``binaryFile`` source lists and opens the files, so any folder that
Spark can read will do, and a workbook is parsed where its bytes arrive.  The
sheet's XML is pulled row by row and leaves as Arrow batches of ``BATCH_ROWS``
rows; a row's elements are dropped as soon as it is read.  Shared strings are
kept as one compact Arrow array.  So memory is the compressed file, its distinct
strings and one batch, whatever the number of rows (a sheet holds at most
1,048,576).

Cells are read by the schema given, like the text feeds: the header must name
the schema's columns in order (upper or lower case), and a value that does not
fit its column fails with file, cell and text.

* string: text as it is; a whole number without ".0" (a passport typed as a
  number); a number in a date format as its date;
* timestamp: a date serial (1900 or 1904 system, to the millisecond) or ISO text;
* number: a number or its text;
* boolean: a boolean cell.

An empty cell, and one that says ``#N/A``, is NULL; other error values fail.  A
row without a value is skipped.  Formulas give their stored values.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from itertools import chain
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cardwatch.session import ship_package

BATCH_ROWS = 10_000
#: Rows of a written workbook, well under the format's limit.
SHEET_ROWS = 100_000

# Fixed values of the file format: number formats that are dates, and the first days of its two date systems.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
EPOCH_1900, EPOCH_1904 = _dt.datetime(1899, 12, 30), _dt.datetime(1904, 1, 1)
_DATE_LETTERS = re.compile(r"[ymdhs]", re.IGNORECASE)
_NOT_FORMAT = re.compile(r'"[^"]*"|\\.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', re.IGNORECASE)


class WorkbookError(ValueError):
    """A workbook that does not hold what the schema says."""


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _attribute(el: ET.Element, name: str) -> str | None:
    """Value of an attribute in any name space."""
    return next((v for k, v in el.attrib.items() if _local(k) == name), None)


def _pulled(stream, parent: str, child: str) -> Iterator[ET.Element]:
    """The ``child`` elements under ``parent``, one at a time: each is dropped before the next."""
    inside = None
    for event, el in ET.iterparse(stream, events=("start", "end")):
        name = _local(el.tag)
        if event == "start" and name == parent and inside is None:
            inside = el
        elif event == "end" and name == child and inside is not None:
            yield el
            inside.clear()


def _said(el: ET.Element) -> str:
    """Text of a string item: its runs, without phonetic guides."""
    out = []
    for x in el:
        name = _local(x.tag)
        if name == "t":
            out.append(x.text or "")
        elif name == "r":
            out += [t.text or "" for t in x if _local(t.tag) == "t"]
    return "".join(out)


class Workbook:
    """One open workbook: where its sheets are, shared strings, and which cell styles are dates."""

    def __init__(self, file, name: str):
        self.name, self.zip = name, zipfile.ZipFile(file)
        self.parts = set(self.zip.namelist())
        book = ET.fromstring(self.zip.read("xl/workbook.xml"))
        props = next((e for e in book if _local(e.tag) == "workbookPr"), None)
        self.epoch = EPOCH_1904 if props is not None and props.get("date1904") in ("1", "true") else EPOCH_1900
        rels = ET.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))
        target = {r.get("Id"): r.get("Target", "") for r in rels}
        sheets = next((e for e in book if _local(e.tag) == "sheets"), ())
        self.sheets = {s.get("name"): self._part(target.get(_attribute(s, "id"), "")) for s in sheets}
        self.strings = self._strings()
        self.dates = self._date_styles()

    @staticmethod
    def _part(target: str) -> str:
        return target.lstrip("/") if target.startswith("/") else f"xl/{target}"

    def _strings(self) -> pa.Array:
        chunks, held = [], []
        if "xl/sharedStrings.xml" in self.parts:
            with self.zip.open("xl/sharedStrings.xml") as f:
                for si in _pulled(f, "sst", "si"):
                    held.append(_said(si))
                    if len(held) == BATCH_ROWS:
                        chunks.append(pa.array(held, pa.large_string()))
                        held = []
        chunks.append(pa.array(held, pa.large_string()))
        return pa.concat_arrays(chunks)

    def _date_styles(self) -> np.ndarray:
        """By cell style: whether its number format is a date."""
        if "xl/styles.xml" not in self.parts:
            return np.zeros(1, dtype=bool)
        root = ET.fromstring(self.zip.read("xl/styles.xml"))
        own, styles = {}, []
        for group in root:
            if _local(group.tag) == "numFmts":
                own = {f.get("numFmtId"): f.get("formatCode", "") for f in group}
            elif _local(group.tag) == "cellXfs":
                styles = [x.get("numFmtId", "0") for x in group]
        is_date = lambda s: bool(_DATE_LETTERS.search(_NOT_FORMAT.sub("", own[s]))) if s in own else int(s) in DATE_FORMATS
        return np.array([is_date(s) for s in styles] or [False])

    def rows(self, sheet: str | None) -> Iterator[tuple[int, dict[int, tuple[str, str, int]]]]:
        """(row number, {column: (type, text, style)}) of the rows of a sheet (the first one: None) that hold a value."""
        name = next(iter(self.sheets), None) if sheet is None else sheet
        if name not in self.sheets:
            raise WorkbookError(f"{self.name}: no sheet {sheet!r}")
        number = 0
        with self.zip.open(self.sheets[name]) as f:
            for row in _pulled(f, "sheetData", "row"):
                number = int(row.get("r") or number + 1)
                cells, at = {}, -1
                for c in row:
                    ref = c.get("r")
                    at = _column(ref) if ref else at + 1
                    kind, text = c.get("t", "n"), None
                    for x in c:
                        if _local(x.tag) == "v":
                            text = x.text
                        elif _local(x.tag) == "is":
                            text = _said(x)
                    if text is not None and not (kind == "e" and text == "#N/A"):
                        cells[at] = (kind, text, int(c.get("s") or 0))
                if cells:
                    yield number, cells


def _column(ref: str) -> int:
    """Number, from 0, of the column of a cell reference: "AB12" gives 27."""
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def _number_text(text: str) -> str:
    """A stored number as text, whole ones without a fraction."""
    value = decimal.Decimal(text)
    return format(value.to_integral_value(), "f") if value == value.to_integral_value() else repr(float(text))


def _date(serial: float, epoch: _dt.datetime) -> _dt.datetime:
    if epoch == EPOCH_1900 and serial < 60:  # that system counts a 29 February 1900
        serial += 1
    return epoch + _dt.timedelta(milliseconds=round(serial * 86_400_000))


def _value(book: Workbook, kind: str, text: str, style: int, dtype: T.DataType):
    """A cell's value for its column; shared strings are handled a batch at a time."""
    if kind == "e":
        raise ValueError("an error value")
    if isinstance(dtype, T.StringType):
        if kind == "n":
            if book.dates[style] if style < len(book.dates) else False:
                return str(_date(float(text), book.epoch))
            return _number_text(text)
        return {"0": "FALSE", "1": "TRUE"}.get(text, text) if kind == "b" else text
    text = text.strip()
    if not text:
        return None
    if isinstance(dtype, T.BooleanType):
        if kind != "b":
            raise ValueError("not a boolean")
        return text == "1"
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        when = _date(float(text), book.epoch) if kind == "n" else _dt.datetime.fromisoformat(text)
        if when.tzinfo is not None:
            raise ValueError("a time zone")
        return when.date() if isinstance(dtype, T.DateType) else when
    if isinstance(dtype, T.DecimalType):
        # a stored number is a double: its 15 digits are what the user typed
        exact = decimal.Decimal(text) if kind != "n" else decimal.Decimal(format(float(text), ".15g"))
        return exact.quantize(decimal.Decimal(1).scaleb(-dtype.scale))
    if isinstance(dtype, T.IntegralType):
        exact = decimal.Decimal(text)
        if exact != exact.to_integral_value():
            raise ValueError("not a whole number")
        return int(exact)
    if isinstance(dtype, T.FractionalType):
        return float(text)
    raise WorkbookError(f"no cell can be read as {dtype.simpleString()}")


def parse(file, name: str, schema: T.StructType, sheet: str | None = None) -> Iterator[pa.RecordBatch]:
    """Arrow batches of the rows under the header row of a sheet."""
    book, arrow = Workbook(file, name), to_arrow_schema(schema)
    rows = book.rows(sheet)
    _check_header(book, next(rows, None), schema)
    width = len(schema)
    values, shared = [[] for _ in range(width)], [[] for _ in range(width)]

    def batch() -> pa.RecordBatch:
        arrays = []
        for k, field in enumerate(arrow):
            column = pa.array(values[k], field.type)
            if any(s is not None for s in shared[k]):
                column = pc.coalesce(book.strings.take(pa.array(shared[k], pa.int64())).cast(field.type), column)
            arrays.append(column)
            values[k], shared[k] = [], []
        return pa.RecordBatch.from_arrays(arrays, schema=arrow)

    for number, cells in rows:
        if max(cells) >= width:
            raise WorkbookError(f"{name}, row {number}: a value beyond the {width} columns")
        for k, field in enumerate(schema.fields):
            value, index = None, None
            if k in cells:
                kind, text, style = cells[k]
                try:
                    if kind == "s":
                        index = int(text)
                        if not isinstance(field.dataType, T.StringType):
                            value, index = _value(book, "str", book.strings[index].as_py(), style, field.dataType), None
                    else:
                        value = _value(book, kind, text, style, field.dataType)
                except (ValueError, ArithmeticError, IndexError) as e:
                    raise WorkbookError(f"{name}, row {number}, column {field.name}: {text!r} is no {field.dataType.simpleString()}: {e}") from e
            values[k].append(value)
            shared[k].append(index)
        if len(values[0]) == BATCH_ROWS:
            yield batch()
    if values[0]:
        yield batch()


def _check_header(book: Workbook, first, schema: T.StructType) -> None:
    cells = first[1] if first else {}
    says = []
    for k in range(max(cells, default=-1) + 1):
        kind, text, style = cells.get(k, ("str", "", 0))
        says.append(book.strings[int(text)].as_py() if kind == "s" else text)
    if [s.strip().lower() for s in says] != [f.name.lower() for f in schema.fields]:
        raise WorkbookError(f"{book.name}: header {says} is not {schema.fieldNames()}")


def workbook_rows(files: DataFrame, schema: T.StructType, sheet: str | None = None) -> DataFrame:
    """Rows of the workbooks in (path, content); a workbook is read by one task, a batch holds one."""
    ship_package(files.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                yield from parse(pa.BufferReader(content.as_buffer()), path, schema, sheet)

    return files.select("path", "content").mapInArrow(run, schema)


def read_workbook(spark: SparkSession, path: str | list[str], schema: T.StructType, sheet: str | None = None) -> DataFrame:
    """Rows of one sheet (the first one: None) of the workbooks at ``path``."""
    return workbook_rows(spark.read.format("binaryFile").load(path).select("path", "content"), schema, sheet)


# --- writing ---------------------------------------------------------------------------

_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
#: Parts of every written workbook: one sheet, and one date style (number 1).
_PARTS = {
    "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
    '<Override PartName="/xl/sharedStrings.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sharedStrings+xml"/>'
    '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/></Types>',
    "_rels/.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    f'<Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    f'<Relationship Id="rId1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/>'
    f'<Relationship Id="rId2" Type="{_REL}/sharedStrings" Target="sharedStrings.xml"/>'
    f'<Relationship Id="rId3" Type="{_REL}/styles" Target="styles.xml"/></Relationships>',
    "xl/workbook.xml": f'<workbook {_NS} xmlns:r="{_REL}"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
    "xl/styles.xml": f'<styleSheet {_NS}><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders>'
    '<cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>',
}


def _letters(k: int) -> str:
    out = ""
    while k >= 0:
        out, k = chr(65 + k % 26) + out, k // 26 - 1
    return out


def _cell(ref: str, value, strings: dict[str, int]) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, _dt.datetime):
        days = (value - EPOCH_1900) / _dt.timedelta(days=1)
        return f'<c r="{ref}" s="1"><v>{days if days >= 61 else days - 1}</v></c>'
    if isinstance(value, (int, float, decimal.Decimal)):
        return f'<c r="{ref}"><v>{value}</v></c>'
    return f'<c r="{ref}" t="s"><v>{strings.setdefault(str(value), len(strings))}</v></c>'


def workbook_bytes(header: list[str], rows: Iterable[Iterable]) -> bytes:
    """A workbook of one sheet: dates as serials, texts as shared strings."""
    out, strings = io.BytesIO(), {}
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for part, xml in _PARTS.items():
            z.writestr(part, _XML + xml)
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            f.write(f"{_XML}<worksheet {_NS}><sheetData>".encode())
            for i, row in enumerate(chain([header], rows), 1):
                f.write(f'<row r="{i}">{"".join(_cell(f"{_letters(k)}{i}", v, strings) for k, v in enumerate(row))}</row>'.encode())
            f.write(b"</sheetData></worksheet>")
        with z.open("xl/sharedStrings.xml", "w") as f:
            f.write(f"{_XML}<sst {_NS}>".encode())
            for s in strings:
                f.write(f'<si><t xml:space="preserve">{escape(s)}</t></si>'.encode())
            f.write(b"</sst>")
    return out.getvalue()


def to_workbooks(df: DataFrame, header: list[str] | None = None, rows: int = SHEET_ROWS) -> DataFrame:
    """(path, content): the rows of every partition as workbooks of up to ``rows`` rows."""
    ship_package(df.sparkSession)
    names = header or df.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            held += zip(*(c.to_pylist() for c in b.columns), strict=True)
            while len(held) >= rows:
                yield _file(names, held[:rows])
                held = held[rows:]
        if held:
            yield _file(names, held)

    return df.mapInArrow(run, "path string, content binary")


def _file(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(["memory.xlsx"]), pa.array([workbook_bytes(names, rows)], pa.binary())], names=["path", "content"])
