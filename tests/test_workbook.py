"""Workbook feeds: cells of every kind, dates of both systems, errors with their place, memory, and a daily run from workbooks."""

import datetime as dt
import io
import tracemalloc
import zipfile
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from cardwatch import schemas as S
from cardwatch.plans.daily import run_daily
from cardwatch.sources import workbook
from cardwatch.sources.feeds import BLACKLIST_FILE, next_day, read_blacklist, read_terminals
from cardwatch.sources.store import Store
from cardwatch.sources.workbook import WorkbookError, parse, read_workbook, to_workbooks, workbook_bytes, workbook_rows
from tests.test_daily import D, day_files, snapshot, sources

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def made(sheet, strings="", styles=None, book="", target="worksheets/sheet1.xml", extra=None):
    """A workbook of hand-written XML."""
    base = workbook_bytes(["x"], [])
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(base)) as src, zipfile.ZipFile(out, "w") as z:
        for n in src.namelist():
            data = src.read(n).decode()
            if n == "xl/worksheets/sheet1.xml":
                data = f"<worksheet {NS}><sheetData>{sheet}</sheetData></worksheet>"
            elif n == "xl/sharedStrings.xml":
                data = f"<sst {NS}>{strings}</sst>"
            elif n == "xl/styles.xml" and styles:
                data = f"<styleSheet {NS}>{styles}</styleSheet>"
            elif n == "xl/workbook.xml":
                data = data.replace("<sheets>", f"{book}<sheets>")
            elif n == "xl/_rels/workbook.xml.rels":
                data = data.replace("worksheets/sheet1.xml", target)
            z.writestr(n, data)
        for n, data in (extra or {}).items():
            z.writestr(n, data)
    return out.getvalue()


def rows_of(content, schema, sheet=None):
    return [tuple(r.values()) for b in parse(io.BytesIO(content), "book.xlsx", schema, sheet) for r in b.to_pylist()]


def fields(*types):
    return T.StructType([T.StructField(f"c{k}", t) for k, t in enumerate(types)])


HEAD = '<row r="1"><c r="A1" t="inlineStr"><is><t>C0</t></is></c><c r="B1" t="inlineStr"><is><t> c1 </t></is></c></row>'


def test_cells_of_every_kind():
    strings = '<si><t xml:space="preserve"> a&amp;b </t></si><si><r><t>ri</t></r><r><rPr/><t>ch</t></r><rPh sb="0" eb="1"><t>no</t></rPh></si><si/>'
    sheet = HEAD + (
        '<row r="2"><c r="A2" t="s"><v>0</v></c><c r="B2"><v>45352.4375</v></c></row>'
        '<row r="3"><c r="B3" t="d"><v>2024-03-01T10:00:00</v></c><c r="A3" t="s"><v>1</v></c></row>'
        "<row r=\"4\"/><row r=\"5\"><c r=\"A5\" s=\"1\"/></row>"
        '<row r="6"><c><v>4509123456</v></c><c t="str"><f>A1</f><v>2024-03-02 00:00:00</v></c></row>'
        '<row r="7"><c r="A7"><v>1.5</v></c></row>'
        '<row r="8"><c r="A8" s="1"><v>59</v></c><c r="B8"><v>1</v></c></row>'
        '<row r="9"><c r="A9" t="b"><v>1</v></c><c r="B9" t="e"><v>#N/A</v></c></row>'
        '<row r="10"><c r="A10" t="s"><v>2</v></c><c r="B10"><v>61</v></c></row>'
        '<row r="11"><c r="A11"><v>1.2345E3</v></c></row><row r="12"><c r="A12"><v>4.509E9</v></c></row>'
    )
    assert rows_of(made(sheet, strings), fields(T.StringType(), T.TimestampNTZType())) == [
        (" a&b ", dt.datetime(2024, 3, 1, 10, 30)), ("rich", dt.datetime(2024, 3, 1, 10)),
        ("4509123456", dt.datetime(2024, 3, 2)), ("1.5", None),
        ("1900-02-28 00:00:00", dt.datetime(1900, 1, 1)), ("TRUE", None), ("", dt.datetime(1900, 3, 1)),
        ("1234.5", None), ("4509000000", None),
    ]


def test_numbers_and_the_1904_system():
    sheet = HEAD + '<row r="2"><c r="A2"><v>0.1</v></c><c r="B2"><v>0</v></c></row><row r="3"><c r="A3" t="inlineStr"><is><t>12.30</t></is></c></row>'
    got = rows_of(made(sheet, book='<workbookPr date1904="1"/>'), fields(T.DecimalType(10, 2), T.TimestampNTZType()))
    assert got == [(Decimal("0.10"), dt.datetime(1904, 1, 1)), (Decimal("12.30"), None)]
    assert rows_of(made(HEAD + '<row r="2"><c r="A2"><v>7</v></c><c r="B2" t="b"><v>0</v></c></row>'), fields(T.LongType(), T.BooleanType())) == [(7, False)]
    assert rows_of(made(HEAD + '<row r="2"><c r="A2"><v>7</v></c><c r="B2"><v>2.5</v></c></row>'), fields(T.IntegerType(), T.DoubleType())) == [(7, 2.5)]


def test_custom_date_formats():
    styles = (
        '<numFmts count="3"><numFmt numFmtId="164" formatCode="dd/mm/yyyy"/><numFmt numFmtId="165" formatCode="0.00&quot; days&quot;"/>'
        '<numFmt numFmtId="166" formatCode="[Red]#,##0"/></numFmts><cellXfs><xf numFmtId="164"/><xf numFmtId="165"/><xf numFmtId="166"/></cellXfs>'
    )
    sheet = HEAD + "".join(f'<row r="{2 + k}"><c r="A{2 + k}" s="{k}"><v>45352</v></c></row>' for k in range(3))
    got = rows_of(made(sheet, styles=styles), fields(T.StringType(), T.StringType()))
    assert [g[0] for g in got] == ["2024-03-01 00:00:00", "45352", "45352"]


@pytest.mark.parametrize("cell", [
    '<c r="B2" t="inlineStr"><is><t>soon</t></is></c>', '<c r="B2" t="e"><v>#REF!</v></c>', '<c r="B2" t="s"><v>9</v></c>',
    '<c r="C2"><v>1</v></c>', '<c r="B2" t="d"><v>2024-03-01T10:00:00+03:00</v></c>',
])
def test_a_bad_cell_names_its_place(cell):
    with pytest.raises(WorkbookError, match="book.xlsx, row 2"):
        rows_of(made(HEAD + f'<row r="2">{cell}</row>'), fields(T.StringType(), T.TimestampNTZType()))


def test_header_and_sheets():
    two = fields(T.StringType(), T.StringType())
    assert rows_of(made(HEAD), two) == []
    for sheet in ("", '<row r="1"><c t="str"><v>c1</v></c><c t="str"><v>c0</v></c></row>', HEAD.replace("</row>", '<c t="str"><v>c2</v></c></row>')):
        with pytest.raises(WorkbookError, match="header"):
            rows_of(made(sheet), two)
    with pytest.raises(WorkbookError, match="sheet"):
        rows_of(made(HEAD), two, "Other")
    assert rows_of(made(HEAD, target="/xl/worksheets/sheet1.xml"), two, "Sheet1") == []


def test_reads_what_it_writes(spark, tmp_path):
    rows = [(f"T{i}", ["POS", None, "<&>"][i % 3], f"город {i % 7}", f" a  {i}") for i in range(25_000)]
    path = tmp_path / "terminals_01032024.xlsx"
    path.write_bytes(workbook_bytes(S.STG_TERMINALS.fieldNames(), rows))
    got = read_terminals(spark, f"file://{path}")
    assert got.schema == S.STG_TERMINALS and sorted(map(tuple, got.collect())) == sorted(rows)
    listed = [(dt.datetime(2024, 3, 1, 9, 0, k), f"{k} {k}") for k in range(50)] + [(None, "x")]
    path = tmp_path / "passport_blacklist_01032024.xlsx"
    path.write_bytes(workbook_bytes(["date", "passport"], listed))
    other = tmp_path / "passport_blacklist_b_01032024.csv"
    other.write_text("date;passport\n2024-03-05 00:00:00;text\n")
    got = read_blacklist(spark, [str(path), str(other)])  # formats by extension
    assert sorted(map(tuple, got.collect()), key=str) == sorted([*listed, (dt.datetime(2024, 3, 5), "text")], key=str)
    frame = spark.createDataFrame(listed, BLACKLIST_FILE).repartition(3)
    files = to_workbooks(frame, rows=7)
    assert files.count() >= 8
    assert sorted(map(tuple, workbook_rows(files, BLACKLIST_FILE).collect()), key=str) == sorted(listed, key=str)
    assert workbook_rows(files.limit(0), BLACKLIST_FILE).count() == 0


def test_a_broken_workbook_fails(spark, tmp_path):
    path = tmp_path / "terminals_01032024.xlsx"
    path.write_bytes(b"PK not a workbook")
    with pytest.raises(Exception, match="zip"):
        read_workbook(spark, str(path), S.STG_TERMINALS).collect()


def test_memory_does_not_follow_the_rows():
    """200,000 rows take no more than 20,000 do: a batch, the strings, the inflating buffers."""
    schema, peaks = fields(T.StringType(), T.TimestampNTZType(), T.DecimalType(10, 2)), []
    for n in (20_000, 200_000):
        book = workbook_bytes(["c0", "c1", "c2"], ((f"s{i % 100}", dt.datetime(2024, 1, 1, i % 24), Decimal(i) / 100) for i in range(n)))
        tracemalloc.start()
        before = pa.total_allocated_bytes()
        assert sum(b.num_rows for b in parse(io.BytesIO(book), "b", schema)) == n
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert pa.total_allocated_bytes() - before < 4 << 20
    assert peaks[1] < 1.2 * peaks[0] and peaks[1] < 40 << 20


def test_daily_run_from_workbooks_equals_the_text_run(spark, tmp_path):
    """Terminals and blacklist as workbooks, as the source delivers them: the same state as from text."""
    states = []
    for kind in ("csv", "xlsx"):
        folder = tmp_path / kind
        folder.mkdir()
        day_files(folder)
        if kind == "xlsx":
            for p in sorted(folder.glob("*.csv")):
                header, *rows = [line.split(";") for line in p.read_text().splitlines()]
                if header[0] == "date":
                    rows = [(dt.datetime.fromisoformat(d), x) for d, x in rows]
                p.with_suffix(".xlsx").write_bytes(workbook_bytes(header, rows))
                p.unlink()
        store = Store(spark, str(tmp_path / f"wh-{kind}"))
        for i in range(3):
            day = next_day(spark, str(folder), store.ledger(store.effective()))
            assert day.load_dt == D[i]
            run_daily(spark, store, day, sources(spark, i))
        states.append(snapshot(store))
    assert states[0] == states[1]


def test_batches_are_cut(monkeypatch):
    monkeypatch.setattr(workbook, "BATCH_ROWS", 3)
    book = workbook_bytes(["c0"], [[str(i)] for i in range(8)])
    assert [b.num_rows for b in parse(io.BytesIO(book), "b", fields(T.StringType()))] == [3, 3, 2]
