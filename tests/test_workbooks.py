"""Workbooks as other programs write them, and our own read back."""

import io
import os
import zipfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.sinks import workbooks as sink
from tallyloom.sources import sheets as sh
from tallyloom.sources import workbooks as src

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
RELATION = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def book(sheet_xml, strings="", styles="", date1904=False):
    """A workbook with a chart sheet, a second sheet listed first, absolute targets and shared strings."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("_rels/.rels", f'<Relationships><Relationship Id="a" Type="{RELATION}/officeDocument" Target="/xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<workbook {MAIN}><workbookPr date1904="{int(date1904)}"/><sheets><sheet name="Last" sheetId="9" r:id="r2"/><sheet name="Chart" sheetId="3" r:id="r3"/><sheet name="A &amp; B" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f"""<Relationships>
<Relationship Id="r1" Type="{RELATION}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Type="{RELATION}/worksheet" Target="/xl/worksheets/sheet2.xml"/>
<Relationship Id="r3" Type="{RELATION}/chartsheet" Target="chartsheets/sheet1.xml"/><Relationship Id="r4" Type="{RELATION}/sharedStrings" Target="sharedStrings.xml"/>
<Relationship Id="r5" Type="{RELATION}/styles" Target="styles.xml"/></Relationships>""")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {MAIN}><sheetData>{sheet_xml}</sheetData></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet {MAIN}><sheetData><row r="2"><c r="B2"><v>7</v></c></row></sheetData></worksheet>')
        z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{strings}</sst>")
        z.writestr("xl/styles.xml", f"<styleSheet {MAIN}>{styles}</styleSheet>")
    return out.getvalue()


def read(spark, content, path="/x/My book.xlsx"):
    return src.workbook_rows(spark.createDataFrame([(path, bytearray(content))], "path string, content binary"))


def test_strings_gaps_and_order(spark):
    xml = """<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row r="2"/><row r="4"><c r="AA4" t="inlineStr"><is><t>far</t></is></c></row>
<row><c t="b"><v>1</v></c><c t="e"><v>#N/A</v></c><c t="str"><v>made</v></c><c><v>0.1</v></c></row>"""
    got = rows(read(spark, book(xml, "<si><t>Name</t></si><si><r><t>Imp</t></r><r><t>\nressions</t></r><rPh><t>no</t></rPh></si>")), "position", "line_no")
    assert got == [
        ("My book", "Last", 1, 1, [None, "7"]), ("My book", "A & B", 2, 0, ["Name", None, "Imp\nressions"]),
        ("My book", "A & B", 2, 3, [None] * 26 + ["far"]), ("My book", "A & B", 2, 4, ["TRUE", None, "made", "0.1"]),
    ]


def test_dates_and_times(spark):
    styles = '<numFmts><numFmt numFmtId="170" formatCode="&quot;day &quot;0.00"/><numFmt numFmtId="171" formatCode="[$-409]d\\-mmm;@"/></numFmts><cellXfs>' + "".join(f'<xf numFmtId="{i}"/>' for i in (0, 14, 20, 22, 170, 171)) + "</cellXfs>"
    cells = [(0, "45292"), (1, "45292"), (2, "0.375"), (3, "45292.75"), (4, "45292"), (5, "45292"), (1, "59"), (1, "61")]
    xml = "<row>" + "".join(f'<c s="{s}"><v>{v}</v></c>' for s, v in cells) + "</row>"
    want = ["45292", "2024-01-01", "09:00:00", "2024-01-01 18:00:00", "45292", "2024-01-01", "1900-02-28", "1900-03-01"]
    assert rows(read(spark, book(xml, styles=styles)).filter("position = 2").select("cells")) == [(want,)]
    later = rows(read(spark, book(xml, styles=styles, date1904=True)).filter("position = 2").select(F.get("cells", F.lit(1))))
    assert later == [("2028-01-02",)]


def test_own_workbooks_read_back(spark, tmp_path):
    lines = spark.createDataFrame([
        ("A/1", "Net", 2, 0, ["Title"]), ("A/1", "Net", 2, 3, ["Name", "Code", 'Imp "x"\n<&>']), ("A/1", "Net", 2, 4, ["n\x01", "007", "-1.50"]), ("A/1", "Day", 1, 0, ["12"]),
        ("B", "Only", None, 0, ["é", "", "1e5"]),
    ], "file string, sheet string, position int, line_no bigint, cells array<string>")
    folder = sink.write_workbooks(lines, str(tmp_path / "books"))
    assert sorted(os.listdir(folder)) == ["A_1.xlsx", "B.xlsx"]
    (tmp_path / "books" / "~$B.xlsx").write_bytes(b"open elsewhere")
    got = rows(src.read_workbooks(spark, folder), "file", "position", "line_no")
    assert got == [
        ("A_1", "Day", 1, 0, ["12"]), ("A_1", "Net", 2, 0, ["Title"]), ("A_1", "Net", 2, 3, ["Name", "Code", 'Imp "x"\n<&>']), ("A_1", "Net", 2, 4, ["n", "007", "-1.50"]),
        ("B", "Only", 1, 0, ["é", "", "1e5"]),
    ]
    assert rows(sh.promote_header(src.read_workbooks(spark, folder), ["Name"]).filter("file = 'A_1' and sheet = 'Net'").select("Name")) == [("n",)]


def test_a_failed_task_leaves_no_workbook(spark, tmp_path):
    books = spark.createDataFrame([(f"b{i}", bytearray(b"x")) for i in range(6)], "file string, content binary").repartition(3)
    broken = books.withColumn("content", F.when(F.col("file") == "b4", F.raise_error(F.lit("broken")).cast("binary")).otherwise(F.col("content")))
    spark.dataSource.register(sink.BookSink)
    with pytest.raises(Exception, match="broken"):
        broken.write.format("tallyloom_books").mode("append").save(str(tmp_path / "out"))
    assert not [n for n in os.listdir(tmp_path / "out") if n.endswith(".xlsx")] if (tmp_path / "out").exists() else True


def test_two_books_of_one_name_and_what_is_no_book(spark, tmp_path):
    twice = spark.createDataFrame([("a/b", bytearray(b"1")), ("a:b", bytearray(b"2"))], "file string, content binary")
    spark.dataSource.register(sink.BookSink)
    with pytest.raises(Exception, match="one name"):
        twice.write.format("tallyloom_books").mode("append").save(str(tmp_path / "out"))
    with pytest.raises(Exception, match="zip"):
        read(spark, b"plain text").collect()
