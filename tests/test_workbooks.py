"""Workbooks written by hand and by the report sink, read back."""

from __future__ import annotations

import io
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.sources import workbooks

SPACE = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def book(rows: str, strings: str = "", formats: str = "") -> bytes:
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as parts:
        parts.writestr("xl/workbook.xml", f'<workbook {SPACE} xmlns:r="{LINKS}"><sheets><sheet name="other" r:id="a"/><sheet name="said" r:id="b"/></sheets></workbook>')
        parts.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="a" Target="worksheets/one.xml"/><Relationship Id="b" Target="/xl/worksheets/two.xml"/></Relationships>')
        parts.writestr("xl/worksheets/one.xml", f"<worksheet {SPACE}><sheetData/></worksheet>")
        parts.writestr("xl/worksheets/two.xml", f"<worksheet {SPACE}><sheetData>{rows}</sheetData></worksheet>")
        parts.writestr("xl/sharedStrings.xml", f"<sst {SPACE}>{strings}</sst>")
        parts.writestr("xl/styles.xml", f'<styleSheet {SPACE}><numFmts><numFmt numFmtId="170" formatCode="dd.mm.yyyy"/><numFmt numFmtId="171" formatCode="0.0 &quot;days&quot;"/></numFmts><cellXfs>{formats}</cellXfs></styleSheet>')
    return made.getvalue()


HEAD = "".join(f'<c r="{at}" t="str"><v>{name}</v></c>' for at, name in (("A1", " Message_ID "), ("B1", "DATE"), ("C1", "text"), ("E1", "user_id"), ("F1", "username"), ("G1", "phone")))
STRINGS = "<si><t>hello</t></si><si><r><t>in </t></r><r><t xml:space='preserve'>runs </t></r><rPh><t>aid</t></rPh></si>"
FORMATS = '<xf numFmtId="0"/><xf numFmtId="170"/><xf numFmtId="171"/><xf numFmtId="22"/><xf numFmtId="21"/>'
ROWS = [
    '<c r="A2"><v>7</v></c><c r="B2" s="1"><v>45293.5</v></c><c r="C2" t="s"><v>0</v></c><c r="E2"><v>12.0</v></c><c r="F2" t="inlineStr"><is><t> ann </t></is></c>',
    '<c r="A3" t="str"><v>12.5</v></c><c r="B3" s="2"><v>45293</v></c><c r="C3" t="s"><v>1</v></c><c r="E3" t="b"><v>1</v></c><c r="F3"><v>5</v></c>',
    '<c r="A4" t="str"><v> 9 </v></c><c r="B4" s="3"><v>1.25</v></c><c r="C4"><v>123</v></c>',  # a number is no text
    '<c r="A5"/><c r="B5" t="str"><v>2024-01-01</v></c><c r="C5" t="str"><v>  </v></c>',
    '<c r="A6"><v>9007199254740993</v></c><c r="B6" s="4"><v>0.5</v></c><c r="C6" t="e"><v>#N/A</v></c><c r="G6"><v>491</v></c>',
]


def written(folder, data: bytes, name: str = "m.xlsx") -> str:
    (folder / name).write_bytes(data)
    return str(folder / name)


def test_messages_of_a_workbook(spark, tmp_path):
    path = written(tmp_path, book(f"<row>{HEAD}</row>" + "".join(f"<row>{r}</row>" for r in ROWS), STRINGS, FORMATS))
    got = {r["text"]: r for r in workbooks.read_messages_xlsx(spark, path, "said").collect()}
    assert set(got) == {"hello", "in runs ", "#N/A"}
    first, second, third = got["hello"], got["in runs "], got["#N/A"]
    assert (first["message_id"], first["date"], first["user_id"], first["username"], first["group_id"]) == (7, datetime(2024, 1, 2, 12), 12, "ann", None)
    assert (second["message_id"], second["date"], second["user_id"], second["username"]) == (None, None, 1, "5")
    assert (third["message_id"], third["date"], third["phone"]) == (9007199254740993, None, "491")
    everything = workbooks.read_messages_xlsx(spark, path, "said", only_with_text=False)
    assert everything.count() == 5 and everything.where("message_id = 9").first()["date"] == datetime(1899, 12, 31, 6)
    assert workbooks.read_messages_xlsx(spark, path, "said", limit=2).count() == 2
    assert workbooks.read_messages_xlsx(spark, path).count() == 0  # the first sheet is empty
    written(tmp_path, book(f"<row>{HEAD}</row><row>{ROWS[0]}</row>", STRINGS, FORMATS), "n.xlsx")
    assert workbooks.read_messages_xlsx(spark, f"{tmp_path}/*.xlsx", "said").count() == 4


@pytest.mark.parametrize(("sheet", "rows", "told"), [("none", "", "no sheet"), ("said", '<row><c r="A1" t="str"><v>text</v></c></row>', "message_id")])
def test_unreadable_workbooks(sheet, rows, told):
    with pytest.raises(ValueError, match=told):
        list(workbooks.message_rows(book(rows), sheet))


def test_a_report_reads_back(spark, tmp_path):
    nasty = 'a <b> & "c"\r\n\x00\ud7ff\ue000\ufffe' + "\U0001d6fc" * 40_000
    rows = spark.createDataFrame([(1, nasty, datetime(2024, 5, 6, 7, 8, 9), True), (2, "plain", None, False)], "message_id bigint, text string, date timestamp, lead boolean")
    listed = spark.range(3).select(F.col("id").alias("message_id"), F.array(F.lit("x"), F.lit("y")).alias("text"), (F.col("id") / 4).alias("share"), (F.col("id") > 1).alias("yes"))
    path = str(tmp_path / "r.xlsx")
    for _ in range(2):  # a report replaces the last one
        workbooks.write_report([workbooks.Sheet("leads", rows, "lead"), workbooks.Sheet("all <1>", listed), workbooks.Sheet("none", rows.limit(0))], path)
    got = {r["message_id"]: r for r in workbooks.read_messages_xlsx(spark, path, "leads").collect()}
    assert got[1]["text"] == nasty.replace("\x00", "").replace("\ufffe", "")[: workbooks.MOST_CHARS] and got[1]["date"] == datetime(2024, 5, 6, 7, 8, 9)
    assert (got[2]["text"], got[2]["date"]) == ("plain", None)
    assert {r["text"] for r in workbooks.read_messages_xlsx(spark, path, "all <1>").collect()} == {"x; y"}
    assert workbooks.read_messages_xlsx(spark, path, "none").count() == 0
    with open(path, "rb") as file:
        cells = list(workbooks.Workbook(file.read()).rows("all <1>"))
    assert cells[0] == {i + 1: ("text", n) for i, n in enumerate(listed.columns)} and cells[2] == {1: ("number", "1"), 2: ("text", "x; y"), 3: ("number", "0.25"), 4: ("truth", "False")}
    with pytest.raises(ValueError, match="different names"):
        workbooks.write_report([], path)
