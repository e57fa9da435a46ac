"""Workbooks (XLSX): messages read by executors, one task a file, and reports of several sheets.

A workbook is a zip of XML parts, and the standard library reads and writes both, so no
further package is needed. Sheets are parsed row by row; a task holds one compressed file, its
shared strings and a batch of rows. The format ends at 1,048,576 rows a sheet.
"""

from __future__ import annotations

import io
import os
import re
import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ship
from tidemark.sources.readers import MESSAGE_COLUMNS, OPTIONAL_COLUMNS

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Numbers of built-in cell formats that show a day (others of them show a time alone).
DAY_FORMATS = frozenset([*range(14, 18), 22, *range(27, 32), 36, *range(50, 59)])
MOST_ROWS, MOST_CHARS = 1_048_576, 32_767
BATCH_ROWS = 1000
MESSAGES = MESSAGE_COLUMNS | OPTIONAL_COLUMNS

#: A cell: its kind (text, number, day or truth) and its value as text.
Cell = tuple[str, str]


def _shows_day(code: str) -> bool:
    bare = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", code.lower())
    return "d" in bare or "y" in bare


class Workbook:
    """The sheets of one file."""

    def __init__(self, data: bytes) -> None:
        self.parts = zipfile.ZipFile(io.BytesIO(data))
        book = self._tree("xl/workbook.xml")
        settings = book.find(f"{MAIN}workbookPr")
        self.first_day = datetime(1904, 1, 1) if settings is not None and settings.get("date1904") in ("1", "true") else datetime(1899, 12, 30)
        targets = {r.get("Id"): r.get("Target", "") for r in self._tree("xl/_rels/workbook.xml.rels")}
        self.sheets = {s.get("name"): targets[s.get(LINK)] for s in book.iter(f"{MAIN}sheet")}
        self.strings = self._strings()
        self.days = self._days()

    def _tree(self, name: str) -> ElementTree.Element:
        return ElementTree.fromstring(self.parts.read(name))

    @staticmethod
    def _text(item: ElementTree.Element) -> str:
        """The text of a shared or inline string, whole or in formatted runs, without reading aids."""
        runs = [item, *item.findall(f"{MAIN}r")]
        return "".join(t.text or "" for run in runs for t in run.findall(f"{MAIN}t"))

    def _strings(self) -> list[str]:
        if "xl/sharedStrings.xml" not in self.parts.namelist():
            return []
        found = []
        with self.parts.open("xl/sharedStrings.xml") as part:
            for _, item in ElementTree.iterparse(part):
                if item.tag == f"{MAIN}si":
                    found.append(self._text(item))
                    item.clear()
        return found

    def _days(self) -> list[bool]:
        """Whether each cell style shows a day."""
        if "xl/styles.xml" not in self.parts.namelist():
            return []
        styles = self._tree("xl/styles.xml")
        own = {int(f.get("numFmtId", "0")): _shows_day(f.get("formatCode", "")) for f in styles.iter(f"{MAIN}numFmt")}
        formats = [int(x.get("numFmtId", "0")) for x in styles.findall(f"{MAIN}cellXfs/{MAIN}xf")]
        return [own.get(n, n in DAY_FORMATS) for n in formats]

    def _cell(self, cell: ElementTree.Element) -> Cell | None:
        kind, value = cell.get("t", "n"), cell.findtext(f"{MAIN}v")
        if kind == "inlineStr":
            inline = cell.find(f"{MAIN}is")
            return ("text", self._text(inline)) if inline is not None else None
        if value is None:
            return None
        if kind == "s":
            return ("text", self.strings[int(value)])
        if kind in ("str", "e"):
            return ("text", value)
        if kind == "b":
            return ("truth", "True" if value == "1" else "False")
        if kind == "d":
            return ("day", value.replace("T", " "))
        style = int(cell.get("s", "0"))
        if style < len(self.days) and self.days[style]:
            try:
                moment = self.first_day + timedelta(milliseconds=round(float(value) * 86_400_000))
            except (ValueError, OverflowError):
                return None
            return ("day", moment.isoformat(" "))
        return ("number", value)

    def rows(self, sheet: str | None = None) -> Iterator[dict[int, Cell]]:
        """The cells of each row by column number; the first sheet if none is named."""
        name = next(iter(self.sheets)) if sheet is None else sheet
        if name not in self.sheets:
            raise ValueError(f"no sheet {name!r}; there are {list(self.sheets)}")
        target = self.sheets[name]
        with self.parts.open(target[1:] if target.startswith("/") else f"xl/{target}") as part:
            events = ElementTree.iterparse(part, ("start", "end"))
            parent = None
            for event, item in events:
                if item.tag == f"{MAIN}sheetData" and event == "start":
                    parent = item
                if item.tag != f"{MAIN}row" or event == "start":
                    continue
                cells: dict[int, Cell] = {}
                at = 0
                for cell in item.findall(f"{MAIN}c"):
                    if letters := re.match("[A-Z]+", cell.get("r", "")):
                        at = 0
                        for letter in letters[0]:
                            at = at * 26 + ord(letter) - 64
                    else:
                        at += 1
                    if made := self._cell(cell):
                        cells[at] = made
                yield cells
                parent.clear()  # rows already read


def _plain(kind: str, cell: Cell | None) -> str | None:
    """A cell as text that casts to the kind; None where it says something else."""
    if cell is None:
        return None
    what, value = cell
    if kind == "timestamp":
        return value if what == "day" else None
    if kind != "bigint":
        return value.strip() or None
    if what == "truth":
        return "1" if value == "True" else "0"
    if re.fullmatch(r"\s*[+-]?[0-9]+\s*", value):
        return value.strip()
    try:
        return str(int(float(value))) if what == "number" else None
    except (ValueError, OverflowError):
        return None


def message_rows(data: bytes, sheet: str | None = None, limit: int | None = None, only_with_text: bool = True) -> Iterator[tuple[str | None, ...]]:
    """The values of ``MESSAGES`` of each row, as text; ``limit`` counts the rows returned."""
    rows = Workbook(data).rows(sheet)
    head = next(rows, None)
    if head is None or limit == 0:
        return
    names: dict[str, int] = {}
    for at, (_, value) in head.items():
        names.setdefault(value.strip().lower(), at)
    if missing := {"message_id", "text"} - set(names):
        raise ValueError(f"no column {sorted(missing)}; there are {list(names)}")
    given = 0
    for cells in rows:
        said = cells.get(names["text"])
        text = said[1] if said and said[0] == "text" else None
        if only_with_text and not (text or "").strip():
            continue
        yield tuple(text if name == "text" else _plain(kind, cells.get(names.get(name, 0))) for name, kind in MESSAGES.items())
        given += 1
        if given == limit:
            return


def read_messages_xlsx(spark: SparkSession, path: str, sheet: str | None = None, limit: int | None = None, only_with_text: bool = True) -> DataFrame:
    """The messages of a workbook, or of all that a folder or pattern names, each in a task of its own.

    Columns are found by header name in any case; those absent are null. A text counts only if
    its cell holds text, a date only if it is formatted as one; numbers that can't be read are
    null. ``limit`` is a limit for each file. A sheet without a row has no messages; a header
    without message_id or text is an error.
    """
    ship(spark)
    names = list(MESSAGES)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for file in files.column(0):
                held = []
                for row in message_rows(file.as_py(), sheet, limit, only_with_text):
                    held.append(row)
                    if len(held) == BATCH_ROWS:
                        yield batch(held)
                        held = []
                if held:
                    yield batch(held)

    content = spark.read.format("binaryFile").load(path).select("content")
    raw = content.mapInArrow(run, ", ".join(f"{n} string" for n in names))
    return raw.select(*[F.col(n) if kind == "string" else F.col(n).try_cast(kind).alias(n) for n, kind in MESSAGES.items()])


@dataclass(frozen=True)
class Sheet:
    """A sheet of a report; ``shade`` names a boolean column that colours the rows and isn't written."""

    name: str
    rows: DataFrame
    shade: str | None = None


_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_SPACE = MAIN[1:-1]
#: Cell styles: plain, header, then (text, day) of rows without shade, shaded and not shaded.
_STYLES = f"""{_HEAD}<styleSheet xmlns="{_SPACE}"><numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy-mm-dd hh:mm:ss"/></numFmts>
<fonts count="2"><font/><font><b/><color rgb="FFFFFFFF"/></font></fonts>
<fills count="5"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>{
    "".join(f'<fill><patternFill patternType="solid"><fgColor rgb="{c}"/></patternFill></fill>' for c in ("FF1F3864", "FFDFF0D8", "FFEEEEEE"))
}</fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>
<cellXfs count="8"><xf/><xf fontId="1" fillId="2" applyFont="1" applyFill="1"/>{
    "".join(f'<xf fillId="{f}" applyFill="1"><alignment vertical="top" wrapText="1"/></xf><xf numFmtId="164" fillId="{f}" applyNumberFormat="1" applyFill="1"/>' for f in (0, 3, 4))
}</cellXfs></styleSheet>"""


def _written(value: object, style: int) -> str:
    """A cell's XML. Lists are joined; what XML can't hold is left out; text ends at the format's limit."""
    if value is None:
        return f'<c s="{style}"/>'
    if isinstance(value, bool):
        return f'<c s="{style}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float, Decimal)) and value == value and abs(value) < 10**15:
        return f'<c s="{style}"><v>{value}</v></c>'
    if isinstance(value, date):
        moment = value.replace(tzinfo=None) if isinstance(value, datetime) else datetime(value.year, value.month, value.day)
        return f'<c s="{style + 1}"><v>{(moment - datetime(1899, 12, 30)) / timedelta(days=1)!r}</v></c>'
    text = "; ".join(map(str, value)) if isinstance(value, list) else str(value)
    text = re.sub(r"[^\t\n\r\u0020-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]", "", text)[:MOST_CHARS]
    return f'<c s="{style}" t="inlineStr"><is><t xml:space="preserve">{escape(text, {chr(13): "&#13;"})}</t></is></c>'


def write_report(sheets: Sequence[Sheet], path: str) -> None:
    """One workbook with a sheet for each table: bold header that stays in view, a filter, coloured rows.

    Rows come to the driver partition by partition and go straight into the file, which is then
    copied to ``path`` in whichever store that is. A table over the format's number of rows is an
    error, since nothing may be dropped: write it as CSV.
    """
    if len({s.name for s in sheets}) < len(sheets) or not sheets:
        raise ValueError("a report needs sheets of different names")
    spark = sheets[0].rows.sparkSession
    numbers = range(1, len(sheets) + 1)
    relation = LINK[1 : LINK.index("}")]
    package = "http://schemas.openxmlformats.org/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    with tempfile.TemporaryDirectory(prefix="tidemark-report-") as folder:
        local = os.path.join(folder, "report.xlsx")
        with zipfile.ZipFile(local, "w", zipfile.ZIP_DEFLATED) as parts:
            parts.writestr(
                "[Content_Types].xml",
                f'{_HEAD}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>'
                + "".join(f'<Override PartName="/xl/worksheets/sheet{n}.xml" ContentType="{kind}.worksheet+xml"/>' for n in numbers) + "</Types>",
            )
            parts.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{relation}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
            named = "".join(f'<sheet name={quoteattr(s.name)} sheetId="{n}" r:id="r{n}"/>' for n, s in zip(numbers, sheets, strict=True))
            parts.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_SPACE}" xmlns:r="{relation}"><sheets>{named}</sheets></workbook>')
            links = "".join(f'<Relationship Id="r{n}" Type="{relation}/worksheet" Target="worksheets/sheet{n}.xml"/>' for n in numbers)
            parts.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{package}/relationships">{links}<Relationship Id="r0" Type="{relation}/styles" Target="styles.xml"/></Relationships>')
            parts.writestr("xl/styles.xml", _STYLES)
            for n, sheet in zip(numbers, sheets, strict=True):
                with parts.open(f"xl/worksheets/sheet{n}.xml", "w") as out:
                    for piece in _sheet(sheet):
                        out.write(piece.encode())
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        source = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{local}")
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).copyFromLocalFile(False, True, source, target)


def _sheet(sheet: Sheet) -> Iterator[str]:
    columns = [c for c in sheet.rows.columns if c != sheet.shade]
    yield f'{_HEAD}<worksheet xmlns="{_SPACE}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><sheetData>'
    yield f"<row>{''.join(_written(c, 1) for c in columns)}</row>"
    count = 1
    for row in sheet.rows.toLocalIterator():
        count += 1
        if count > MOST_ROWS:
            raise ValueError(f"sheet {sheet.name!r} has more rows than a workbook holds")
        style = 2 if sheet.shade is None else 4 if row[sheet.shade] else 6
        yield f"<row>{''.join(_written(row[c], style) for c in columns)}</row>"
    last, at = "", len(columns)
    while at:
        at, letter = divmod(at - 1, 26)
        last = chr(65 + letter) + last
    yield f'</sheetData><autoFilter ref="A1:{last}{count}"/></worksheet>'
