"""Spreadsheets as a Spark data source, on zipfile and xml of the standard library.

spark.dataSource.register(XlsxSource); spark.read.format("xlsx").option("sheet", "Raw").option("startRow", 8).load(path)
reads string cells col1..colN; df.write.format("xlsx").option("sheet", "Raw").save(path) writes one workbook a partition.
Paths of the source are files that driver and executors both see; read_books() reads from any store that Spark reads.
"""

from __future__ import annotations

import io
import os
import re
import uuid
import zipfile
from collections.abc import Iterator
from typing import BinaryIO
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def column_number(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n


def column_name(n: int) -> str:
    out = ""
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def read_rows(path: str | BinaryIO, sheet: str, start: int) -> Iterator[tuple[int, dict[int, str]]]:
    """(row number, {column: text}) from row `start` on; the named sheet if there is one, else the active (first) one."""
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in si.iter(f"{_MAIN}t")))
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        sheets = {s.get("name"): s.get(_REL) for s in book.iter(f"{_MAIN}sheet")}
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = targets[sheets.get(sheet, next(iter(sheets.values())))]
        with z.open(("xl/" + target) if not target.startswith("/") else target[1:]) as f:
            parent = None
            for event, row in ElementTree.iterparse(f, ("start", "end")):
                if event == "start":
                    parent = row if row.tag == f"{_MAIN}sheetData" else parent
                    continue
                if row.tag != f"{_MAIN}row":
                    continue
                at, cells = int(row.get("r")), {}
                for c in row:
                    value = c.find(f"{_MAIN}v")
                    if c.get("t") == "inlineStr":
                        text = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                    elif value is None or value.text is None:
                        continue
                    else:
                        text = shared[int(value.text)] if c.get("t") == "s" else value.text
                    cells[column_number(c.get("r"))] = text
                parent.clear()  # rows that are read leave the tree, so a sheet of any length takes the memory of one
                if at >= start and cells:
                    yield at, cells


def read_books(spark: SparkSession, path: str, sheet: str = "", start: int = 1, cols: tuple[int, ...] = (1,)) -> DataFrame:
    """Columns `cols` (col1..., as text) of the rows from `start` on of every workbook under path, a workbook a task at a time."""
    names = [f"col{i}" for i in range(1, len(cols) + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows = [[cells.get(c) for c in cols] for _, cells in read_rows(io.BytesIO(content.as_py()), sheet, start)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*rows) if rows else [()] * len(cols))], names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, ", ".join(f"{n} string" for n in names))


def _local(path: str) -> str:
    """A path on a file system that driver and executors mount; ValueError for other stores, which only Spark reaches."""
    if re.match("[A-Za-z][A-Za-z0-9+.-]*:", path) and not path.startswith("file:"):
        raise ValueError(f"the xlsx source needs a mounted folder, not {path}; read_books() reads other stores")
    return re.sub("^file:/*", "/", path)


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema, self.options = schema, options

    def partitions(self) -> list[InputPartition]:
        path = _local(self.options["path"])
        if os.path.isdir(path):
            return [_File(os.path.join(path, f)) for f in sorted(os.listdir(path)) if f.endswith(".xlsx")]
        return [_File(path)]

    def read(self, partition: _File) -> Iterator[tuple]:
        cols = [int(c) for c in self.options.get("cols", "").split(",") if c] or list(range(1, len(self.schema) + 1))
        for _, cells in read_rows(partition.path, self.options.get("sheet", ""), int(self.options.get("startrow", 1))):
            yield tuple(cells.get(c) for c in cols)


class _Written(WriterCommitMessage):
    def __init__(self, path: str) -> None:
        self.path = path


# Fills of the header and of the tiers.
FILLS = {"header": "D9E1F2", "HOT": "FFD8D8", "WARM": "FFF2CC", "COLD": "E2EFDA"}
_STYLES = (
    '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><fonts count="2"><font/><font><b/></font></fonts>'
    '<fills count="6"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>'
    + "".join(f'<fill><patternFill patternType="solid"><fgColor rgb="FF{c}"/></patternFill></fill>' for c in FILLS.values())
    + '</fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="5"><xf/><xf fontId="1" fillId="2" applyFont="1" applyFill="1"/>'
    + "".join(f'<xf fillId="{i}" applyFill="1"/>' for i in (3, 4, 5)) + "</cellXfs></styleSheet>"
)


def _style(tier: object) -> int:
    """Cell style of a tier text: HOT, WARM or, for all else, COLD."""
    return 2 if "HOT" in str(tier or "") else 3 if "WARM" in str(tier or "") else 4


def write_book(path: str, sheet: str, header: list[str], rows: Iterator[tuple], tiers: str = "") -> None:
    """One workbook with one sheet; the header row is bold on a light fill.

    With a column named `tiers`, its text colours the first two cells of each row.
    """
    by = header.index(tiers) if tiers in header else None
    cell = lambda r, c, v, s="": f'<c r="{column_name(c)}{r}" t="inlineStr"{s}><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        types = "http://schemas.openxmlformats.org/package/2006/content-types"
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        z.writestr("[Content_Types].xml", f'<Types xmlns="{types}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/></Types>')
        rel = "http://schemas.openxmlformats.org/package/2006/relationships"
        doc = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        z.writestr("_rels/.rels", f'<Relationships xmlns="{rel}"><Relationship Id="rId1" Type="{doc}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{rel}"><Relationship Id="rId1" Type="{doc}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{doc}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{doc}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/styles.xml", _STYLES)
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            f.write(f'<worksheet xmlns="{_MAIN[1:-1]}"><sheetData>'.encode())
            f.write(f'<row r="1">{"".join(cell(1, i, h, " s=" + chr(34) + "1" + chr(34)) for i, h in enumerate(header, 1))}</row>'.encode())
            for r, row in enumerate(rows, 2):
                own = f' s="{_style(row[by])}"' if by is not None else ""
                f.write(f'<row r="{r}">{"".join(cell(r, i, v, own if i < 3 else "") for i, v in enumerate(row, 1) if v is not None)}</row>'.encode())
            f.write(b"</sheetData></worksheet>")


class _Writer(DataSourceWriter):
    def __init__(self, schema: StructType, options: dict, overwrite: bool) -> None:
        self.names, self.options, self.overwrite = schema.names, options, overwrite
        self.folder = _local(options["path"])

    def write(self, rows: Iterator) -> WriterCommitMessage:
        os.makedirs(self.folder, exist_ok=True)
        path = os.path.join(self.folder, f".part-{uuid.uuid4().hex}.xlsx")
        write_book(path, self.options.get("sheet", "Raw"), self.names, (tuple(r) for r in rows), self.options.get("tiers", ""))
        return _Written(path)

    def commit(self, messages: list) -> None:
        """Parts get their names once all are whole; an overwrite removes earlier ones first."""
        if self.overwrite:
            for f in os.listdir(self.folder):
                if f.startswith("part-"):
                    os.remove(os.path.join(self.folder, f))
        for i, m in enumerate(x for x in messages if x is not None):
            os.rename(m.path, os.path.join(self.folder, f"part-{i:05d}-{uuid.uuid4().hex[:8]}.xlsx"))

    def abort(self, messages: list) -> None:
        for m in messages:
            if m is not None and os.path.exists(m.path):
                os.remove(m.path)


class XlsxSource(DataSource):
    """Format `xlsx`: options sheet, startRow, cols (comma-separated numbers), width (columns if cols isn't given)."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> str:
        n = len([c for c in self.options.get("cols", "").split(",") if c]) or int(self.options.get("width", 1))
        return ", ".join(f"col{i} string" for i in range(1, n + 1))

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, {k.lower(): v for k, v in self.options.items()})

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(schema, {k.lower(): v for k, v in self.options.items()}, overwrite)
