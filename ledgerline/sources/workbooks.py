"""Workbooks and archives: their sheets' cells and merged ranges, their members, as functions of contents in a table and as data sources.

A row of cells is a filled cell, tagged n (number), d (date, as ISO text), b (boolean) or s (text), or, tagged m, a merged range with its last
row and column. Only the parts of a workbook that are asked for are opened; cells come some thousands at a time.
"""

from __future__ import annotations

import datetime
import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from typing import IO
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

CELLS = "file string, sheet string, row int, col int, value string, ctype string, last_row int, last_col int"
MEMBERS = "archive string, member string, size long, content binary"
DATA_MEMBERS = (".csv", ".xlsx", ".xls")
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Numbers of the format's own date and time formats. Fixed values.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
#: Cells that are handed on together.
HELD = 50_000
#: Files whose sheets or members become input partitions of their own; of more files each file is one.
PLANNED = 1000


def column_number(letters: str) -> int:
    n = 0
    for c in letters:
        n = n * 26 + ord(c) - 64
    return n


def corner(reference: str) -> tuple[int, int]:
    letters, digits = re.fullmatch(r"\$?([A-Z]+)\$?(\d+)", reference).groups()
    return int(digits), column_number(letters)


def opened(content: IO[bytes], path: str) -> zipfile.ZipFile:
    try:
        return zipfile.ZipFile(content)
    except zipfile.BadZipFile as e:
        raise ValueError(f"{path} is damaged or not of its kind") from e


@dataclass
class Workbook:
    """An open workbook. `sheets` are its sheets' parts by title, in order."""

    book: zipfile.ZipFile
    path: str

    def part(self, name: str) -> ElementTree.Element | None:
        return ElementTree.fromstring(self.book.read(name)) if name in self.book.namelist() else None

    @cached_property
    def sheets(self) -> dict[str, str]:
        told, links = self.part("xl/workbook.xml"), self.part("xl/_rels/workbook.xml.rels")
        if told is None:
            raise ValueError(f"{self.path} is damaged or not of its kind")
        target = {} if links is None else {r.get("Id"): r.get("Target") for r in links}
        numbered = sorted((n for n in self.book.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n).group()))
        found = {}
        for place, sheet in enumerate(told.iter(f"{MAIN}sheet")):
            to = target.get(sheet.get(RELATION))
            found[sheet.get("name")] = numbered[place] if to is None else to.lstrip("/") if to.startswith("/") else f"xl/{to}"
        return found

    def chosen(self, wanted: Iterable[str] | None, single: bool = False) -> list[str]:
        """The titles asked for that there are; with `single` exactly one, an error if it is missing or, none being named, there are several."""
        titles = list(self.sheets)
        if single and wanted is None and len(titles) > 1:
            raise ValueError(f"{self.path} has several sheets, of which one must be named: {', '.join(titles[:5])}")
        out = titles if wanted is None else [t for t in titles if t in set(wanted)]
        if single and not out:
            raise ValueError(f"{self.path} has no such sheet; there are {', '.join(titles[:5])}")
        return out

    @cached_property
    def shared(self) -> list[str]:
        if "xl/sharedStrings.xml" not in self.book.namelist():
            return []
        out = []
        with self.book.open("xl/sharedStrings.xml") as xml:
            for _, item in ElementTree.iterparse(xml):
                if item.tag == f"{MAIN}si":
                    out.append("".join(t.text or "" for t in item.iter(f"{MAIN}t")))
                    item.clear()
        return out

    @cached_property
    def dated(self) -> list[bool]:
        """For each cell style whether its number format shows a date or time."""
        styles = self.part("xl/styles.xml")
        if styles is None:
            return []
        own = {int(f.get("numFmtId")): f.get("formatCode") for f in styles.iter(f"{MAIN}numFmt")}
        formats = [int(x.get("numFmtId") or 0) for group in styles.iter(f"{MAIN}cellXfs") for x in group]
        return [shows_date(own[n]) if n in own else n in DATE_FORMATS for n in formats]

    @cached_property
    def first_day(self) -> datetime.datetime:
        told = self.part("xl/workbook.xml").find(f"{MAIN}workbookPr")
        return datetime.datetime(1904, 1, 1) if told is not None and told.get("date1904") in ("1", "true") else datetime.datetime(1899, 12, 30)

    def day(self, number: str) -> str:
        at = self.first_day + datetime.timedelta(seconds=round(float(number) * 86_400))
        return at.date().isoformat() if not (at.hour or at.minute or at.second) else at.isoformat(sep=" ")

    def rows(self, title: str) -> Iterator[tuple]:
        """(row, col, value, tag, last row, last column) of the sheet's filled cells, then of its merged ranges."""
        with self.book.open(self.sheets[title]) as xml:
            for _, e in ElementTree.iterparse(xml):
                if e.tag == f"{MAIN}mergeCell":
                    first, _, last = e.get("ref").partition(":")
                    yield *corner(first), None, "m", *corner(last or first)
                elif e.tag == f"{MAIN}c":
                    value, tag = self.cell(e)
                    if value:
                        yield *corner(e.get("r")), value, tag, None, None
                    e.clear()

    def cell(self, e: ElementTree.Element) -> tuple[str | None, str]:
        kind, value = e.get("t", "n"), e.find(f"{MAIN}v")
        if kind == "inlineStr":
            return "".join(t.text or "" for t in e.iter(f"{MAIN}t")), "s"
        if value is None or not value.text:
            return None, "s"
        if kind == "s":
            return self.shared[int(value.text)], "s"
        if kind == "d":
            return value.text.removesuffix("T00:00:00").replace("T", " "), "d"
        style = int(e.get("s") or 0)
        if kind == "n" and style < len(self.dated) and self.dated[style]:
            return self.day(value.text), "d"
        return value.text, kind if kind in "nb" else "s"


def shows_date(code: str) -> bool:
    plain = re.sub(r'"[^"]*"|\\.|_.|\*.|\[(?![hms]+\])[^\]]*\]', "", code, flags=re.I)
    return bool(re.search("[dmyhs]", plain, re.I)) and plain.lower() != "general"


def batches(path: str, content: IO[bytes], wanted: Iterable[str] | None = None, single: bool = False) -> Iterator[pa.RecordBatch]:
    """The rows of the sheets of a workbook that are asked for."""
    with opened(content, path) as book:
        workbook, held = Workbook(book, path), []
        for title in workbook.chosen(wanted, single):
            for row in workbook.rows(title):
                held.append((path, title, *row))
                if len(held) == HELD:
                    yield batch_of(held)
                    held = []
        if held:
            yield batch_of(held)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["file", "sheet", "row", "col", "value", "ctype", "last_row", "last_col"])


def contents_of(files: DataFrame, sheet: str | None = None, single: bool = False) -> DataFrame:
    """Cells and merged ranges of workbooks (path, content)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for path, content in zip(part["path"].to_pylist(), part["content"], strict=True):
                yield from batches(path, pa.BufferReader(content.as_buffer()), None if sheet is None else [sheet], single)

    return files.select("path", "content").mapInArrow(run, CELLS)


def cells_of(files: DataFrame, sheet: str | None = None) -> DataFrame:
    """The filled cells of workbooks (path, content)."""
    return contents_of(files, sheet).where("ctype <> 'm'").drop("last_row", "last_col")


def merges_of(contents: DataFrame) -> DataFrame:
    """The merged ranges among `contents_of`, as sheets.resolved takes them."""
    return contents.where("ctype = 'm'").select("file", "sheet", F.col("row").alias("first_row"), "last_row", F.col("col").alias("first_col"), "last_col")


def read_cells(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """The cells of every sheet, or the one named, of every workbook in a folder, each file read once."""
    return cells_of(spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path), sheet)


def members(path: str, content: IO[bytes], wanted: Iterable[str] | None = None) -> Iterator[pa.RecordBatch]:
    """The data members of an archive that are asked for, one at a time."""
    with opened(content, path) as archive:
        for info in archive.infolist():
            if not info.is_dir() and info.filename.lower().endswith(DATA_MEMBERS) and (wanted is None or info.filename in wanted):
                yield pa.RecordBatch.from_pydict({"archive": [path], "member": [info.filename], "size": pa.array([info.file_size], pa.int64()), "content": pa.array([archive.read(info)], pa.binary())})


# --- data sources ----------------------------------------------------------------------------------------


@dataclass
class Part(InputPartition):
    """A file, and the sheets or members of it to read (None: all)."""

    path: str
    names: tuple[str, ...] | None

    def __post_init__(self) -> None:
        super().__init__(self.path)


@dataclass
class Reader(DataSourceReader):
    """Reads the files at a path (a file or a folder, local or by URI), one partition for each file and sheet or member.

    Tests of the file's name and of the sheet's or member's are taken over from the query, so that no other is opened.
    """

    path: str
    suffix: str
    keys: tuple[str, str]
    asked: dict[str, set[str]] = field(default_factory=dict)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute[0] in self.keys:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                name = f.attribute[0]
                self.asked[name] = self.asked[name] & values if name in self.asked else values
            else:
                yield f

    def found(self) -> list[str]:
        system, inside = located(self.path)
        listed = system.get_file_info(inside)
        if listed.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [listed.path] if listed.type == fs.FileType.File else [i.path for i in system.get_file_info(fs.FileSelector(inside)) if i.type == fs.FileType.File and i.path.lower().endswith(self.suffix)]
        only = self.asked.get(self.keys[0])
        return sorted(f for f in files if only is None or f in only)

    def names(self, path: str, content: IO[bytes]) -> list[str]:
        raise NotImplementedError

    def partitions(self) -> list[Part]:
        files, only = self.found(), self.asked.get(self.keys[1])
        if len(files) > PLANNED:
            return [Part(f, None if only is None else tuple(sorted(only))) for f in files]
        out = []
        for f in files:
            with located(self.path)[0].open_input_file(f) as content:
                out += [Part(f, (n,)) for n in self.names(f, content) if only is None or n in only]
        return out or [Part("", ())]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if partition.path:
            with located(self.path)[0].open_input_file(partition.path) as content:
                yield from self.batches(partition, content)

    def batches(self, partition: Part, content: IO[bytes]) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError


def located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else (fs.LocalFileSystem(), path)


class WorkbookReader(Reader):
    def names(self, path: str, content: IO[bytes]) -> list[str]:
        with opened(content, path) as book:
            return list(Workbook(book, path).sheets)

    def batches(self, partition: Part, content: IO[bytes]) -> Iterator[pa.RecordBatch]:
        return batches(partition.path, content, partition.names)


class ArchiveReader(Reader):
    def names(self, path: str, content: IO[bytes]) -> list[str]:
        with opened(content, path) as archive:
            return [n for n in archive.namelist() if not n.endswith("/") and n.lower().endswith(DATA_MEMBERS)]

    def batches(self, partition: Part, content: IO[bytes]) -> Iterator[pa.RecordBatch]:
        return members(partition.path, content, partition.names)


class WorkbookSource(DataSource):
    """`spark.read.format("workbook").load(path)`: cells and merged ranges."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema: object) -> Reader:
        return WorkbookReader(self.options["path"], ".xlsx", ("file", "sheet"))


class ArchiveSource(DataSource):
    """`spark.read.format("archive").load(path)`: the data members."""

    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema: object) -> Reader:
        return ArchiveReader(self.options["path"], ".zip", ("archive", "member"))


def register(spark: SparkSession) -> None:
    """Makes the formats workbook and archive known to `spark`, which then hands them the tests they take over."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (WorkbookSource, ArchiveSource):
        spark.dataSource.register(source)


def read_workbook(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """Cells and merged ranges of one sheet of each workbook at `path`; an error where there is none of that name, or several and none is named."""
    return contents_of(spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path), sheet, single=True)


def workbook_bytes(sheets: dict[str, tuple[list[list[object]], list[str]]]) -> bytes:
    """A workbook of rows and merged ranges by sheet title: a small writer for inputs and tests. Dates get a date style."""
    out, ns = io.BytesIO(), 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    links = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'

    def cell(row: int, col: int, v: object) -> str:
        letters = ""
        while col:
            col, rest = divmod(col - 1, 26)
            letters = chr(65 + rest) + letters
        if v is None:
            return ""
        if isinstance(v, bool):
            return f'<c r="{letters}{row}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, datetime.date):
            return f'<c r="{letters}{row}" s="1"><v>{(v - datetime.date(1899, 12, 30)).days}</v></c>'
        text = str(v).replace("&", "&amp;").replace("<", "&lt;")
        return f'<c r="{letters}{row}"><v>{v}</v></c>' if isinstance(v, int | float) else f'<c r="{letters}{row}" t="inlineStr"><is><t>{text}</t></is></c>'

    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f"<workbook {ns} {links}><sheets>" + "".join(f'<sheet name="{t}" sheetId="{i}" r:id="r{i}"/>' for i, t in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><numFmts><numFmt numFmtId="164" formatCode="dd&quot; of &quot;mmm yyyy"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>')
        for i, (rows, merges) in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row, 1)) + "</row>" for r, row in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {ns}><sheetData>{body}</sheetData><mergeCells>" + "".join(f'<mergeCell ref="{m}"/>' for m in merges) + "</mergeCells></worksheet>")
    return out.getvalue()
