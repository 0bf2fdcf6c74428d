"""Workbooks (zipped XML, ``.xlsx``): all sheets of all files as one table of text cells.

The files come from Spark's own scan, so any store that Spark reads will do; a task unpacks the workbooks of its
partition and streams their sheets, with the standard library, a row at a time.
"""

from __future__ import annotations

import datetime as dt
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Built-in number formats that show a date, and those that show a time of day alone.
_DATE_FORMATS = {14, 15, 16, 17, 22, *range(27, 37), *range(50, 59)}
_TIME_FORMATS = {18, 19, 20, 21, 45, 46, 47}

_BATCH = 2000
_SCHEMA = "path string, sheet string, position int, line_no bigint, cells array<string>"


def _tag(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _attribute(element, name: str) -> str | None:
    return next((v for k, v in element.attrib.items() if k.rsplit("}", 1)[-1] == name), None)


class _Book:
    """One open workbook: names and places of its sheets, shared strings, and which styles are dates."""

    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        self.names = {n.lower(): n for n in self.zip.namelist()}
        self.first_day, self.sheets = dt.datetime(1899, 12, 30), []
        top = self._targets("_rels/.rels", "").get("officeDocument", ["xl/workbook.xml"])[0]
        folder = posixpath.dirname(top)
        by_id = self._ids(f"{folder}/_rels/{posixpath.basename(top)}.rels", folder)
        for _, e in self._elements(top):
            if _tag(e) == "workbookPr" and e.get("date1904") in ("1", "true"):
                self.first_day = dt.datetime(1904, 1, 1)
            if _tag(e) == "sheet":
                kind, place = by_id.get(_attribute(e, "id"), (None, None))
                if kind == "worksheet":
                    self.sheets.append((e.get("name"), place))
        places = {kind: place for kind, place in by_id.values()}
        self.strings = self._strings(places.get("sharedStrings"))
        self.styles = self._styles(places.get("styles"))

    def _open(self, name: str):
        return self.zip.open(self.names[name.lower()])

    def _elements(self, name: str, events=("end",)):
        with self._open(name) as f:
            yield from ElementTree.iterparse(f, events)

    def _ids(self, name: str, folder: str) -> dict[str, tuple[str, str]]:
        """{id: (kind, place)} of a relationships part."""
        if name.lower() not in self.names:
            return {}
        found = {}
        for _, e in self._elements(name):
            if _tag(e) == "Relationship" and e.get("TargetMode") != "External":
                target = e.get("Target")
                place = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target))
                found[e.get("Id")] = (e.get("Type").rsplit("/", 1)[-1], place)
        return found

    def _targets(self, name: str, folder: str) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for kind, place in self._ids(name, folder).values():
            out.setdefault(kind, []).append(place)
        return out

    def _strings(self, name: str | None) -> list[str]:
        out = []
        if name and name.lower() in self.names:
            for _, e in self._elements(name):
                if _tag(e) == "si":
                    out.append(_text(e))
                    e.clear()
        return out

    def _styles(self, name: str | None) -> list[str | None]:
        """What each cell style shows: 'date', 'time', or None for anything else."""
        own: dict[int, str | None] = {}
        styles: list[str | None] = []
        if not name or name.lower() not in self.names:
            return styles
        for _, e in self._elements(name):
            if _tag(e) == "numFmt":
                own[int(e.get("numFmtId"))] = _shows(e.get("formatCode") or "")
            if _tag(e) == "cellXfs":
                for xf in e:
                    i = int(xf.get("numFmtId") or 0)
                    styles.append(own[i] if i in own else "date" if i in _DATE_FORMATS else "time" if i in _TIME_FORMATS else None)
        return styles

    def rows(self, place: str) -> Iterator[tuple[int, list[str | None]]]:
        """(row number from 0, cells) of a sheet; rows without any value are left out."""
        at, path = -1, []
        for event, e in self._elements(place, ("start", "end")):
            if event == "start":
                path.append(e)
                continue
            path.pop()
            if _tag(e) == "row":
                at = int(e.get("r")) - 1 if e.get("r") else at + 1
                cells: list[str | None] = []
                for c in e:
                    i = _column(c.get("r")) if c.get("r") else len(cells)
                    cells += [None] * (i + 1 - len(cells))
                    cells[i] = self._value(c)
                if any(v is not None for v in cells):
                    yield at, cells
                e.clear()
                if path:
                    path[-1].remove(e)

    def _value(self, c) -> str | None:
        kind, parts = c.get("t"), {_tag(x): x for x in c}
        if kind == "inlineStr":
            return _text(parts["is"]) if "is" in parts else None
        raw = parts["v"].text if "v" in parts else None
        if raw is None or kind == "e":
            return None
        if kind == "s":
            return self.strings[int(raw)]
        if kind == "b":
            return "TRUE" if raw == "1" else "FALSE"
        style = int(c.get("s") or 0)
        if kind in (None, "n") and style < len(self.styles) and self.styles[style]:
            return self._moment(float(raw), self.styles[style])
        return raw

    def _moment(self, serial: float, shows: str) -> str:
        """A day count as ISO text; the count of 1900 has a 29th of February."""
        days = serial + 1 if self.first_day.year == 1899 and 0 < serial < 60 and shows == "date" else serial
        try:
            moment = self.first_day + dt.timedelta(seconds=round(days * 86400))
        except OverflowError:
            return repr(serial)
        if shows == "time" and 0 <= serial < 1:
            return moment.strftime("%H:%M:%S")
        return moment.strftime("%Y-%m-%d" if moment.time() == dt.time() else "%Y-%m-%d %H:%M:%S")


def _shows(code: str) -> str | None:
    """Whether a number format shows a date or a time: by its letters, outside quotes, brackets and after a backslash."""
    bare = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.|_.|\*.', "", code.split(";")[0]).lower()
    if "general" in bare:
        return None
    return "date" if re.search("[dy]", bare) else "time" if re.search("[hs]", bare) else None


def _text(element) -> str:
    """The text of a string item, its runs joined, without phonetic hints."""
    out = []
    for e in element:
        if _tag(e) == "t":
            out.append(e.text or "")
        elif _tag(e) == "r":
            out += [t.text or "" for t in e if _tag(t) == "t"]
    return "".join(out)


def _column(reference: str) -> int:
    n = 0
    for letter in re.match("[A-Za-z]+", reference)[0].upper():
        n = 26 * n + ord(letter) - 64
    return n - 1


def workbook_rows(books: DataFrame) -> DataFrame:
    """Rows of every sheet of workbooks given as (path, content): file, sheet, position, line_no, cells, as ``read_sheet_set`` has them.

    ``position`` is the sheet's place in its workbook, from 1; ``line_no`` the row's, from 0, rows without any value being left out;
    ``cells`` texts, numbers as they are stored, dates and times as ISO text, errors and gaps null.  A workbook is read by
    one task; its sheets have at most 1,048,576 rows by their format.  A file that is no workbook raises.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("sheet", pa.string()), ("position", pa.int32()), ("line_no", pa.int64()), ("cells", pa.list_(pa.string()))])
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                book = _Book(content.as_py())
                for position, (sheet, place) in enumerate(book.sheets, 1):
                    rows = []
                    for at, cells in book.rows(place):
                        rows.append({"path": path, "sheet": sheet, "position": position, "line_no": at, "cells": cells})
                        if len(rows) == _BATCH:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                    yield pa.RecordBatch.from_pylist(rows, schema)

    rows = books.select("path", "content").mapInArrow(unpack, _SCHEMA)
    file = F.regexp_replace(F.substring_index("path", "/", -1), r"(?i)\.xls[xm]$", "")
    return rows.select(file.alias("file"), "sheet", "position", "line_no", "cells")


def read_workbooks(spark: SparkSession, root: str) -> DataFrame:
    """All workbooks below a folder; temporary ones ('~$...') are left alone.  See ``workbook_rows``."""
    books = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xls[xm]").load(root)
    return workbook_rows(books.filter(~F.substring_index("path", "/", -1).startswith("~$")))
