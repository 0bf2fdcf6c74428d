"""Reports as workbooks, one file for each ``file`` value, all or none of them in place."""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

# The format's limits, and its parts around the sheets.
MOST_ROWS = 1_048_576
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DOCUMENT = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def _cell(value: str | None) -> str:
    if value is None:
        return "<c/>"
    if re.fullmatch(r"-?(0|[1-9]\d{0,14})(\.\d+)?", value):
        return f"<c><v>{value}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(_CONTROL.sub("", value))}</t></is></c>'


def workbook_bytes(sheets: list[tuple[str, list[list[str | None]]]]) -> bytes:
    """A workbook of named sheets, in order, from rows of text cells; plain numbers are stored as numbers."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        ids = range(1, len(sheets) + 1)
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in ids)
        z.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{parts}</Types>')
        z.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_DOCUMENT}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(name[:31], {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, (name, _) in zip(ids, sheets))
        z.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_DOCUMENT}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{_DOCUMENT}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in ids)
        z.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships">{links}</Relationships>')
        for i, (name, rows) in zip(ids, sheets):
            if len(rows) > MOST_ROWS:
                raise ValueError(f"sheet {name} has {len(rows)} rows, more than its format holds")
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as f:
                f.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
                for row in rows:
                    f.write(f"<row>{''.join(map(_cell, row))}</row>".encode())
                f.write(b"</sheetData></worksheet>")
    return out.getvalue()


def build_workbooks(lines: DataFrame) -> DataFrame:
    """(file, content): a workbook for each file, from lines (file, sheet, position, line_no, cells).

    Sheets come in order of position, then name; rows are put where ``line_no`` says, blank ones in between.  A workbook
    is built by one task, and a report's sheets are small by their format.
    """

    def build(table: pa.Table) -> pa.Table:
        sheets: dict[tuple, list] = {}
        ordered = sorted(table.to_pylist(), key=lambda r: (r["position"] is None, r["position"] or 0, r["sheet"] or "", r["line_no"]))
        for r in ordered:
            rows = sheets.setdefault((r["position"], r["sheet"]), [])
            rows += [[] for _ in range(r["line_no"] - len(rows))] if r["line_no"] <= MOST_ROWS else []
            rows.append(r["cells"] or [])
        content = workbook_bytes([(name or "Sheet", rows) for (_, name), rows in sheets.items()])
        return pa.table({"file": pa.array([ordered[0]["file"]], pa.string()), "content": pa.array([content], pa.binary())})

    return lines.select("file", "sheet", "position", "line_no", "cells").groupBy("file").applyInArrow(build, "file string, content binary")


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]]


def _file_system(path: str):
    """pyarrow's file system and the path on it; plain and ``file:`` paths are mounts that all executors share."""
    from pyarrow import fs

    u = urlparse(path)
    if u.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(u.path) if u.scheme else path
    return fs.FileSystem.from_uri(path)


class _BookWriter(DataSourceWriter):
    """Tasks write under names of their own; files get theirs when all tasks have ended well, and are taken away otherwise."""

    def __init__(self, folder: str):
        self.folder = folder

    def write(self, iterator: Iterator) -> _Written:
        system, folder = _file_system(self.folder)
        staged = f"{folder}/_staged"
        system.create_dir(staged, recursive=True)
        done = []
        for row in iterator:
            name = re.sub(r"[/\\:\0]", "_", row["file"] or "workbook")
            at = f"{staged}/{uuid.uuid4().hex}"
            with system.open_output_stream(at) as f:
                f.write(row["content"])
            done.append((at, f"{folder}/{name}.xlsx"))
        return _Written(done)

    def commit(self, messages: list) -> None:
        system, folder = _file_system(self.folder)
        files = [f for m in messages if m for f in m.files]
        if len({place for _, place in files}) < len(files):
            self.abort(messages)
            raise ValueError("two workbooks would have one name")
        for at, place in files:
            system.move(at, place)
        if system.get_file_info(f"{folder}/_staged").type.name == "Directory":
            system.delete_dir(f"{folder}/_staged")

    def abort(self, messages: list) -> None:
        system, _ = _file_system(self.folder)
        for at, _ in [f for m in messages if m for f in m.files]:
            if system.get_file_info(at).type.name == "File":
                system.delete_file(at)


class BookSink(DataSource):
    """``df.write.format("tallyloom_books").mode("append").save(folder)`` for rows (file, content)."""

    @classmethod
    def name(cls) -> str:
        return "tallyloom_books"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _BookWriter(self.options["path"])


def write_workbooks(lines: DataFrame, folder: str) -> str:
    """Workbooks of all files as ``folder/file.xlsx``; see ``build_workbooks``.  Readers see all of them or none."""
    spark = lines.sparkSession
    spark.dataSource.register(BookSink)
    build_workbooks(lines).write.format("tallyloom_books").mode("append").save(folder)
    return folder
