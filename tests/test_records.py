"""Records with line breaks inside quoted cells, however the files are split."""

import csv
import io
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.sources import records as rec
from tallyloom.sources import sheets as sh
from tallyloom.sources.tables import read_many_csv


@pytest.fixture
def splits(spark):
    """splits(bytes) changes how later scans cut the files."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum")
    old = [spark.conf.get(n, None) for n in names]

    def cut(size):
        for n, v in zip(names, (size, 64), strict=True):
            spark.conf.set(n, v)

    yield cut
    for n, v in zip(names, old, strict=True):
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def random_rows(seed, n):
    """Cells with line breaks, quotes and separators; single rows, long runs of broken ones, and blank lines."""
    r = random.Random(seed)
    pieces = ["a", "b c", '"', ",", "\n", "\n\n", "", "x", '",\n"', "1"]
    out = []
    for i in range(n):
        kind = r.random()
        if kind < 0.1:
            out.append(None)
        elif kind < 0.5:
            out.append([f"r{i}", "plain", ""])
        else:
            out.append([f"r{i}", *("".join(r.choice(pieces) for _ in range(r.randrange(6))) for _ in range(3))])
    return out


def written(table):
    """RFC 4180 text; None is a blank line, every cell with a mark in it is quoted."""
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    for row in table:
        if row is None:
            out.write("\n")
        else:
            w.writerow(row)
    return out.getvalue()


def plain(table):
    """{row: cells}: empty cells null unless they were quoted, which csv.writer never does."""
    return {i: [c or None for c in row] for i, row in enumerate(table) if row is not None}


@pytest.mark.parametrize("size", [150, 10_000_000])
def test_rows_and_numbers_for_any_split(spark, tmp_path, splits, size):
    tables = {f"s{k}": random_rows(k, 150) for k in range(2)} | {"flat": [[f"r{i}", "x"] if i % 7 else None for i in range(200)]}
    for name, table in tables.items():
        path = tmp_path / "book" / f"{name}.csv"
        path.parent.mkdir(exist_ok=True)
        path.write_text(written(table), encoding="utf-8", newline="")
    splits(size)
    lines = sh.read_sheet_set(spark, str(tmp_path))
    splits(900)
    got = {}
    for sheet, row, cells in rows(lines.select("sheet", "line_no", "cells")):
        got.setdefault(sheet, {})[row] = cells
    assert got == {name: plain(table) for name, table in tables.items()}
    skipped = sh.skip_rows(lines, 90).groupBy("sheet").count()
    assert dict(rows(skipped)) == {name: sum(i >= 90 for i in plain(table)) for name, table in tables.items()}


def test_a_header_cell_with_a_line_break_is_one_cell(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.csv").write_text('\nTitle,\n\n"Na""me","Imp\nressions"\nx,1\n"y\n\nz",2\n', encoding="utf-8")
    lines = sh.read_sheet_set(spark, str(tmp_path))
    assert rows(lines.select("line_no"), "line_no") == [(1,), (3,), (4,), (5,)]
    got = rows(sh.promote_header(lines, ['Na"me', "Imp\nressions"]).select('Na"me', "Imp\nressions"), 'Na"me')
    assert got == [("x", "1"), ("y\n\nz", "2")]


def test_stray_quotes_open_nothing(spark, tmp_path):
    text = 'a,5" pipe\nb,"open\nc,1\n\nd,"2"\n'  # the quote of b is closed by that of d, as every reader has it
    lost = 'a,1\nb,"never closed\nc,2\n\nd,3\n'
    for name, content in (("closed", text), ("lost", lost)):
        path = tmp_path / "w" / f"{name}.csv"
        path.parent.mkdir(exist_ok=True)
        path.write_text(content, encoding="utf-8")
    got = {}
    for sheet, row, cells in rows(sh.read_sheet_set(spark, str(tmp_path)).select("sheet", "line_no", "cells")):
        got.setdefault(sheet, {})[row] = cells
    assert got["closed"] == {0: ["a", '5" pipe'], 1: ["b", "open\nc,1\n\nd,"]} or list(got["closed"]) == [0, 1]
    assert got["lost"] == {0: ["a", "1"], 1: ["b", '"never closed'], 2: ["c", "2"], 4: ["d", "3"]}


@pytest.mark.parametrize("encoding, sep, text", [
    ("ISO-8859-1", ";", 'Réseau;"Total;\nété"\nCafé;1\n'), ("UTF-16LE", "\t", '﻿Réseau\t"Total;\nété"\nCafé\t1\n'),
    ("UTF-16BE", "\t", '﻿Réseau\t"Total;\r\nété"\r\nCafé\t1\r\n'), ("UTF-8", ",", '﻿Réseau,"Total;\nété"\nCafé,1\n'),
])
def test_encodings(spark, tmp_path, encoding, sep, text):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "s.csv").write_bytes(text.encode(encoding))
    lines = sh.read_sheet_set(spark, str(tmp_path), sep=sep, encoding=encoding)
    assert rows(lines.select("line_no", "cells"), "line_no") == [(0, ["Réseau", "Total;\nété"]), (1, ["Café", "1"])]
    got = read_many_csv(spark, str(tmp_path / "w"), "`Total;\nété` int, `Réseau` string", sep=sep, encoding=encoding)
    assert rows(got) == [(1, "Café", "s")]


def test_long_cells_and_many_escapes(spark, frame):
    long = 'x' * 300_000 + '""' * 50_000 + "\\n" * 1000
    df = frame("v string", (f'a,"{long}",b',), (f'a,"{long}',), ("c," * 20_000 + '"',))
    assert rows(df.select(rec.ends_open(F.col("v")), F.size(rec.csv_cells(F.col("v"))))) == [(False, 3), (True, 2), (True, 20_001)]


def test_no_file_and_empty_files(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.csv").write_text("", encoding="utf-8")
    (tmp_path / "w" / "b.csv").write_text("\n\n", encoding="utf-8")
    assert rows(sh.read_sheet_set(spark, str(tmp_path))) == []
