"""Sheet sets: workbooks as folders of CSV sheets, ``root/workbook/sheet.csv``.

All sheets of all workbooks are one scan.  A sheet is kept as numbered lines of text cells, as many as each line has,
until its header is known, so ragged and differently named sheets need no pass of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.text import contains_word
from tallyloom.session import materialize
from tallyloom.sources.records import csv_cells, read_records
from tallyloom.sources.tables import path_name

# A line number takes the lower bits where it is packed with a count of cells.
_LINE_BITS = 40


def read_sheet_set(spark: SparkSession, root: str, sep: str = ",", encoding: str | None = None) -> DataFrame:
    """Rows of every sheet: file, sheet, position, line_no and the array of its text cells.

    ``position`` is the sheet's place in its workbook, from a name such as '2. Week', whose sheet is 'Week'; null
    without a number.  ``line_no`` counts 0, 1, 2, ... in each sheet, over several part files if there are such.
    Blank rows count, but are left out; a row whose quoted cells hold line breaks is one.  See ``records.read_records``.
    """
    records, sizes = read_records(spark, root, sep, encoding)
    name = path_name(F.col("_path"), 1)
    numbered = F.regexp_extract(name, r"^(\d+)\. (.+)$", 1)
    sheets = sizes.select(
        path_name(F.col("_path"), 2).alias("file"),
        F.when(numbered == "", name).otherwise(F.regexp_extract(name, r"^(\d+)\. (.+)$", 2)).alias("sheet"),
        numbered.try_cast("int").alias("position"),
        "_path", "rows",
    )
    before = Window.partitionBy("file", "sheet", "position").orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    sheets = sheets.withColumn("_shift", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows")
    placed = records.filter("value <> ''").join(sheets, "_path")
    return materialize(placed.select("file", "sheet", "position", (F.col("row") + F.col("_shift")).alias("line_no"), csv_cells(F.col("value"), sep).alias("cells")), "sheet_lines")


def list_sheets(lines: DataFrame) -> DataFrame:
    return lines.select("file", "sheet", "position").distinct()


def skip_rows(lines: DataFrame, n: int) -> DataFrame:
    """Leave out the first n rows of every sheet, blank ones included."""
    return lines.filter(F.col("line_no") >= n)


def classify_file(name: Column, words: dict[str, str], exclude: Sequence[str] = (), temp_marks: Sequence[str] = ("~$",)) -> Column:
    """Role of a file by the first word its lower-cased name contains; null for excluded or temp files."""
    low = F.lower(name)
    out = F.lit(False)
    for mark in [*exclude, *temp_marks]:
        out = out | low.contains(mark)
    role = F.lit(None).cast("string")
    for word, value in reversed(list(words.items())):
        role = F.when(low.contains(word), value).otherwise(role)
    return F.when(~out, role)


def sheet_role(name: Column, rules: Sequence[tuple[str, str]], precedence: str = "first") -> Column:
    """Role of a sheet by (role, regex) rules on its lower-cased name; the first or the last match wins."""
    ordered = rules if precedence == "last" else list(reversed(rules))
    role = F.lit(None).cast("string")
    for value, pattern in ordered:
        role = F.when(F.lower(name).rlike(pattern), value).otherwise(role)
    return role


def first_sheet_per_role(sheets: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """For each workbook and role, the first sheet in workbook order whose name fits; one sheet may serve several
    roles.  Sheets without a position follow the others, by name."""
    fits = F.array(*[F.when(F.lower("sheet").rlike(p), F.lit(r)) for r, p in rules])
    roles = sheets.select("file", "sheet", "position", F.explode(F.array_compact(fits)).alias("role"))
    place = F.struct(F.col("position").isNull(), "position", "sheet")
    return roles.groupBy("file", "role").agg(F.min_by("sheet", place).alias("sheet"))


def sheet_headers(lines: DataFrame, label: str = "Total") -> DataFrame:
    """Per sheet the line of its header, the header's cells, and which columns are in use.

    The header is the first of the fullest lines.  A column is in use if any line below the header, other than a
    total row, has a value in it.  Both come from hash aggregates over packed numbers (a sheet has fewer than 2 ** 40
    lines, a line fewer than 2 ** 20 cells); only the header lines themselves are fetched.
    """
    filled = F.size(F.filter("cells", lambda c: c.isNotNull())).cast("bigint")
    rank = F.shiftleft(F.lit(1 << 20) - filled, _LINE_BITS) + F.col("line_no")
    at = lines.groupBy("file", "sheet").agg(F.min(rank).bitwiseAND(F.lit((1 << _LINE_BITS) - 1)).alias("header_line"))
    at = materialize(at, "header_lines")
    header = lines.join(at, ["file", "sheet"]).filter("line_no = header_line")
    header = header.select("file", "sheet", "header_line", F.transform("cells", lambda c: F.trim(c)).alias("header"))
    data = lines.filter(~contains_word(F.get("cells", F.lit(0)), label)).select("file", "sheet", "line_no", F.posexplode("cells").alias("column", "cell"))
    last = data.filter("cell is not null").groupBy("file", "sheet", "column").agg(F.max("line_no").alias("last"))
    used = last.join(at, ["file", "sheet"]).filter("last > header_line").groupBy("file", "sheet").agg(F.sort_array(F.collect_list("column")).alias("used"))
    return header.join(used, ["file", "sheet"], "left").withColumn("used", F.coalesce("used", F.array().cast("array<int>")))


def promote_header(lines: DataFrame, names: Sequence[str] | None = None, headers: DataFrame | None = None) -> DataFrame:
    """Lines below the header of their sheet, with its cells as ``header``.

    With names, those columns are picked out of the cells by header name, absent ones being null.  ``headers`` is a
    written table of ``sheet_headers``, where several steps start from the same sheets.
    """
    found = materialize(sheet_headers(lines), "headers") if headers is None else headers
    below = lines.join(found, ["file", "sheet"]).filter(F.col("line_no") > F.col("header_line")).drop("header_line")
    if names is None:
        return below
    return below.select("file", "sheet", "line_no", *[cell_named(n).alias(n) for n in names])


def cell_at(index: int) -> Column:
    return F.get("cells", F.lit(index))


def cell_named(name: str) -> Column:
    return F.get("cells", F.array_position("header", F.lit(name)).cast("int") - 1)


def measure_cell() -> Column:
    """The impressions cell, by the rules of ``operators.columns.measure_column``; null if none fits."""

    def positions(test) -> Column:
        return F.filter(
            F.transform("header", lambda h, i: F.when(test(F.lower(h)), i)), lambda i: i.isNotNull()
        )

    rules = [
        positions(lambda h: h.contains("imp")),
        positions(lambda h: h.contains("net counted ads") | h.contains("imp")),
        positions(lambda h: h.contains("imp") & h.contains("deliver")),
    ]
    place = F.lit(None).cast("int")
    for fits in reversed(rules):
        place = F.when(F.size(fits) == 1, fits[0]).otherwise(place)
    return F.get("cells", place)


def clean_records(records: DataFrame, label: str = "Total") -> DataFrame:
    """Drop total rows, then rows with a gap in any column that their sheet uses."""
    complete = F.forall("used", lambda i: F.get("cells", i).isNotNull())
    return records.filter(~contains_word(cell_at(0), label) & complete).drop("used")


# What a cell can be, as bits that are merged by or, and the patterns of numbers in text.
_INTEGER, _DECIMAL, _DOUBLE, _DATE, _TEXT = 1, 2, 4, 8, 16
_KINDS = ((_INTEGER, r"^[+-]?\d{1,18}$"), (_DECIMAL, r"^[+-]?(\d{0,28}\.\d{1,10}|\d{19,28})$"), (_DOUBLE, r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf(inity)?)$"))
_TYPES = {"integer": "bigint", "decimal": "decimal(38,10)", "double": "double", "date": "date", "text": "string", "empty": "string"}


def cell_kind(cell: Column) -> Column:
    """The bit of one cell; null for a gap."""
    text = F.trim(cell)
    kind = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull(), _DATE).otherwise(_TEXT)
    for bit, pattern in reversed(_KINDS):
        kind = F.when(text.rlike(pattern), bit).otherwise(kind)
    return F.when(text != "", kind)


def sheet_types(records: DataFrame) -> DataFrame:
    """(file, sheet, column, name, type, n): the narrowest type that all cells of a sheet's column have.

    From records with their header, as ``promote_header`` gives them.  Types form a lattice: integer below decimal below double, dates
    beside them, text above all; gaps do not count, and a column of gaps is 'empty'.  What a set of cells is, is an or of
    bits, so one aggregate with partial sums serves all sheets, and no sheet is looked at on its own.
    """
    width = F.greatest(F.size("header"), F.size("cells"))
    both = F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.struct(F.get("header", i).alias("name"), F.get("cells", i).alias("cell")))
    cells = records.select("file", "sheet", F.posexplode(both).alias("column", "c"))
    found = cells.select("file", "sheet", "column", "c.name", cell_kind(F.col("c.cell")).alias("kind")).groupBy("file", "sheet", "column", "name").agg(
        F.bit_or("kind").alias("kinds"), F.count("kind").alias("n")
    )
    k = F.col("kinds")
    above = F.when(k == _DATE, "date").when(k >= _DATE, "text").when(k >= _DOUBLE, "double").when(k >= _DECIMAL, "decimal").when(k == _INTEGER, "integer")
    return found.select("file", "sheet", "column", "name", F.coalesce(above, F.lit("empty")).alias("type"), "n")


def typed_sheet(records: DataFrame, types: DataFrame, file: str, sheet: str) -> DataFrame:
    """The rows of one sheet as a table: columns named by its header, each with the type that all its cells have.

    ``types`` is ``sheet_types`` of the same records, best written before; a row per column of the sheet comes to the driver.
    Columns without a name are called after their place; a name that repeats gets its place added.
    """
    own = (F.col("file") == file) & (F.col("sheet") == sheet)
    columns, names = types.filter(own).orderBy("column").collect(), set()
    out = []
    for c in columns:
        name = c["name"] or f"column {c['column']}"
        name = f"{name} {c['column']}" if name in names else name
        names.add(name)
        out.append(F.trim(cell_at(c["column"])).try_cast(_TYPES[c["type"]]).alias(name) if c["type"] != "text" else cell_at(c["column"]).alias(name))
    return records.filter(own).select(*out)
