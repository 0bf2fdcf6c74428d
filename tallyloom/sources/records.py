"""Records of delimited text files, cut in parallel, with line breaks inside quoted cells.

A file is scanned as lines, by byte blocks.  Whether a line starts inside a quoted cell depends on all lines before it,
but each line only passes that bit on, sets it, clears it or flips it.  So lines are judged on their own, what blocks do
to the bit is combined by a prefix scan over blocks, and then each block knows its lines' state.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.session import materialize

# Encodings whose line ends are not single bytes, under the names that Spark's decoder takes.
_WIDE = {"UTF-16": "UTF-16LE", "UTF-16LE": "UTF-16LE", "UTF-16BE": "UTF-16BE"}
_AS_IS = ("UTF-8", "UTF8", "US-ASCII")

# What a line does to the bit "inside a quoted cell".
_KEEP, _CLEAR, _SET, _FLIP = range(4)


def csv_cells(line: Column, sep: str = ",") -> Column:
    """The cells of a CSV record: quotes removed, an empty cell is null, an empty quoted one an empty text."""
    s = re.escape(sep)
    raw = F.regexp_extract_all(
        F.concat(F.lit(sep), line), F.lit(rf'(?s){s}("[^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+"|[^{s}]*+)'), F.lit(1)
    )

    def cell(c: Column) -> Column:
        is_quoted = c.startswith('"') & c.endswith('"') & (F.length(c) > 1)
        inner = F.regexp_replace(F.substring(c, F.lit(2), F.length(c) - 2), r'\\"|""', '"')
        return F.when(c == "", None).when(is_quoted, inner).otherwise(c)

    return F.transform(raw, cell)


def ends_open(line: Column, sep: str = ",") -> Column:
    """Whether a line that starts a record ends inside a quoted cell.  A quote inside an unquoted cell is a mark like others."""
    s = re.escape(sep)
    opened = r'"[^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+'
    return line.rlike(rf'(?s)^(?:(?:{opened}"[^{s}]*+|[^"{s}][^{s}]*+|){s})*+{opened}\\?\z')


def read_lines(spark: SparkSession, root: str, encoding: str | None = None, pattern: str | None = None) -> DataFrame:
    """(_path, _block, _line, value): physical lines of all files below a folder, in order by (_block, _line) within a path."""
    reader = spark.read.option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    name = (encoding or "UTF-8").upper()
    value = F.col("value")
    if name in _WIDE:
        reader = reader.option("encoding", _WIDE[name]).option("lineSep", "\n")
        value = F.rtrim(F.decode(value.cast("binary"), _WIDE[name]), F.lit("\r"))
    elif name not in _AS_IS:
        value = F.decode(value.cast("binary"), name)
    return reader.text(root).select(
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"), F.ltrim(value, F.lit("\ufeff")).alias("value"),
    )


def read_records(
    spark: SparkSession, root: str, sep: str = ",", encoding: str | None = None, pattern: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(_path, row, value) of every record, and (_path, rows) of every file.

    ``row`` counts 0, 1, 2, ... in each file, blank records included; a record with line breaks inside quoted cells is
    one row, its lines joined by a line feed.  Where a file ends inside a quoted cell, that quote opened nothing: the
    lines from there on are rows of their own.  ``encoding`` is UTF-8, ISO-8859-1, UTF-16 (little-endian unless it says
    BE) or another one that Spark decodes.

    The scan is written once, and all later steps read that one table, so results do not depend on how a later
    scan splits the files.  Only files in which some line ends inside a quoted cell go through the prefix scan: its
    window runs over one byte block at a time, and over one row per block.
    """
    value = F.col("value")
    opens, closes = ends_open(value, sep), ~ends_open(F.concat(F.lit('"'), value), sep)
    kind = F.when(~value.contains('"'), _KEEP).when(opens & closes, _FLIP).when(opens, _SET).when(closes, _CLEAR).otherwise(_KEEP)
    lines = materialize(read_lines(spark, root, encoding, pattern).withColumn("_kind", F.when(value == "", _KEEP).otherwise(kind)), "lines")
    opening = F.max(F.col("_kind").isin(_FLIP, _SET))
    blocks = materialize(lines.groupBy("_path", "_block").agg(F.min("_line").alias("_first"), F.count("*").alias("_lines"), opening.alias("_opens")), "line_blocks")
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_lines").over(before), F.lit(0)) - F.col("_first")
    starts = blocks.select("_path", "_block", shift.alias("_shift"), F.max("_opens").over(Window.partitionBy("_path")).alias("_opens"))
    placed = lines.join(starts, ["_path", "_block"]).select("_path", "_block", (F.col("_line") + F.col("_shift")).alias("row"), "value", "_kind", "_opens")
    paths = blocks.groupBy("_path").agg(F.max("_opens").alias("_opens"), F.sum("_lines").alias("rows"))
    if not blocks.filter("_opens").limit(1).collect():  # one row at most
        return placed.select("_path", "row", "value"), paths.select("_path", "rows")
    records, sizes = _joined(placed.filter("_opens").drop("_opens"))
    plain = placed.filter("not _opens").select("_path", "row", "value")
    return plain.unionByName(records), paths.filter("not _opens").select("_path", "rows").unionByName(sizes)


def _scan(by: list[str], order: str, kind: Column) -> tuple[Column, Column]:
    """The last setting or clearing before each row (1, 0, or null if none), and how often rows have flipped since."""
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    flips = F.coalesce(F.sum((kind == _FLIP).cast("int")).over(before), F.lit(0))
    return F.last(F.when(kind == _SET, 1).when(kind == _CLEAR, 0), ignorenulls=True).over(before), flips


def _joined(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records and row counts of files with line breaks inside quoted cells, from their numbered lines."""
    by_block = ["_path", "_block"]
    kind = F.col("_kind")
    # Flips count from the last setting or clearing on: lines between two of them are a run of their own.
    run = F.sum(kind.isin(_SET, _CLEAR).cast("int")).over(Window.partitionBy(*by_block).orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
    last, _ = _scan(by_block, "row", kind)
    runs = lines.select("*", F.coalesce(run, F.lit(0)).alias("_run"), last.alias("_last"))
    _, flips = _scan([*by_block, "_run"], "row", kind)
    odd = runs.withColumn("_odd", flips % 2)
    # The state before each line, and the records begun with it, if its block starts outside a quoted cell (0), and inside one (1).
    both = odd.select(
        *by_block, "row", "value", "_kind", *[((F.coalesce("_last", F.lit(i)) + F.col("_odd")) % 2 == 1).alias(f"_s{i}") for i in (0, 1)]
    )
    upto = Window.partitionBy(*by_block).orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = materialize(both.select("*", *[F.sum((~F.col(f"_s{i}")).cast("bigint")).over(upto).alias(f"_n{i}") for i in (0, 1)]), "line_states")

    def after(state: Column) -> Column:
        return F.when(kind == _KEEP, state).when(kind == _FLIP, ~state).otherwise(kind == _SET)

    sums = [F.max("row").alias("_end")]
    for i in (0, 1):
        state = F.col(f"_s{i}")
        sums += [F.max_by(after(state), "row").alias(f"_e{i}"), F.max(f"_n{i}").alias(f"_n{i}"), F.max(F.when(~state, F.col("row"))).alias(f"_top{i}")]
    e0, e1 = F.col("_e0"), F.col("_e1")
    block = F.when(e0 & e1, _SET).when(e0, _FLIP).when(e1, _KEEP).otherwise(_CLEAR)
    ends = both.groupBy(*by_block).agg(*sums).withColumn("_kind", block)
    ends = materialize(_entered(ends), "block_states")

    def of(name: str) -> Column:
        return F.when(F.col("_inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    known = both.join(ends, by_block).withColumn("_s", of("_s"))
    loose = F.coalesce(F.col("row") >= F.col("_loose"), F.lit(False))
    record = F.when(loose, F.col("_all") - 1 + F.col("row") - F.col("_loose")).otherwise(F.col("_done") + of("_n") - 1)
    numbered = known.select("_path", record.alias("record"), "row", "value", (loose | (~F.col("_s") & ~after(F.col("_s")))).alias("_single"))
    alone = numbered.filter("_single").select("_path", F.col("record").alias("row"), "value")
    parts = numbered.filter("not _single").groupBy("_path", "record").agg(F.sort_array(F.collect_list(F.struct("row", "value"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    joined = parts.select("_path", F.col("record").alias("row"), text.alias("value"))
    rows = F.max(F.coalesce(F.col("_all") - 1 + F.col("_lines") - F.col("_loose"), "_all")).alias("rows")
    return alone.unionByName(joined), ends.groupBy("_path").agg(rows)


def _entered(ends: DataFrame) -> DataFrame:
    """For each block whether it starts inside a quoted cell and how many records begin before it; per file their number,
    that of its lines, and the line from which on lines are records of their own, where the file ends inside a quoted cell."""
    run = F.sum(F.col("_kind").isin(_SET, _CLEAR).cast("int")).over(Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    last, _ = _scan(["_path"], "_block", F.col("_kind"))
    runs = ends.select("*", F.coalesce(run, F.lit(0)).alias("_run"), last.alias("_last"))
    _, flips = _scan(["_path", "_run"], "_block", F.col("_kind"))
    known = runs.withColumn("_inside", (F.coalesce("_last", F.lit(0)) + flips) % 2 == 1)

    def of(name: str) -> Column:
        return F.when(F.col("_inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    known = known.select("_path", "_block", "_inside", "_end", of("_e").alias("_e"), of("_n").alias("_begun"), of("_top").alias("_top"))
    whole, before = Window.partitionBy("_path"), Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    lost = F.max_by("_e", "_block").over(whole)
    return known.select(
        "_path", "_block", "_inside", F.coalesce(F.sum("_begun").over(before), F.lit(0)).alias("_done"), F.sum("_begun").over(whole).alias("_all"),
        (F.max("_end").over(whole) + 1).alias("_lines"), F.when(lost, F.max("_top").over(whole)).alias("_loose"),
    )
