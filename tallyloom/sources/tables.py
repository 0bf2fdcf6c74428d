"""Delimited tables with an explicit schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.text import quoted
from tallyloom.session import materialize
from tallyloom.sources.records import csv_cells, read_records


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    encoding: str | None = None,
    columns: Sequence[str] | None = None,
    sep: str = ",",
) -> DataFrame:
    """A CSV table with a header line, whose columns are found by the header's names, in any order.

    Columns of the file that the schema lacks are not read; columns that the file lacks raise.  Only the header is
    looked at before the scan.  Columns that are not asked for are not parsed.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if encoding:
        reader = reader.option("encoding", encoding)
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    in_file = [n.strip() for n in reader.csv(path).columns]
    types = {f.name: f.dataType for f in wanted.fields}
    if absent := [n for n in types if n not in in_file]:
        raise ValueError(f"{path} has no columns {absent}")
    df = reader.schema(T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in in_file])).csv(path)
    return df.select(*[quoted(n) for n in columns or wanted.names])


def read_many_csv(
    spark: SparkSession, folder: str, schema: str | T.StructType, name: str = "source", pattern: str = "*.csv", sep: str = ",", encoding: str | None = None
) -> DataFrame:
    """All CSV tables of a folder in one scan, each row naming its table.

    A table is a file ``folder/x.csv`` or a directory of part files ``folder/x``; files whose name does not fit the
    pattern are left alone.  Each file's columns are found by its own header, its first row that is not blank: rows are
    read as cells, and those headers, one row a file, are written and joined.  A column that a file lacks is null.
    Quoted cells may hold line breaks; see ``records.read_records``.
    """
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    records, _ = read_records(spark, folder, sep, encoding, pattern)
    records = records.filter("value <> ''")
    first = records.groupBy("_path").agg(F.min("row").alias("_top"), F.min_by("value", "row").alias("_header"))
    headers = first.select("_path", "_top", F.transform(csv_cells(F.col("_header"), sep), lambda c: F.trim(c)).alias("_names"))
    rows = records.join(materialize(headers, "csv_headers"), "_path").filter(F.col("row") > F.col("_top"))
    rows = rows.withColumn("_cells", csv_cells(F.col("value"), sep))
    cells = [F.get("_cells", F.array_position("_names", F.lit(f.name)).cast("int") - 1).try_cast(f.dataType).alias(f.name) for f in wanted.fields]
    return rows.select(*cells, path_name(F.col("_path"), 1).alias(name))


def path_name(path: Column, level: int) -> Column:
    """Name of a table (level 1) or of the folder above it (level 2), seen from the data file's path.

    Part files, a trailing '.csv' and a leading 'column=' of partitioned output do not count.  This
    runs for every row, so plain substring searches do the work and decoding only where it is needed.
    """
    is_part = F.substring_index(path, "/", -1).startswith("part-")
    name = F.when(is_part, _segment(path, level + 1)).otherwise(_segment(path, level))
    name = F.when(name.endswith(".csv"), F.substring(name, F.lit(1), F.length(name) - 4)).otherwise(name)
    name = F.when(name.contains("="), F.regexp_replace(name, r"^\w+=", "")).otherwise(name)
    return F.when(name.contains("%"), F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))).otherwise(name)


def _segment(path: Column, from_end: int) -> Column:
    return F.substring_index(F.substring_index(path, "/", -from_end), "/", 1)
