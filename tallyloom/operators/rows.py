"""Filters, row selection by order, and row positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.text import contains_word, quoted
from tallyloom.operators.selection import rows_between
from tallyloom.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def remove_total_rows(df: DataFrame, column: str, mode: str = "contains", word: str = "Total") -> DataFrame:
    """Drop total rows: those whose label contains the word, or equals it.  Null labels stay."""
    label = F.col(column).cast("string")
    hit = contains_word(label, word) if mode == "contains" else F.coalesce(label == word, F.lit(False))
    return df.filter(~hit)


def drop_any_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna("any", subset=list(columns) or None)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are null in every row.  One aggregate; one row comes back to the driver."""
    filled = df.agg(*[F.count(F.col(quoted(c))).alias(c) for c in df.columns]).first()
    return df.drop(*[c for c in df.columns if filled[c] == 0])


def ascending(*order: Column | str) -> list[Column]:
    """Names as ascending order with nulls last, as everywhere here; columns are taken as they are."""
    return [F.col(quoted(c)).asc_nulls_last() if isinstance(c, str) else c for c in order]


def head_n(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    return df.orderBy(*ascending(*order)).limit(n)


def tail_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The last n rows in the given ascending order (nulls last, as everywhere here)."""
    return df.orderBy(*[F.col(quoted(c)).desc_nulls_first() for c in order]).limit(n)


def slice_rows(df: DataFrame, start: int, stop: int, *order: str) -> DataFrame:
    """Rows start ... stop-1 in the given order, at any depth, without sorting or writing the table.

    The keys at both ends are found by counting (``selection.keys_at``, which reads the order columns a few times when
    called); the rows between them are the slice.  ``head_n`` is the cheaper way to the first few rows.
    """
    return rows_between(df, order, start, stop)


def lookup_rows_by_label(df: DataFrame, key: str, labels: list, *columns: str) -> DataFrame:
    return df.filter(F.col(key).isin(labels)).select(*(columns or ["*"]))


def drop_rows_by_label(df: DataFrame, key: str, *labels: object) -> DataFrame:
    return df.filter(~F.coalesce(F.col(key).isin(list(labels)), F.lit(False)))


def with_position(df: DataFrame, *order: Column | str, name: str = "position", total: str | None = None, partitions: int | None = None) -> DataFrame:
    """Number all rows 0, 1, 2, ... in the given order without gathering them in one task.
    ``total`` names a further column for the number of rows; ``partitions`` sets into how many parts they are sorted.

    Rows are range-partitioned and sorted, each noting its place in its partition, and written.  The
    row counts per partition, at most one row each per shuffle partition, are then summed up and joined
    back as offsets.  The order should end in a unique column, which also keeps repeated values of the
    leading columns from ending up in one partition.
    """
    order = ascending(*order)
    ranged = (
        (df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order))
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    stored = materialize(ranged, "ordered").withColumns(
        {"_part": F.shiftright("_slot", _ROW_BITS), "_row": F.col("_slot").bitwiseAND((1 << _ROW_BITS) - 1)}
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_rows"))
    starts = sizes.select(
        "_part",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        F.sum("_rows").over(Window.partitionBy()).alias("_total"),
    )
    placed = stored.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_row"))
    if total:
        placed = placed.withColumnRenamed("_total", total)
    return placed.drop("_part", "_row", "_slot", "_start", "_total")


def with_position_by(df: DataFrame, groups: list[str], *order: Column | str, name: str = "position") -> DataFrame:
    """Number rows within groups.  For report tables, whose groups have one row per feature; use
    ``with_position`` for tables of unknown size."""
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(*ascending(*order))) - 1
    return df.withColumn(name, place.cast("bigint"))


def totals_last(df: DataFrame, label: str, *groups: str, total: str = "Total") -> DataFrame:
    """Sort by label with the total rows behind all others."""
    is_total = F.coalesce(F.col(quoted(label)) == total, F.lit(False))
    return df.orderBy(*ascending(*groups, is_total, label))
