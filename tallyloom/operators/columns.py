"""Projections and schema edits."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.text import quoted, try_number


def select_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names)


def select_by_position(df: DataFrame, *positions: int) -> DataFrame:
    return df.select(*[quoted(df.columns[i]) for i in positions])


def columns_with(df: DataFrame, word: str, without: str | None = None) -> list[str]:
    """Names that contain a word (and not another one), ignoring case."""
    return [
        c for c in df.columns
        if word.lower() in c.lower() and not (without and without.lower() in c.lower())
    ]


def select_by_name_pattern(df: DataFrame, word: str, without: str | None = None) -> DataFrame:
    return df.select(*[quoted(c) for c in columns_with(df, word, without)])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop by name; names that are not there are ignored."""
    return df.drop(*names)


def rename_columns(df: DataFrame, mapping: dict[str, str] | Sequence[str]) -> DataFrame:
    """Rename by a map or, with a list, all columns in order."""
    if isinstance(mapping, dict):
        return df.withColumnsRenamed(mapping)
    return df.toDF(*mapping)


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def measure_column(names: Iterable[str]) -> str:
    """The one column that holds impressions.

    Tried in turn, each accepted only if exactly one name fits: contains 'imp'; contains 'net counted
    ads' or 'imp'; contains 'imp' and 'deliver'.
    """
    names = list(names)
    rules = (
        lambda c: "imp" in c,
        lambda c: "net counted ads" in c or "imp" in c,
        lambda c: "imp" in c and "deliver" in c,
    )
    for rule in rules:
        fits = [n for n in names if rule(n.lower())]
        if len(fits) == 1:
            return fits[0]
    raise ValueError(f"no single impressions column among {names}")


def detect_measure_column(df: DataFrame, to: str = "Impressions") -> DataFrame:
    return df.withColumnRenamed(measure_column(df.columns), to)


def add_constant(df: DataFrame, **values: object) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def ratio(a: Column, b: Column) -> Column:
    """a / b, null when b is 0."""
    return F.try_divide(a, b)


def row_sum(*cols: Column) -> Column:
    """Sum across a row; null if any part is null."""
    return reduce(lambda a, b: a + b, cols)


def cast_type(df: DataFrame, **types: str) -> DataFrame:
    """Convert columns; values that do not fit the new type become null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def infer_numeric_columns(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Turn text columns into numbers, each only if every one of its values parses.

    One aggregate over the table decides for all columns; a single row comes back to the driver.
    """
    texts = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and (names is None or f.name in names)
    ]
    if not texts:
        return df
    number = {c: try_number(F.col(quoted(c))) for c in texts}
    bad = df.agg(*[F.count_if(F.col(quoted(c)).isNotNull() & number[c].isNull()).alias(c) for c in texts]).first()
    return df.select(*[number[c].alias(c) if c in number and bad[c] == 0 else F.col(quoted(c)) for c in df.columns])
