"""Aggregations with the null rules of the wrangling scripts: null keys drop out, an all-null sum is 0."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import quoted

TOTAL = "decimal(38,6)"


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in which every key is present."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def exact_sum(measure: str):
    """Decimal sum, so the result does not depend on the order of the rows; 0 when all are null."""
    return F.coalesce(F.sum(F.col(measure)), F.lit(0)).cast(TOTAL)


def group_sum(df: DataFrame, keys: Sequence[str], *measures: str) -> DataFrame:
    """Sum decimal measures per key."""
    measures = measures or ("impressions",)
    return keyed(df, keys).groupBy(*keys).agg(*[exact_sum(m).alias(m) for m in measures])


def sum_complete(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Sum per key over the rows in which keys and measure are all present."""
    return group_sum(df.dropna(subset=[*keys, measure]), keys, measure)


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def value_counts(df: DataFrame, column: str, n: int | None = None, name: str = "n") -> DataFrame:
    """Counts of the non-null values, largest first, equal counts by value."""
    counts = count_by(df.filter(F.col(column).isNotNull()), column, name=name)
    ranked = counts.orderBy(F.col(name).desc(), F.col(column))
    return ranked if n is None else ranked.limit(n)


def count_non_null(df: DataFrame) -> DataFrame:
    """One row per column with its number of non-null values: one aggregate over the table."""
    counts = df.agg(*[F.count(F.col(quoted(c))).alias(f"_{i}") for i, c in enumerate(df.columns)])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("non_null")) for i, c in enumerate(df.columns)]
    return counts.select(F.inline(F.array(*pairs)))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def profile_table(df: DataFrame) -> DataFrame:
    """Position, name, type and non-null count of every column."""
    facts = F.create_map(*[x for i, (c, t) in enumerate(df.dtypes) for x in (F.lit(c), F.struct(F.lit(i).cast("bigint").alias("position"), F.lit(t).alias("dtype")))])
    fact = facts[F.col("column_name")]
    return count_non_null(df).select(
        fact["position"].alias("position"), "column_name", fact["dtype"].alias("dtype"), "non_null"
    )


def global_sum(df: DataFrame, *measures: str) -> DataFrame:
    return df.agg(*[exact_sum(m).alias(m) for m in measures])


def min_max_by(df: DataFrame, key: str, column: str, first: str = "first", last: str = "last") -> DataFrame:
    return df.groupBy(key).agg(F.min(column).alias(first), F.max(column).alias(last))


def unique_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def corr_matrix(df: DataFrame, *columns: str) -> DataFrame:
    """Pearson correlation of every pair of columns, all in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    return row.unpivot([], row.columns, "pair", "corr").select(
        F.split("pair", r"\|")[0].alias("column_a"), F.split("pair", r"\|")[1].alias("column_b"), "corr"
    )
