"""Joins.

Size rule: only tables made from literals in this package carry a broadcast hint.  All other sides are
left to Spark, which broadcasts below ``spark.sql.autoBroadcastJoinThreshold`` by measured size and
otherwise shuffles, splitting skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.aggregates import group_sum

UNASSIGNED = "Unassigned"


def merge_inner(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str | None = None,
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Inner join on one key, named differently or not; other columns with equal names get suffixes."""
    right_on = right_on or left_on
    shared = (set(left.columns) & set(right.columns)) - {left_on, right_on}
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    if right_on != left_on:
        right = right.withColumnRenamed(right_on, left_on)
    return left.join(right, left_on, "inner")


def lookup(df: DataFrame, mapping: DataFrame, key: str, mapping_key: str | None = None, values: Sequence[str] = ()) -> DataFrame:
    """Left join to a mapping; rows without a match keep nulls."""
    mapping_key = mapping_key or key
    values = list(values) or [c for c in mapping.columns if c != mapping_key]
    side = mapping.select(F.col(mapping_key).alias("_lookup"), *values)
    return df.join(side, F.col(key) == F.col("_lookup"), "left").drop("_lookup")


def literal_lookup(df: DataFrame, pairs: dict[str, str], key: str, value: str) -> DataFrame:
    """Left join to a table built from literals, whose exact size Spark knows."""
    table = literal_table(df.sparkSession, [("_lookup", "string"), (value, "string")], list(pairs.items()))
    return df.join(table, F.col(key) == F.col("_lookup"), "left").drop("_lookup")


def literal_table(spark: SparkSession, fields: Sequence[tuple[str, str]], rows: Sequence[tuple]) -> DataFrame:
    """A lookup from literals.  It goes in as one Arrow table, so Spark knows its exact size."""
    arrow = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}
    schema = pa.schema([(name, arrow[kind]) for name, kind in fields])
    columns = [pa.array(values, f.type) for values, f in zip(zip(*rows), schema)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=schema))


def map_or_unassigned(
    df: DataFrame,
    mapping: DataFrame,
    key: str,
    mapping_key: str,
    mapped: str,
    keys: Sequence[str],
    measure: str = "impressions",
    fold_case: bool = False,
) -> DataFrame:
    """Replace names through a mapping, unknown ones by 'Unassigned', and sum per new name.

    Rows are summed per raw name before the join, so one name holding much of the input has shrunk to
    a few partial sums by the time anything is shuffled or joined.
    """
    raw = df.withColumn(key, F.lower(key)) if fold_case else df
    side = mapping.select((F.lower(mapping_key) if fold_case else F.col(mapping_key)).alias(mapping_key), mapped).distinct()
    per_name = group_sum(raw, [key, *keys], measure)
    named = lookup(per_name, side, key, mapping_key, [mapped])
    named = named.withColumn(key, F.coalesce(mapped, F.lit(UNASSIGNED))).drop(mapped)
    return group_sum(named, [key, *keys], measure)


def anti_unmapped(df: DataFrame, mapping: DataFrame, key: str, mapping_key: str, fold_case: bool = False) -> DataFrame:
    """Rows whose name the mapping does not know, null names included."""
    name = F.lower(key) if fold_case else F.col(key)
    known = mapping.select((F.lower(mapping_key) if fold_case else F.col(mapping_key)).alias("_known"))
    return df.withColumn("_name", name).join(known, F.col("_name") == F.col("_known"), "left_anti").drop("_name")


def combine_scalars(a: DataFrame, b: DataFrame) -> DataFrame:
    """Put the columns of two one-row tables side by side, by a union and an aggregate: no cross join."""
    both = a.unionByName(b, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def attach_order_key(df: DataFrame, rank: Column, name: str = "order_key") -> DataFrame:
    return df.withColumn(name, rank).orderBy(F.col(name).asc_nulls_last())
